"""Whitening against a dense eigensolver, and the solver on matrices that are hard for it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from authledger.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, n int, data string"


def whole(vector):
    return np.floor(256 * np.asarray(vector, np.float32).astype(float)).astype(np.int64) + 0


def compare(rows, got):
    """``rows`` are the usable (id, vector) pairs."""
    x = np.array([whole(v) for _, v in rows])
    fitted = np.unique(x, axis=0)
    n, sums = len(fitted), fitted.sum(0)
    y = fitted - fitted.mean(0)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    scores = (x - sums / n) @ vectors / np.sqrt(values)
    want = {}
    for (vec_id, _), own, score in zip(rows, x, scores):
        for c in range(4):
            want.setdefault((vec_id, c + 1), []).append((score[c], int(((n * own - sums) ** 2).sum())))
    assert len(got) == 4 * len(rows)
    signs = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / np.trace(y.T @ y / n)) < 1e-12
        exact = [(abs(w), w, d) for w, d in want[r.vec_id, r.component]]
        close = min(exact, key=lambda e: abs(e[0] - abs(r.whitened)))
        assert abs(close[0] - abs(r.whitened)) < 1e-8 and r.deviation in {d for _, _, d in exact}
        if close[0] > 1e-6 and len(exact) == 1:
            signs.setdefault(r.component, set()).add(np.sign(close[1]) == np.sign(r.whitened))
    assert all(len(s) == 1 for s in signs.values())


def test_table_matches_a_dense_solver(spark, sample):
    embeddings = spark.read.parquet(f"{sample.replace('sf0.001', 'sf0.01')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in embeddings.collect()]
    compare(rows, whitening.whiten(embeddings).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(9).tolist()) for i in range(60)]
    good += [(3, good[3][1]), (100, good[4][1]), (None, rng.standard_normal(9).tolist()), (61, [-0.0] * 9), (62, [0.0] * 9)]
    bad = [(200, None), (201, [None, *[1.0] * 8]), (202, [float("nan")] * 9), (203, [float("inf")] * 9), (204, []), (205, [1.0, 2.0])]
    rows = [(i, v, "x", 1, "d") for i, v in good + bad]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    compare(good, got)


def test_tables_without_variance_give_no_rows(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    same = [(i, [1.0, 2.0], "x", 1, "d") for i in range(5)]
    assert whitening.whiten(spark.createDataFrame(same, SCHEMA)).count() == 0
    line = [(i, [float(i), 2.0, 2.0 * i], "x", 1, "d") for i in range(5)]
    assert {r.component for r in whitening.whiten(spark.createDataFrame(line, SCHEMA)).collect()} == {1}


def test_wide_deviations_are_exact_or_null():
    far = np.array([[3, 4], [2**31, 2**31], [2**32, 1]])
    assert whitening._squares(far).to_pylist() == [25, None, None]
    assert whitening._squares(np.array([[2**31, 2**30]])).to_pylist() == [2**62 + 2**60]


@pytest.mark.parametrize("kind", ["falling", "close", "rank", "equal", "small"])
def test_solver_reaches_double_precision(kind):
    rng = np.random.default_rng(2)
    d = 3 if kind == "small" else 120
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    values = {
        "falling": 0.8 ** np.arange(d), "close": 1 + 1e-3 * np.arange(d)[::-1], "rank": np.r_[5.0, 3.0, np.zeros(d - 2)],
        "equal": np.r_[[3.0] * 6, [1.0] * (d - 6)], "small": np.arange(d, 0.0, -1),
    }[kind]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, vectors = whitening.jacobi_davidson(lambda b: a @ b, d, 4)
    k = min(4, d)
    assert np.abs(found - values[:k]).max() < 1e-12 * values[0]
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-12 * values[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_extra_columns_do_not_matter(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(4).tolist(), "x", 1, "d") for i in range(30)]
    table = spark.createDataFrame(rows, SCHEMA)
    plain = whitening.whiten(table.select("vec_id", "embedding"))
    both = whitening.whiten(table.withColumn("c", F.lit(1)).withColumn("sums", F.lit(2)))
    pairs = plain.join(both.select("vec_id", "component", F.col("whitened").alias("other")), ["vec_id", "component"])
    assert pairs.filter("abs(whitened - other) > 1e-9").isEmpty()
