"""What several corpus operators share: stored steps, labelled samples, small linear models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from authledger.session import scratch_dir

# Rows whose crc32(doc_id as text) has this remainder by 4 are never learnt from.
HELD_OUT = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` written to a new folder of the shared scratch space and read back.

    Cuts the lineage: a lost executor costs a rerun of single tasks of one step.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders of the scratch space that no later step reads."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def held_out(doc_id: Column) -> Column:
    """True, false, never null: rows without an id take part in training."""
    bucket = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(bucket == HELD_OUT, F.lit(False))


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text as UTF-8 bytes): all that the text operators read."""
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"))


def map_texts(
    docs: DataFrame,
    each: Callable[[list[int | None], list[bytes]], dict[str, list]],
    schema: str,
) -> DataFrame:
    """Columns made from whole texts in Arrow batches; a null text counts as empty.

    ``each`` gets the ids and texts of a slice of at most 512 rows, so that what
    it builds stays small whatever the batch size of the session.
    """
    fields = pa.schema([(f.name, _arrow(f.dataType)) for f in T._parse_datatype_string(schema).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                columns = each(
                    part.column("doc_id").to_pylist(),
                    [text or b"" for text in part.column("text").to_pylist()],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in fields], schema=fields
                )

    return texts(docs).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    return simple[kind.simpleString()]


def sent(spark: SparkSession, value: object) -> Callable[[], object]:
    """A function that gives ``value`` on the executors, unpacked once per worker."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get() -> object:
        if not hasattr(packed, "unpacked"):
            packed.unpacked = cloudpickle.loads(packed.value)
        return packed.unpacked

    return get


def keep_rows(docs: DataFrame, keep: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows whose text passes, with every column as it is; no join, so ids may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                raw = part.column("text").cast(pa.binary()).to_pylist()
                yield part.filter(pa.array(keep([text or b"" for text in raw]), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int
) -> list[tuple[bytes, int, float]]:
    """(text, label, weight) of at most ``per_class`` training rows of each class.

    A documented, bounded sample for fitting: rows are taken in the order of a
    hash of the id, so that the choice does not depend on the layout. Weights bring
    the classes back to their true shares. Rows without a label, of null text, or
    labelled differently in two rows are left out.
    """
    training = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .drop("other")
    )
    chosen, weight = None, {}
    for value in (0, 1):
        rows = training.filter(F.col("label") == value)
        weight[value] = rows.count()
        part = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * per_class ids, whatever the tables hold.
    found = texts(docs).join(F.broadcast(chosen), "doc_id").filter("text IS NOT NULL")
    rows = [(bytes(r.text), r.label) for r in found.select("text", "label").collect()]
    n = {value: max(1, sum(1 for _, y in rows if y == value)) for value in (0, 1)}
    total = max(1, sum(weight.values()))
    scale = {value: weight[value] / total * len(rows) / n[value] for value in (0, 1)}
    return sorted((text, y, scale[y]) for text, y in rows)


class Rows:
    """A sparse matrix in row order: a row is a pair of (column numbers, values)."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.n = len(rows)
        lengths = [len(columns) for columns, _ in rows]
        self.row = np.repeat(np.arange(self.n), lengths)
        self.column = np.concatenate([c for c, _ in rows]) if rows else np.zeros(0, np.int64)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.n)

    def transposed_times(self, r: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(
    x: Rows, y: np.ndarray, weight: np.ndarray, width: int, l2: float, steps: int = 250, rate: float = 0.05
) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2 logistic regression; ``y`` may be probabilities."""
    w, b = np.zeros(width), 0.0
    if not x.n:
        return w, b
    m, v, mb, vb, share = np.zeros(width), np.zeros(width), 0.0, 0.0, weight / weight.sum()
    for t in range(1, steps + 1):
        error = share * (sigmoid(x.times(w) + b) - y)
        g, gb = x.transposed_times(error, width) + l2 * w, error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fade = rate * min(1.0, 2.0 * (1 - t / (steps + 1)))
        w -= fade * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        b -= fade * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-9)
    return w, b


def fit_calibration(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the probability sigmoid(slope * raw + offset), slope at least 0.05.

    Newton steps with softened targets, so that separable scores stay finite. With
    fewer than two classes the scores stay as they are.
    """
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(float(np.std(raw)), 1e-6)
    x, centre = (raw - raw.mean()) / scale, raw.mean()
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * x + b)
        r, d = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-6)
        g = np.array([(r * x).sum() + 1e-3 * a, r.sum()])
        h = np.array([[(d * x * x).sum() + 1e-3, (d * x).sum()], [(d * x).sum(), d.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    slope = max(a / scale, 0.05)
    return float(slope), float(b - a / scale * centre)
