"""Whitening of embeddings by Jacobi-Davidson over distributed centred products.

Vectors become whole numbers, x = floor(256 * c); the fit list holds every distinct x
once. The covariance is never formed. Every product of it with a few vectors is one
pass over the stored fit list: a task centres its rows first (n * x - S, exact in whole
numbers while below 2^53) and adds up its part; the parts, one small row a task, meet on
the driver, which holds nothing but d x (a few) matrices.

1. Rayleigh-Ritz on the search space gives Ritz pairs; the residuals are taken from
   products that are already there. A leading pair is locked as soon as its residual
   reaches double precision (``TOLERANCE`` of the largest Ritz value).
2. For each wanted pair that is not locked, the correction equation, projected against
   the locked vectors and all current Ritz vectors, is solved by MINRES. The solves
   of all pairs go on side by side, so that one pass over the data serves them all.
3. The corrections widen the search space, which is cut back to its best Ritz vectors
   when it is full. A solve that does not get there in ``OUTER`` rounds raises.

Rows that are dropped: null vectors, vectors with a null, NaN or infinite entry, and
vectors whose length is not the commonest one (ties: the longer). Repeated ids stay
separate rows; null ids stay. Directions without variance give no component, so that one
distinct vector, or an empty table, gives no rows. Equal eigenvalues: any basis of
their space. A deviation too wide for a long is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from authledger.llm.common import sent, stored

COMPONENTS = 4
# Ritz vectors that are improved besides the wanted ones, against close eigenvalues.
GUARDS = 2
TOLERANCE = 128 * np.finfo(float).eps
INNER, OUTER, SPACE = 4, 100, 32
BLOCK_ROWS = 4096

Product = Callable[[np.ndarray], np.ndarray]


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x array<bigint>) of the rows that can be used."""
    # floor gives whole numbers; + 0.0 makes -0 and 0 the same vector.
    usable = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("c")).filter(
        "c IS NOT NULL AND size(c) > 0 AND forall(c, v -> v IS NOT NULL AND abs(v) < double('infinity'))"
    )
    sizes = usable.groupBy(F.size("c").alias("d")).agg(F.count("*").alias("n"))
    width = sizes.agg(F.max_by("d", F.struct("n", "d"))).scalar()
    return usable.filter(F.size("c") == width).select(
        "vec_id", F.expr("transform(c, v -> CAST(floor(256 * v + 0.0D) AS BIGINT))").alias("x")
    )


def fit_blocks(vectors: DataFrame) -> DataFrame:
    """The distinct vectors, packed: (rows, sums, data) with the vectors as 64-bit numbers one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS).column("x")
                x = part.flatten().to_numpy().reshape(len(part), -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)], pa.int64()), pa.array([x.sum(0).tolist()], pa.list_(pa.int64())),
                     pa.array([x.astype("<i8").tobytes()], pa.binary())],
                    names=["n", "sums", "data"],
                )

    return vectors.select("x").distinct().mapInArrow(run, "n bigint, sums array<bigint>, data binary")


def distributed_product(blocks: DataFrame, n: int, sums: np.ndarray) -> Product:
    """b -> V b for a d x k matrix b, by one pass over the fit list."""

    def product(b: np.ndarray) -> np.ndarray:
        width, k = b.shape

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width, k))
            for batch in batches:
                for data in batch.column("data").to_pylist():
                    y = (n * np.frombuffer(data, "<i8").reshape(-1, width) - sums) / n
                    total += y.T @ (y @ b)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

        parts = blocks.select("data").mapInArrow(run, "part binary").collect()
        out = np.zeros((width, k))
        for row in parts:
            out += np.frombuffer(row.part).reshape(width, k)
        return out / n

    return product


def _orthonormal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """The columns of ``t`` made orthonormal to ``against`` and each other; dependent ones go."""
    kept = against
    for j in range(t.shape[1]):
        v = t[:, j].copy()
        start = np.linalg.norm(v)
        if not start:
            continue
        for _ in range(3):
            v -= kept @ (kept.T @ v)
        if np.linalg.norm(v) > 1e-12 * start:
            kept = np.column_stack([kept, v / np.linalg.norm(v)])
    return kept[:, against.shape[1] :]


class Minres:
    """One MINRES solve of P (A - theta) P t = -P r that asks for its products instead of making them."""

    def __init__(self, theta: float, residual: np.ndarray, project: Callable[[np.ndarray], np.ndarray]):
        self.theta, self.project = theta, project
        self.t, self.v_old = np.zeros_like(residual), np.zeros_like(residual)
        self.v = -project(residual)
        self.beta = self.first = self.left = float(np.linalg.norm(self.v))
        self.v = self.v / self.beta if self.beta else self.v
        self.w = self.w_old = np.zeros_like(residual)
        self.c, self.s, self.c_old, self.s_old, self.eta = 1.0, 0.0, 1.0, 0.0, self.beta
        self.done = self.beta == 0

    def step(self, product: np.ndarray, enough: float) -> None:
        """Take up A v; Lanczos step, Givens rotation, update of the solution."""
        u = self.project(product - self.theta * self.v) - (self.beta * self.v_old if self.v_old.any() else 0)
        alpha = float(self.v @ u)
        u -= alpha * self.v
        beta = float(np.linalg.norm(u))
        rho0 = self.c * alpha - self.c_old * self.s * (self.beta if self.v_old.any() else 0.0)
        rho1 = np.hypot(rho0, beta)
        rho2 = self.s * alpha + self.c_old * self.c * (self.beta if self.v_old.any() else 0.0)
        rho3 = self.s_old * (self.beta if self.v_old.any() else 0.0)
        if rho1 == 0:
            self.done = True
            return
        self.c_old, self.s_old, self.c, self.s = self.c, self.s, rho0 / rho1, beta / rho1
        self.w_old, self.w = self.w, (self.v - rho3 * self.w_old - rho2 * self.w) / rho1
        self.t = self.t + self.c * self.eta * self.w
        self.eta = -self.s * self.eta
        self.left = abs(self.eta)
        self.v_old, self.beta = self.v, beta
        if beta <= 1e-15 * max(1.0, abs(self.theta)) or self.left <= enough * self.first:
            self.done = True
        else:
            self.v = u / beta


def jacobi_davidson(product: Product, width: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the largest ``wanted`` eigenvalues, falling."""
    wanted = min(wanted, width)
    block, space = min(wanted + GUARDS, width), min(SPACE, width)
    start = np.random.default_rng(seed).standard_normal((width, block))
    locked, values = np.zeros((width, 0)), []
    q = _orthonormal(start, locked)
    aq = product(q)
    for outer in range(OUTER):
        h = q.T @ aq
        theta, y = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-theta)
        theta, y = theta[order], y[:, order]
        u, au = q @ y, aq @ y
        scale = max([*values, abs(theta[0]) if len(theta) else 0.0, np.finfo(float).tiny])
        residual = au - u * theta
        norm = np.linalg.norm(residual, axis=0)
        # Pairs are locked in falling order only, so that none is passed over.
        ready = 0
        while len(values) + ready < wanted and ready < len(theta) and norm[ready] <= TOLERANCE * scale:
            ready += 1
        if ready:
            locked = np.column_stack([locked, u[:, :ready]])
            values += theta[:ready].tolist()
            theta, u, au, residual = theta[ready:], u[:, ready:], au[:, ready:], residual[:, ready:]
        if len(values) == wanted:
            return np.array(values), locked
        if u.shape[1] > space - block:
            theta, u, au = theta[: 2 * block], u[:, : 2 * block], au[:, : 2 * block]
        q, aq = u, au
        active = min(block, q.shape[1], wanted - len(values) + GUARDS)
        basis = np.column_stack([locked, u[:, :active]])

        def project(v: np.ndarray, basis: np.ndarray = basis) -> np.ndarray:
            v = v - basis @ (basis.T @ v)
            return v - basis @ (basis.T @ v)

        solves = [Minres(theta[j], residual[:, j], project) for j in range(active)]
        for _ in range(INNER):
            running = [s for s in solves if not s.done]
            if not running:
                break
            products = product(np.column_stack([s.v for s in running]))
            for s, p in zip(running, products.T, strict=True):
                s.step(p, max(2.0 ** -(outer + 2), 1e-3))
        # Residuals stand in where a solve came out empty.
        new = np.column_stack([s.t if s.t.any() else residual[:, j] for j, s in enumerate(solves)])
        new = _orthonormal(new, np.column_stack([locked, q]))
        if not new.shape[1]:
            fresh = np.random.default_rng(seed + outer + 1).standard_normal((width, block))
            new = _orthonormal(fresh, np.column_stack([locked, q]))
        if new.shape[1]:
            q, aq = np.column_stack([q, new]), np.column_stack([aq, product(new)])
        elif outer > 3:
            # The space is everything there is: take fresh products against rounding.
            q = _orthonormal(q, locked)
            aq = product(q)
    raise ArithmeticError(f"{len(values)} of {wanted} eigenpairs reached double precision in {OUTER} rounds")


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict | None:
    """n, sums, eigenvalues, eigenvectors, trace and identity error; None without any variance."""
    blocks, _ = stored(fit_blocks(vectors), "whitening-fit")
    whole = blocks.agg(F.sum("n").alias("n")).first().n
    if not whole:
        return None
    sums = np.array([
        r.total for r in blocks.select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("total")).orderBy("i").collect()
    ], dtype=np.int64)
    product = distributed_product(blocks, whole, sums)
    trace = _trace(blocks, whole, sums)
    if trace <= 0:
        return None
    values, basis = jacobi_davidson(product, len(sums), components)
    held = values > len(sums) * np.finfo(float).eps * trace
    values, basis = values[held], basis[:, held]
    if not len(values):
        return None
    white = basis / np.sqrt(values)
    error = np.abs(white.T @ product(white) - np.eye(len(values))).max()
    return {"n": int(whole), "sums": sums, "values": values, "white": white, "trace": trace, "error": float(error)}


def _trace(blocks: DataFrame, n: int, sums: np.ndarray) -> float:
    width = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [((n * np.frombuffer(d, "<i8").reshape(-1, width) - sums) / n) for d in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([float((y * y).sum()) for y in parts], pa.float64())], names=["v"])

    return (blocks.select("data").mapInArrow(run, "v double").agg(F.sum("v").alias("v")).first().v or 0.0) / n


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component."""
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    spark = embeddings.sparkSession
    vectors, _ = stored(whole_vectors(embeddings), "whitening-vectors")
    model = fit(vectors, components)
    if model is None:
        return spark.createDataFrame([], schema)
    get = sent(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = get()
        n, sums, white = m["n"], m["sums"], m["white"]
        k = white.shape[1]
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                column = part.column("x")
                x = column.flatten().to_numpy().reshape(len(column), -1)
                far = n * x - sums
                score = (far / n) @ white
                rows = np.repeat(np.arange(len(x)), k)
                count = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(count, n, np.int64)),
                        _squares(far).take(pa.array(rows)),
                        pa.array(score.ravel()),
                        pa.array(np.tile(m["values"] / m["trace"], len(x))),
                        pa.array(np.full(count, m["error"])),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.mapInArrow(run, schema)


def _squares(far: np.ndarray) -> pa.Array:
    """Sums of squares by row, exact; null beyond a long."""
    if np.square(far.astype(float)).sum(1).max(initial=0.0) < 2.0**62:
        return pa.array((far * far).sum(1))
    exact = [sum(int(v) ** 2 for v in row) for row in far]
    return pa.array([v if v < 2**63 else None for v in exact], pa.int64())
