"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A row's place on the ring is a hash of its id, cut into ``CELLS`` cells. Its home is the
shard of the next virtual node clockwise. A shard's load is bounded by its fair number of
rows (counts differ by one at most); what overflows a full shard continues clockwise to
the next shard with room. Law: ``rows``.

Only one (cell, count) row per cell reaches the driver, ``CELLS`` at most whatever the
table holds. There the ring is walked and each cell is cut into runs of ranks; the ranks
themselves, and the slots, are found on the executors, one cell at a time.

Edge cases: a null or empty text has size 1; a null id hashes as the empty string;
repeated rows each get their own slot; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from zlib import crc32

from pyspark.sql import DataFrame, Window, functions as F

from authledger.llm.common import stored

SHARDS, VIRTUAL_NODES, CELLS = 16, 64, 1 << 15
COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def ring(shards: int, nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    return sorted((crc32(f"node {s}/{v}".encode()) % cells, s) for s in range(shards) for v in range(nodes))


def place(counts: dict[int, int], shards: int, cells: int = CELLS) -> list[tuple[int, int, int, int, int]]:
    """Runs (cell, first rank, end rank, shard, slot of the first rank) for the counts per cell."""
    nodes = ring(shards, cells=cells)
    at = [cell for cell, _ in nodes]
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    runs, waiting = [], []

    def take(cell: int, first: int, end: int, shard: int) -> int:
        n = min(end - first, room[shard] - filled[shard])
        if n > 0:
            runs.append((cell, first, first + n, shard, filled[shard]))
            filled[shard] += n
        return first + max(n, 0)

    for cell in sorted(counts):
        home = bisect_left(at, cell) % len(nodes)
        first = take(cell, 0, counts[cell], nodes[home][1])
        if first < counts[cell]:
            waiting.append((cell, first, counts[cell], home))
    for cell, first, end, node in waiting:
        while first < end:
            node = (node + 1) % len(nodes)
            first = take(cell, first, end, nodes[node][1])
    return runs


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: its size, checksum, shard and gapless slot in the shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    digest, _ = stored(
        docs.select(
            "doc_id",
            (F.length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(CELLS))
            .cast("int")
            .alias("cell"),
        ),
        "sharding",
    )
    counts = {r.cell: r.n for r in digest.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    runs = spark.createDataFrame(
        place(counts, shards) or [], "run_cell int, first long, end long, shard int, slot_of_first long"
    )
    ranked = digest.withColumn(
        "rank",
        F.row_number().over(Window.partitionBy("cell").orderBy("doc_id", "size", "text_crc32")).cast("long") - 1,
    )
    # At most CELLS + shards * nodes runs: bounded, however many rows there are.
    found = ranked.join(
        F.broadcast(runs),
        (F.col("cell") == F.col("run_cell")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")),
    )
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot_of_first") + F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


