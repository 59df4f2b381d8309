"""Joins, sorts and top-k that hold when one key or score owns a large part of the rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

# A key with more rows than this is spread over ceil(rows / HOT_ROWS) join tasks.
HOT_ROWS = 2_000_000
# A key is only hot with more than 1 / HOT_KEYS of all rows, which bounds the list of hot keys.
HOT_KEYS = 10_000
# Items that the frequency sketch of a task holds. Its error is at most 3.5 / 2^17 of the rows, so
# that no key with 1 / HOT_KEYS of them can be missing from what it reports.
TRACKED = 98_000
# Rows without a key match nothing and are spread freely.
KEYLESS_SALTS = 1 << 20


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, salts) of the keys above ``hot_rows`` rows and above 1 / HOT_KEYS of all rows.

    One aggregate with a mergeable heavy-hitter sketch names the candidates; only where there
    are any, a second one counts exactly those. The list is a local table of less than HOT_KEYS
    rows: both sides of a join see the same one, and the join's plan does not scan the rows for it.
    """
    keyed = rows.filter(F.col(key).isNotNull()).select(key)
    seen = keyed.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED})").alias("top")).first()
    least = max(hot_rows, seen["n"] / HOT_KEYS)
    candidates = [t["item"] for t in seen["top"] if t["count"] > least]
    spark, kind = rows.sparkSession, keyed.schema[key].dataType.simpleString()

    def local(**columns: list) -> DataFrame:
        kinds = {key: kind, "salts": "int"}
        return spark.createDataFrame(pa.table(columns), ", ".join(f"`{name}` {kinds[name]}" for name in columns))

    exact = []
    if candidates:
        counted = keyed.join(F.broadcast(local(**{key: candidates})), key).groupBy(key).agg(F.count("*").alias("n"))
        exact = counted.filter(F.col("n") > least).collect()
    return local(**{key: [r[key] for r in exact], "salts": [-(-r["n"] // hot_rows) for r in exact]})


def salted_left_join(
    rows: DataFrame, lookup: DataFrame, key: str, spread_by: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``rows`` left join ``lookup`` on ``key``, where ``lookup`` has one row per key.

    The rows of a hot key are dealt out over several salts and its one lookup row
    is repeated for each. All other keys keep salt 0. The task id takes part in
    the salt, so that exact copies of one row are dealt out as well.
    """
    hot = hot_keys(rows, key, hot_rows)
    deal = F.xxhash64(spread_by) + F.spark_partition_id()
    keyless = F.when(F.col(key).isNull(), F.pmod(deal, F.lit(KEYLESS_SALTS)))
    if hot.isEmpty():
        salted_rows = rows.withColumn("salt", keyless.otherwise(0).cast("int"))
        salted_lookup = lookup.withColumn("salt", F.lit(0))
    else:
        # Less than HOT_KEYS rows.
        hot = F.broadcast(hot)
        salt = keyless.when(F.col("salts").isNotNull(), F.pmod(deal, F.col("salts"))).otherwise(0)
        salted_rows = rows.join(hot, key, "left").withColumn("salt", salt.cast("int")).drop("salts")
        last_salt = F.coalesce(F.col("salts"), F.lit(1)) - 1
        salted_lookup = (
            lookup.join(hot, key, "left")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), last_salt)))
            .drop("salts")
        )
    return salted_rows.join(salted_lookup, [key, "salt"], "left").drop("salt")


def ordered(df: DataFrame, *keys: Column) -> DataFrame:
    """Total order; the task id comes last so that equal rows can be cut into ranges too."""
    return df.withColumn("lane", F.spark_partition_id()).orderBy(*keys, "lane").drop("lane")


def top_k(df: DataFrame, k: int, score: str, *ties: str) -> DataFrame:
    """The first k rows by falling ``score`` (null last), then by the columns ``ties``.

    The rows are counted by score first; the counts, one row for each distinct score
    (a rate has at most 10,001), tell the score at which the k-th row lies. Rows above
    it are all in, whatever their number; only those that tie at it compete by id, and only
    when not all of them fit. ``df`` is read up to three times: pass a stored table.
    """
    by_score = F.struct(F.col(score).isNotNull().alias("known"), F.col(score).alias("score"))
    counted = df.groupBy(by_score.alias("s")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = counted.withColumn("before", before).filter(F.col("before") < k).orderBy("s").first()
    if cut is None:
        return df.limit(0)
    known, value, room = cut["s"]["known"], cut["s"]["score"], k - cut["before"]
    at = F.col(score) == F.lit(value) if known else F.col(score).isNull()
    above = F.col(score) > F.lit(value) if known else F.col(score).isNotNull()
    if cut["n"] <= room:
        kept = df.filter(above | at)
    else:
        kept = df.filter(above).unionByName(df.filter(at).orderBy(*ties).limit(room))
    return kept.orderBy(F.col(score).desc_nulls_last(), *ties)
