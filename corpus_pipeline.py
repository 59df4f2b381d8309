"""The corpus pipeline: toxicity, near duplicates, benchmark, mixing, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
in the shared folder and read again as the docs of the next one. All but the last return
the columns of documents; the last one returns the shard and slot of each row kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from authledger.llm import decontamination, mixing, near_dedup, sharding, toxicity
from authledger.llm.common import remove, stored, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, width=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs)


STAGES = [("toxicity", toxic), ("near_dedup", near), ("decontamination", benchmark), ("mixing", mix), ("sharding", shard)]

# Trained models decide two stages, so that SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, written = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if read:
            # What this stage has read is not needed once its own rows are there.
            remove(spark, read)
        read = written
    return docs
