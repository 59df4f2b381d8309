"""Stored tables: declared reads, writes that a failed job cannot spoil, counts, order, catalog entries."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from authledger import schemas


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A silver or gold table in its declared column order, without inference."""
    return (
        spark.read.schema(schemas.struct(table)).parquet(f"{root}/{table}").select(*schemas.columns(table))
    )


def _declared(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The stored table; only one that is declared nowhere has its schema taken from its files."""
    reader = spark.read.schema(schemas.struct(table)) if table in schemas.DECLARED else spark.read
    return reader.parquet(f"{root}/{table}")


# --- writes -----------------------------------------------------------------


class Folder:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.files.exists(self.path)

    def delete(self) -> None:
        self.files.delete(self.path, True)

    def move_to(self, other: Folder) -> None:
        if not self.files.rename(self.path, other.path):
            raise OSError(f"cannot rename {self.path} to {other.path}")


def _swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; the old folder goes last, and back if that fails."""
    fresh, place = Folder(spark, new), Folder(spark, path)
    if not place.exists():
        fresh.move_to(place)
        return
    old = Folder(spark, f"{new}-old")
    place.move_to(old)
    try:
        fresh.move_to(place)
    except Exception:
        old.move_to(place)
        raise
    old.delete()


def _shaped(df: DataFrame, table: str) -> DataFrame:
    """Rows of a year together, so that it is not cut into one small file per task; AQE splits a
    year that is too large for one."""
    year = schemas.PARTITION_COLUMNS.get(table)
    return df if year is None else df.hint("rebalance", year)


def write_table(df: DataFrame, root: str, table: str) -> None:
    """Replace a table; tables with a year column are partitioned by it.

    The rows are written beside the table and swapped in by renaming once they are all
    there: a job that fails leaves the old table as it was, and a table may be computed from
    itself. Where renaming is no single step (object stores), readers can meet the swap halfway.
    """
    spark, path = df.sparkSession, f"{root}/{table}"
    # A leading underscore hides the folder from readers of the root.
    new = f"{root}/_new-{table}-{uuid.uuid4().hex}"
    writer = _shaped(df, table).write
    if year := schemas.PARTITION_COLUMNS.get(table):
        writer = writer.partitionBy(year)
    try:
        writer.parquet(new)
        _swap_in(spark, new, path)
    finally:
        Folder(spark, new).delete()


def overwrite_years(df: DataFrame, root: str, table: str) -> None:
    """Replace only the years that ``df`` has rows of; all other years stay.

    Spark stages the new years and moves them in when every task is done.
    """
    year = schemas.PARTITION_COLUMNS[table]
    writer = _shaped(df, table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(year).parquet(f"{root}/{table}")


# --- order ------------------------------------------------------------------


def write_clustered(df: DataFrame, root: str, table: str, *keys: Column) -> None:
    """Replace a table by ranges of ``keys``, each sorted, in files whose names follow the ranges.

    The task id comes last in the ranges, so that rows of equal keys can be cut as well.
    """
    ranged = df.withColumn("lane", F.spark_partition_id()).repartitionByRange(*keys, "lane")
    write_table(ranged.sortWithinPartitions(*keys, "lane").drop("lane"), root, table)


def read_positions(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A clustered table with ``position``, from 1, in the order of its keys; no row is sorted again.

    A file's rows follow those of all files before it; the files are counted, one row each.
    """
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    stored = spark.read.parquet(f"{root}/{table}").withColumn("place", place)
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = (
        stored.groupBy(F.col("place.file").alias("file")).agg(F.count("*").alias("n")).withColumn("before", before)
    )
    return stored.join(files, F.col("place.file") == F.col("file")).select(
        *[c for c in stored.columns if c != "place"], (F.col("before") + F.col("place.row") + 1).alias("position")
    )


# --- counts -----------------------------------------------------------------


@contextmanager
def _footers(spark: SparkSession) -> Iterator[None]:
    """Parquet through the reader that answers counts from the footers of the files."""
    wanted = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    held = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)


def count_plan(spark: SparkSession, root: str, table: str, column: str | None = None) -> DataFrame:
    """The count of a stored table, or of the values of a column that are not null."""
    return _declared(spark, root, table).agg(F.count(column or F.lit(1)).alias("n"))


def count_stored(spark: SparkSession, roots: dict[str, str], of: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """(table_name, row_count) of stored tables, from file footers: no row is read and nothing is planned again.

    ``of`` adds counts under names of their own: name -> (table, column that is not null).
    """
    asked = {name: (name, None) for name in roots} | (of or {})
    with _footers(spark):
        rows = [
            (name, count_plan(spark, roots[table], table, column).first()["n"])
            for name, (table, column) in asked.items()
        ]
    return spark.createDataFrame(rows, "table_name string, row_count bigint")


# --- catalog ----------------------------------------------------------------


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")


def register_table(spark: SparkSession, root: str, table: str, database: str) -> None:
    """Catalog table over the stored files, its partitions discovered from the folders.

    A table that is there already keeps its entry, and with it whatever reads it by name; its
    partitions and cached listing are brought up to date.
    """
    name = f"{database}.{table}"
    year = schemas.PARTITION_COLUMNS.get(table)
    if not spark.catalog.tableExists(name):
        schema = schemas.struct(table) if table in schemas.DECLARED else None
        if schema is None:
            spark.catalog.createTable(name, path=f"{root}/{table}", source="parquet")
        else:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            parted = f"PARTITIONED BY ({year})" if year else ""
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parted} LOCATION '{root}/{table}'")
    if year is not None:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def partition_column(spark: SparkSession, database: str, table: str) -> str | None:
    """The partition column that the catalog knows of."""
    return next((c.name for c in spark.catalog.listColumns(f"{database}.{table}") if c.isPartition), None)
