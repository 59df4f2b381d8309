"""Bundle files: one JSON document per file, ``entry[].resource`` inside.

Everything is JVM-side and narrow: a file is parsed, judged and exploded in the
task that read it, without a shuffle. An ordinary file is parsed once, straight
into the fields that the wanted tables read and nothing else, contained resources
included. Only a file with something odd in it is looked at a second time, resource
by resource as text, to tell what can still be used from what makes the file
unreadable.

Spark's file sources pass over files of length 0 when they plan a scan, but list
them: an inventory starts from the listing and joins what a scan knows of each file.

A file costs a create, a rename, an entry in the driver's file index and an open, however
small it is. Many small bundles are therefore packed: a Parquet table in the schema of
Spark's binary file source, a row per bundle, whose files grow with the bytes.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from authledger import schemas

DOCUMENT_AS_TEXT = "document struct<entry: array<struct<resource: string>>>, damage string"
# A null list reads like an absent one but is an error.
NULL_LIST = r'"(entry|contained)"[ \t\r\n]*:[ \t\r\n]*null'

# An entry whose resource is one of these holds nothing and is passed over.
EMPTY_RESOURCES = "'', '{}', '[]', '0', '0.0', 'false'"
EMPTY_CONTAINERS = "'', '{}'"

ALL_TABLES = tuple(schemas.TABLE_FIELDS)

# --- files ------------------------------------------------------------------


# Columns of a packed folder: those of the binary file source, the text in place of the bytes.
PACKED = "path string, modificationTime timestamp, length bigint, content string"
# A reader's batch never crosses a row group, so this bounds its memory for any size of bundle.
PACKED_ROW_GROUP = 4 << 20


def pack_bundles(files: DataFrame, path: str) -> None:
    """Add the bundles (name, value) to a packed folder."""
    packed = files.select(
        F.col("name").alias("path"),
        F.current_timestamp().alias("modificationTime"),
        F.octet_length("value").cast("bigint").alias("length"),
        F.col("value").alias("content"),
    )
    packed.write.option("parquet.block.size", PACKED_ROW_GROUP).mode("append").parquet(path)


def read_bundles(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """(file_path, value), one row per file that holds anything, in the folder and below.

    Of a ``packed`` folder, one row per bundle that holds anything.
    """
    if packed:
        members = spark.read.schema(PACKED).parquet(path).filter("length > 0")
        return members.select(F.col("path").alias("file_path"), F.col("content").alias("value"))
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), "value")


def _one_slash(path: str) -> str:
    """Listing and scan write the root of a local path differently."""
    return f"regexp_replace({path}, '^file:/+', 'file:/')"


def bundle_inventory(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """(file_path, length, modified) of every file in the folder and below, empty ones too.

    The names are those of the file index that Spark's driver makes for any scan. Length and
    time come from the metadata columns of the binary source, read in tasks without the
    contents; a listed file that the scan passes over has length 0 and no time. Of a ``packed``
    folder the same columns are read, of every bundle, again without the contents.
    """
    if packed:
        members = spark.read.schema(PACKED).parquet(path)
        return members.select(F.col("path").alias("file_path"), "length", F.col("modificationTime").alias("modified"))
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = pa.table({"listed": pa.array(scan.inputFiles(), pa.string())})
    listed = spark.createDataFrame(names).selectExpr(f"{_one_slash('listed')} AS file_path")
    known = scan.selectExpr(
        f"{_one_slash('_metadata.file_path')} AS scanned",
        "_metadata.file_size AS length",
        "_metadata.file_modification_time AS modified",
    )
    return listed.join(known, F.col("file_path") == F.col("scanned"), "left").select(
        "file_path", F.coalesce("length", F.lit(0).cast("bigint")).alias("length"), "modified"
    )


def empty_files(inventory: DataFrame) -> DataFrame:
    """(file_path, value) of the files without any content; they cannot be read as bundles."""
    return inventory.filter("length = 0").select("file_path", F.lit("").alias("value"))


def arrival_report(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count("*").alias("file_count"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        F.count_if(F.col("length") == 0).alias("empty_files"),
    )


def assert_arrived(spark: SparkSession, path: str) -> int:
    """Number of bundle files that hold anything below ``path``; raises when there is none."""
    report = arrival_report(bundle_inventory(spark, path)).first()
    files = report["file_count"] - report["empty_files"]
    if files == 0:
        raise FileNotFoundError(f"no bundle file has arrived in {path}; {report['empty_files']} are empty")
    return files


# --- parsing ----------------------------------------------------------------

# The expressions below are SQL text: lambdas over nested lists read better that
# way, and each reaches Spark in one call. ``{x}`` stands for a resource.

STRICT = "map('allowSingleQuotes', 'false', 'columnNameOfCorruptRecord', 'damage')"
WRAPPED = """concat('{"document":', value, '}')"""


def _json(text: str, schema: str, *options: str) -> str:
    return f"from_json({text}, '{schema}'{''.join(f', {o}' for o in options)})"


class Shape:
    """SQL text of the parse for some fields of a resource.

    The document is parsed as a field of an object around it: text after the
    document, a second document or an empty file is then a syntax error.
    """

    def __init__(self, fields: list[str], types: Iterable[str] | None = None):
        self.fields = fields
        members = schemas.resource_type(fields)
        self.resource = f"struct<{members}, contained: array<struct<{members}>>>"
        self.document = f"document struct<entry: array<struct<resource: {self.resource}>>>, damage string"
        self.rows_type = (
            f"array<struct<resource_type: string, resource_id: string, is_contained: boolean, r: struct<{members}>>>"
        )
        self.no_rows = f"CAST(array() AS {self.rows_type})"
        self.types = None if types is None else ", ".join(f"'{t}'" for t in types)

    def row(self, x: str, resource_id: str, contained: str) -> str:
        parts = ", ".join(f"'{name}', {x}.`{name}`" for name in self.fields)
        return (
            f"named_struct('resource_type', coalesce({x}.resourceType, ''), 'resource_id', {resource_id}, "
            f"'is_contained', {contained}, 'r', named_struct({parts}))"
        )

    def rows(self, x: str) -> str:
        """A resource, followed by its contained resources (one level)."""
        # concat is NULL for a child without id, which stays without one.
        child = self.row("child", f"concat(coalesce({x}.id, 'unknown'), '_', child.id)", "true")
        top = f"array({self.row(x, f'{x}.id', 'false')})"
        both = f"concat({top}, transform({x}.contained, child -> {child}))"
        return f"CASE WHEN {x}.contained IS NULL THEN {top} ELSE {both} END"

    def only_wanted(self, rows: str) -> str:
        return rows if self.types is None else f"filter({rows}, row -> row.resource_type IN ({self.types}))"

    @property
    def parsed(self) -> str:
        """The document as a struct; NULL for one with a list that is null."""
        return (
            f"CASE WHEN contains(value, 'null') AND value RLIKE '{NULL_LIST}' THEN NULL "
            f"ELSE {_json(WRAPPED, self.document, STRICT)} END"
        )

    @property
    def quick_rows(self) -> str:
        """Rows of an ordinary file; NULL for one with something the quick parse cannot judge."""
        return f"""
CASE WHEN parsed.damage IS NULL AND parsed.document IS NOT NULL AND NOT coalesce(
  exists(parsed.document.entry, entry ->
    entry IS NULL
    OR (entry.resource IS NOT NULL AND entry.resource.resourceType IS NULL)
    OR coalesce(exists(entry.resource.contained, child -> child IS NULL), false)), false)
THEN coalesce({self.only_wanted(f'''
  flatten(transform(parsed.document.entry, entry ->
    CASE WHEN entry.resource IS NULL THEN {self.no_rows} ELSE {self.rows("entry.resource")} END))''')},
  {self.no_rows})
END"""

    @property
    def rows_again(self) -> str:
        """Rows of an odd file; NULL when it cannot be read. No entry is legal, an entry
        that is no array of objects is not."""
        return f"""
transform(array({_json(WRAPPED, DOCUMENT_AS_TEXT, STRICT)}), again ->
  CASE WHEN again.damage IS NULL AND again.document IS NOT NULL
    AND (again.document.entry IS NOT NULL
         OR NOT coalesce(array_contains(json_object_keys(value), 'entry'), false))
    AND NOT coalesce(exists(again.document.entry, entry -> entry IS NULL), false)
    AND NOT coalesce(exists(
      filter(again.document.entry.resource, x -> x IS NOT NULL AND x NOT IN ({EMPTY_RESOURCES})),
      resource -> {UNREADABLE}), false)
  THEN coalesce({self.only_wanted(f'''
    flatten(transform(
      transform(
        filter(again.document.entry.resource, x -> x IS NOT NULL AND x NOT IN ({EMPTY_RESOURCES})),
        resource -> {_json("resource", self.resource)}),
      part -> {self.rows("part")}))''')},
    {self.no_rows})
  END)[0]"""


# Resource text that makes its whole file unusable: no object, or a contained list
# that is none or holds anything but objects.
UNREADABLE = f"""
NOT startswith(resource, '{{') OR CASE
  WHEN get_json_object(resource, '$.contained') IS NULL
    THEN coalesce(array_contains(json_object_keys(resource), 'contained'), false)
  WHEN get_json_object(resource, '$.contained') IN ({EMPTY_CONTAINERS}) THEN false
  ELSE coalesce(NOT startswith(get_json_object(resource, '$.contained'), '[')
    OR exists(from_json(get_json_object(resource, '$.contained'), 'array<string>'),
              child -> child IS NULL OR NOT startswith(child, '{{')), true)
END"""


# --- results ----------------------------------------------------------------


def _shape(tables: Iterable[str], types: Iterable[str] | None = None) -> Shape:
    return Shape(schemas.resource_fields(tables), types)


def examine(files: DataFrame, shape: Shape) -> DataFrame:
    """(file_path, value) -> (file_path, value, rows); rows is NULL for an unreadable file."""
    quick = files.withColumn("parsed", F.expr(shape.parsed)).select(
        "file_path", "value", F.expr(shape.quick_rows).alias("quick_rows")
    )
    return quick.select(
        "file_path",
        "value",
        F.expr(f"CASE WHEN quick_rows IS NOT NULL THEN quick_rows ELSE {shape.rows_again} END").alias("rows"),
    )


def resources(files: DataFrame, tables: Iterable[str] = ALL_TABLES, types: Iterable[str] | None = None) -> DataFrame:
    """(file_path, resource_type, resource_id, is_contained, r) of all readable files.

    ``r`` has the fields that ``tables`` read; no other field is converted by the
    parser. With ``types`` other resources are left out before the rows are made.
    A rejected file gives an empty list. A filter on it would be pushed below the
    parse and repeat the parse for every use inside the condition.
    """
    shape = _shape(tables, types)
    return examine(files, shape).select("file_path", F.expr(f"inline(coalesce(rows, {shape.no_rows}))"))


def entries(files: DataFrame) -> DataFrame:
    """Type and id of the top-level resources."""
    return resources(files, ()).filter(~F.col("is_contained")).drop("r")


def contained(files: DataFrame) -> DataFrame:
    """Type and id of the contained resources, under their parent's id."""
    return resources(files, ()).filter("is_contained").drop("r")


def quarantine(files: DataFrame) -> DataFrame:
    """(file_path, value) of the files that give no rows because they cannot be read.

    Whether a file can be read is decided with all fields: the first look at it judges the
    shape of the lists only, which is the same for any choice of fields.
    """
    text = F.array(F.struct("value"))
    return examine(files, _shape(())).select(
        "file_path", F.inline(F.when(F.col("rows").isNull(), text).otherwise(F.slice(text, 1, 0)))
    )


def resources_and_rejects(files: DataFrame, tables: Iterable[str] = ALL_TABLES) -> DataFrame:
    """Both of the above in one pass: a rejected file is one row with ``rejected_text`` set."""
    shape = _shape(tables)
    # The text travels with rejected files only, not with every exploded row.
    judged = examine(files, shape).select(
        "file_path", "rows", F.when(F.col("rows").isNull(), F.col("value")).alias("rejected_text")
    )
    return judged.select(
        "file_path", "rejected_text", F.expr(f"inline(coalesce(rows, CAST(array(NULL) AS {shape.rows_type})))")
    )


def type_distribution(resource_rows: DataFrame, limit: int = 30) -> DataFrame:
    """The most frequent resource types."""
    return (
        resource_rows.groupBy("resource_type")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "resource_type")
        .limit(limit)
    )
