"""Schema discovery of a zone (Q6): one sub-folder per asset, one row per column.

What each file says of its columns is data: the values of JSON and CSV lines
and the footers of Parquet and ORC files give (asset, column, type) rows in
tasks, and one aggregation folds the types of a column to the narrowest type
that holds them all.  The driver reads no file and sees no schema.

* JSON: a line is an object (other lines are ignored); columns stand in the
  order of their names.  Whole numbers are ``bigint``, other numbers
  ``double``, a column of nulls or of unlike types ``string``.
* CSV: the first line of a file that isn't blank names its columns; empty cells
  tell nothing, cells beyond the header are ignored.  A line is a record, so a
  quoted cell doesn't span lines.
* Parquet and ORC: footers are read through pyarrow's file systems.

An asset has one format: that of its files which comes first in ``FORMATS``.
Columns of several files are ordered by their least position, then by name.  An
empty zone has no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.orc as po
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.sources.file_sets import opened

FORMATS = ("parquet", "json", "csv", "orc")
#: Towers of types, each held by those after it.
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")
TIMES = ("date", "timestamp")

_CELL = r',("(?:[^"\\]|\\.|"")*"|[^,]*)'


def widest(types: Column) -> Column:
    """The narrowest type that holds all of a set of type names (none: string)."""
    known = F.array_remove(types, "void")

    def top(tower: tuple[str, ...]) -> Column:
        out = F.lit(None).cast("string")
        for t in tower:
            out = F.when(F.array_contains(known, t), F.lit(t)).otherwise(out)
        return out

    def within(tower: tuple[str, ...]) -> Column:
        return F.size(F.array_except(known, F.array(*map(F.lit, tower)))) == 0

    # a float doesn't hold every int
    number = F.when(F.array_contains(known, "float") & (F.array_contains(known, "int") | F.array_contains(known, "bigint")), "double").otherwise(top(NUMBERS))
    return (F.when(F.size(known) == 0, "string").when(F.size(known) == 1, known[0])
            .when(within(NUMBERS), number).when(within(TIMES), top(TIMES)).otherwise("string"))


def _asset(path: Column, zone_dir: str) -> Column:
    root = re.sub(r"^[a-z0-9]+:/*(?=/)", "", zone_dir.rstrip("/")).lstrip("/")
    return F.regexp_extract(path, r"^(?:[a-z0-9]+:)?/*" + re.escape(root) + r"/([^/]+)/.+$", 1)


def _lines(spark: SparkSession, zone_dir: str, ending: str) -> DataFrame:
    raw = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{ending}").text(zone_dir)
           .select("value", "_metadata.file_path", "_metadata.file_block_start"))
    path = F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B")))
    return raw.withColumn("asset", _asset(path, zone_dir)).filter((F.col("asset") != "") & (F.trim("value") != ""))


def _variant_type(shape: Column) -> Column:
    """A variant's schema as a type name of Spark's JSON reader."""
    out = F.regexp_replace(shape, r"\bDECIMAL\(\d+,\d+\)(?=[,>]|$)", "DOUBLE")
    for told, name in (("VOID", "string"), ("VARIANT", "string"), ("STRING", "string"), ("BIGINT", "bigint"), ("DOUBLE", "double"), ("BOOLEAN", "boolean")):
        out = F.regexp_replace(out, rf"\b{told}(?=[,>]|$)", name)
    out = F.regexp_replace(out, r"(^|[:<]\s?)OBJECT<", "$1struct<")
    out = F.regexp_replace(out, r"(^|[:<]\s?)ARRAY<", "$1array<")
    return F.regexp_replace(out, r"([:,]) ", "$1")


def _json_columns(spark: SparkSession, zone_dir: str) -> DataFrame:
    parsed = _lines(spark, zone_dir, "json").select("asset", F.try_parse_json("value").alias("row"))
    pairs = parsed.filter(F.expr("schema_of_variant(row) LIKE 'OBJECT<%'")).lateralJoin(spark.tvf.variant_explode(F.col("row").outer()))
    folded = pairs.groupBy("asset", F.col("key").alias("column_name")).agg(F.schema_of_variant_agg("value").alias("shape"))
    return folded.select("asset", F.lit("json").alias("format"), F.lit(0).alias("position"), "column_name", _variant_type(F.col("shape")).alias("type"))


def _cells(line: Column) -> Column:
    # a comma before the line gives every cell one, and every match a character
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1))
    return F.transform(found, lambda c: F.when(c.startswith('"'), F.regexp_replace(F.regexp_replace(c, r'^"|"$', ""), r'\\(.)|"(")', "$1$2")).otherwise(F.trim(c)))


def _cell_type(cell: Column) -> Column:
    number = cell.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$") | cell.isin("NaN", "Inf", "-Inf")
    whole = cell.rlike(r"^[+-]?\d+$")
    return (F.when(whole & cell.try_cast("int").isNotNull(), "int").when(whole & cell.try_cast("bigint").isNotNull(), "bigint")
            .when(number, "double")
            .when(cell.rlike(r"^\d{4}-\d{2}-\d{2}$") & cell.try_cast("date").isNotNull(), "date")
            .when(cell.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}") & cell.try_cast("timestamp").isNotNull(), "timestamp")
            .when(F.lower(cell).isin("true", "false"), "boolean").otherwise("string"))


def _csv_columns(spark: SparkSession, zone_dir: str) -> DataFrame:
    # lines of a block keep their order, so a file's header is the first line of its first block
    lines = _lines(spark, zone_dir, "csv").withColumn("at", F.monotonically_increasing_id())
    first = lines.filter(F.col("file_block_start") == 0).groupBy("file_path").agg(F.min("at").alias("header"), F.min_by("value", "at").alias("names"))
    first = first.withColumn("names", _cells(F.col("names")))
    body = lines.join(first, "file_path").withColumn("header", F.col("at") == F.col("header"))
    cells = body.select("asset", "header", "names", F.posexplode(F.when(F.col("header"), F.col("names")).otherwise(_cells(F.col("value")))).alias("position", "cell"))
    cells = cells.filter(F.col("position") < F.size("names"))
    told = F.when(F.col("header") | (F.col("cell") == ""), "void").otherwise(_cell_type(F.col("cell")))
    return cells.select("asset", F.lit("csv").alias("format"), "position", F.col("names")[F.col("position")].alias("column_name"), told.alias("type"))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import from_arrow_type

    for batch in batches:
        rows = []
        for asset, kind, path in zip(*(c.to_pylist() for c in batch.columns)):
            fs, name = opened(quote(path, safe="/:@"))
            with fs.open_input_file(name) as f:
                if kind == "orc":
                    schema, old_times = po.ORCFile(f).schema, set()
                else:
                    file = pq.ParquetFile(f)
                    schema = file.schema_arrow
                    flat = [file.schema.column(i) for i in range(len(file.schema))]
                    old_times = {c.path for c in flat if c.physical_type == "INT96"}
                for i, field in enumerate(schema):
                    told = "timestamp" if field.name in old_times else from_arrow_type(field.type).simpleString()
                    rows.append((asset, kind, i, field.name, told))
        cols = list(zip(*rows)) or [()] * 5
        types = (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["asset", "format", "position", "column_name", "type"])


def discover(spark: SparkSession, zone_dir: str) -> DataFrame:
    """(asset, format, position, column_name, data_type, nullable) of a zone's assets."""
    # contents aren't read: the scan selects paths only
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(zone_dir).select("path")
    files = paths.select(_asset(F.col("path"), zone_dir).alias("asset"), F.lower(F.regexp_extract("path", r"/[^/_.][^/]*\.([A-Za-z0-9]+)$", 1)).alias("format"), "path")
    files = files.filter((F.col("asset") != "") & F.col("format").isin(*FORMATS))
    rank = F.array_position(F.array(*map(F.lit, FORMATS)), F.col("format"))
    chosen = files.groupBy("asset").agg(F.min_by("format", rank).alias("format"))
    stored = (files.filter(F.col("format").isin("parquet", "orc"))
              .mapInArrow(_footers, "asset string, format string, position int, column_name string, type string"))
    told = stored.unionByName(_json_columns(spark, zone_dir)).unionByName(_csv_columns(spark, zone_dir))
    folded = (told.groupBy("asset", "format", "column_name").agg(F.min("position").alias("least"), F.collect_set("type").alias("types"))
              .join(chosen, ["asset", "format"], "left_semi"))
    place = F.row_number().over(Window.partitionBy("asset").orderBy("least", "column_name")) - 1
    return folded.select("asset", "format", place.alias("position"), "column_name", widest(F.col("types")).alias("data_type"), F.lit(True).alias("nullable"))
