"""Sources and sinks (S1-S19; file sets are in ``file_sets``).

Reads are lazy DataFrame scans so Catalyst pushes filters and column
pruning into the Parquet reader; writes are plain DataFrameWriter calls.
Every location an operator creates lives under a caller-given root, which on
a cluster is the shared folder from ``spark.checkpoint.dir`` (see
``quarry.session.shared_dir``), never a machine-local temporary folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --------------------------------------------------------------------------
# Reads
# --------------------------------------------------------------------------


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def scan(spark: SparkSession, name: str, sf_dir: str | None = None,
         cols: Sequence[str] | None = None) -> DataFrame:
    """Full table scan.  ``name`` is a catalog table, or a Parquet table
    under ``sf_dir``.  ``cols`` is only a convenience; Catalyst prunes the
    read schema to what the plan uses either way."""
    df = spark.read.parquet(table_path(sf_dir, name)) if sf_dir else spark.table(name)
    return df.select(*cols) if cols else df


def load_ndjson(spark: SparkSession, path: str | Sequence[str],
                schema: StructType | str | None = None,
                order: Sequence[str] | None = None) -> DataFrame:
    """Newline-delimited JSON.  Without ``schema`` the reader infers
    one (an extra pass over the input: avoid at scale); inferred struct
    fields come back in alphabetical order, so ``order`` restores the
    declared column order."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    return df.select(*order) if order else df


def scan_family(spark: SparkSession, base: str, suffix_pred: Callable[[Column], Column] | None = None,
                suffix_col: str = "suffix") -> DataFrame:
    """A table family stored as one dataset partitioned by ``suffix``.
    The predicate on the suffix is a partition filter: files of other
    members are never listed or opened.  Comparison is textual, like the
    wildcard-table suffix it replaces."""
    df = spark.read.option("basePath", base).parquet(base)
    if suffix_pred is not None:
        df = df.filter(suffix_pred(F.col(suffix_col).cast("string")))
    return df


def write_family(df: DataFrame, base: str, suffix: Column, suffix_col: str = "suffix",
                 mode: str = "overwrite", max_records_per_file: int = 5_000_000) -> str:
    """Lay a family out as ``base/suffix=<s>/``.  Rows are *not* shuffled by
    the suffix: a member holding a third of all rows would then be written
    by a single task.  Each task writes its own rows of every member it
    holds (the dynamic-partition writer sorts within the task), and
    ``maxRecordsPerFile`` bounds the file size."""
    out = df.withColumn(suffix_col, suffix.cast("string"))
    (out.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(suffix_col).parquet(base))
    return base


# --------------------------------------------------------------------------
# Catalog objects and writes
# --------------------------------------------------------------------------


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """CREATE DATABASE IF NOT EXISTS (optionally at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")
    return name


def ctas(df: DataFrame, name: str, replace: bool = False) -> str:
    """Create a table from a query; fail if it exists unless
    ``replace``."""
    df.write.mode("overwrite" if replace else "errorifexists").format("parquet").saveAsTable(name)
    return name


def ctas_partitioned(spark: SparkSession, df: DataFrame, name: str, by: str,
                     description: str | None = None, ttl_days: int | None = None,
                     replace: bool = True) -> str:
    """CTAS partitioned by a DATE column, with a description and a
    partition-TTL property (enforced by ``tables.expire_partitions``).
    Rows are not shuffled by the partition column (a hot date would land in
    one task); each task writes its rows of each date, and
    ``spark.sql.files.maxRecordsPerFile`` bounds the file size."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    view = f"_ctas_src_{abs(hash(name))}"
    df.createOrReplaceTempView(view)
    props = []
    if ttl_days is not None:
        props.append(f"'partition_expiration_days' = '{int(ttl_days)}'")
    comment = f" COMMENT '{description}'" if description else ""
    tblprops = f" TBLPROPERTIES ({', '.join(props)})" if props else ""
    cols = [c for c in df.columns if c != by] + [by]
    spark.sql(f"CREATE TABLE {name} USING parquet PARTITIONED BY ({by}){comment}{tblprops} "
              f"AS SELECT {', '.join('`%s`' % c for c in cols)} FROM {view}")
    spark.catalog.dropTempView(view)
    return name


def materialize(df: DataFrame, name: str, mode: str = "overwrite") -> str:
    """Write a query result to a destination table
    (``overwrite`` replaces, ``append`` adds)."""
    df.write.mode(mode).format("parquet").saveAsTable(name)
    return name


def refresh(spark: SparkSession, template: str, params: Mapping[str, object], target: str) -> str:
    """Fill a parameterised query (``:name`` markers, ``IDENTIFIER(:t)``
    for table names) and replace ``target`` with its result.  Values are
    bound, never spliced into the text."""
    df = spark.sql(template, args=dict(params))
    return materialize(df, target, "overwrite")


def load_if_absent(spark: SparkSession, name: str, loader: Callable[[], DataFrame]) -> bool:
    """Load only when the target is missing; True if a load ran."""
    if spark.catalog.tableExists(name):
        return False
    materialize(loader(), name, "errorifexists")
    return True


def publish_view(spark: SparkSession, source: str, name: str, where: str | None = None,
                 cap: int | None = None, order_by: str | None = None,
                 columns: str = "*") -> str:
    """CREATE OR REPLACE VIEW over a table or join, optionally with
    a row filter and a row cap.  The cap is the feature (a shared subset);
    with ``order_by`` it is a repeatable top-k rather than an arbitrary
    sample."""
    sql = f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {source}"
    if where:
        sql += f" WHERE {where}"
    if order_by:
        sql += f" ORDER BY {order_by}"
    if cap is not None:
        sql += f" LIMIT {int(cap)}"
    spark.sql(sql)
    return name


def constant(spark: SparkSession, **cols) -> DataFrame:
    """A one-row relation of literals (scalars or lists -> arrays)."""
    exprs = []
    for k, v in cols.items():
        if isinstance(v, (list, tuple)):
            exprs.append(F.array(*[F.lit(x) for x in v]).alias(k))
        else:
            exprs.append(F.lit(v).alias(k))
    return spark.range(1).select(*exprs)


def append_rows(spark: SparkSession, name: str, rows: Sequence[Sequence], columns: Sequence[str] | None = None) -> str:
    """INSERT INTO ... VALUES for a handful of literal rows (the rows
    are literals in the statement, so this is for small inserts only)."""
    def lit_sql(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    values = ", ".join("(" + ", ".join(lit_sql(v) for v in r) + ")" for r in rows)
    cols = f" ({', '.join(columns)})" if columns else ""
    spark.sql(f"INSERT INTO {name}{cols} VALUES {values}")
    return name


# --------------------------------------------------------------------------
# Streams
# --------------------------------------------------------------------------


def stream_files(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Each new file under ``path`` is processed once (file source with
    its own commit log in the query checkpoint).  ``_metadata`` carries the
    file name and modification time of every row."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select("*", F.col("_metadata.file_path").alias("_file"),
                               F.col("_metadata.file_modification_time").alias("_file_mtime"))


def stream_messages(spark: SparkSession, path: str | None = None, schema: StructType | None = None,
                    kafka: Mapping[str, str] | None = None) -> DataFrame:
    """Topic messages as a stream of ``(message_id, publish_time, data)``.
    With ``kafka`` options it reads a Kafka topic (connector must be on the
    classpath); otherwise a folder of message files (tests)."""
    if kafka:
        r = spark.readStream.format("kafka")
        for k, v in kafka.items():
            r = r.option(k, v)
        return r.load().select(F.col("key").cast("string").alias("message_id"),
                               F.col("timestamp").alias("publish_time"),
                               F.col("value").cast("string").alias("data"))
    return spark.readStream.schema(schema).parquet(path)
