"""DDL and DML on tables (D1-D9) as DataFrame -> DataFrame rewrites.

Parquet tables take no UPDATE/DELETE/MERGE, so every change is expressed as
a new DataFrame and committed by writing a fresh snapshot under the shared
folder and pointing the table at it (``commit_snapshot``).  The path being
read is never overwritten, so a lost executor or a failed job leaves the old
snapshot intact.

The source side of an update or upsert must have unique keys.  That check is
folded into the plan: the source is grouped by key (which is also the
partitioning the join needs, so no extra exchange) and a key with more than
one row raises at runtime, before anything is written.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import shared_dir

_MATCH = "_src_matched"


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def unique_source(src: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Source rows reduced to one per key; a duplicate key fails the job.

    Partial aggregation runs map-side, so a key repeated across tasks moves
    one row per task; the final count per key is what is checked."""
    aggs = [F.first(c, ignorenulls=False).alias(c) for c in cols]
    g = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *aggs)
    dup = F.raise_error(F.concat(F.lit("duplicate source key: "), F.to_json(F.struct(*keys))))
    return g.select(*keys, *cols,
                    F.when(F.col("_n") > 1, dup).otherwise(F.lit(True)).alias(_MATCH))


# --------------------------------------------------------------------------
# Add columns
# --------------------------------------------------------------------------


def add_columns(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """D1 (DataFrame form): new columns, scalar or struct, all NULL for the
    rows that exist.  ``fields`` maps name -> DDL type string."""
    out = df
    for name, dtype in fields.items():
        out = out.withColumn(name, F.lit(None).cast(dtype))
    return out


def alter_add_columns(spark: SparkSession, table: str, fields: Mapping[str, str]) -> None:
    """D1 (catalog form): ALTER TABLE ... ADD COLUMNS; old files read NULL."""
    cols = ", ".join(f"`{k}` {v}" for k, v in fields.items())
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")


# --------------------------------------------------------------------------
# UPDATE ... FROM
# --------------------------------------------------------------------------


def update_from(target: DataFrame, source: DataFrame, on, set_cols: Mapping[str, str]) -> DataFrame:
    """Rows of ``target`` whose key matches take the source value,
    *even when that value is NULL*; other rows keep theirs.

    ``set_cols`` maps a target column -- or a struct field path
    ``"struct.field"`` (D3) -- to a source column.  Row count and order of
    columns of ``target`` are preserved.  A NULL struct that is matched
    becomes a struct holding the new field."""
    keys = _keys(on)
    src_cols = sorted(set(set_cols.values()))
    src = unique_source(source, keys, src_cols)
    renamed = src.select(*[F.col(k) for k in keys],
                         *[F.col(c).alias(f"_s_{c}") for c in src_cols], F.col(_MATCH))
    j = target.join(renamed, keys, "left")
    matched = F.coalesce(F.col(_MATCH), F.lit(False))

    new_cols: dict[str, Column] = {}
    struct_updates: dict[str, list[tuple[str, str]]] = {}
    for tgt, s in set_cols.items():
        if "." in tgt:
            top, fld = tgt.split(".", 1)
            struct_updates.setdefault(top, []).append((fld, s))
        else:
            new_cols[tgt] = F.when(matched, F.col(f"_s_{s}")).otherwise(F.col(tgt))
    for top, fields in struct_updates.items():
        base = F.col(top)
        upd = base
        for fld, s in fields:
            upd = upd.withField(fld, F.col(f"_s_{s}"))
        # A NULL struct has no fields to set: start from an all-NULL struct.
        empty_then_set = F.when(base.isNull(), _null_struct_like(target, top)).otherwise(base)
        for fld, s in fields:
            empty_then_set = empty_then_set.withField(fld, F.col(f"_s_{s}"))
        new_cols[top] = F.when(matched, empty_then_set).otherwise(base)
    return j.select(*[new_cols.get(c, F.col(c)).alias(c) for c in target.columns])


def _null_struct_like(df: DataFrame, col: str) -> Column:
    dtype = df.schema[col].dataType
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in dtype.fields])


# --------------------------------------------------------------------------
# Delete, insert-if-absent, upsert
# --------------------------------------------------------------------------


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """DELETE WHERE cond; a row whose condition is NULL is kept."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the rows whose key pair is not in ``target`` yet
    (NOT EXISTS -> left anti join; NULL keys never match)."""
    new = rows.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def upsert(target: DataFrame, rows: DataFrame, key) -> DataFrame:
    """Edit matched rows, add unmatched ones; keys of ``rows`` must be
    unique (checked in-plan).  Columns missing from ``rows`` keep the
    target value on an edit and are NULL on an insert."""
    keys = _keys(key)
    payload = [c for c in rows.columns if c not in keys]
    src = unique_source(rows, keys, payload)
    src = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in payload], F.col(_MATCH))
    j = target.withColumn("_tgt", F.lit(True)).join(src, keys, "full")
    m = F.coalesce(F.col(_MATCH), F.lit(False))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in payload:
            out.append(F.when(m, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


# --------------------------------------------------------------------------
# Partition expiry
# --------------------------------------------------------------------------


def expire_partitions(spark: SparkSession, table: str, as_of: str | _dt.date, days: int | None = None,
                      by: str | None = None) -> list[str]:
    """Drop the partitions of ``table`` whose date is older than
    ``as_of - days``.  ``days`` defaults to the table's
    ``partition_expiration_days`` property.  ``as_of`` is explicit, never
    the wall clock.  Only partition metadata reaches the driver."""
    if days is None:
        props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        days = int(props["partition_expiration_days"])
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    cutoff = as_of - _dt.timedelta(days=int(days))
    dropped = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = dict(p.split("=", 1) for p in row[0].split("/"))
        value = spec[by or next(iter(spec))]
        # a partition without a date never expires
        if value not in ("__HIVE_DEFAULT_PARTITION__", "null") and _dt.date.fromisoformat(value) < cutoff:
            dropped.append((spec, value))
    # one catalog call for all expired partitions
    for i in range(0, len(dropped), 500):
        specs = ", ".join("PARTITION (" + ", ".join(f"`{c}` = '{v}'" for c, v in spec.items()) + ")" for spec, _ in dropped[i:i + 500])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    dropped = [v for _, v in dropped]
    return dropped


# --------------------------------------------------------------------------
# Surrogate keys
# --------------------------------------------------------------------------


def with_serial(df: DataFrame, name: str = "id", start: int | Column = 1,
                input_is_stable: bool = False) -> DataFrame:
    """Dense surrogate keys ``start, start+1, ...`` with no global sort
    and no single-task window.

    ``monotonically_increasing_id`` holds the partition id in its upper bits
    and the row's position inside the partition in its lower 33 bits.  Rows
    per partition are counted (one small row per partition), prefix sums of
    those counts give each partition's offset, and that table -- bounded by
    the number of partitions, not by the data -- is broadcast back.  The
    input is counted and numbered by two passes over the same plan, so it
    must give the same rows in the same partitions twice: the caller says so
    with ``input_is_stable`` (a scan with filters and projections);
    otherwise the input is checkpointed to the shared folder first."""
    if not input_is_stable:
        shared_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = df.withColumn("_mid", mid)
    tagged = tagged.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    base = start if isinstance(start, Column) else F.lit(int(start))
    out = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        name, base + F.col("_off") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    return out.drop("_mid", "_pid", "_off")


def next_serial_start(existing: DataFrame, col: str = "id") -> Column:
    """``max(id) + 1`` of a table as a scalar subquery (1 when empty)."""
    return F.coalesce(existing.agg(F.max(col).alias("_m")).select("_m").scalar() + 1, F.lit(1))


# --------------------------------------------------------------------------
# Retention eligibility
# --------------------------------------------------------------------------


def deletable(objects: DataFrame, retention_s: int, as_of: str,
              created: str = "created", temp_hold: str = "temporary_hold",
              event_hold: str = "event_based_hold", released: str = "event_hold_released") -> DataFrame:
    """Which objects may be deleted at ``as_of``.

    An object is deletable when it carries neither a temporary nor an
    event-based hold and its retention clock has run out.  The clock starts
    at creation, and restarts when an event-based hold is released."""
    start = F.greatest(F.col(created), F.coalesce(F.col(released), F.col(created)))
    expires = start + F.make_interval(secs=F.lit(retention_s))
    held = F.coalesce(F.col(temp_hold), F.lit(False)) | F.coalesce(F.col(event_hold), F.lit(False))
    now = F.to_timestamp_ntz(F.lit(as_of))
    return objects.withColumn("retention_expires", expires).withColumn(
        "deletable", (~held) & (now >= F.col("retention_expires")))


# --------------------------------------------------------------------------
# Changes committed to a catalog table
# --------------------------------------------------------------------------


def _new_path(spark: SparkSession, table: str, root: str | None) -> str:
    return f"{(root or shared_dir(spark)).rstrip('/')}/snapshots/{table.replace('.', '/')}/{uuid.uuid4().hex}"


def create_table(spark: SparkSession, df: DataFrame, table: str, root: str | None = None, partition_by: str | None = None) -> str:
    """An external table over a first snapshot of ``df`` under the shared folder."""
    w = df.write.mode("errorifexists").format("parquet").option("path", _new_path(spark, table, root))
    (w.partitionBy(partition_by) if partition_by else w).saveAsTable(table)
    return table


def commit_snapshot(spark: SparkSession, df: DataFrame, table: str, root: str | None = None) -> str:
    """Write ``df`` as a new snapshot of an unpartitioned ``table`` and point the
    table at it.  The location is switched in one catalog call: readers see the old
    rows or the new ones, at no time no table, and the files of old snapshots (also
    those of a managed table) stay."""
    path = _new_path(spark, table, root)
    df.select(*spark.table(table).columns).write.mode("errorifexists").parquet(path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{_sql(path)}'")
    spark.catalog.refreshTable(table)
    return path


def _sql(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _spec(by: str, value) -> str:
    return f"`{by}` = " + ("NULL" if value is None else f"'{_sql(str(value))}'")


def rewrite_partitions(spark: SparkSession, table: str, by: str, touched: DataFrame, rewrite, root: str | None = None) -> list:
    """Rewrite the partitions of ``table`` (by one column) whose values ``touched``
    lists: they alone are read (a partition filter), changed by ``rewrite`` and
    written to a new place, to which each is then pointed; partitions left empty are
    dropped from the catalog.  All others keep their files.  A partition is switched
    by one catalog call, after all of them are written; a failed job has changed
    nothing.  Returns the values; what reaches the driver is one value a partition."""
    values = [r[0] for r in touched.select(by).distinct().collect()]
    if not values:
        return []
    known = [v for v in values if v is not None]
    cond = F.col(by).isin(known) if known else F.lit(False)
    if None in values:
        cond = cond | F.col(by).isNull()
    own = spark.table(table)
    path = _new_path(spark, table, root)
    new = rewrite(own.filter(cond)).select(*own.columns)
    new.write.mode("errorifexists").partitionBy(by).parquet(path)
    kind = own.schema[by].dataType
    made = {r[0] for r in spark.read.schema(own.schema).parquet(path).select(F.col(by).cast(kind)).distinct().collect()}
    for v in sorted(made | set(values), key=lambda x: (x is not None, x)):
        spec = _spec(by, v)
        if v not in made:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
            continue
        where = f"{path}/{_folder(spark, path, by, v)}"
        if v in values and spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").take(1):
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{_sql(where)}'")
        else:
            if spark.sql(f"SHOW PARTITIONS {table} PARTITION ({spec})").take(1):
                raise ValueError(f"rows moved to partition {v!r}, which isn't among those to rewrite")
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec}) LOCATION '{_sql(where)}'")
    spark.catalog.refreshTable(table)
    return values


def _folder(spark: SparkSession, path: str, by: str, value) -> str:
    """The folder that the writer gives a partition value."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return names.getPartitionPathString(by, None if value is None else str(value))


def update_table(spark: SparkSession, table: str, by: str, source: DataFrame, on, set_cols: Mapping[str, str]) -> list:
    """D2/D3 on a catalog table: only partitions that hold a matched key are rewritten."""
    keys = _keys(on)
    touched = spark.table(table).join(source.select(*keys).distinct(), keys, "left_semi")
    return rewrite_partitions(spark, table, by, touched, lambda part: update_from(part, source, on, set_cols))


def delete_from_table(spark: SparkSession, table: str, by: str, cond: Column) -> list:
    """D4 on a catalog table: only partitions that hold a row to delete are rewritten."""
    return rewrite_partitions(spark, table, by, spark.table(table).filter(cond), lambda part: delete_where(part, cond))


def upsert_table(spark: SparkSession, table: str, by: str, rows: DataFrame, key) -> list:
    """D7 on a catalog table; ``rows`` has the partition column.  A row whose key
    stands in another partition moves: both are rewritten."""
    keys = _keys(key)
    target = spark.table(table)
    touched = target.join(rows.select(*keys).distinct(), keys, "left_semi").select(by).union(rows.select(by))
    # keys in no touched partition are new, so the touched ones are all that the join needs
    return rewrite_partitions(spark, table, by, touched, lambda part: upsert(part, rows, key))


def insert_if_absent_into(spark: SparkSession, table: str, rows: DataFrame, keys: Sequence[str]) -> None:
    """D5 on a catalog table: rows whose keys it doesn't hold are appended; nothing is rewritten."""
    target = spark.table(table)
    new = rows.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    new.select(*target.columns).write.mode("append").insertInto(table)


# --------------------------------------------------------------------------
# D8 over repeated appends
# --------------------------------------------------------------------------


def _claim(spark: SparkSession, fs, file) -> bool:
    """Make an empty file; False where there is one already.  Stores make a file
    without overwriting in one step; for local folders (tests) Java's file API does."""
    jvm = spark._jvm
    try:
        if fs.getScheme() == "file":
            none = spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(file.toUri().getPath()).toPath(), none)
        else:
            fs.create(file, False).close()
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def reserve(spark: SparkSession, table: str, n: int, root: str | None = None, patience_s: float = 30.0) -> int:
    """The first of ``n`` keys that no other append gets.

    A writer claims a first key by making a file of that name, which fails where
    there is one, and then says in a second file's name where its keys end.  Of two
    writers that ask at once one gets the claim; the other waits for its end.  Both
    files stay, and are made before any row is written, so an append that fails
    leaves a gap and its keys never come back."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(f"{(root or shared_dir(spark)).rstrip('/')}/serial/{table.replace('.', '/')}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    until = time.monotonic() + patience_s
    while True:
        ends = [int(name.split("-")[1]) for name in (st.getPath().getName() for st in fs.listStatus(folder)) if "-" in name]
        start = max(ends, default=1)
        if _claim(spark, fs, path(folder, str(start))):
            _claim(spark, fs, path(folder, f"{start}-{start + n}"))
            return start
        if time.monotonic() > until:
            raise RuntimeError(f"{folder}/{start} was claimed by a writer that never said where its keys end: add {start}-<end>")
        time.sleep(0.05)


def append_with_serial(spark: SparkSession, table: str, rows: DataFrame, key: str = "id", root: str | None = None) -> int:
    """Append ``rows`` with keys of their own.  The rows are written to the
    shared folder first (a retried task must number the same rows), counted, and
    numbered without gaps from the first key reserved for them.  Columns that the
    table says are NOT NULL may hold none, and values must fit its types: either
    fails the job before anything is appended.  Returns the number of rows."""
    target = spark.table(table)
    required = set((spark.sql(f"SHOW TBLPROPERTIES {table}").filter("key = 'not_null'").collect() or [("", "")])[0][1].split(","))

    def checked(c: str) -> Column:
        value = F.col(c).cast(target.schema[c].dataType)
        return F.coalesce(value, F.raise_error(F.lit(f"NULL in column {c}")).cast(target.schema[c].dataType)) if c in required else value

    path = _new_path(spark, table, root)
    rows.select(*[checked(c).alias(c) for c in target.columns if c != key]).write.parquet(path)
    fixed = spark.read.parquet(path)
    n = fixed.count()
    if n:
        start = reserve(spark, table, n, root)
        with_serial(fixed, key, start, input_is_stable=True).select(*[F.col(c).cast(target.schema[c].dataType) for c in target.columns]).write.mode("append").insertInto(table)
    return n


def create_serial_table(spark: SparkSession, table: str, columns: Mapping[str, str], key: str = "id", root: str | None = None) -> None:
    """A table with a serial ``key`` and ``columns`` of SQL types; a type that ends
    in NOT NULL is kept as a rule of the table, which ``append_with_serial`` checks."""
    types = {c: t.upper().removesuffix("NOT NULL").strip() for c, t in columns.items()}
    required = ",".join(c for c, t in columns.items() if t.upper().endswith("NOT NULL"))
    cols = ", ".join([f"`{key}` BIGINT", *(f"`{c}` {t}" for c, t in types.items())])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet LOCATION '{_sql(_new_path(spark, table, root))}' TBLPROPERTIES ('not_null' = '{required}')")
