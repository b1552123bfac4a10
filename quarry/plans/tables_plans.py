"""Table sources/sinks, DDL/DML rewrites and scalar functions
(S2-S17, D1-D9, F1-F12) on the supplied tables.

Every query that writes gets a fresh database whose location lies under the
shared folder (``spark.checkpoint.dir``), so reruns never collide and no
machine-local path is used on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from quarry.functions import scalar as S
from quarry.operators import tables as D
from quarry.plans.registry import register, t
from quarry.session import scratch_path
from quarry.sources import io


def fresh_db(spark: SparkSession, tag: str) -> tuple[str, str]:
    root = scratch_path(spark, "warehouse", tag)
    name = f"q_{tag}_{uuid.uuid4().hex[:10]}"
    io.ensure_database(spark, name, root)
    return name, root


# --------------------------------------------------------------------------
# NDJSON
# --------------------------------------------------------------------------

ORDER_DOC_SCHEMA = StructType([
    StructField("o_orderkey", LongType()),
    StructField("o_orderstatus", StringType()),
    StructField("lines", ArrayType(StructType([
        StructField("linenumber", IntegerType()),
        StructField("quantity", DoubleType()),
    ]))),
])


def order_documents_json(spark: SparkSession, d: str) -> str:
    """Orders with their lines as nested NDJSON under the shared folder."""
    li = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_linenumber").alias("linenumber"), F.col("l_quantity").alias("quantity"))).alias("lines"))
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    docs = o.join(li, o["o_orderkey"] == li["l_orderkey"], "inner").select("o_orderkey", "o_orderstatus", "lines")
    path = scratch_path(spark, "ndjson", "orders")
    docs.write.mode("errorifexists").json(path)
    return path


ORDER_DOC_SQL = """
(SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_quantity
 FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey)"""


@register("s2_load_ndjson_inferred", f"""
SELECT o_orderkey, o_orderstatus, CAST(count(*) AS BIGINT) AS n_lines, round(sum(l_quantity), 2) AS total_qty
FROM {ORDER_DOC_SQL} GROUP BY o_orderkey, o_orderstatus""")
def s2_load_ndjson_inferred(spark, d):
    df = io.load_ndjson(spark, order_documents_json(spark, d), order=["o_orderkey", "o_orderstatus", "lines"])
    return df.select("o_orderkey", "o_orderstatus", F.size("lines").cast("bigint").alias("n_lines"),
                     F.round(F.aggregate("lines", F.lit(0.0), lambda a, x: a + x["quantity"]), 2).alias("total_qty"))


@register("s3_load_ndjson_declared", f"""
SELECT o_orderstatus, l_linenumber AS linenumber, CAST(count(*) AS BIGINT) AS n_lines,
       round(sum(l_quantity), 2) AS total_qty
FROM {ORDER_DOC_SQL} GROUP BY o_orderstatus, l_linenumber""")
def s3_load_ndjson_declared(spark, d):
    df = io.load_ndjson(spark, order_documents_json(spark, d), schema=ORDER_DOC_SCHEMA)
    u = df.select("o_orderstatus", F.explode("lines").alias("ln"))
    return u.groupBy("o_orderstatus", F.col("ln.linenumber").alias("linenumber")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("ln.quantity"), 2).alias("total_qty"))


# --------------------------------------------------------------------------
# Table family by suffix
# --------------------------------------------------------------------------


@register("s4_scan_family", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS suffix, CAST(count(*) AS BIGINT) AS n_orders,
       round(sum(o_totalprice), 2) AS total_price
FROM orders WHERE CAST(year(o_orderdate) AS VARCHAR) >= '1998' GROUP BY 1""")
def s4_scan_family(spark, d):
    base = scratch_path(spark, "family", "orders")
    io.write_family(t(spark, d, "orders"), base, F.year("o_orderdate"))
    fam = io.scan_family(spark, base, lambda s: s >= F.lit("1998"))
    return fam.groupBy(F.col("suffix").cast("string").alias("suffix")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price"))


# --------------------------------------------------------------------------
# Catalog tables and views
# --------------------------------------------------------------------------

STATUS_SUMMARY_SQL = """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n_orders, round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY o_orderstatus"""


def _status_summary(spark, d) -> DataFrame:
    return t(spark, d, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price"))


@register("s5_ctas", STATUS_SUMMARY_SQL)
def s5_ctas(spark, d):
    db, _ = fresh_db(spark, "s5")
    name = io.ctas(_status_summary(spark, d), f"{db}.status_summary")
    try:  # a second CTAS into the same name must fail
        io.ctas(_status_summary(spark, d), name)
        raise AssertionError("CTAS over an existing table did not fail")
    except AssertionError:
        raise
    except Exception:
        pass
    return spark.table(name)


@register("s6_ctas_replace", STATUS_SUMMARY_SQL)
def s6_ctas_replace(spark, d):
    db, _ = fresh_db(spark, "s6")
    name = f"{db}.status_summary"
    io.ctas(t(spark, d, "region"), name, replace=True)
    io.ctas(_status_summary(spark, d), name, replace=True)
    return spark.table(name)


def _monthly_orders(spark, d) -> DataFrame:
    return t(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("o_month"))


@register("s7_ctas_partitioned", """
SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS o_month
FROM orders WHERE CAST(date_trunc('month', o_orderdate) AS DATE) = DATE '2000-02-01'""")
def s7_ctas_partitioned(spark, d):
    db, _ = fresh_db(spark, "s7")
    name = io.ctas_partitioned(spark, _monthly_orders(spark, d), f"{db}.orders_by_month", "o_month",
                               description="orders partitioned by month", ttl_days=60)
    # a DATE literal on the partition column prunes to one folder
    return spark.table(name).filter(F.col("o_month") == S.date_lit("2000-02-01")).select(
        "o_orderkey", "o_totalprice", "o_month")


@register("d6_expire_partitions", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS o_month, CAST(count(*) AS BIGINT) AS n_orders
FROM orders WHERE CAST(date_trunc('month', o_orderdate) AS DATE) >= DATE '2001-08-01' - INTERVAL 100 DAY
GROUP BY 1""")
def d6_expire_partitions(spark, d):
    db, _ = fresh_db(spark, "d6")
    name = io.ctas_partitioned(spark, _monthly_orders(spark, d), f"{db}.orders_by_month", "o_month",
                               description="orders partitioned by month", ttl_days=100)
    D.expire_partitions(spark, name, as_of="2001-08-01")
    return spark.table(name).groupBy("o_month").agg(F.count(F.lit(1)).alias("n_orders"))


@register("s8_materialize", """
SELECT c.c_custkey, CAST(count(*) AS BIGINT) AS n_orders
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'BUILDING' GROUP BY c.c_custkey""")
def s8_materialize(spark, d):
    db, _ = fresh_db(spark, "s8")
    c = t(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    o = t(spark, d, "orders").select("o_custkey")
    res = c.join(o, c["c_custkey"] == o["o_custkey"]).groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"))
    name = f"{db}.building_orders"
    io.materialize(t(spark, d, "nation"), name)  # replaced below
    io.materialize(res, name)
    return spark.table(name)


COST_TEMPLATE = """
SELECT CAST(date_trunc('MONTH', l_shipdate) AS DATE) AS month,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS cost
FROM IDENTIFIER(:source)
WHERE l_shipdate >= CAST(:start_date AS TIMESTAMP_NTZ)
GROUP BY 1"""


@register("s9_refresh", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS cost
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1""")
def s9_refresh(spark, d):
    db, _ = fresh_db(spark, "s9")
    view = f"lineitem_{uuid.uuid4().hex[:8]}"
    t(spark, d, "lineitem").createOrReplaceTempView(view)
    target = f"{db}.cost_by_month"
    for start in ("1999-01-01", "2000-01-01"):  # each run replaces the target
        io.refresh(spark, COST_TEMPLATE, {"source": view, "start_date": start}, target)
    return spark.table(target)


@register("s10_load_if_absent", "SELECT r_regionkey, r_name, CAST(1 AS BIGINT) AS loads FROM region")
def s10_load_if_absent(spark, d):
    db, _ = fresh_db(spark, "s10")
    name = f"{db}.region"
    ran = [io.load_if_absent(spark, name, lambda: t(spark, d, "region")) for _ in range(2)]
    return spark.table(name).withColumn("loads", F.lit(sum(ran)).cast("bigint"))


@register("s11_publish_view_subset", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
ORDER BY c_custkey LIMIT 1000""")
def s11_publish_view_subset(spark, d):
    db, _ = fresh_db(spark, "s11")
    io.materialize(t(spark, d, "customer"), f"{db}.customer")
    io.publish_view(spark, f"{db}.customer", f"{db}.building_customers", where="c_mktsegment = 'BUILDING'",
                    cap=1000, order_by="c_custkey", columns="c_custkey, c_name, c_acctbal")
    return spark.table(f"{db}.building_customers")


@register("s12_publish_view_join", """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def s12_publish_view_join(spark, d):
    db, _ = fresh_db(spark, "s12")
    io.materialize(t(spark, d, "customer"), f"{db}.customer")
    io.materialize(t(spark, d, "nation"), f"{db}.nation")
    io.publish_view(spark, f"{db}.customer c JOIN {db}.nation n ON c.c_nationkey = n.n_nationkey",
                    f"{db}.customer_nation", columns="c.c_custkey, c.c_name, n.n_name")
    return spark.table(f"{db}.customer_nation")


@register("s13_constant_relation", """
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n_customers
FROM customer WHERE list_contains(['BUILDING', 'FURNITURE'], c_mktsegment) GROUP BY c_mktsegment""")
def s13_constant_relation(spark, d):
    segs = io.constant(spark, segments=["BUILDING", "FURNITURE"])
    c = t(spark, d, "customer")
    seg_arr = segs.select("segments").scalar()  # one-row relation as a scalar subquery
    return c.filter(F.array_contains(seg_arr, F.col("c_mktsegment"))).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_customers"))


@register("s14_append_rows", """
SELECT r_regionkey, r_name FROM region
UNION ALL SELECT * FROM (VALUES (5, 'ANTARCTICA'), (6, 'ATLANTIS'), (7, 'O''BRIEN SEA')) v(r_regionkey, r_name)""")
def s14_append_rows(spark, d):
    db, _ = fresh_db(spark, "s14")
    name = io.ctas(t(spark, d, "region").select("r_regionkey", "r_name"), f"{db}.region")
    io.append_rows(spark, name, [(5, "ANTARCTICA"), (6, "ATLANTIS"), (7, "O'BRIEN SEA")])
    return spark.table(name)


@register("s17_ensure_database", "SELECT 1 AS n_databases, r_regionkey, r_name FROM region")
def s17_ensure_database(spark, d):
    name = f"q_s17_{uuid.uuid4().hex[:10]}"
    root = scratch_path(spark, "warehouse", "s17")
    for _ in range(2):  # idempotent
        io.ensure_database(spark, name, root)
    io.materialize(t(spark, d, "region"), f"{name}.region")
    # what the new namespace holds
    found = spark.sql(f"SHOW DATABASES LIKE '{name}'").count()
    return spark.table(f"{name}.region").select(F.lit(found).alias("n_databases"), "r_regionkey", "r_name")


# --------------------------------------------------------------------------
# D: rewrites on customer
# --------------------------------------------------------------------------


@register("d1_add_columns", "SELECT c_custkey, CAST(NULL AS DOUBLE) AS avg_order, "
          "CAST(NULL AS BIGINT) AS stats_n_orders FROM customer")
def d1_add_columns(spark, d):
    db, _ = fresh_db(spark, "d1")
    name = io.ctas(t(spark, d, "customer"), f"{db}.customer")
    D.alter_add_columns(spark, name, {"avg_order": "DOUBLE",
                                      "stats": "STRUCT<n_orders: BIGINT, avg_price: DOUBLE>"})
    return spark.table(name).select("c_custkey", "avg_order", F.col("stats.n_orders").alias("stats_n_orders"))


def _urgent_avgs(spark, d) -> DataFrame:
    o = t(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    g = o.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("avg_price"),
                                   F.count(F.lit(1)).alias("n_orders"))
    # a matched NULL value: the update must write it
    return g.select(F.col("o_custkey").alias("c_custkey"),
                    F.when(F.col("o_custkey") % 11 == 0, None).otherwise(F.col("avg_price")).alias("avg_price"),
                    "n_orders")


URGENT_AVGS_SQL = """
(SELECT o_custkey AS c_custkey,
        CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE avg(o_totalprice) END AS avg_price,
        CAST(count(*) AS BIGINT) AS n_orders
 FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)"""


@register("d2_update_from", f"""
SELECT c.c_custkey, round(CASE WHEN s.c_custkey IS NOT NULL THEN s.avg_price ELSE c.c_acctbal END, 4) AS c_acctbal
FROM customer c LEFT JOIN {URGENT_AVGS_SQL} s ON c.c_custkey = s.c_custkey""")
def d2_update_from(spark, d):
    out = D.update_from(t(spark, d, "customer"), _urgent_avgs(spark, d), "c_custkey", {"c_acctbal": "avg_price"})
    return out.select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"))


@register("d3_update_struct_fields", f"""
WITH base AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(0 AS BIGINT) END AS n0,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 0.0 END AS p0,
         c_custkey % 3 = 0 AS struct_null
  FROM customer)
SELECT b.c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.n_orders ELSE b.n0 END AS stats_n_orders,
       round(CASE WHEN s.c_custkey IS NOT NULL THEN s.avg_price ELSE b.p0 END, 4) AS stats_avg_price,
       (b.struct_null AND s.c_custkey IS NULL) AS stats_is_null
FROM base b LEFT JOIN {URGENT_AVGS_SQL} s ON b.c_custkey = s.c_custkey""")
def d3_update_struct_fields(spark, d):
    c = t(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("struct<n_orders:bigint,avg_price:double>"))
         .otherwise(F.struct(F.lit(0).cast("bigint").alias("n_orders"), F.lit(0.0).alias("avg_price")))
         .alias("stats"))
    out = D.update_from(c, _urgent_avgs(spark, d), "c_custkey",
                        {"stats.n_orders": "n_orders", "stats.avg_price": "avg_price"})
    return out.select("c_custkey", F.col("stats.n_orders").alias("stats_n_orders"),
                      F.round("stats.avg_price", 4).alias("stats_avg_price"),
                      F.col("stats").isNull().alias("stats_is_null"))


@register("d4_delete_where", """
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer
WHERE NOT coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END < 0, false)""")
def d4_delete_where(spark, d):
    from quarry.plans.warehouse import customers_with_nulls
    c = customers_with_nulls(spark, d).select("c_custkey", "c_acctbal")
    return D.delete_where(c, F.col("c_acctbal") < 0)


@register("d5_insert_if_absent", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0
UNION ALL
SELECT r.c_custkey, r.c_name FROM customer r
WHERE r.c_custkey % 3 = 0
  AND NOT EXISTS (SELECT 1 FROM customer x WHERE x.c_custkey % 2 = 0
                  AND x.c_custkey = r.c_custkey AND x.c_name = r.c_name)""")
def d5_insert_if_absent(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_name")
    return D.insert_if_absent(c.filter(F.col("c_custkey") % 2 == 0), c.filter(F.col("c_custkey") % 3 == 0),
                              ["c_custkey", "c_name"])


@register("d7_upsert", """
WITH src AS (
  SELECT c_custkey, 'UPDATED' AS c_mktsegment FROM customer WHERE c_custkey % 10 = 0
  UNION ALL
  SELECT s_suppkey + 1000000 AS c_custkey, 'SUPPLIER' AS c_mktsegment FROM supplier)
SELECT coalesce(c.c_custkey, s.c_custkey) AS c_custkey, c.c_name,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_mktsegment ELSE c.c_mktsegment END AS c_mktsegment
FROM customer c FULL OUTER JOIN src s ON c.c_custkey = s.c_custkey""")
def d7_upsert(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    edits = c.filter(F.col("c_custkey") % 10 == 0).select("c_custkey", F.lit("UPDATED").alias("c_mktsegment"))
    adds = t(spark, d, "supplier").select((F.col("s_suppkey") + 1000000).alias("c_custkey"),
                                          F.lit("SUPPLIER").alias("c_mktsegment"))
    return D.upsert(c, edits.unionByName(adds), "c_custkey")


@register("d8_serial_keys", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST((SELECT max(c_custkey) FROM customer) + 1 AS BIGINT) AS min_id,
       CAST((SELECT max(c_custkey) FROM customer) + count(*) AS BIGINT) AS max_id,
       CAST(count(*) AS BIGINT) AS n_distinct_ids
FROM orders WHERE o_orderpriority = '1-URGENT'""")
def d8_serial_keys(spark, d):
    existing = t(spark, d, "customer")
    new_rows = t(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")
    ids = D.with_serial(new_rows, "id", start=D.next_serial_start(existing, "c_custkey"), input_is_stable=True)
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
                   F.count_distinct("id").alias("n_distinct_ids"))


# --------------------------------------------------------------------------
# D1 to D7 as one chain on one catalog table
# --------------------------------------------------------------------------

CHAIN_SQL = f"""
WITH u AS {URGENT_AVGS_SQL},
moved AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal,
         CASE WHEN u.c_custkey IS NOT NULL THEN u.avg_price END AS avg_order, u.n_orders AS stats_n_orders
  FROM customer c LEFT JOIN (SELECT * FROM u WHERE c_custkey % 4 = 0) u ON u.c_custkey = c.c_custkey AND c.c_nationkey < 10),
kept AS (SELECT * FROM moved WHERE NOT coalesce(c_acctbal < 0 AND c_nationkey BETWEEN 12 AND 15, false))"""


def _chain(spark, d) -> tuple[str, list]:
    """Customers by nation: columns added, filled from orders (scalar and struct field), rows deleted."""
    db, root = fresh_db(spark, "chain")
    name = D.create_table(spark, t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey"), f"{db}.customer", root, "c_nationkey")
    before = _locations(spark, name)
    D.alter_add_columns(spark, name, {"avg_order": "DOUBLE", "stats": "STRUCT<n_orders: BIGINT, avg_price: DOUBLE>"})
    low = spark.table(name).filter("c_nationkey < 10").select("c_custkey")
    source = _urgent_avgs(spark, d).filter("c_custkey % 4 = 0").join(low, "c_custkey", "left_semi")
    D.update_table(spark, name, "c_nationkey", source, "c_custkey", {"avg_order": "avg_price"})
    D.update_table(spark, name, "c_nationkey", source, "c_custkey", {"stats.n_orders": "n_orders"})
    D.delete_from_table(spark, name, "c_nationkey", (F.col("c_acctbal") < 0) & F.col("c_nationkey").between(12, 15))
    return name, before


def _locations(spark, name: str) -> DataFrame:
    """The file of every row's partition, by partition."""
    rows = spark.table(name).select("c_nationkey", F.col("_metadata.file_path").alias("file")).distinct().collect()
    return spark.createDataFrame([(r.c_nationkey, r.file) for r in rows], "nation long, file string")


@register("d4_chain_on_one_table", CHAIN_SQL + """
SELECT c_custkey, c_name, c_nationkey, round(avg_order, 4) AS avg_order, stats_n_orders, stats_n_orders IS NULL AS no_stats,
       c_nationkey NOT IN (SELECT c_nationkey FROM moved WHERE stats_n_orders IS NOT NULL OR (c_acctbal < 0 AND c_nationkey BETWEEN 12 AND 15)) AS untouched
FROM kept""")
def d4_chain_on_one_table(spark, d):
    name, before = _chain(spark, d)
    files = before.withColumnRenamed("nation", "n")
    rows = spark.table(name).select("*", F.col("_metadata.file_path").alias("now"))
    same = rows.join(files, (rows["c_nationkey"] == files["n"]) & (rows["now"] == files["file"]), "left")
    return same.select("c_custkey", "c_name", "c_nationkey", F.round("avg_order", 4).alias("avg_order"), F.col("stats.n_orders").alias("stats_n_orders"),
                       F.col("stats").isNull().alias("no_stats"), F.col("file").isNotNull().alias("untouched"))


@register("d7_chain_on_one_table", CHAIN_SQL + """,
inserted AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, avg_order FROM kept
  UNION ALL SELECT s.s_suppkey, s.s_name, s.s_nationkey, s.s_acctbal, NULL FROM supplier s
  WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.c_custkey = s.s_suppkey)),
edits AS (SELECT c_custkey, 3 AS c_nationkey, 'moved' AS c_name FROM inserted WHERE c_nationkey IN (3, 20) AND c_custkey % 7 = 0
          UNION ALL SELECT n_nationkey - 1000, 20, 'new' FROM nation)
SELECT coalesce(e.c_custkey, i.c_custkey) AS c_custkey, coalesce(e.c_name, i.c_name) AS c_name, coalesce(e.c_nationkey, i.c_nationkey) AS c_nationkey,
       round(i.avg_order, 4) AS avg_order FROM inserted i FULL JOIN edits e ON e.c_custkey = i.c_custkey""")
def d7_chain_on_one_table(spark, d):
    name, _ = _chain(spark, d)
    new = t(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"),
                                         F.lit(None).cast("double").alias("avg_order"), F.lit(None).cast("struct<n_orders:bigint,avg_price:double>").alias("stats"),
                                         F.col("s_nationkey").alias("c_nationkey"))
    D.insert_if_absent_into(spark, name, new, ["c_custkey"])
    edits = spark.table(name).filter(F.col("c_nationkey").isin(3, 20) & (F.col("c_custkey") % 7 == 0)).select(
        "c_custkey", F.lit(3).cast("bigint").alias("c_nationkey"), F.lit("moved").alias("c_name"))
    adds = t(spark, d, "nation").select((F.col("n_nationkey") - 1000).alias("c_custkey"), F.lit(20).cast("bigint").alias("c_nationkey"), F.lit("new").alias("c_name"))
    path = scratch_path(spark, "edits")  # the edits are read from the table that they change
    edits.unionByName(adds).write.parquet(path)
    D.upsert_table(spark, name, "c_nationkey", spark.read.parquet(path), "c_custkey")
    return spark.table(name).select("c_custkey", "c_name", "c_nationkey", F.round("avg_order", 4).alias("avg_order"))


@register("d8_employees", """
WITH added AS (
  SELECT 1 AS batch, c_name AS first, c_mktsegment AS last, CAST(c_acctbal AS DECIMAL(10, 2)) AS salary FROM customer WHERE c_nationkey < 8
  UNION ALL SELECT 2, s_name, 'supplier', CAST(s_acctbal AS DECIMAL(10, 2)) FROM supplier
  UNION ALL SELECT 3, c_name, c_mktsegment, CAST(c_acctbal AS DECIMAL(10, 2)) FROM customer WHERE c_nationkey BETWEEN 8 AND 12)
SELECT first, last, CAST(salary AS DOUBLE) AS salary, true AS unique_id,
       CASE batch WHEN 1 THEN 0 WHEN 2 THEN (SELECT count(*) FROM added WHERE batch = 1) ELSE (SELECT count(*) FROM added WHERE batch < 3) END < (SELECT count(*) FROM added) AS ranged,
       batch FROM added""")
def d8_employees(spark, d):
    # the employees table: serial key, NOT NULL names, decimal salary; three appends, each only of who is absent
    db, root = fresh_db(spark, "d8")
    name = f"{db}.employees"
    D.create_serial_table(spark, name, {"first": "STRING NOT NULL", "last": "STRING NOT NULL", "salary": "DECIMAL(10,2)"}, "id", root)
    c = t(spark, d, "customer").select(F.col("c_name").alias("first"), F.col("c_mktsegment").alias("last"), F.col("c_acctbal").cast("decimal(10,2)").alias("salary"), "c_nationkey")
    s = t(spark, d, "supplier").select(F.col("s_name").alias("first"), F.lit("supplier").alias("last"), F.col("s_acctbal").cast("decimal(10,2)").alias("salary"))
    ends = [0]
    for rows in (c.filter("c_nationkey < 8").drop("c_nationkey"), s, c.filter("c_nationkey <= 12").drop("c_nationkey")):
        absent = rows.join(spark.table(name).select("first", "last"), ["first", "last"], "left_anti")
        ends.append(ends[-1] + D.append_with_serial(spark, name, absent, "id", root))
    all_ = spark.table(name)
    counts = all_.groupBy(F.col("id").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    batch = F.when(F.col("id") <= ends[1], 1).when(F.col("id") <= ends[2], 2).otherwise(3)
    return all_.join(counts, all_["id"] == counts["k"]).select("first", "last", F.col("salary").cast("double").alias("salary"), (F.col("n") == 1).alias("unique_id"),
                                                               ((F.col("id") >= 1) & (F.col("id") <= ends[3])).alias("ranged"), batch.alias("batch"))


@register("d9_deletable_objects", """
WITH obj AS (
  SELECT o_orderkey, o_orderdate AS created, o_orderstatus = 'P' AS temporary_hold,
         (o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 0) AS event_based_hold,
         CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderdate + INTERVAL 400 DAY END AS event_hold_released
  FROM orders)
SELECT o_orderkey,
       (NOT (temporary_hold OR event_based_hold))
       AND TIMESTAMP '2001-01-01 00:00:00' >= greatest(created, coalesce(event_hold_released, created))
                                              + INTERVAL 94608000 SECOND AS deletable
FROM obj""")
def d9_deletable_objects(spark, d):
    o = t(spark, d, "orders")
    objects = o.select("o_orderkey", F.col("o_orderdate").alias("created"),
                       (F.col("o_orderstatus") == "P").alias("temporary_hold"),
                       ((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 2 == 0))
                       .alias("event_based_hold"),
                       F.when(F.col("o_orderpriority") == "2-HIGH",
                              F.col("o_orderdate") + F.make_interval(days=F.lit(400))).alias("event_hold_released"))
    return D.deletable(objects, 3 * 365 * 86400, "2001-01-01 00:00:00").select("o_orderkey", "deletable")


# --------------------------------------------------------------------------
# F: scalar functions
# --------------------------------------------------------------------------


@register("f1_f4_dates", """
WITH s AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 13 = 0 THEN 'bad' || CAST(o_orderkey AS VARCHAR)
              ELSE strftime(o_orderdate, '%Y%m%d') END AS ds
  FROM orders)
SELECT o_orderkey, ds, CAST(try_strptime(ds, '%Y%m%d') AS DATE) AS parsed,
       CAST(make_date(TRY_CAST(substr(ds, 1, 4) AS BIGINT), TRY_CAST(substr(ds, 5, 2) AS BIGINT),
                      TRY_CAST(substr(ds, 7, 2) AS BIGINT)) AS DATE) AS from_parts,
       TRY_CAST(substr(ds, 1, 4) AS BIGINT) AS year_num,
       CAST(try_strptime(ds, '%Y%m%d') AS DATE) >= DATE '2000-01-01' AS recent
FROM s""")
def f1_f4_dates(spark, d):
    o = t(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit("bad"), F.col("o_orderkey").cast("string")))
         .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("ds"))
    y, m, dd = (S.to_int64(F.substring("ds", 1, 4)), S.to_int64(F.substring("ds", 5, 2)),
                S.to_int64(F.substring("ds", 7, 2)))
    return o.select("o_orderkey", "ds", S.parse_date("ds").alias("parsed"),
                    S.date_from_parts(y, m, dd).alias("from_parts"), y.alias("year_num"),
                    (S.parse_date("ds") >= S.date_lit("2000-01-01")).alias("recent"))


@register("f5_f6_f9_strings", """
SELECT c_custkey, trim(concat('  ', c_name, ' ')) AS trimmed,
       concat(c_name, '/', CAST(c_nationkey AS VARCHAR), '/', CAST(c_custkey AS VARCHAR)) AS label,
       c_name LIKE '%9%' AS has_nine
FROM customer""")
def f5_f6_f9_strings(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", S.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("trimmed"),
                    S.concat_any("c_name", F.lit("/"), "c_nationkey", F.lit("/"), "c_custkey").alias("label"),
                    S.like("c_name", "%9%").alias("has_nine"))


@register("f7_f8_f10_arrays", f"""
SELECT l_orderkey, CAST(len(lines) AS INTEGER) AS n_lines, lines[1].quantity AS first_qty,
       list_contains([1, 2, 3], CAST(len(lines) AS INTEGER)) AS few_lines
FROM (SELECT l_orderkey,
             list({{'linenumber': l_linenumber, 'quantity': l_quantity}} ORDER BY l_linenumber, l_quantity) AS lines
      FROM lineitem GROUP BY l_orderkey)""")
def f7_f8_f10_arrays(spark, d):
    from quarry.plans.warehouse import order_lines
    ol = order_lines(spark, d)
    n = S.array_length("lines")
    return ol.select("l_orderkey", n.alias("n_lines"), S.field(F.col("lines")[0], "quantity").alias("first_qty"),
                     F.array_contains(S.array_lit(1, 2, 3), n).alias("few_lines"))


@register("f11_decode_message", """
WITH m AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN NULL
              ELSE to_base64(encode(c_name)) END AS data
  FROM customer)
SELECT c_custkey, 'Hello ' || coalesce(nullif(decode(from_base64(data)), ''), 'World') || '!' AS greeting
FROM m""")
def f11_decode_message(spark, d):
    c = t(spark, d, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 10 == 0, F.lit("")).when(F.col("c_custkey") % 10 == 1, F.lit(None))
         .otherwise(F.base64(F.encode("c_name", "UTF-8"))).alias("data"))
    return c.select("c_custkey", S.decode_message("data").alias("greeting"))


def policy_documents(spark: SparkSession, d: str) -> DataFrame:
    """One small policy document (JSON text) per customer, built from
    ``customer`` and ``nation``: bounded size per document."""
    c = t(spark, d, "customer")
    n = t(spark, d, "nation").select("n_nationkey", "n_name")
    cn = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"])
    doc = F.to_json(F.struct(F.array(
        F.struct(F.concat(F.lit("roles/"), F.lower("c_mktsegment")).alias("role"),
                 F.array(F.concat(F.lit("user:"), "c_name"), F.concat(F.lit("group:"), F.lower("n_name")))
                 .alias("members")),
        F.struct(F.lit("roles/viewer").alias("role"),
                 F.array(F.concat(F.lit("user:"), "c_name")).alias("members"))).alias("bindings")))
    return cn.select(F.col("c_custkey").alias("policy_id"), doc.alias("policy"))


POLICY_PAIRS_SQL = """
(SELECT c.c_custkey AS policy_id, 'roles/' || lower(c.c_mktsegment) AS role, 'user:' || c.c_name AS member
 FROM customer c
 UNION ALL
 SELECT c.c_custkey, 'roles/' || lower(c.c_mktsegment), 'group:' || lower(n.n_name)
 FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
 UNION ALL
 SELECT c_custkey, 'roles/viewer', 'user:' || c_name FROM customer)"""


@register("f12_policy_flatten", f"SELECT policy_id, role, member FROM {POLICY_PAIRS_SQL} WHERE role <> 'roles/viewer'")
def f12_policy_flatten(spark, d):
    p = policy_documents(spark, d)
    flat = p.select("policy_id", F.inline(S.policy_members("policy")))
    return flat.filter(F.col("role") != "roles/viewer")
