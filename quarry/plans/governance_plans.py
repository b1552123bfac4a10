"""Governance, quality and finding-rule queries (Q1-Q9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import governance as G
from quarry.operators.discovery import discover
from quarry.plans.registry import register, t
from quarry.plans.warehouse import CUSTOMERS_WITH_NULLS_SQL, MISSING_KEYS_SQL, customers_with_nulls
from quarry.session import scratch_path
from quarry.sources import io

DQ_RULES = [{"column": "c_mktsegment", "dimension": "COMPLETENESS", "threshold": 0.9},
            {"column": "c_acctbal", "dimension": "COMPLETENESS", "threshold": 0.9},
            {"column": "c_name", "dimension": "COMPLETENESS", "threshold": 1.0}]


def _dq_sql() -> str:
    parts = []
    for r in DQ_RULES:
        c, thr = r["column"], r["threshold"]
        ratio = f"CASE WHEN count(*) = 0 THEN 1.0 ELSE count({c}) / count(*) END"
        parts.append(f"SELECT '{c}' AS column_name, '{r['dimension']}' AS dimension, CAST({thr} AS DOUBLE) AS threshold, "
                     f"CAST(count(*) AS BIGINT) AS n_rows, CAST(count({c}) AS BIGINT) AS n_passed, "
                     f"round({ratio}, 6) AS pass_ratio, {ratio} >= {thr} AS passed FROM {CUSTOMERS_WITH_NULLS_SQL}")
    return " UNION ALL ".join(parts)


@register("q1_dq_scan", _dq_sql())
def q1_dq_scan(spark, d):
    return G.dq_scan(customers_with_nulls(spark, d), DQ_RULES).withColumn("pass_ratio", F.round("pass_ratio", 6))


@register("q2_export_results", f"SELECT *, CAST(run AS INTEGER) AS run_no FROM ({_dq_sql()}) CROSS JOIN (VALUES (1), (2)) r(run)")
def q2_export_results(spark, d):
    from quarry.plans.tables_plans import fresh_db
    db, _ = fresh_db(spark, "q2")
    name = f"{db}.dq_results"
    for run in (1, 2):  # each scan appends its results
        res = G.dq_scan(customers_with_nulls(spark, d), DQ_RULES).withColumn("pass_ratio", F.round("pass_ratio", 6))
        io.materialize(res.withColumn("run_no", F.lit(run)), name, mode="append")
    return spark.table(name).withColumn("run", F.col("run_no"))


@register("q3_missing_keys", MISSING_KEYS_SQL)
def q3_missing_keys(spark, d):
    return G.missing_keys(customers_with_nulls(spark, d), "c_custkey", ["c_mktsegment", "c_acctbal"])


@register("q4_q5_drop_protected", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def q4_q5_drop_protected(spark, d):
    c = G.tag_columns(t(spark, d, "customer"), ["c_name", "c_acctbal"], "protected")
    return G.project_unprotected(c, "drop")


@register("q5_redact_protected",
          "SELECT c_custkey, '[redacted]' AS c_name, c_nationkey, '[redacted]' AS c_acctbal, c_mktsegment FROM customer")
def q5_redact_protected(spark, d):
    c = G.tag_columns(t(spark, d, "customer"), ["c_name", "c_acctbal"], "protected")
    return G.project_unprotected(c, "redact")


@register("q6_discover_zone", """
WITH told AS (
  SELECT DISTINCT table_name AS asset, column_name, CAST(ordinal_position - 1 AS INTEGER) AS place, data_type AS kind
  FROM information_schema.columns WHERE table_name IN ('nation', 'orders', 'supplier')),
keys AS (SELECT max(s_suppkey) <= 2147483647 AS small FROM supplier)
SELECT asset, 'parquet' AS format, place AS position, column_name,
       CASE WHEN column_name = 'n_regionkey' OR kind = 'BIGINT' THEN 'bigint' WHEN kind = 'INTEGER' THEN 'int' ELSE 'string' END AS data_type, true AS nullable
FROM told WHERE asset = 'nation'
UNION ALL SELECT 'nation', 'parquet', 3, 'n_note', 'string', true
UNION ALL
SELECT asset, 'json', CAST(row_number() OVER (ORDER BY column_name) - 1 AS INTEGER), column_name,
       CASE WHEN column_name = 'o_custkey' THEN 'string' WHEN kind IN ('BIGINT', 'INTEGER') THEN 'bigint' WHEN kind = 'DOUBLE' THEN 'double' ELSE 'string' END, true
FROM told WHERE asset = 'orders'
UNION ALL
SELECT asset, 'csv', place, column_name,
       CASE WHEN kind = 'DOUBLE' THEN 'double' WHEN kind = 'VARCHAR' THEN 'string' WHEN kind = 'INTEGER' OR small THEN 'int' ELSE 'bigint' END, true
FROM told CROSS JOIN keys WHERE asset = 'supplier'""")
def q6_discover_zone(spark, d):
    # a RAW zone of three formats; the files of two assets differ in their types
    zone = scratch_path(spark, "zones", "raw")
    n, o = t(spark, d, "nation"), t(spark, d, "orders")
    n.write.parquet(f"{zone}/nation")
    (n.withColumn("n_regionkey", F.col("n_regionkey").cast("long")).withColumn("n_note", F.lit("x"))
     .write.mode("append").parquet(f"{zone}/nation"))
    even = F.col("o_orderkey") % 2 == 0
    o.filter(even).withColumn("o_totalprice", F.col("o_totalprice").cast("long")).write.json(f"{zone}/orders")
    o.filter(~even).withColumn("o_custkey", F.concat(F.lit("c"), "o_custkey")).write.mode("append").json(f"{zone}/orders")
    t(spark, d, "supplier").write.option("header", "true").csv(f"{zone}/supplier")
    return discover(spark, zone)


def _event_findings(spark, d):
    e = t(spark, d, "events")
    sev = (F.when(F.col("value") >= 450, "CRITICAL").when(F.col("value") >= 400, "CRITICAL-ish")
            .when(F.col("value") >= 100, "HIGH").otherwise("LOW"))
    return e.select("event_id", F.col("user_id").alias("image"), F.col("event_type").alias("category"),
                    sev.alias("severity"))


EVENT_FINDINGS_SQL = """
(SELECT event_id, user_id AS image, event_type AS category,
        CASE WHEN value >= 450 THEN 'CRITICAL' WHEN value >= 400 THEN 'CRITICAL-ish'
             WHEN value >= 100 THEN 'HIGH' ELSE 'LOW' END AS severity
 FROM events)"""


@register("q7_mute_rules", f"""
SELECT event_id, image, category, severity, category IN ('view', 'click') AS muted FROM {EVENT_FINDINGS_SQL}""")
def q7_mute_rules(spark, d):
    rules = spark.createDataFrame([("view",), ("click",)], "category string")
    return G.mute(_event_findings(spark, d), rules)


@register("q8_severity_gate", f"""
SELECT image, bool_or(severity = 'CRITICAL') AS failed, CAST(count(*) AS BIGINT) AS n_findings
FROM {EVENT_FINDINGS_SQL} GROUP BY image""")
def q8_severity_gate(spark, d):
    return G.severity_gate(_event_findings(spark, d), "CRITICAL", by=["image"])


@register("q9_has_binding", """
SELECT c_custkey AS policy_id, 'roles/' || lower(c_mktsegment) AS role, 'group:' || lower(n.n_name) AS member
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE lower(c_mktsegment) = 'building' AND lower(n.n_name) IN ('nation_3', 'nation_7')""")
def q9_has_binding(spark, d):
    from quarry.plans.tables_plans import policy_documents
    wanted = spark.createDataFrame([("roles/building", "group:nation_3"), ("roles/building", "group:nation_7"),
                                    ("roles/owner", "group:nation_3")], "role string, member string")
    return G.has_binding(policy_documents(spark, d), wanted).select("policy_id", "role", "member")
