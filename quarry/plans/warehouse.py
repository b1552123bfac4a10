"""Warehouse queries: projections, filters, joins, aggregates, windows,
sort/limit and unions (P1-P12, J1-J15, A1-A15, W1-W2, O1-O3, U1, Q3).

NULLs are made by rule (the supplied tables have none), identically in the
Spark plan and in the oracle SQL.  Doubles that come out of sums and
averages are rounded in both, so the value hash does not depend on the
order of floating point additions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import relational as R
from quarry.operators.scans import distributed_rank
from quarry.plans.registry import register, t

# --------------------------------------------------------------------------
# shared derived frames
# --------------------------------------------------------------------------


def customers_with_nulls(spark: SparkSession, d: str) -> DataFrame:
    """customer with NULL segments (key % 7 = 0) and NULL balances (key % 5 = 0)."""
    c = t(spark, d, "customer")
    return c.select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_custkey") % 5 == 0, None).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))


CUSTOMERS_WITH_NULLS_SQL = """
(SELECT c_custkey, c_name, c_nationkey,
        CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
        CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
 FROM customer)"""


def order_lines(spark: SparkSession, d: str, sort: bool = True) -> DataFrame:
    """Per order, its lines as ``array<struct<linenumber, quantity>>``
    (nested, repeated data rebuilt from ``lineitem``).  The group is one
    order's lines: bounded by the order size, never by the table."""
    li = t(spark, d, "lineitem")
    return R.array_agg(li, ["l_orderkey"],
                       F.struct(F.col("l_linenumber").alias("linenumber"),
                                F.col("l_quantity").alias("quantity")),
                       "lines", sort=sort)


# --------------------------------------------------------------------------
# S1, P: scans, projections, predicates
# --------------------------------------------------------------------------


@register("s1_scan_supplier", "SELECT * FROM supplier")
def s1_scan_supplier(spark, d):
    return t(spark, d, "supplier")


@register("p1_project_aliases",
          "SELECT p_partkey AS sku, p_name AS name, p_retailprice AS price FROM part")
def p1_project_aliases(spark, d):
    return R.project(t(spark, d, "part"), {"sku": "p_partkey", "name": "p_name", "price": "p_retailprice"})


@register("p2_project_side", """
SELECT o.o_orderkey, c.*
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderpriority = '1-URGENT'""")
def p2_project_side(spark, d):
    o = t(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT").alias("o")
    c = t(spark, d, "customer").alias("c")
    j = o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"))
    return R.project_side(j, "c", F.col("o.o_orderkey"))


@register("p3_nested_field", """
SELECT o_orderkey, info.priority AS priority, info.status AS status
FROM (SELECT o_orderkey, {'status': o_orderstatus, 'priority': o_orderpriority} AS info FROM orders)
WHERE info.status = 'O'""")
def p3_nested_field(spark, d):
    o = t(spark, d, "orders").select(
        "o_orderkey", F.struct(F.col("o_orderstatus").alias("status"),
                               F.col("o_orderpriority").alias("priority")).alias("info"))
    return o.filter(F.col("info.status") == "O").select(
        "o_orderkey", F.col("info.priority").alias("priority"), F.col("info.status").alias("status"))


@register("p4_where_eq", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND l_linenumber = 1 AND CAST(l_shipdate AS DATE) >= DATE '1996-01-01'""")
def p4_where_eq(spark, d):
    li = R.where_eq(R.where_eq(t(spark, d, "lineitem"), "l_returnflag", "R"), "l_linenumber", 1)
    li = li.filter(F.col("l_shipdate").cast("date") >= F.to_date(F.lit("1996-01-01")))
    return li.select("l_orderkey", "l_linenumber", "l_quantity")


@register("p5_where_eq_double", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice = 900.1")
def p5_where_eq_double(spark, d):
    return R.where_eq(t(spark, d, "part"), "p_retailprice", 900.1).select(
        "p_partkey", "p_name", "p_retailprice")


@register("p6_where_not_in", f"""
SELECT c_custkey, c_mktsegment FROM {CUSTOMERS_WITH_NULLS_SQL}
WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def p6_where_not_in(spark, d):
    return R.where_not_in(customers_with_nulls(spark, d), "c_mktsegment",
                          ["BUILDING", "MACHINERY"]).select("c_custkey", "c_mktsegment")


@register("p7_where_null", f"""
SELECT c_custkey, c_mktsegment, c_acctbal FROM {CUSTOMERS_WITH_NULLS_SQL}
WHERE c_mktsegment IS NULL OR (c_acctbal IS NOT NULL AND c_acctbal < 0)""")
def p7_where_null(spark, d):
    c = customers_with_nulls(spark, d)
    return c.filter(F.col("c_mktsegment").isNull() |
                    (F.col("c_acctbal").isNotNull() & (F.col("c_acctbal") < 0))).select(
        "c_custkey", "c_mktsegment", "c_acctbal")


@register("p8_and_or", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE (l_returnflag = 'R' OR l_linestatus = 'O') AND l_quantity > 40""")
def p8_and_or(spark, d):
    li = t(spark, d, "lineitem")
    return li.filter(((F.col("l_returnflag") == "R") | (F.col("l_linestatus") == "O")) &
                     (F.col("l_quantity") > 40)).select("l_orderkey", "l_linenumber")


@register("p9_where_range", """
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0 AND l_discount < 0.03""")
def p9_where_range(spark, d):
    return R.where_range(t(spark, d, "lineitem"), "l_discount", 0, 0.03).select(
        "l_orderkey", "l_linenumber", "l_discount")


@register("p10_where_like", """
SELECT p_partkey, p_name, p_type FROM part WHERE p_name LIKE 'small%' OR p_type LIKE '%CO%'""")
def p10_where_like(spark, d):
    p = t(spark, d, "part")
    return p.filter(F.col("p_name").like("small%") | F.col("p_type").like("%CO%")).select(
        "p_partkey", "p_name", "p_type")


@register("p11_label_filter", """
SELECT event_id, user_id, props FROM events
WHERE event_type = 'error' AND contains(lower(props), '9')""")
def p11_label_filter(spark, d):
    return R.label_filter(t(spark, d, "events"), eq={"event_type": "error"},
                          has={"props": "9"}).select("event_id", "user_id", "props")


@register("p12_event_type_filter", """
SELECT event_id, ts, value FROM events
WHERE event_type = 'purchase' AND user_id = 7 AND contains(lower(props), '"k"')""")
def p12_event_type_filter(spark, d):
    return R.label_filter(t(spark, d, "events"), eq={"event_type": "purchase", "user_id": 7},
                          has={"props": '"k"'}).select("event_id", "ts", "value")


# --------------------------------------------------------------------------
# J: joins
# --------------------------------------------------------------------------


@register("j1_join_inner", """
SELECT o.o_orderkey, c.c_name, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'AUTOMOBILE'""")
def j1_join_inner(spark, d):
    o = t(spark, d, "orders")
    c = t(spark, d, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
    return R.join_inner(o, c, {"o_custkey": "c_custkey"}).select("o_orderkey", "c_name", "o_totalprice")


@register("j2_join_left", """
SELECT o.o_orderkey, l.l_linenumber
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def j2_join_left(spark, d):
    o = t(spark, d, "orders").select("o_orderkey")
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return R.join_left(o, li, {"o_orderkey": "l_orderkey"}).select("o_orderkey", "l_linenumber")


@register("j3_left_only", """
SELECT o.o_orderkey, o.o_custkey, l.l_linenumber
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_orderkey IS NULL""")
def j3_left_only(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = t(spark, d, "lineitem")
    return R.left_only(o, li, {"o_orderkey": "l_orderkey"}, right_cols={"l_linenumber": "int"})


@register("j4_right_only_keys", """
SELECT o.o_orderkey
FROM lineitem l RIGHT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_orderkey IS NULL""")
def j4_right_only_keys(spark, d):
    li = t(spark, d, "lineitem")
    o = t(spark, d, "orders")
    return R.right_only(li, o, {"l_orderkey": "o_orderkey"}).select("o_orderkey")


@register("j5_right_only_rows", """
SELECT o.*
FROM lineitem l RIGHT JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_orderkey IS NULL""")
def j5_right_only_rows(spark, d):
    return R.right_only(t(spark, d, "lineitem"), t(spark, d, "orders"), {"l_orderkey": "o_orderkey"})


@register("j6_reconcile", """
SELECT a.o_orderkey, b.l_orderkey
FROM (SELECT o_orderkey FROM orders) a
FULL OUTER JOIN (SELECT DISTINCT l_orderkey FROM lineitem) b ON a.o_orderkey = b.l_orderkey
WHERE a.o_orderkey IS NULL OR b.l_orderkey IS NULL""")
def j6_reconcile(spark, d):
    li_keys = t(spark, d, "lineitem").select("l_orderkey").distinct()
    return R.reconcile(t(spark, d, "orders"), li_keys, "o_orderkey", "l_orderkey")


@register("j7_cross_param", """
SELECT p_partkey, p_retailprice, p_retailprice * (1 - discount) AS sale_price
FROM part CROSS JOIN (SELECT CAST(0.05 AS DOUBLE) AS discount) promotion""")
def j7_cross_param(spark, d):
    from quarry.sources.io import constant
    promo = constant(spark, discount=0.05)
    out = R.cross_param(t(spark, d, "part").select("p_partkey", "p_retailprice"), promo)
    return out.select("p_partkey", "p_retailprice",
                      (F.col("p_retailprice") * (1 - F.col("discount"))).alias("sale_price"))


ORDER_LINES_SQL = """
(SELECT l_orderkey, list({'linenumber': l_linenumber, 'quantity': l_quantity}) AS lines
 FROM lineitem GROUP BY l_orderkey)"""


@register("j8_unnest", f"""
SELECT o.l_orderkey, ln.linenumber AS linenumber, ln.quantity AS quantity
FROM (SELECT l_orderkey, unnest(lines) AS ln FROM {ORDER_LINES_SQL}) o""")
def j8_unnest(spark, d):
    u = R.unnest(order_lines(spark, d), "lines", "ln", keep=["l_orderkey"])
    return u.select("l_orderkey", F.col("ln.linenumber").alias("linenumber"),
                    F.col("ln.quantity").alias("quantity"))


@register("j9_unnest_chain", """
WITH per_order AS (
  SELECT l_orderkey,
         list({'linenumber': l_linenumber, 'splits': [l_quantity, l_extendedprice]}) AS lines
  FROM lineitem GROUP BY l_orderkey),
flat AS (
  SELECT o.o_orderstatus AS status, unnest(x.splits) AS v
  FROM (SELECT l_orderkey, unnest(lines) AS x FROM per_order) p JOIN orders o ON o.o_orderkey = p.l_orderkey)
SELECT status, CAST(count(*) AS BIGINT) AS n_values, round(sum(v), 2) AS total
FROM flat GROUP BY status""")
def j9_unnest_chain(spark, d):
    # array (per line) inside an array of structs (per order): two levels,
    # each bounded by the size of one order
    li = t(spark, d, "lineitem")
    nested = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_linenumber").alias("linenumber"),
        F.array("l_quantity", "l_extendedprice").alias("splits"))).alias("lines"))
    flat = R.unnest_chain(nested, "lines", "x", "splits", "v", keep=["l_orderkey"])
    o = t(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    j = flat.join(o, flat["l_orderkey"] == o["o_orderkey"])
    return j.groupBy("status").agg(F.count(F.lit(1)).alias("n_values"), F.round(F.sum("v"), 2).alias("total"))


@register("j10_lookup_one", """
SELECT n.n_nationkey, n.n_name,
       (SELECT min(c.c_mktsegment) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS any_segment
FROM nation n""")
def j10_lookup_one(spark, d):
    n = t(spark, d, "nation").select("n_nationkey", "n_name")
    return R.lookup_one(n, t(spark, d, "customer"), "n_nationkey", "c_nationkey",
                        "c_mktsegment", "any_segment")


@register("j11_anti_by_keys", """
SELECT DISTINCT l.l_partkey, l.l_suppkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem r
                  WHERE r.l_returnflag = 'R' AND r.l_partkey = l.l_partkey AND r.l_suppkey = l.l_suppkey)""")
def j11_anti_by_keys(spark, d):
    li = t(spark, d, "lineitem")
    pairs = li.select("l_partkey", "l_suppkey").distinct()
    returned = li.filter(F.col("l_returnflag") == "R")
    return R.anti_by_keys(pairs, returned, ["l_partkey", "l_suppkey"])


@register("j12_fanout_join", """
SELECT a.l_orderkey, a.l_linenumber AS line, b.l_linenumber AS other, a.l_partkey, b.l_suppkey
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey""")
def j12_fanout_join(spark, d):
    # the fan-out is kept as it is; the key's multiplicity is bounded by the lines of an order
    li = t(spark, d, "lineitem")
    a = li.select("l_orderkey", F.col("l_linenumber").alias("line"), "l_partkey")
    b = li.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("other"), "l_suppkey")
    return R.join_inner(a, b, {"l_orderkey": "key"}).select("l_orderkey", "line", "other", "l_partkey", "l_suppkey")


@register("j13_join_trimmed", """
SELECT o.o_orderkey, c.c_name
FROM (SELECT o_orderkey, concat(CAST(o_custkey AS VARCHAR), '  ') AS ckey FROM orders) o
JOIN (SELECT c_name, lpad(CAST(c_custkey AS VARCHAR), 12, ' ') AS ckey FROM customer) c
  ON trim(o.ckey) = trim(c.ckey)""")
def j13_join_trimmed(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.concat(F.col("o_custkey").cast("string"),
                                                            F.lit("  ")).alias("o_ckey"))
    c = t(spark, d, "customer").select("c_name", F.lpad(F.col("c_custkey").cast("string"), 12, " ")
                                       .alias("c_ckey"))
    j = R.join_on_expr(o, c, [(F.trim(o["o_ckey"]), F.trim(c["c_ckey"]))])
    return j.select("o_orderkey", "c_name")


@register("j14_join_concat", """
WITH daily AS (
  SELECT c.c_mktsegment AS seg, CAST(o.o_orderdate AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
big AS (
  SELECT c.c_mktsegment AS seg, CAST(o.o_orderdate AS DATE) AS day, round(max(o.o_totalprice), 2) AS max_price
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_totalprice > 300000 GROUP BY 1, 2)
SELECT a.seg, a.day, a.n_orders, b.max_price
FROM daily a JOIN big b ON concat(a.seg, CAST(a.day AS VARCHAR)) = concat(b.seg, CAST(b.day AS VARCHAR))""")
def j14_join_concat(spark, d):
    o = t(spark, d, "orders")
    c = t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("c_mktsegment").alias("seg"), F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    daily = oc.groupBy("seg", "day").agg(F.count(F.lit(1)).alias("n_orders"))
    big = oc.filter(F.col("o_totalprice") > 300000).groupBy("seg", "day").agg(
        F.round(F.max("o_totalprice"), 2).alias("max_price"))
    a, b = daily.alias("a"), big.alias("b")
    j = R.join_on_expr(a, b, [(F.concat(F.col("a.seg"), F.col("a.day").cast("string")),
                               F.concat(F.col("b.seg"), F.col("b.day").cast("string")))])
    return j.select("a.seg", "a.day", "a.n_orders", "b.max_price")


@register("j15_key_audit_name_brands", """
SELECT p_name, CAST(count(DISTINCT p_brand) AS BIGINT) AS n_values,
       array_to_string(list_sort(list(DISTINCT p_brand))[1:5], ',') AS "values"
FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1""")
def j15_key_audit_name_brands(spark, d):
    return R.key_audit(t(spark, d, "part"), "p_name", "p_brand", n=5)


@register("j15_key_audit_brand_names", """
SELECT p_brand, CAST(count(DISTINCT p_name) AS BIGINT) AS n_values,
       array_to_string(list_sort(list(DISTINCT p_name))[1:5], ',') AS "values"
FROM part GROUP BY p_brand HAVING count(DISTINCT p_name) > 1""")
def j15_key_audit_brand_names(spark, d):
    return R.key_audit(t(spark, d, "part"), "p_brand", "p_name", n=5)


# --------------------------------------------------------------------------
# A: aggregates
# --------------------------------------------------------------------------


@register("a1_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def a1_distinct(spark, d):
    return R.distinct(t(spark, d, "part"), ["p_brand", "p_type"])


@register("a2_group_dedupe", "SELECT c_nationkey, c_mktsegment FROM customer GROUP BY c_nationkey, c_mktsegment")
def a2_group_dedupe(spark, d):
    return R.distinct(t(spark, d, "customer"), ["c_nationkey", "c_mktsegment"])


@register("a3_count_distinct", """
SELECT p_name, CAST(count(DISTINCT p_brand) AS BIGINT) AS n_brands FROM part GROUP BY p_name""")
def a3_count_distinct(spark, d):
    return R.count_distinct(t(spark, d, "part"), ["p_name"], "p_brand", "n_brands")


@register("a4_string_agg_distinct", """
SELECT p_name, array_to_string(list_sort(list(DISTINCT p_brand))[1:5], ',') AS brands
FROM part GROUP BY p_name""")
def a4_string_agg_distinct(spark, d):
    return R.string_agg_distinct(t(spark, d, "part"), "p_name", "p_brand", 5, "brands")


@register("a5_having", """
SELECT p_name, CAST(count(DISTINCT p_brand) AS BIGINT) AS n_brands
FROM part GROUP BY p_name HAVING n_brands > 20""")
def a5_having(spark, d):
    agg = R.count_distinct(t(spark, d, "part"), ["p_name"], "p_brand", "n_brands")
    return R.having(agg, F.col("n_brands") > 20)


@register("a6_sum_over_distinct", """
WITH dedup AS (SELECT DISTINCT l_orderkey, l_partkey, l_quantity FROM lineitem)
SELECT l_partkey, round(sum(l_quantity), 2) AS total_qty FROM dedup GROUP BY l_partkey""")
def a6_sum_over_distinct(spark, d):
    out = R.sum_by(t(spark, d, "lineitem"), ["l_partkey"], "l_quantity", "total_qty",
                   dedupe=["l_orderkey", "l_partkey", "l_quantity"])
    return out.withColumn("total_qty", F.round("total_qty", 2))


@register("a7_sum_unnested", f"""
SELECT l_orderkey, round(sum(ln.quantity), 2) AS total_qty
FROM (SELECT l_orderkey, unnest(lines) AS ln FROM {ORDER_LINES_SQL})
GROUP BY l_orderkey ORDER BY total_qty, l_orderkey""")
def a7_sum_unnested(spark, d):
    u = R.unnest(order_lines(spark, d, sort=False), "lines", "ln", keep=["l_orderkey"])
    s = u.groupBy("l_orderkey").agg(F.round(F.sum("ln.quantity"), 2).alias("total_qty"))
    return R.sort(s, "total_qty", "l_orderkey")


@register("a8_avg_by_two_keys", """
SELECT l_returnflag, l_linestatus,
       round(avg(l_quantity), 4) AS avg_qty, round(avg(l_extendedprice), 4) AS avg_price,
       round(avg(l_discount), 6) AS avg_disc, round(avg(l_tax), 6) AS avg_tax
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def a8_avg_by_two_keys(spark, d):
    out = R.avg_by(t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"],
                   {"avg_qty": "l_quantity", "avg_price": "l_extendedprice",
                    "avg_disc": "l_discount", "avg_tax": "l_tax"})
    return out.select("l_returnflag", "l_linestatus", F.round("avg_qty", 4).alias("avg_qty"),
                      F.round("avg_price", 4).alias("avg_price"), F.round("avg_disc", 6).alias("avg_disc"),
                      F.round("avg_tax", 6).alias("avg_tax"))


@register("a9_array_agg", """
SELECT l_orderkey, array_to_string(list_sort(list(CAST(l_linenumber AS VARCHAR))), ',') AS linenumbers
FROM lineitem GROUP BY l_orderkey""")
def a9_array_agg(spark, d):
    a = R.array_agg(t(spark, d, "lineitem"), ["l_orderkey"], F.col("l_linenumber").cast("string"),
                    "linenumbers")
    return a.select("l_orderkey", F.array_join("linenumbers", ",").alias("linenumbers"))


@register("a10_array_agg_distinct", """
SELECT p_name, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS brands FROM part GROUP BY p_name""")
def a10_array_agg_distinct(spark, d):
    a = R.array_agg(t(spark, d, "part"), ["p_name"], "p_brand", "brands", distinct=True)
    return a.select("p_name", F.array_join("brands", ",").alias("brands"))


@register("a11_pick_one", """
SELECT p_name, min(p_brand) AS brand FROM part GROUP BY p_name""")
def a11_pick_one(spark, d):
    a = R.pick_one(t(spark, d, "part"), ["p_name"], "p_brand", "brand_arr")
    return a.select("p_name", F.col("brand_arr")[0].alias("brand"))


@register("a12_array_length", """
SELECT l_orderkey, CAST(count(l_linenumber) AS BIGINT) AS n_lines,
       CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_parts
FROM lineitem GROUP BY l_orderkey""")
def a12_array_length(spark, d):
    li = t(spark, d, "lineitem")
    return li.groupBy("l_orderkey").agg(F.count("l_linenumber").alias("n_lines"),
                                        F.count_distinct("l_partkey").alias("n_parts"))


@register("a13_any_value", """
SELECT c_nationkey, min(c_name) AS some_customer FROM customer GROUP BY c_nationkey""")
def a13_any_value(spark, d):
    return R.any_value(t(spark, d, "customer"), ["c_nationkey"], "c_name", "some_customer")


@register("a14_count_nonnull_unnested", f"""
SELECT l_orderkey, CAST(count(CASE WHEN ln.quantity > 25 THEN ln.quantity END) AS BIGINT) AS n_big
FROM (SELECT l_orderkey, unnest(lines) AS ln FROM {ORDER_LINES_SQL})
GROUP BY l_orderkey""")
def a14_count_nonnull_unnested(spark, d):
    u = R.unnest(order_lines(spark, d), "lines", "ln", keep=["l_orderkey"])
    u = u.select("l_orderkey", F.when(F.col("ln.quantity") > 25, F.col("ln.quantity")).alias("big_qty"))
    return R.count_nonnull(u, "big_qty", "n_big", keys=["l_orderkey"])


@register("a15_share_of_total", """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / (SELECT count(*) FROM orders), 6) AS share
FROM orders GROUP BY o_orderpriority""")
def a15_share_of_total(spark, d):
    s = R.share_of_total(t(spark, d, "orders"), "o_orderpriority")
    return s.withColumn("share", F.round("share", 6))


# --------------------------------------------------------------------------
# W, O, U
# --------------------------------------------------------------------------


def orders_by_nation(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = t(spark, d, "nation").select("n_nationkey", "n_name")
    # nation has one row per nation (a fixed, tiny dimension): broadcast it.
    return (o.join(c, o["o_custkey"] == c["c_custkey"])
             .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
             .select("n_name", "o_orderkey", "o_totalprice"))


ORDERS_BY_NATION_SQL = """
(SELECT n.n_name, o.o_orderkey, o.o_totalprice
 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


@register("w1_row_number", f"""
SELECT n_name, o_orderkey, o_totalprice,
       CAST(row_number() OVER (PARTITION BY n_name ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn
FROM {ORDERS_BY_NATION_SQL}""")
def w1_row_number(spark, d):
    # 25 keys: ranged by (key, order), so that no task sorts a whole one
    return distributed_rank(orders_by_nation(spark, d), ["n_name"], [F.col("o_totalprice").desc(), F.col("o_orderkey")])


def top_orders_per_nation(spark: SparkSession, d: str, n: int = 10) -> DataFrame:
    """W2, the flagship: top ``n`` orders by total price per customer nation."""
    return R.top_n_per_group(orders_by_nation(spark, d), ["n_name"],
                             [F.col("o_totalprice").desc(), F.col("o_orderkey")], n)


@register("w2_top_n_per_group", f"""
SELECT * FROM (
  SELECT n_name, o_orderkey, o_totalprice,
         CAST(row_number() OVER (PARTITION BY n_name ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rn
  FROM {ORDERS_BY_NATION_SQL}) WHERE rn <= 10""")
def w2_top_n_per_group(spark, d):
    return top_orders_per_nation(spark, d, 10)


@register("o1_sort", "SELECT n_nationkey, n_name FROM nation ORDER BY n_name DESC")
def o1_sort(spark, d):
    return R.sort(t(spark, d, "nation").select("n_nationkey", "n_name"), F.col("n_name").desc())


@register("o2_limit", "SELECT CAST(5 AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_of_orders")
def o2_limit(spark, d):
    # unordered LIMIT is the feature itself: any 5 rows, all of them orders
    orders = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    some = R.limit(orders, 5).withColumn("taken", F.lit(1))
    known = orders.distinct().withColumn("known", F.lit(1))
    return some.join(known, ["o_orderkey", "o_orderdate"], "left").agg(F.count("taken").alias("n_rows"), F.count("known").alias("n_of_orders"))


@register("o3_top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def o3_top_k(spark, d):
    return R.top_k(t(spark, d, "orders").select("o_orderkey", "o_totalprice"), 10,
                   F.col("o_totalprice").desc(), F.col("o_orderkey"))


MISSING_KEYS_SQL = f"""
SELECT * FROM (
  SELECT DISTINCT c_custkey, 'c_mktsegment' AS missing FROM {CUSTOMERS_WITH_NULLS_SQL} WHERE c_mktsegment IS NULL
  UNION ALL
  SELECT DISTINCT c_custkey, 'c_acctbal' AS missing FROM {CUSTOMERS_WITH_NULLS_SQL} WHERE c_acctbal IS NULL)
ORDER BY c_custkey, missing"""


@register("u1_union_all", MISSING_KEYS_SQL)
def u1_union_all(spark, d):
    c = customers_with_nulls(spark, d)
    a = c.filter(F.col("c_mktsegment").isNull()).select("c_custkey", F.lit("c_mktsegment").alias("missing")).distinct()
    b = c.filter(F.col("c_acctbal").isNull()).select("c_custkey", F.lit("c_acctbal").alias("missing")).distinct()
    return R.union_all(a, b, order=["c_custkey", "missing"])
