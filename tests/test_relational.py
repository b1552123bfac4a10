from pyspark.sql import functions as F

from quarry.operators import relational as R


def keys(spark):
    return spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "z")], "k string, v string")


def test_not_in_drops_null(spark):
    out = R.where_not_in(keys(spark), "k", ["b"]).collect()
    assert sorted(r.v for r in out) == ["x", "y"]


def test_left_only_right_only_reconcile(spark):
    a = keys(spark)
    b = spark.createDataFrame([("a",), ("c",), (None,)], "k2 string")
    lo = R.left_only(a, b, {"k": "k2"}).collect()
    assert sorted(((r.k, r.v) for r in lo), key=str) == sorted([("b", "x"), (None, "z")], key=str)
    ro = R.right_only(a, b, {"k": "k2"}).collect()
    assert sorted(str(r.k2) for r in ro) == ["None", "c"]
    rec = R.reconcile(a.select("k").distinct(), b, "k", "k2").collect()
    # NULL keys never match: both NULLs are unmatched, plus b and c
    assert len(rec) == 4


def test_left_only_plus_matched_is_left(spark):
    a = keys(spark)
    b = spark.createDataFrame([("a",)], "k2 string")
    lo = R.left_only(a, b, {"k": "k2"}).count()
    matched = a.join(b, a.k == b.k2, "left_semi").count()
    assert lo + matched == a.count()


def test_anti_by_keys_null_never_matches(spark):
    a = keys(spark)
    out = R.anti_by_keys(a, a, ["k", "v"]).collect()
    assert [(r.k, r.v) for r in out] == [(None, "z")]


def test_string_agg_distinct_and_key_audit(spark):
    df = spark.createDataFrame([("n", b) for b in "edcbaab"] + [("m", "z")], "name string, brand string")
    s = {r.name: r.s for r in R.string_agg_distinct(df, "name", "brand", 3, "s").collect()}
    assert s == {"n": "a,b,c", "m": "z"}
    audit = R.key_audit(df, "name", "brand", n=2).collect()
    assert [(r.name, r.n_values, r["values"]) for r in audit] == [("n", 5, "a,b")]


def test_top_n_per_group_ties_broken(spark):
    df = spark.createDataFrame([("g", 1, 10.0), ("g", 2, 10.0), ("g", 3, 5.0), ("h", 4, 1.0)],
                               "g string, id int, p double")
    out = R.top_n_per_group(df, ["g"], [F.col("p").desc(), F.col("id")], 1).collect()
    assert sorted((r.g, r.id) for r in out) == [("g", 1), ("h", 4)]


def test_unnest_drops_empty_arrays(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, []), (3, None)], "id int, xs array<double>")
    out = R.unnest(df, "xs", "x", keep=["id"]).collect()
    assert sorted(r.id for r in out) == [1, 1]


def test_union_all_keeps_duplicates(spark):
    a = spark.createDataFrame([(1,)], "k int")
    assert R.union_all(a, a, order=["k"]).count() == 2


def test_share_of_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "c string")
    out = {r.c: r.share for r in R.share_of_total(df, "c").collect()}
    assert out == {"a": 0.5, "b": 0.25, "c": 0.25}
