"""Stored profiles: parts merged in any grouping give what one pass gives."""
import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import sensitive as X

EXACT = ["table_name", "column_name", "data_type", "is_text", "n_rows", "n_nulls", "min_value", "max_value", "n_high_findings", "n_other_findings"]


def test_merged_parts_equal_one_pass(spark):
    rows = [(i, float(-i) / 3 if i % 5 else None, f"v{i % 40}" if i % 7 else None, dt.date(2024, 1, 1) + dt.timedelta(days=i), [i], "mail a@b.co" if i % 10 == 0 else "x") for i in range(300)]
    df = spark.createDataFrame(rows, "i long, d double, s string, day date, a array<int>, t string")
    whole = X.profile_parts({"t": df})
    parts = [X.profile_parts({"t": df.filter(F.col("i") % 4 == k)}) for k in range(4)] + [X.profile_parts({"t": df.limit(0)})]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    once = X.merge_profiles(merged)
    again = X.merge_profiles(X.merge_profiles(merged.filter("n_rows > 0")).unionByName(X.merge_profiles(merged.filter("n_rows = 0"))))
    want = sorted(tuple(r) for r in whole.select(*EXACT).collect())
    assert sorted(tuple(r) for r in once.select(*EXACT).collect()) == want == sorted(tuple(r) for r in again.select(*EXACT).collect())
    report = {r.column_name: r for r in X.profile_report(once).collect()}
    assert report["i"].min_value == "0" and report["i"].max_value == "299" and report["t"].n_other_findings == 30
    assert abs(report["s"].approx_distinct - 40) <= 2 and abs(report["i"].approx_distinct - 300) <= 15
    assert 140 <= report["i"].approx_median <= 160 and report["s"].approx_median is None


def test_profiles_scan_a_table_once(spark, tmp_path):
    spark.createDataFrame([("a", "b", 1)], "s string, t string, i int").write.parquet(f"{tmp_path}/t")
    plan = X.profile_parts({"t": spark.read.parquet(f"{tmp_path}/t")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
