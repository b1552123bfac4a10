"""Micro-frames: groups with only NULLs, an empty parameter table, a NULL
partition, period texts, long runs in e-mail shapes."""
import time

import pytest
from pyspark.sql import functions as F

from quarry.operators import relational as R
from quarry.operators import tables as TB
from quarry.streaming.metrics import _secs


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("a", None), ("n", None), ("n", None)], "k string, v string")


def test_groups_of_nulls_stay(groups):
    assert dict(R.string_agg_distinct(groups, "k", "v", 5, "o").collect()) == {"a": "x,y", "n": None}
    assert dict(R.string_agg_distinct(groups, "k", "v", 1, "o").collect()) == {"a": "x", "n": None}
    assert dict(R.array_agg(groups, ["k"], "v", "o").collect()) == {"a": ["x", "x", "y"], "n": None}
    assert dict(R.array_agg(groups, ["k"], "v", "o", distinct=True).collect()) == {"a": ["x", "y"], "n": None}
    assert dict(R.pick_one(groups, ["k"], "v", "o").collect()) == {"a": ["x"], "n": None}


def test_empty_parameter_table_gives_no_rows(spark):
    rows = spark.range(3)
    none = spark.createDataFrame([], "p int, q string")
    assert R.cross_param(rows, none).columns == ["id", "p", "q"]
    assert R.cross_param(rows, none).count() == 0
    one = spark.createDataFrame([(1, None)], "p int, q string")
    assert [tuple(r) for r in R.cross_param(rows, one).orderBy("id").collect()] == [(0, 1, None), (1, 1, None), (2, 1, None)]


def test_null_partition_never_expires(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS expiry_test")
    df = spark.sql("SELECT * FROM VALUES (1, DATE'2020-01-01'), (2, DATE'2024-01-01'), (3, CAST(NULL AS DATE)) AS t(id, d)")
    df.write.mode("overwrite").partitionBy("d").saveAsTable("expiry_test.t")
    assert TB.expire_partitions(spark, "expiry_test.t", "2024-01-10", days=30) == ["2020-01-01"]
    assert sorted(r[0] for r in spark.table("expiry_test.t").select("id").collect()) == [2, 3]
    spark.sql("DROP DATABASE expiry_test CASCADE")


@pytest.mark.parametrize("text, secs", [("300s", 300), ("5 minutes", 300), ("1 hour", 3600), ("2h", 7200), ("1 day", 86400), ("90", 90), (60, 60), ("2000ms", 2)])
def test_periods(text, secs):
    assert _secs(text) == secs


@pytest.mark.parametrize("text", ["500ms", "soon", "", "5 parsecs", "-3s", 0.5])
def test_bad_periods(text):
    with pytest.raises(ValueError):
        _secs(text)


def test_long_run_before_an_at_sign_is_quick(spark):
    from quarry.functions import infotypes as I
    from quarry.operators import sensitive as X

    df = spark.createDataFrame([(1, "a" * 80_000 + " @ me@example.org")], "doc_id long, text string")
    X.inspect(df, "doc_id", "text", types=["EMAIL_ADDRESS"]).collect()
    began = time.time()
    found = X.inspect(df, "doc_id", "text", types=["EMAIL_ADDRESS"]).collect()
    assert [r["quote"] for r in found] == ["me@example.org"] and time.time() - began < 5 and I.BY_NAME
