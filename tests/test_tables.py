import pytest
from pyspark.sql import functions as F

from quarry.operators import tables as D


def target(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "id int, name string, v double")


def test_update_from_writes_matched_null(spark):
    src = spark.createDataFrame([(1, None), (3, 9.0), (7, 1.0)], "id int, nv double")
    out = {r.id: r.v for r in D.update_from(target(spark), src, "id", {"v": "nv"}).collect()}
    assert out == {1: None, 2: 2.0, 3: 9.0}


def test_update_from_keeps_row_count(spark):
    src = spark.createDataFrame([(2, 5.0)], "id int, nv double")
    assert D.update_from(target(spark), src, "id", {"v": "nv"}).count() == 3


def test_duplicate_source_key_fails(spark):
    src = spark.createDataFrame([(1, 1.0), (1, 2.0)], "id int, nv double")
    with pytest.raises(Exception):
        D.update_from(target(spark), src, "id", {"v": "nv"}).collect()


def test_update_struct_field_null_struct(spark):
    t = spark.createDataFrame([(1, None), (2, (1, 2.0))], "id int, s struct<n:int, p:double>")
    src = spark.createDataFrame([(1, 7.5)], "id int, np double")
    out = {r.id: r.s for r in D.update_from(t, src, "id", {"s.p": "np"}).collect()}
    assert out[1].p == 7.5 and out[1].n is None and out[2].p == 2.0


def test_delete_where_null_keeps(spark):
    out = D.delete_where(target(spark), F.col("v") > 1.5).collect()
    assert sorted(r.id for r in out) == [1, 3]


def test_insert_if_absent_and_upsert(spark):
    rows = spark.createDataFrame([(2, "b", 5.0), (4, "d", 4.0)], "id int, name string, v double")
    ins = D.insert_if_absent(target(spark), rows, ["id", "name"]).collect()
    assert sorted(r.id for r in ins) == [1, 2, 3, 4]
    ups = {r.id: r.v for r in D.upsert(target(spark), rows, "id").collect()}
    assert ups == {1: 1.0, 2: 5.0, 3: None, 4: 4.0}


def test_with_serial_dense(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 3).alias("x"))
    ids = sorted(r.id for r in D.with_serial(df, "id", start=100, input_is_stable=True).collect())
    assert ids == list(range(100, 1100))
    shuffled = df.repartition(5, "x")          # not stable: checkpointed first
    ids = sorted(r.id for r in D.with_serial(shuffled, "id", start=1).collect())
    assert ids == list(range(1, 1001))


def test_deletable(spark):
    objs = spark.createDataFrame([
        ("held", "2020-01-01 00:00:00", True, False, None),
        ("event", "2020-01-01 00:00:00", False, True, None),
        ("released", "2020-01-01 00:00:00", False, False, "2020-12-31 00:00:00"),
        ("young", "2020-12-31 00:00:00", False, False, None),
        ("old", "2020-01-01 00:00:00", False, False, None)],
        "name string, c string, temporary_hold boolean, event_based_hold boolean, r string")
    objs = objs.select("name", F.to_timestamp_ntz("c").alias("created"), "temporary_hold", "event_based_hold",
                       F.to_timestamp_ntz("r").alias("event_hold_released"))
    out = {r.name: r.deletable for r in D.deletable(objs, 86400 * 30, "2021-01-10 00:00:00").collect()}
    assert out == {"held": False, "event": False, "released": False, "young": False, "old": True}
