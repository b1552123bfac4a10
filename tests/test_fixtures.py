import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from quarry.functions import scalar as S
from quarry.operators import relational as R
from quarry.operators import tables as D
from quarry.sources import io

RACE_SCHEMA = StructType([
    StructField("race", StringType()),
    StructField("participants", ArrayType(StructType([
        StructField("name", StringType()), StructField("splits", ArrayType(DoubleType()))]))),
])


@pytest.fixture(scope="module")
def races_path():
    d = tempfile.mkdtemp(prefix="races-")
    rows = [{"race": "800M", "participants": [{"name": "Rudisha", "splits": [23.4, 26.3, 26.4]},
                                              {"name": None, "splits": [23.2, 27.0]}]},
            {"race": "400M", "participants": []}]
    with open(os.path.join(d, "races.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n")
    return d


def test_ndjson_declared_and_inferred(spark, races_path):
    declared = io.load_ndjson(spark, races_path, RACE_SCHEMA)
    assert declared.schema == RACE_SCHEMA
    inferred = io.load_ndjson(spark, races_path, order=["race", "participants"])
    assert inferred.columns == ["race", "participants"]


def test_unnest_count_and_double_equality(spark, races_path):
    races = io.load_ndjson(spark, races_path, RACE_SCHEMA)
    people = R.unnest(races, "participants", "p", keep=["race"])
    assert people.count() == 2                     # the empty race drops out
    assert R.count_nonnull(people.select("race", F.col("p.name").alias("name")), "name", "n",
                           ["race"]).collect()[0].n == 1
    splits = R.unnest_chain(races, "participants", "p", "splits", "s", keep=["race"])
    assert splits.count() == 5
    assert R.where_eq(splits, "s", 23.2).count() == 1


def test_dates_tolerant_and_strict(spark):
    df = spark.createDataFrame([("20170708",), ("20180708",), ("2018x708",)], "d string")
    got = [r.p for r in df.select(S.parse_date("d").alias("p")).collect()]
    assert [str(x) for x in got] == ["2017-07-08", "2018-07-08", "None"]
    with pytest.raises(Exception):
        df.select(S.parse_date("d", strict=True)).collect()
    assert [r.y for r in df.select(S.to_int64(F.substring("d", 1, 4)).alias("y")).collect()] == [2017, 2018, 2018]


def test_messages(spark):
    df = spark.createDataFrame([("SGk=",), ("",), (None,)], "data string")
    assert [r.g for r in df.select(S.decode_message("data").alias("g")).collect()] == \
        ["Hello Hi!", "Hello World!", "Hello World!"]


def test_partition_expiry(spark):
    db = f"fx_{os.getpid()}"
    io.ensure_database(spark, db, tempfile.mkdtemp(prefix="wh-"))
    days = spark.createDataFrame([(i, f"2024-01-0{i}") for i in range(1, 6)], "id int, d string") \
        .select("id", F.to_date("d").alias("day"))
    name = io.ctas_partitioned(spark, days, f"{db}.events_by_day", "day", description="test", ttl_days=2)
    dropped = D.expire_partitions(spark, name, as_of="2024-01-05")
    assert sorted(dropped) == ["2024-01-01", "2024-01-02"]
    assert sorted(r.id for r in spark.table(name).collect()) == [3, 4, 5]
