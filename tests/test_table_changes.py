"""Changes committed to catalog tables: which files move, what a failure leaves, keys of repeated appends."""
import os
import threading
import uuid
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from quarry.operators import tables as D
from quarry.sources import io


@pytest.fixture
def db(spark, tmp_path):
    name = f"tc_{uuid.uuid4().hex[:8]}"
    io.ensure_database(spark, name, f"{tmp_path}/wh")
    return name, f"{tmp_path}/wh"


ROWS = [(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, "o'b", 40), (5, None, 50)]


@pytest.fixture
def people(spark, db):
    name, root = db
    df = spark.createDataFrame(ROWS, "id int, part string, v int").select("id", "v", "part")
    return D.create_table(spark, df, f"{name}.people", root, "part")


def content(spark, table):
    return sorted(((r.id, r.v, r.part) for r in spark.table(table).collect()), key=str)


def files(spark, table):
    return {r.part: r.f for r in spark.table(table).select("part", F.col("_metadata.file_path").alias("f")).distinct().collect()}


def local(uri):
    return unquote(urlparse(uri).path)


def test_only_touched_partitions_are_rewritten(spark, people):
    before = files(spark, people)
    source = spark.createDataFrame([(2, 99), (4, None), (77, 1)], "id int, w int")
    assert sorted(D.update_table(spark, people, "part", source, "id", {"v": "w"}), key=str) == ["a", "o'b"]
    assert content(spark, people) == sorted([(1, 10, "a"), (2, 99, "a"), (3, 30, "b"), (4, None, "o'b"), (5, 50, None)], key=str)
    after = files(spark, people)
    assert {p for p in before if before[p] == after[p]} == {"b", None}
    assert os.path.exists(local(before["a"]))  # the old snapshot stays readable
    assert D.update_table(spark, people, "part", source.limit(0), "id", {"v": "w"}) == []


def test_delete_empties_and_drops_partitions(spark, people):
    D.delete_from_table(spark, people, "part", F.col("v") >= 30)
    assert content(spark, people) == [(1, 10, "a"), (2, 20, "a")]
    assert spark.sql(f"SHOW PARTITIONS {people}").count() == 1


def test_upsert_moves_rows_between_partitions(spark, people):
    rows = spark.createDataFrame([(1, "b", 11), (9, "new", 90), (5, None, 55)], "id int, part string, v int")
    D.upsert_table(spark, people, "part", rows, "id")
    assert content(spark, people) == sorted([(1, 11, "b"), (2, 20, "a"), (3, 30, "b"), (4, 40, "o'b"), (5, 55, None), (9, 90, "new")], key=str)
    D.insert_if_absent_into(spark, people, spark.createDataFrame([(9, 1, "x"), (10, 1, "new"), (10, 1, "new")], "id int, v int, part string"), ["id"])
    assert [r for r in content(spark, people) if r[0] >= 9] == [(10, 1, "new"), (9, 90, "new")]


def test_a_failed_change_changes_nothing(spark, people):
    before = files(spark, people)
    doubled = spark.createDataFrame([(1, 5), (1, 6)], "id int, w int")
    with pytest.raises(Exception, match="duplicate source key"):
        D.update_table(spark, people, "part", doubled, "id", {"v": "w"})
    assert files(spark, people) == before and content(spark, people) == sorted([(i, v, p) for i, p, v in ROWS], key=str)


def test_snapshots_of_a_managed_table(spark, db):
    name = io.ctas(spark.createDataFrame([(1, "x")], "id int, s string"), f"{db[0]}.small")
    old = spark.table(name).inputFiles()
    D.commit_snapshot(spark, spark.table(name).withColumn("s", F.lit("y")), name, db[1])
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "y")]
    assert old and all(os.path.exists(local(f)) for f in old)


def test_reserved_keys_never_meet(spark, db):
    got = []

    def ask():
        for n in (1, 5, 3):
            got.append((D.reserve(spark, f"{db[0]}.t", n, db[1]), n))

    threads = [threading.Thread(target=ask) for _ in range(4)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    spans = sorted((a, a + n) for a, n in got)
    assert len(spans) == 12 and all(b == c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_serial_appends_check_their_rows(spark, db):
    name = f"{db[0]}.employees"
    D.create_serial_table(spark, name, {"first": "STRING NOT NULL", "salary": "DECIMAL(10,2)"}, root=db[1])
    rows = spark.createDataFrame([("Max", "5000.00"), ("Anna", None)], "first string, salary string")
    assert D.append_with_serial(spark, name, rows, root=db[1]) == 2
    with pytest.raises(Exception, match="NULL in column first"):
        D.append_with_serial(spark, name, spark.createDataFrame([(None, "1")], "first string, salary string"), root=db[1])
    with pytest.raises(Exception):
        D.append_with_serial(spark, name, spark.createDataFrame([("Big", "123456789012.5")], "first string, salary string"), root=db[1])
    assert D.append_with_serial(spark, name, rows.limit(0), root=db[1]) == 0
    D.append_with_serial(spark, name, rows.limit(1), root=db[1])
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3]
    D.reserve(spark, name, 10, db[1])  # an append that ended after it reserved
    D.append_with_serial(spark, name, rows, root=db[1])
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3, 14, 15]
    assert spark.table(name).schema["salary"].dataType.simpleString() == "decimal(10,2)"
