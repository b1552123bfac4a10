"""Scans without whole-key sorts, and alert policies as tables and streams."""
import datetime as dt
import json
import random
import tempfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.operators import scans
from quarry.sources import io
from quarry.streaming import metrics as M
from quarry.streaming import policies as P
from quarry.streaming import streams as ST

BASE = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("bits", [2, 16])
@pytest.mark.parametrize("how", ["sum", "max"])
def test_prefix_scan(spark, monkeypatch, bits, how):
    monkeypatch.setattr(scans, "BITS", bits)
    monkeypatch.setattr(scans, "OFFSET", 0 if bits == 2 else 1 << 31)
    r = random.Random(bits)
    rows = [(k, o, r.choice([None, r.randrange(-5, 9)])) for k in ("a", None, "b") for o in r.sample(range(16 if bits == 2 else 400_000), 12)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    for inclusive in (True, False):
        got = {(x.k, x.o): x.s for x in scans.prefix_scan(df, ["k"], "o", F.col("v"), how, "s", inclusive).collect()}
        for k, o, _ in rows:
            own = [v for kk, oo, v in rows if kk == k and (oo < o or inclusive and oo == o) and v is not None]
            assert got[k, o] == ((sum(own) if how == "sum" else max(own)) if own else None)
    assert scans.prefix_scan(df.limit(0), [], "o", F.col("v"), how, "s").count() == 0


def test_distributed_rank_with_a_hot_key(spark):
    r = random.Random(3)
    rows = [(r.choice(["hot", "hot", "hot", "a", None]), r.randrange(50), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(5)
    ranked = scans.distributed_rank(df, ["k"], [F.col("v").desc(), F.col("i")], partitions=8)
    assert ranked.columns == ["k", "v", "i", "rn"]
    want = defaultdict(list)
    for k, v, i in sorted(rows, key=lambda x: (-x[1], x[2])):
        want[k].append((v, i))
    assert {(x.k, x.rn): (x.v, x.i) for x in ranked.collect()} == {(k, n): x for k, own in want.items() for n, x in enumerate(own, 1)}
    # the hot key is spread: no partition of the written rows holds most of them
    sizes = [x["count"] for x in df.repartitionByRange(8, F.col("k").asc_nulls_first(), F.col("v").desc(), F.col("i")).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 300


def breaches(r, series, n=300):
    out = []
    for s in series:
        idx = -1
        for _ in range(n):
            idx += r.choice([1, 1, 1, 2, 3, 70])
            out.append((s, BASE + dt.timedelta(minutes=idx), BASE + dt.timedelta(minutes=idx + 1), 1.0))
    return out


@pytest.mark.parametrize("bits", [4, 16])
def test_holds_and_incidents_equal_a_walk(spark, monkeypatch, bits):
    monkeypatch.setattr(scans, "BITS", bits)
    monkeypatch.setattr(M, "prefix_scan", scans.prefix_scan if bits == 16 else lambda *a, **k: scans._scan_levels(*a, **k))
    if bits == 4:  # more levels for smaller blocks
        monkeypatch.setattr(scans, "_scan_levels", lambda df, keys, order, value, how, out, inclusive=True: scans._scan(
            df.withColumn("_at", F.col(order).cast("long") + scans.OFFSET), list(keys), "_at", value, how, out, inclusive, 8).drop("_at"), raising=False)
    r = random.Random(bits)
    rows = breaches(r, ["a", "b"], 60 if bits == 4 else 300)
    df = spark.createDataFrame(rows, "series string, window_start timestamp, window_end timestamp, value double")
    want_runs, want_incidents = set(), set()
    for s in ("a", "b"):
        run, last, opened, until, n, number = 0, None, None, None, 0, 0
        for _, start, end, _ in (x for x in rows if x[0] == s):
            run = run + 1 if last == start - dt.timedelta(minutes=1) else 1
            last = start
            if run >= 3:
                want_runs.add((s, start, run))
            if opened is None or start > until + dt.timedelta(seconds=120):
                if opened:
                    want_incidents.add((s, number, opened, until, n))
                opened, n, number = start, 0, number + 1
            until, n = end, n + 1
        want_incidents.add((s, number, opened, until, n))
    got = M.sustained(df, 180, 60, ["series"])
    assert {(x.series, x.window_start, x.run_length) for x in got.collect()} == want_runs
    inc = M.incidents(df, 120, series=["series"]).collect()
    assert {(x.series, x.incident, x.opened_at, x.last_breach_end, x.n_windows) for x in inc} == want_incidents
    assert all(x.closed_at == x.last_breach_end + dt.timedelta(seconds=120) for x in inc)


def test_no_window_over_all_rows(spark):
    import __spark_entry__ as E

    for name in ("t11_alert_policy", "t11_policy_two_conditions", "t10_incidents", "w1_row_number"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan, name


def condition(filter_, period="60s", aligner="ALIGN_MAX", reducer="REDUCE_NONE", value=5, duration="0s", count=1, comparison="COMPARISON_GT", by=()):
    return {"displayName": "c", "conditionThreshold": {"filter": filter_, "aggregations": [{"alignmentPeriod": period, "crossSeriesReducer": reducer, "perSeriesAligner": aligner, "groupByFields": list(by)}],
                                                       "comparison": comparison, "duration": duration, "trigger": {"count": count}, "thresholdValue": value}}


def policy(*conditions, close=None):
    return json.dumps({"displayName": "p", "userLabels": {}, "conditions": conditions, "combiner": "OR", "enabled": True, "alertStrategy": {"autoClose": close} if close else {}})


FIELDS = {"resource.type": "kind", "metric.type": "metric", "textPayload": "note"}


def test_policies_are_read_in_their_json_form():
    p = P.parse(policy(condition('resource.type = "vm" AND metric.type = "traffic"', "300s", "ALIGN_RATE", duration="60s", value=500),
                       condition('resource.type="pod" textPayload:"200"', "600s", "ALIGN_COUNT", "REDUCE_SUM", 0), close="604800s"), FIELDS)
    assert p.auto_close == 604800 and [c.period for c in p.conditions] == [300, 600]
    assert p.conditions[0].eq == {"kind": "vm", "metric": "traffic"} and p.conditions[1].has == {"note": "200"} and p.conditions[1].reducer == "sum"
    assert P.parse(policy(condition("")), FIELDS).auto_close is None
    for broken in (condition('color = "x"'), condition("", aligner="ALIGN_ODD"), condition("", comparison="COMPARISON_EQ"), condition("", period="0s")):
        with pytest.raises((ValueError, KeyError)):
            P.parse(policy(broken), FIELDS)
    with pytest.raises(ValueError):
        P.parse({"conditions": [condition("")], "combiner": "AND"}, FIELDS)


SCHEMA = "ts timestamp_ntz, kind string, host string, value double"


def points(minutes, v=10.0, kind="vm", host="a"):
    return [(BASE + dt.timedelta(minutes=m, seconds=5), kind, host, v) for m in minutes]


DATA = [points(range(0, 4)) + points([1, 2], host="b"), points(range(6, 9)), points(range(9, 12)) + points([10], 1.0, "pod"), points([70], 1.0),
        points([90, 91, 92, 93]) + points([92, 93], host="b"), points([300], 1.0)]
TWO = policy(condition('resource.type = "vm"', duration="180s"), condition('resource.type = "vm"', count=2), condition('resource.type = "pod"', value=0.5, reducer="REDUCE_SUM"), close="1200s")


def staged(spark, root, k, data):
    ST.stage_files(spark, spark.createDataFrame(data, SCHEMA), "ts", 1, root=root, prefix=f"f{k}", mtime_base=1_700_000_000_000 + k * 60_000)


def test_a_policy_on_a_stream_opens_and_closes_over_restarts(spark):
    p = P.parse(TWO, FIELDS)
    root, fired_out, fired_ckpt, life_out, life_ckpt = (tempfile.mkdtemp(prefix=x) for x in ("in-", "f-", "fc-", "l-", "lc-"))
    for k, data in enumerate(DATA):  # each file is a batch, each run resumes from the checkpoint
        staged(spark, root, k, data)
        source = io.stream_files(spark, root, spark.createDataFrame([], SCHEMA).schema)
        ST.run_available_now(P.stream_fired(source, p, ["host"]), out=fired_out, checkpoint=fired_ckpt, state_partitions=2)
        ST.run_available_now(P.stream_life_cycle(P.stream_fired(source, p, ["host"]), 1200), out=life_out, checkpoint=life_ckpt, state_partitions=2)
    table = spark.createDataFrame([x for data in DATA for x in data], SCHEMA)
    fired = M.combine_or(*[P.condition_windows(table, c, ["host"]) for c in p.conditions])
    want = sorted(x.window_start for x in fired.collect())
    assert sorted(x.window_start for x in spark.read.parquet(fired_out).collect()) == want and len(want) > 8
    inc = P.policy_incidents(table, p, ["host"]).collect()
    assert len(inc) == 2
    rows = {(x.event, x.opened_at, x.at, x.n_windows) for x in spark.read.parquet(life_out).collect()}
    assert rows == {("OPEN", x.opened_at, x.opened_at, 0) for x in inc} | {("CLOSE", x.opened_at, x.closed_at, x.n_windows) for x in inc}


def test_counts_of_triggers_without_series(spark):
    held = spark.createDataFrame([(BASE, BASE, 1.0)], "window_start timestamp, window_end timestamp, value double")
    assert M.fired(held, [], 1).count() == 1 and M.fired(held, [], 2).count() == 0
