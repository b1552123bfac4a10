import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import governance as G
from quarry.streaming import metrics as M


def series(spark, minutes):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=m, seconds=5), "s", v) for m, v in minutes]
    return spark.createDataFrame(rows, "ts timestamp_ntz, series string, value double")


def test_sustained_gap_breaks_run(spark):
    # breach for 4 minutes, gap, breach for 6 minutes; hold 5 minutes at 60 s
    pts = [(m, 10.0) for m in range(0, 4)] + [(m, 10.0) for m in range(6, 12)]
    a = M.align(series(spark, pts), 60, ["series"], "max")
    held = M.sustained(M.threshold(a, gt=5), 300, 60, ["series"]).collect()
    starts = sorted(r.window_start.minute for r in held)
    assert starts == [10, 11]


def test_incidents_auto_close(spark):
    pts = [(0, 10.0), (1, 10.0), (40, 10.0)]   # silence of 39 minutes, auto-close 30
    a = M.threshold(M.align(series(spark, pts), 60, ["series"], "max"), gt=5)
    inc = M.incidents(a, auto_close=1800, series=["series"]).orderBy("opened_at").collect()
    assert [r.n_windows for r in inc] == [2, 1]
    assert inc[0].closed_at == dt.datetime(2024, 1, 1, 0, 32)


def test_counter_rate_with_reset(spark):
    pts = [(0, 10.0), (1, 40.0), (2, 5.0)]   # +30, then a reset to 5 counts 5
    a = M.align(series(spark, pts), 300, ["series"], "rate", counter=True).collect()
    assert len(a) == 1 and abs(a[0].value - 35.0 / 300) < 1e-12


def test_dq_scan_empty_table_passes(spark):
    df = spark.createDataFrame([], "a string")
    r = G.dq_scan(df, [{"column": "a", "threshold": 1.0}]).collect()[0]
    assert r.passed and r.pass_ratio == 1.0


def test_severity_gate_exact(spark):
    f = spark.createDataFrame([("i1", "CRITICAL-ish"), ("i1", "LOW"), ("i2", "CRITICAL")], "image string, severity string")
    out = {r.image: r.failed for r in G.severity_gate(f).collect()}
    assert out == {"i1": False, "i2": True}


def test_mute_and_policy(spark):
    f = spark.createDataFrame([("A",), ("B",)], "category string")
    out = {r.category: r.muted for r in G.mute(f, spark.createDataFrame([("A",)], "category string")).collect()}
    assert out == {"A": True, "B": False}
    pol = spark.createDataFrame([
        (1, '{"bindings":[{"role":"roles/viewer","members":["user:a@x.org"]}]}'),
        (2, '{"bindings":[{"role":"roles/viewer","members":["user:b@x.org"]}]}')], "policy_id int, policy string")
    wanted = spark.createDataFrame([("roles/viewer", "user:a@x.org")], "role string, member string")
    assert [r.policy_id for r in G.has_binding(pol, wanted).collect()] == [1]


def test_tags_drive_projection(spark):
    df = G.tag_columns(spark.createDataFrame([(1, "x")], "id int, secret string"), ["secret"])
    assert G.project_unprotected(df).columns == ["id"]
    assert G.project_unprotected(df, "redact").collect()[0].secret == "[redacted]"
