import datetime as dt
import tempfile

from pyspark.sql import functions as F

from quarry.sources import io
from quarry.streaming import metrics as M
from quarry.streaming import streams as ST
from quarry.streaming.alerts import stream_sustained

SCHEMA = "ts timestamp_ntz, series string, value double"
BASE = dt.datetime(2024, 1, 1)


def rows(minutes, v=10.0, s="a"):
    return [(BASE + dt.timedelta(minutes=m, seconds=5), s, v) for m in minutes]


def add_file(spark, root, data, idx):
    df = spark.createDataFrame(data, SCHEMA)
    ST.stage_files(spark, df, "ts", 1, root=root, prefix=f"f{idx}", mtime_base=1_700_000_000_000 + idx * 60_000)


def run_hold(spark, root, out, ckpt):
    s = io.stream_files(spark, root, spark.createDataFrame([], SCHEMA).schema)
    a = ST.stream_align(s, 60, ["series"], "max")
    held = stream_sustained(a.filter(F.col("value") > 5).drop("w"), 300, 60, ["series"])
    ST.run_available_now(held, out=out, checkpoint=ckpt)


def test_hold_with_late_row_and_restart(spark):
    root, out, ckpt = (tempfile.mkdtemp(prefix=p) for p in ("in-", "out-", "ckpt-"))
    # breach for 4 minutes, a gap, then a breach for 6 minutes (in two files)
    add_file(spark, root, rows(range(0, 4)), 0)
    add_file(spark, root, rows(range(6, 9)), 1)
    run_hold(spark, root, out, ckpt)
    # restart from the checkpoint: the rest of the breach, a late row for
    # minute 2 (behind the watermark: dropped), then 31 minutes of silence
    add_file(spark, root, rows(range(9, 12)) + rows([2], v=99.0), 2)
    add_file(spark, root, rows([43], v=1.0), 3)
    run_hold(spark, root, out, ckpt)
    got = sorted((r.window_start.minute, r.run_length) for r in spark.read.parquet(out).collect())
    assert got == [(10, 5), (11, 6)]
    # the batch form over the same closed windows agrees
    batch = spark.createDataFrame(rows(range(0, 4)) + rows(range(6, 12)) + rows([43], v=1.0), SCHEMA)
    b = M.sustained(M.threshold(M.align(batch, 60, ["series"], "max"), gt=5), 300, 60, ["series"])
    assert sorted((r.window_start.minute, r.run_length) for r in b.collect()) == got


def test_stream_incidents_session(spark):
    root, out, ckpt = (tempfile.mkdtemp(prefix=p) for p in ("in-", "out-", "ckpt-"))
    add_file(spark, root, rows([0, 1]), 0)
    add_file(spark, root, rows([40]), 1)
    add_file(spark, root, rows([200], v=1.0), 2)
    s = io.stream_files(spark, root, spark.createDataFrame([], SCHEMA).schema)
    a = ST.stream_align(s, 60, ["series"], "max")
    ST.run_available_now(ST.stream_incidents(a, 5, 60, auto_close=1800, series=["series"]), out=out, checkpoint=ckpt)
    got = sorted((r.opened_at.minute, r.n_windows) for r in spark.read.parquet(out).collect())
    assert got == [(0, 2), (40, 1)]
