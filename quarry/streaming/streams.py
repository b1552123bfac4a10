"""Structured Streaming jobs: file-arrival streams, message decoding,
streaming alignment and incidents (S18, S19, T2-T6 and T10 on streams,
T12, T13).

Every query keeps its state and commit log in a checkpoint folder under the
shared folder, so a restarted driver or a lost executor resumes from the
last committed batch.  Tests drive streams with ``availableNow`` and read
the sink back as a batch table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalar import decode_message
from quarry.session import scratch_path
from quarry.streaming.metrics import _secs, with_watermark


def stage_files(spark: SparkSession, df: DataFrame, ts: str, n: int, root: str | None = None,
                prefix: str = "part", mtime_base: int = 1_700_000_000_000) -> str:
    """Files for a file stream, in time order: ``df`` is ranged by ``ts`` into
    ``n`` partitions, each of which a task writes as one file (one scan, no rows
    through a single task; ``n`` grows with the data).  Modification times increase,
    a minute a file, as the file source takes files in their order."""
    root = root or scratch_path(spark, "stream_in")
    tmp = scratch_path(spark, "stream_stage")
    (df.repartitionByRange(n, F.col(ts).asc()) if n > 1 else df.coalesce(1)).write.parquet(tmp)
    jvm = spark._jvm
    dst = jvm.org.apache.hadoop.fs.Path(root)
    fs = dst.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(dst)
    # part files are numbered by partition, and partitions ascend in time
    files = sorted(st.getPath().getName() for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(tmp)) if st.getPath().getName().endswith(".parquet"))
    for i, name in enumerate(files):
        target = jvm.org.apache.hadoop.fs.Path(f"{root}/{prefix}-{i:05d}.parquet")
        fs.rename(jvm.org.apache.hadoop.fs.Path(f"{tmp}/{name}"), target)
        fs.setTimes(target, mtime_base + i * 60_000, -1)
    return root


def stage_named(spark: SparkSession, df: DataFrame, name: Column, mtime_base: int = 1_700_000_000_000) -> str:
    """Files for a file stream, one for each value of ``name``, with that name;
    modification times increase with the names."""
    root, tmp = scratch_path(spark, "stream_in"), scratch_path(spark, "stream_stage")
    df.withColumn("_name", name).repartition("_name").write.partitionBy("_name").parquet(tmp)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(root))
    folders = sorted(st.getPath().getName() for st in fs.listStatus(path(tmp)) if st.getPath().getName().startswith("_name="))
    for i, folder in enumerate(folders):
        own = [st.getPath() for st in fs.listStatus(path(f"{tmp}/{folder}")) if st.getPath().getName().endswith(".parquet")]
        target = path(f"{root}/{folder.split('=', 1)[1]}.parquet")
        fs.rename(own[0], target)
        fs.setTimes(target, mtime_base + i * 60_000, -1)
    return root


def run_available_now(stream: DataFrame, out: str | None = None, mode: str = "append",
                      checkpoint: str | None = None, state_partitions: int | None = None) -> str:
    """Run a streaming query over everything available now into a Parquet
    sink, then stop.  Checkpoint and output live under the shared folder.

    ``state_partitions`` sizes the state store of stateful operators (fixed
    in the checkpoint at the first run; the session's shuffle-partition
    setting otherwise).  The query clones the session conf when it starts,
    so the setting is restored right after."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, "stream_out")
    checkpoint = checkpoint or scratch_path(spark, "stream_ckpt")
    w = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True))
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if state_partitions:
        spark.conf.set(key, str(int(state_partitions)))
    try:
        q = w.start()
    finally:
        spark.conf.set(key, before)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return out


def stream_align(stream: DataFrame, period, series: Sequence[str], aligner: str = "sum", value: str = "value",
                 ts: str = "ts", delay=None, watermarked: bool = False) -> DataFrame:
    """T2-T4 on a stream: watermark (default two periods; ``watermarked``: the
    stream has one), then the same window aggregation as the batch form; append
    mode emits a window once the watermark passes its end."""
    p = _secs(period)
    s = stream if watermarked else with_watermark(stream, p, ts, delay)
    agg = {"count": F.count(F.lit(1)).cast("double"), "sum": F.sum(value), "mean": F.avg(value),
           "max": F.max(value), "min": F.min(value), "rate": F.sum(value) / F.lit(float(p))}[aligner]
    g = s.groupBy(F.window(ts, f"{p} seconds").alias("w"), *series).agg(agg.alias("value"))
    return g.select("w", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *series, "value")


def stream_incidents(aligned: DataFrame, gt: float, period, auto_close=None,
                     series: Sequence[str] = ()) -> DataFrame:
    """T6 + T10 on a stream, chained after ``stream_align``: breaching
    windows are grouped into incidents by a session window on the aligned
    window's time.  Two windows join one incident when the later starts at
    most ``auto_close`` seconds after the earlier ends (the session gap is
    ``auto_close + period`` plus one microsecond because ``window_time`` is
    a window's end minus one microsecond)."""
    p = _secs(period)
    gap = _secs(auto_close) if auto_close is not None else p
    br = aligned.filter(F.col("value") > F.lit(gt)).withColumn("_t", F.window_time("w"))
    g = br.groupBy(F.session_window("_t", f"{gap + p} seconds 1 microsecond").alias("s"), *series).agg(
        F.min("window_start").alias("opened_at"), F.max("window_end").alias("last_breach_end"),
        F.count(F.lit(1)).alias("n_windows"))
    return g.select(*series, "opened_at", "last_breach_end", "n_windows",
                    (F.col("last_breach_end") + F.make_interval(secs=F.lit(gap))).alias("closed_at"))


def decode_messages(stream: DataFrame, data: str = "data", out: str = "greeting") -> DataFrame:
    """base64 message payloads decoded into greetings on a stream."""
    return stream.withColumn(out, decode_message(data))


def log_arrivals(stream: DataFrame, log_path: str, checkpoint: str | None = None) -> str:
    """One log row per arriving file (name, modification time, rows);
    ``stream`` comes from ``io.stream_files`` (``_file``, ``_file_mtime``).

    A file is read by exactly one micro-batch, so counting per batch is
    exact and keeps no state.  Each batch writes its own folder
    ``batch_id=<n>`` in overwrite mode, so a replayed batch (after a
    failure) rewrites the same rows instead of duplicating them."""
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream_ckpt")

    def write(batch: DataFrame, batch_id: int) -> None:
        per_file = batch.groupBy(F.col("_file").alias("file_path"), F.col("_file_mtime").alias("file_mtime")).agg(
            F.count(F.lit(1)).alias("n_rows"))
        per_file.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return log_path
