"""Stateful alert operators on streams: the duration hold.

Aligned windows leave the windowed aggregation in watermark order (append
mode emits a window once the watermark passes its end, and later rows for
it are dropped as late), so per series the breaching windows arrive in
increasing time.  The hold keeps two values per series in the state store
-- the start of the last breaching window and the current run length --
and emits each window that completes a run of ``windows_needed``
consecutive breaching windows.  State per series is O(1); no window list is
kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from quarry.streaming.metrics import _secs, windows_needed

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_RUN_STATE = StructType([StructField("last_start", LongType()), StructField("run", LongType())])


class SustainedHold(StatefulProcessor):
    """Per-series run counter over breaching windows (epoch seconds)."""

    def __init__(self, period_s: int, needed: int, columns: Sequence[str]):
        self.period_s = period_s
        self.needed = needed
        self.columns = list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", _RUN_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        batch = pd.concat(frames, ignore_index=True).sort_values("start_epoch")
        last, run = (None, 0)
        if self.state.exists():
            last, run = self.state.get()
        start = batch["start_epoch"].to_numpy()
        # a run breaks where a window doesn't follow the one before it
        broken = np.append(last is None or start[0] != last + self.period_s, np.diff(start) != self.period_s)
        at = np.arange(len(start))
        head = np.maximum.accumulate(np.where(broken, at, -1))
        length = np.where(head >= 0, at - head + 1, run + at + 1)
        self.state.update((int(start[-1]), int(length[-1])))
        batch["run_length"] = length
        out = batch[batch["run_length"] >= self.needed]
        if len(out):
            yield out[[*self.columns, "run_length"]]

    def close(self) -> None:
        pass


def rocksdb_state(spark: SparkSession) -> None:
    """Stateful processors need the RocksDB state store.  A stream takes the
    setting when it starts, so it has to stay; one that is set stays as it is."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "") != ROCKSDB:
        spark.conf.set(key, ROCKSDB)


def stream_sustained(breaches: DataFrame, duration, period, series: Sequence[str], event_time: str | None = None) -> DataFrame:
    """T7 on a stream: ``breaches`` are aligned breaching windows
    (``stream_align`` + a threshold filter).  Emits the windows that
    complete a run of ``max(1, ceil(duration / period))`` consecutive
    breaching windows, like the batch ``metrics.sustained``.  ``event_time``
    names the column by whose watermark a stateful operator can follow."""
    rocksdb_state(breaches.sparkSession)
    keys = list(series) or ["_all"]
    own = breaches if series else breaches.withColumn("_all", F.lit(0))
    columns = [c for c in breaches.columns if c != "w"]
    inp = own.select(*columns, *(k for k in keys if k not in columns), F.unix_timestamp("window_start").alias("start_epoch"))
    schema = StructType([StructField(f.name, f.dataType) for f in inp.schema.fields if f.name in columns] + [StructField("run_length", LongType())])
    chained = {"timeMode": "EventTime", "eventTimeColumnName": event_time} if event_time else {"timeMode": "None"}
    return inp.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=SustainedHold(_secs(period), windows_needed(duration, period), columns),
        outputStructType=schema, outputMode="Append", **chained)
