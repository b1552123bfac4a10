"""Alert policies of several conditions, as tables and as streams.

``parse`` reads a policy in the JSON form of the surveyed scripts (conditions
with filter, alignment, reducer, comparison, duration and trigger; combiner;
auto-close).  ``policy_incidents`` evaluates it on a table.  On a stream,
``stream_fired`` chains filter, windowed alignment, reducer, hold and trigger for
each condition, unites them and keeps one row a window
(``dropDuplicatesWithinWatermark``); ``stream_life_cycle`` turns fired windows into
an OPEN row at the first and a CLOSE row when the event-time timer of the
auto-close fires.  State is a few numbers a series, whatever the stream's length.

The conditions of a stream read the same source and share one event-time column
and delay, the longest of the conditions', so the watermark they are judged by is
one (the minimum over the branches, Spark's default, where batches differ).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quarry.operators.relational import label_predicate
from quarry.streaming import metrics as M
from quarry.streaming.alerts import rocksdb_state, stream_sustained
from quarry.streaming.streams import stream_align

# The names of aligners, reducers and comparisons in a policy.
ALIGNERS = {"ALIGN_RATE": "rate", "ALIGN_COUNT": "count", "ALIGN_SUM": "sum", "ALIGN_MEAN": "mean", "ALIGN_MAX": "max", "ALIGN_MIN": "min"}
REDUCERS = {"REDUCE_NONE": "none", "REDUCE_SUM": "sum", "REDUCE_MEAN": "mean", "REDUCE_MAX": "max", "REDUCE_MIN": "min", "REDUCE_COUNT": "count"}
COMPARISONS = {"COMPARISON_GT": "gt", "COMPARISON_LT": "lt"}


@dataclass
class Condition:
    eq: dict[str, object]
    has: dict[str, object]
    period: int
    aligner: str
    reducer: str
    keep: list[str]
    bound: dict[str, float]
    duration: int
    trigger: int = 1


@dataclass
class Policy:
    name: str
    conditions: list[Condition]
    auto_close: int | None
    combiner: str = "OR"
    labels: dict = field(default_factory=dict)


def parse_filter(text: str, columns: Mapping[str, str]) -> tuple[dict, dict]:
    """``a = "x" AND b:"y"`` as (equalities, substrings) by column; ``columns`` names
    the column of each field, a field without one is an error."""
    eq, has = {}, {}
    for term in re.split(r"\s+(?:AND\s+)?(?=[A-Za-z_][\w.]*\s*[:=])", text.strip()) if text.strip() else ():
        m = re.fullmatch(r'([A-Za-z_][\w.]*)\s*([:=])\s*(?:"([^"]*)"|(\S+))', term.strip())
        if not m or m[1] not in columns:
            raise ValueError(f"not a filter on known fields: {term!r}")
        (eq if m[2] == "=" else has)[columns[m[1]]] = m[3] if m[3] is not None else m[4]
    return eq, has


def parse(text: str | Mapping, columns: Mapping[str, str]) -> Policy:
    """A policy from its JSON.  Unknown aligners, reducers, comparisons and
    combiners are errors."""
    spec = json.loads(text) if isinstance(text, str) else text
    conditions = []
    for c in spec["conditions"]:
        t = c["conditionThreshold"]
        (a,) = t["aggregations"]
        eq, has = parse_filter(t.get("filter", ""), columns)
        keep = [columns[f] for f in a.get("groupByFields", ())]
        conditions.append(Condition(eq, has, M._secs(a["alignmentPeriod"]), ALIGNERS[a["perSeriesAligner"]], REDUCERS[a.get("crossSeriesReducer", "REDUCE_NONE")],
                                    keep, {COMPARISONS[t["comparison"]]: float(t["thresholdValue"])}, M._duration(t.get("duration", "0s")), int(t.get("trigger", {}).get("count", 1))))
    if not conditions or spec.get("combiner", "OR") != "OR":
        raise ValueError("a policy has conditions, combined by OR")
    close = spec.get("alertStrategy", {}).get("autoClose")
    return Policy(spec.get("displayName", ""), conditions, None if close is None else M._duration(close), labels=dict(spec.get("userLabels", {})))


def _gap(p: Policy) -> int:
    """Without an auto-close, the longest of the periods."""
    return p.auto_close if p.auto_close is not None else max(c.period for c in p.conditions)


def condition_windows(df: DataFrame, c: Condition, series: Sequence[str], value: str = "value") -> DataFrame:
    """The windows in which a condition fires, on a table; ``series`` are the labels that make a series."""
    own = M.align(df.filter(label_predicate(c.eq, c.has)), c.period, series, c.aligner, value)
    labels = list(series) if c.reducer == "none" else c.keep
    held = M.sustained(M.threshold(M.reduce_series(own, c.reducer, c.keep), **c.bound), c.duration, c.period, labels)
    return M.fired(held, labels, c.trigger)


def policy_incidents(df: DataFrame, policy: Policy, series: Sequence[str], value: str = "value") -> DataFrame:
    """T11 on a table: incidents over the windows in which any condition fires."""
    fired = M.combine_or(*[condition_windows(df, c, series, value) for c in policy.conditions])
    return M.incidents(fired, _gap(policy))


# --------------------------------------------------------------------------
# Streams
# --------------------------------------------------------------------------


def _condition_stream(stream: DataFrame, c: Condition, series: Sequence[str], value: str, ts: str, delay: int) -> DataFrame:
    """Fired windows of one condition, with their event time."""
    # time goes on in a condition without rows, too, so the mark comes before the filter;
    # Catalyst would move one below it that doesn't read the event time
    marked = M.with_watermark(stream, c.period, ts, delay).filter(F.when(label_predicate(c.eq, c.has), F.col(ts)).isNotNull())
    aligned = stream_align(marked, c.period, series, c.aligner, value, ts, watermarked=True)
    labels = list(series)
    if c.reducer != "none":
        agg = {"sum": F.sum("value"), "mean": F.avg("value"), "max": F.max("value"), "min": F.min("value"), "count": F.count(F.lit(1)).cast("double")}[c.reducer]
        labels = c.keep
        w = F.window(F.window_time("w"), f"{c.period} seconds").alias("w")
        aligned = aligned.groupBy(w, *labels).agg(agg.alias("value")).select("w", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *labels, "value")
    breaches = M.threshold(aligned, **c.bound).withColumn("at", F.window_time("w")).drop("w")
    if M.windows_needed(c.duration, c.period) > 1:
        breaches = stream_sustained(breaches, c.duration, c.period, labels, event_time="at")
    if labels and c.trigger > 1:
        # a series has one row a window
        g = breaches.groupBy(F.window("at", f"{c.period} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= c.trigger)
        breaches = g.select(F.window_time("w").alias("at"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    elif c.trigger > 1:
        breaches = breaches.filter(F.lit(False))
    return breaches.select("at", "window_start", "window_end")


def stream_fired(stream: DataFrame, policy: Policy, series: Sequence[str], value: str = "value", ts: str = "ts", delay=None) -> DataFrame:
    """T8, T9 and T11 on a stream: (at, window_start, window_end) of every window
    in which a condition fires, once."""
    rocksdb_state(stream.sparkSession)
    wait = M._secs(delay) if delay is not None else 2 * max(c.period for c in policy.conditions)
    parts = [_condition_stream(stream, c, series, value, ts, wait) for c in policy.conditions]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.dropDuplicatesWithinWatermark(["window_start", "window_end"])


LIFE = "event string, opened_at timestamp, at timestamp, n_windows long"


class LifeCycle(StatefulProcessor):
    """One open incident a series: when it opened, when its last window ended, how many it has."""

    def __init__(self, gap_s: int, series: Sequence[str]):
        self.gap_s, self.series = gap_s, list(series)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("incident", "opened long, until long, windows long")

    def _rows(self, key, found: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(found, columns=["event", "opened_at", "at", "n_windows"])
        for c in ("opened_at", "at"):
            out[c] = pd.to_datetime(out[c], unit="s")
        for name, k in zip(self.series, key):
            out.insert(0, name, k)
        return out[[*self.series, "event", "opened_at", "at", "n_windows"]]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        opened, until, windows = self.open.get() if self.open.exists() else (None, None, 0)
        before, found = until, []
        batch = pd.concat(frames)[["start", "end"]].sort_values(["start", "end"])
        for start, end in batch.itertuples(index=False):
            if opened is not None and start > until + self.gap_s:
                found.append(("CLOSE", opened, until + self.gap_s, windows))
                opened = None
            if opened is None:
                opened, until, windows = int(start), int(end), 0
                found.append(("OPEN", opened, opened, 0))
            until, windows = max(until, int(end)), windows + 1
        self.open.update((opened, until, windows))
        if before is not None:
            self.handle.deleteTimer((before + self.gap_s) * 1000)
        self.handle.registerTimer((until + self.gap_s) * 1000)
        if found:
            yield self._rows(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            opened, until, windows = self.open.get()
            if expiredTimerInfo.getExpiryTimeInMs() == (until + self.gap_s) * 1000:
                self.open.clear()
                yield self._rows(key, [("CLOSE", opened, until + self.gap_s, windows)])

    def close(self) -> None:
        pass


def stream_life_cycle(fired: DataFrame, auto_close, series: Sequence[str] = ()) -> DataFrame:
    """T10 on a stream: ``fired`` windows (``at``, their event time, window_start,
    window_end, series) as rows (series..., event, opened_at, at, n_windows): OPEN
    when an incident's first window comes, ``at`` its start; CLOSE, with its number
    of windows, once the watermark passes ``auto_close`` after its last one's end.
    Without series all windows are one incident's at a time."""
    rocksdb_state(fired.sparkSession)
    series = list(series)
    keyed = fired if series else fired.withColumn("_all", F.lit(0))
    keys = series or ["_all"]
    own = keyed.select("at", *keys, F.unix_timestamp("window_start").alias("start"), F.unix_timestamp("window_end").alias("end"))
    kinds = dict(own.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), LIFE])
    out = own.groupBy(*keys).transformWithStateInPandas(statefulProcessor=LifeCycle(M._duration(auto_close), keys), outputStructType=schema,
                                                        outputMode="Append", timeMode="EventTime")
    return out if series else out.drop("_all")
