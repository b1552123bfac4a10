"""Metric alignment and alert policies (T1-T11), batch or streaming.

A time series is a DataFrame ``(ts, series labels..., value)``.  Alignment
is a ``window(ts, period)`` aggregation keyed by (window, labels): partial
aggregation map-side, and on a stream a watermarked append-mode state
store.  Everything downstream of alignment works on aligned points -- one
row per series and period -- so even a series holding a third of all raw
rows contributes only one row per period.

Contracts (SURVEY §2.9): a breach is *sustained* after
``max(1, ceil(duration / period))`` consecutive breaching windows; a
missing window breaks the run.  An incident opens at the start of the first
window of a sustained breach and closes ``auto_close`` seconds after the end
of its last breaching window (default: one period).  Watermark default:
two periods; later rows are dropped.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.relational import label_predicate
from quarry.operators.scans import prefix_scan


_UNITS = {"ms": 0.001, "s": 1, "sec": 1, "second": 1, "m": 60, "min": 60, "minute": 60, "h": 3600, "hour": 3600,
          "d": 86400, "day": 86400}


def _secs(period) -> int:
    """Whole seconds of a period: a number of seconds, or text such as
    "300s", "5 minutes", "1 hour".  Anything else, or a part of a second,
    is an error."""
    if isinstance(period, (int, float)):
        secs = float(period)
    else:
        m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-z]*)\s*", str(period).lower())
        unit = _UNITS.get(m[2]) or _UNITS.get(m[2].removesuffix("s")) if m and m[2] else 1
        if not m or unit is None:
            raise ValueError(f"not a period: {period!r}")
        secs = float(m[1]) * unit
    if secs < 1 or secs != int(secs):
        raise ValueError(f"a period has whole seconds, one at least: {period!r}")
    return int(secs)


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Streams need a ``timestamp`` event time (``withWatermark`` rejects
    ``timestamp_ntz``); with the session time zone at UTC the cast keeps
    the wall-clock value."""
    if dict(df.dtypes).get(ts) == "timestamp_ntz":
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def with_watermark(df: DataFrame, period, ts: str = "ts", delay=None) -> DataFrame:
    delay_s = _secs(delay) if delay is not None else 2 * _secs(period)
    return event_time(df, ts).withWatermark(ts, f"{delay_s} seconds")


# --------------------------------------------------------------------------
# T1-T6
# --------------------------------------------------------------------------


def log_metric(logs: DataFrame, every, labels: Sequence[str] = (), eq: Mapping | None = None,
               has: Mapping | None = None, ts: str = "ts") -> DataFrame:
    """A counter metric from matching log rows, per period and labels."""
    f = logs.filter(label_predicate(eq, has))
    g = f.groupBy(F.window(ts, f"{_secs(every)} seconds").alias("w"), *labels).agg(
        F.count(F.lit(1)).alias("value"))
    return _flatten(g, labels)


def _flatten(g: DataFrame, labels: Sequence[str], value: str = "value") -> DataFrame:
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *labels, value)


def align(df: DataFrame, period, series: Sequence[str], aligner: str = "sum", value: str = "value",
          ts: str = "ts", counter: bool = False) -> DataFrame:
    """Per-series aligners over tumbling windows.

    * ``count`` -- points per window;
    * ``sum`` / ``mean`` / ``max`` / ``min`` -- of the values;
    * ``rate`` -- per second: for delta values ``sum(v) / period``; for
      cumulative counters (``counter=True``) the positive increases between
      consecutive points (a drop is a reset: the new value counts from 0),
      attributed to the window of the later point, divided by the period.
    """
    p = _secs(period)
    w = F.window(ts, f"{p} seconds").alias("w")
    if aligner == "rate" and counter:
        return _counter_rate(df, p, series, value, ts)
    agg = {"count": F.count(F.lit(1)), "sum": F.sum(value), "mean": F.avg(value), "max": F.max(value),
           "min": F.min(value), "rate": F.sum(value) / F.lit(float(p))}[aligner]
    out = df.groupBy(w, *series).agg(agg.alias("value"))
    if aligner == "count":
        out = out.withColumn("value", F.col("value").cast("double"))
    return _flatten(out, series)


def _counter_rate(df: DataFrame, p: int, series: Sequence[str], value: str, ts: str) -> DataFrame:
    """Increase of a cumulative counter per window, without a per-series
    global sort.  Points are ordered only inside (series, window) -- a
    partition bounded by one period of one series -- and the step across a
    window boundary comes from one aggregated row per (series, window)."""
    bucket = F.window(ts, f"{p} seconds")
    pts = df.select(*series, F.col(ts), F.col(value).alias("_v"), bucket.alias("w"))
    inner_w = Window.partitionBy(*series, "w").orderBy(ts)
    step = F.col("_v") - F.lag("_v").over(inner_w)
    pts = pts.withColumn("_inc", F.when(F.lag("_v").over(inner_w).isNull(), F.lit(0.0))
                         .when(step >= 0, step).otherwise(F.col("_v")))
    per = pts.groupBy(*series, "w").agg(F.sum("_inc").alias("_inner"),
                                        F.min_by("_v", ts).alias("_first"), F.max_by("_v", ts).alias("_last"))
    across_w = Window.partitionBy(*series).orderBy(F.col("w.start"))
    prev_last = F.lag("_last").over(across_w)
    cross = F.when(prev_last.isNull(), F.lit(0.0)).when(F.col("_first") >= prev_last,
                                                       F.col("_first") - prev_last).otherwise(F.col("_first"))
    out = per.withColumn("value", (F.col("_inner") + cross) / F.lit(float(p)))
    return _flatten(out, series)


def reduce_series(aligned: DataFrame, how: str = "sum", keep: Sequence[str] = ()) -> DataFrame:
    """T5: cross-series reducer.  ``none`` keeps every series; ``sum`` /
    ``mean`` / ``max`` / ``count`` combine the series of each window that
    share the ``keep`` labels."""
    if how == "none":
        return aligned
    agg = {"sum": F.sum("value"), "mean": F.avg("value"), "max": F.max("value"), "min": F.min("value"),
           "count": F.count(F.lit(1)).cast("double")}[how]
    return aligned.groupBy("window_start", "window_end", *keep).agg(agg.alias("value"))


def threshold(aligned: DataFrame, gt: float | None = None, lt: float | None = None) -> DataFrame:
    """Windows whose value is strictly above ``gt`` (or below ``lt``)."""
    cond = F.lit(True)
    if gt is not None:
        cond = cond & (F.col("value") > F.lit(gt))
    if lt is not None:
        cond = cond & (F.col("value") < F.lit(lt))
    return aligned.filter(cond)


# --------------------------------------------------------------------------
# T7-T10 (batch forms; streaming forms in quarry.streaming.alerts)
# --------------------------------------------------------------------------


def _duration(value) -> int:
    """Whole seconds like ``_secs``, or none at all (0, "0s")."""
    return 0 if re.fullmatch(r"\s*0+(\.0+)?\s*s?\s*", str(value)) else _secs(value)


def windows_needed(duration, period) -> int:
    return max(1, math.ceil(_duration(duration) / _secs(period)))


def sustained(breaches: DataFrame, duration, period, series: Sequence[str]) -> DataFrame:
    """T7 (batch): breaching windows that complete a run of at least
    ``windows_needed`` consecutive windows, with ``run_length``.  A run starts at
    a window whose predecessor doesn't breach; both are found by scans over
    blocks of windows (``scans.prefix_scan``), so a series, or all rows where
    there is none, is never sorted as a whole."""
    n = windows_needed(duration, period)
    idx = F.floor(F.unix_timestamp(F.col("window_start").cast("timestamp")) / F.lit(_secs(period)))
    b = prefix_scan(breaches.withColumn("_idx", idx), series, "_idx", F.col("_idx"), "max", "_prev", inclusive=False)
    start = F.when(F.col("_prev").isNull() | (F.col("_prev") != F.col("_idx") - 1), F.col("_idx"))
    b = prefix_scan(b, series, "_idx", start, "max", "_start")
    return b.withColumn("run_length", (F.col("_idx") - F.col("_start") + 1).cast("int")).filter(F.col("run_length") >= n).drop("_idx", "_prev", "_start")


def trigger(breaches: DataFrame, n: int = 1, series_col: str | Column = "series") -> DataFrame:
    """Windows in which at least ``n`` distinct series breach."""
    s = F.col(series_col) if isinstance(series_col, str) else series_col
    g = breaches.groupBy("window_start", "window_end").agg(F.count_distinct(s).alias("n_series"))
    return g.filter(F.col("n_series") >= n)


def combine_or(*conds: DataFrame, keys: Sequence[str] = ("window_start", "window_end")) -> DataFrame:
    """A policy fires in a window when any condition does; one row per
    (policy keys, window) whichever condition fired."""
    out = conds[0].select(*keys)
    for c in conds[1:]:
        out = out.unionByName(c.select(*keys))
    return out.dropDuplicates(list(keys))


def incidents(breaches: DataFrame, auto_close=None, period=None, series: Sequence[str] = ()) -> DataFrame:
    """T10 (batch): incident life cycle over breaching windows.  A breach
    starting more than ``auto_close`` seconds after the end of the previous
    one opens a new incident; otherwise it extends the open one.  Returns
    ``(series..., incident, opened_at, last_breach_end, n_windows, closed_at)``.
    Like ``sustained`` it sorts blocks of time only."""
    gap = _duration(auto_close) if auto_close is not None else _secs(period)
    series = list(series)
    ws = F.unix_timestamp(F.col("window_start").cast("timestamp"))
    we = F.unix_timestamp(F.col("window_end").cast("timestamp"))
    b = breaches.select(*series, "window_start", "window_end", ws.alias("_s"), we.alias("_e"))
    b = prefix_scan(b, series, "_s", F.col("_e"), "max", "_until", inclusive=False)
    opened = F.when(F.col("_until").isNull() | (F.col("_s") > F.col("_until") + F.lit(gap)), F.col("_s"))
    b = prefix_scan(b, series, "_s", opened, "max", "_opened")
    g = b.groupBy(*series, "_opened").agg(F.min("window_start").alias("opened_at"), F.max("window_end").alias("last_breach_end"),
                                          F.count(F.lit(1)).alias("n_windows"))
    g = prefix_scan(g, series, "_opened", F.lit(1), "sum", "incident")
    return g.select(*series, F.col("incident").cast("bigint").alias("incident"), "opened_at", "last_breach_end", "n_windows",
                    (F.col("last_breach_end") + F.make_interval(secs=F.lit(gap))).alias("closed_at"))


# --------------------------------------------------------------------------
# Whole policy
# --------------------------------------------------------------------------


def alert_policy(df: DataFrame, cfg: Mapping) -> DataFrame:
    """Filter -> align -> reduce -> compare -> hold -> trigger -> close.

    ``cfg`` keys: ``filter`` ({"eq":…, "has":…}), ``period``, ``series``
    (labels per series), ``aligner``, ``reducer``, ``keep``, ``gt``,
    ``duration``, ``trigger_count``, ``auto_close``."""
    flt = cfg.get("filter", {})
    src = df.filter(label_predicate(flt.get("eq"), flt.get("has")))
    period = cfg["period"]
    aligned = align(src, period, cfg.get("series", []), cfg.get("aligner", "sum"), cfg.get("value", "value"))
    reduced = reduce_series(aligned, cfg.get("reducer", "none"), cfg.get("keep", []))
    labels = cfg.get("keep", []) if cfg.get("reducer", "none") != "none" else cfg.get("series", [])
    br = threshold(reduced, gt=cfg.get("gt"), lt=cfg.get("lt"))
    held = sustained(br, cfg.get("duration", 0), period, labels)
    return incidents(fired(held, labels, cfg.get("trigger_count", 1)), cfg.get("auto_close"), period)


def fired(held: DataFrame, labels: Sequence[str], n: int = 1) -> DataFrame:
    """T8 for a condition: the windows in which ``n`` series or more hold
    (without labels there is one series)."""
    if labels:
        return trigger(held, n, F.to_json(F.struct(*labels))).select("window_start", "window_end")
    return held.select("window_start", "window_end").filter(F.lit(n <= 1))
