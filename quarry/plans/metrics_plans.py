"""Metric and alert queries over ``events`` (T1-T13, P11/P12 on streams).

Batch forms are checked against DuckDB (``time_bucket`` aligns to the epoch
like Spark's ``window``).  Stream forms read ``events`` staged as three
time-ordered files and are checked on the windows the watermark has closed:
``window_end <= max(ts) - delay``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans.registry import register, t
from quarry.sources import io
from quarry.streaming import metrics as M
from quarry.streaming import policies as P
from quarry.streaming import streams as ST


def _events(spark, d):
    return t(spark, d, "events")


def _bucket(p: int) -> str:
    return (f"time_bucket(INTERVAL '{p} seconds', ts) AS window_start, "
            f"time_bucket(INTERVAL '{p} seconds', ts) + INTERVAL '{p} seconds' AS window_end")


@register("t1_log_metric", f"""
SELECT {_bucket(300)}, CAST(count(*) AS BIGINT) AS value FROM events
WHERE event_type = 'error' AND contains(lower(props), '9') GROUP BY 1, 2""")
def t1_log_metric(spark, d):
    return M.log_metric(_events(spark, d), 300, eq={"event_type": "error"}, has={"props": "9"})


@register("t2_align_60s_sum", f"""
SELECT {_bucket(60)}, event_type, round(sum(value), 4) AS value FROM events GROUP BY 1, 2, event_type""")
def t2_align_60s_sum(spark, d):
    return M.align(_events(spark, d), 60, ["event_type"], "sum").withColumn("value", F.round("value", 4))


@register("t2_align_600s_mean", f"""
SELECT {_bucket(600)}, event_type, round(avg(value), 4) AS value FROM events GROUP BY 1, 2, event_type""")
def t2_align_600s_mean(spark, d):
    return M.align(_events(spark, d), 600, ["event_type"], "mean").withColumn("value", F.round("value", 4))


@register("t3_rate_delta", f"""
SELECT {_bucket(300)}, event_type, round(sum(value) / 300.0, 6) AS value FROM events GROUP BY 1, 2, event_type""")
def t3_rate_delta(spark, d):
    return M.align(_events(spark, d), 300, ["event_type"], "rate").withColumn("value", F.round("value", 6))


@register("t3_rate_counter", f"""
WITH pts AS (SELECT user_id, ts, CAST(event_id % 5000 AS DOUBLE) AS v FROM events),
inc AS (SELECT user_id, ts, v, lag(v) OVER (PARTITION BY user_id ORDER BY ts) AS pv FROM pts)
SELECT {_bucket(300)}, user_id,
       round(sum(CASE WHEN pv IS NULL THEN 0 WHEN v >= pv THEN v - pv ELSE v END) / 300.0, 6) AS value
FROM inc GROUP BY 1, 2, user_id""")
def t3_rate_counter(spark, d):
    # a cumulative counter per user that resets every 5000 events
    pts = _events(spark, d).select("user_id", "ts", (F.col("event_id") % 5000).cast("double").alias("value"))
    return M.align(pts, 300, ["user_id"], "rate", counter=True).withColumn("value", F.round("value", 6))


@register("t4_count_60s", f"""
SELECT {_bucket(60)}, event_type, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1, 2, event_type""")
def t4_count_60s(spark, d):
    return M.align(_events(spark, d), 60, ["event_type"], "count")


@register("t5_reduce_sum", f"""
SELECT window_start, window_end, round(sum(v), 6) AS value FROM (
  SELECT {_bucket(300)}, user_id, sum(value) / 300.0 AS v FROM events GROUP BY 1, 2, user_id)
GROUP BY window_start, window_end""")
def t5_reduce_sum(spark, d):
    per_user = M.align(_events(spark, d), 300, ["user_id"], "rate")
    return M.reduce_series(per_user, "sum").withColumn("value", F.round("value", 6))


@register("t6_threshold", f"""
SELECT * FROM (SELECT {_bucket(300)}, event_type, round(sum(value) / 300.0, 6) AS value
               FROM events GROUP BY 1, 2, event_type) WHERE value > 0.5""")
def t6_threshold(spark, d):
    a = M.align(_events(spark, d), 300, ["event_type"], "rate").withColumn("value", F.round("value", 6))
    return M.threshold(a, gt=0.5)


HOURLY_BREACH_SQL = f"""
(SELECT * FROM (SELECT {_bucket(3600)}, event_type, CAST(count(*) AS DOUBLE) AS value
                FROM events GROUP BY 1, 2, event_type) WHERE value > 4)"""


def _hourly_breaches(spark, d):
    return M.threshold(M.align(_events(spark, d), 3600, ["event_type"], "count"), gt=4)


@register("t7_sustained", f"""
WITH b AS (SELECT *, CAST(epoch(window_start) / 3600 AS BIGINT) AS idx FROM {HOURLY_BREACH_SQL}),
i AS (SELECT *, idx - row_number() OVER (PARTITION BY event_type ORDER BY idx) AS island FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type, island ORDER BY idx) AS run_length FROM i)
SELECT window_start, window_end, event_type, value, CAST(run_length AS INTEGER) AS run_length
FROM r WHERE run_length >= 2""")
def t7_sustained(spark, d):
    return M.sustained(_hourly_breaches(spark, d), 7200, 3600, ["event_type"])


@register("t8_trigger", f"""
SELECT window_start, window_end, CAST(count(DISTINCT event_type) AS BIGINT) AS n_series
FROM {HOURLY_BREACH_SQL} GROUP BY window_start, window_end HAVING count(DISTINCT event_type) >= 2""")
def t8_trigger(spark, d):
    return M.trigger(_hourly_breaches(spark, d), 2, "event_type")


@register("t9_combine_or", f"""
SELECT DISTINCT window_start, window_end FROM (
  SELECT window_start, window_end FROM {HOURLY_BREACH_SQL} WHERE event_type = 'error'
  UNION ALL
  SELECT {_bucket(3600)} FROM events WHERE event_type = 'purchase' GROUP BY 1, 2 HAVING sum(value) > 1500)""")
def t9_combine_or(spark, d):
    a = _hourly_breaches(spark, d).filter(F.col("event_type") == "error")
    b = M.threshold(M.align(_events(spark, d).filter(F.col("event_type") == "purchase"), 3600, [], "sum"), gt=1500)
    return M.combine_or(a, b)


def _incidents_sql(breach_sql: str, series: str, gap: int) -> str:
    part = f"PARTITION BY {series}" if series else ""
    sel = f"{series}, " if series else ""
    return f"""
WITH b AS (SELECT *, epoch(window_start) AS s, epoch(window_end) AS e FROM {breach_sql}),
n AS (SELECT *, CASE WHEN max(e) OVER ({part} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NULL
                      OR s > max(e) OVER ({part} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap}
                     THEN 1 ELSE 0 END AS new FROM b),
k AS (SELECT *, sum(new) OVER ({part} ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS incident FROM n)
SELECT {sel}CAST(incident AS BIGINT) AS incident, min(window_start) AS opened_at, max(window_end) AS last_breach_end,
       CAST(count(*) AS BIGINT) AS n_windows, max(window_end) + INTERVAL '{gap} seconds' AS closed_at
FROM k GROUP BY {sel}incident"""


@register("t10_incidents", _incidents_sql(HOURLY_BREACH_SQL, "event_type", 7200))
def t10_incidents(spark, d):
    return M.incidents(_hourly_breaches(spark, d), auto_close=7200, series=["event_type"])


POLICY = {"filter": {"eq": {"event_type": "error"}}, "period": 1800, "series": [], "aligner": "count",
          "reducer": "none", "gt": 2, "duration": 3600, "trigger_count": 1, "auto_close": 7200}

POLICY_BREACH_SQL = f"""
(SELECT * FROM (
  WITH b AS (SELECT * FROM (SELECT {_bucket(1800)}, CAST(count(*) AS DOUBLE) AS value FROM events
                            WHERE event_type = 'error' GROUP BY 1, 2) WHERE value > 2),
  i AS (SELECT *, CAST(epoch(window_start) / 1800 AS BIGINT)
                  - row_number() OVER (ORDER BY window_start) AS island FROM b),
  r AS (SELECT *, row_number() OVER (PARTITION BY island ORDER BY window_start) AS run_length FROM i)
  SELECT window_start, window_end FROM r WHERE run_length >= 2))"""


@register("t11_alert_policy", _incidents_sql(POLICY_BREACH_SQL, "", 7200))
def t11_alert_policy(spark, d):
    return M.alert_policy(_events(spark, d), POLICY)


#: Two conditions in the JSON form of the surveyed policies.
JSON_POLICY = """{"displayName": "Events", "userLabels": {}, "combiner": "OR", "enabled": true, "severity": "SEVERITY_UNSPECIFIED", "notificationChannels": [],
 "alertStrategy": {"autoClose": "7200s"},
 "conditions": [
  {"displayName": "errors", "conditionThreshold": {"filter": "resource.type = \\"error\\"", "comparison": "COMPARISON_GT", "thresholdValue": 2, "duration": "7200s", "trigger": {"count": 1},
   "aggregations": [{"alignmentPeriod": "3600s", "crossSeriesReducer": "REDUCE_NONE", "perSeriesAligner": "ALIGN_COUNT"}]}},
  {"displayName": "many kinds", "conditionThreshold": {"filter": "", "comparison": "COMPARISON_GT", "thresholdValue": 0.02, "duration": "0s", "trigger": {"count": 3},
   "aggregations": [{"alignmentPeriod": "3600s", "crossSeriesReducer": "REDUCE_NONE", "perSeriesAligner": "ALIGN_RATE"}]}}]}"""
FIELDS = {"resource.type": "event_type"}


def _fired_sql(closed: str = "") -> str:
    """The windows in which a condition of JSON_POLICY fires."""
    return f"""(
  WITH b AS (SELECT * FROM (SELECT {_bucket(3600)}, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1, 2) WHERE n > 2 {closed}),
  i AS (SELECT *, CAST(epoch(window_start) / 3600 AS BIGINT) - row_number() OVER (ORDER BY window_start) AS island FROM b),
  r AS (SELECT *, row_number() OVER (PARTITION BY island ORDER BY window_start) AS run_length FROM i)
  SELECT window_start, window_end FROM r WHERE run_length >= 2
  UNION
  SELECT window_start, window_end FROM (SELECT {_bucket(3600)}, event_type, sum(value) / 3600.0 AS rate FROM events GROUP BY 1, 2, event_type) WHERE rate > 0.02 {closed}
  GROUP BY window_start, window_end HAVING count(*) >= 3)"""


@register("t11_policy_two_conditions", _incidents_sql(_fired_sql(), "", 7200))
def t11_policy_two_conditions(spark, d):
    return P.policy_incidents(_events(spark, d), P.parse(JSON_POLICY, FIELDS), ["event_type"])


# --------------------------------------------------------------------------
# streams
# --------------------------------------------------------------------------


def _slots(spark) -> int:
    """State partitions for the test streams: the cluster's task slots."""
    return spark.sparkContext.defaultParallelism


#: The events come as so many files in time order, in so many batches of data.
FILES, BATCHES = 12, 3


def _event_stream(spark, d):
    ev = _events(spark, d)
    root = ST.stage_files(spark, ev, "ts", FILES)
    return io.stream_files(spark, root, ev.schema, max_files_per_trigger=FILES // BATCHES)


@register("t2_stream_align_600s", f"""
SELECT * FROM (SELECT {_bucket(600)}, event_type, round(sum(value), 4) AS value FROM events GROUP BY 1, 2, event_type)
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1200 seconds'""")
def t2_stream_align_600s(spark, d):
    a = ST.stream_align(_event_stream(spark, d), 600, ["event_type"], "sum")
    out = ST.run_available_now(a.drop("w"), state_partitions=_slots(spark))
    return spark.read.parquet(out).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type",
        F.round("value", 4).alias("value"))


@register("t10_stream_incidents", _incidents_sql(f"""
(SELECT * FROM (SELECT {_bucket(3600)}, event_type, CAST(count(*) AS DOUBLE) AS value
                FROM events GROUP BY 1, 2, event_type)
 WHERE value > 4 AND window_end <= (SELECT max(ts) FROM events) - INTERVAL '7200 seconds')""",
                                          "event_type", 7200).replace(
    "SELECT event_type, CAST(incident AS BIGINT) AS incident,", "SELECT event_type,"))
def t10_stream_incidents(spark, d):
    a = ST.stream_align(_event_stream(spark, d), 3600, ["event_type"], "count")
    inc = ST.stream_incidents(a, 4, 3600, auto_close=7200, series=["event_type"])
    out = ST.run_available_now(inc, state_partitions=_slots(spark))
    return spark.read.parquet(out).select(
        "event_type", F.col("opened_at").cast("timestamp_ntz").alias("opened_at"),
        F.col("last_breach_end").cast("timestamp_ntz").alias("last_breach_end"), "n_windows",
        F.col("closed_at").cast("timestamp_ntz").alias("closed_at"))


@register("t12_stream_decode_messages", """
SELECT event_id, 'Hello ' || coalesce(nullif(decode(from_base64(data)), ''), 'World') || '!' AS greeting
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '' ELSE to_base64(encode(event_type)) END AS data
      FROM events)""")
def t12_stream_decode_messages(spark, d):
    s = _event_stream(spark, d).select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.lit("")).otherwise(
            F.base64(F.encode("event_type", "UTF-8"))).alias("data"))
    out = ST.run_available_now(ST.decode_messages(s).select("event_id", "greeting"))
    return spark.read.parquet(out)


@register("t13_log_arrivals", """
SELECT 'arrived-' || strftime(ts, '%Y%m%d') || '.parquet' AS file, CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY 1""")
def t13_log_arrivals(spark, d):
    from quarry.session import scratch_path
    # one file a day, named by it: each is one row of the log
    ev = _events(spark, d)
    root = ST.stage_named(spark, ev, F.concat(F.lit("arrived-"), F.date_format("ts", "yyyyMMdd")))
    log = ST.log_arrivals(io.stream_files(spark, root, ev.schema, max_files_per_trigger=10), scratch_path(spark, "arrivals"))
    return spark.read.parquet(log).select(F.element_at(F.split("file_path", "/"), -1).alias("file"), F.col("n_rows").cast("bigint").alias("n_rows"))


@register("p11_stream_label_filter", """
SELECT event_id, user_id, props FROM events WHERE event_type = 'error' AND contains(lower(props), '9')""")
def p11_stream_label_filter(spark, d):
    from quarry.operators.relational import label_filter
    s = label_filter(_event_stream(spark, d), eq={"event_type": "error"}, has={"props": "9"})
    out = ST.run_available_now(s.select("event_id", "user_id", "props"))
    return spark.read.parquet(out)


@register("s18_stream_files", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT event_id) AS BIGINT) AS n_events
FROM events GROUP BY event_type""")
def s18_stream_files(spark, d):
    s = _event_stream(spark, d).select("event_id", "event_type", "_file")
    out = ST.run_available_now(s)
    return spark.read.parquet(out).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_events"))


@register("s19_stream_messages", """
SELECT event_id AS message_id, ts AS publish_time, props AS payload FROM events""")
def s19_stream_messages(spark, d):
    from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, LongType
    msgs = _events(spark, d).select(F.col("event_id").alias("message_id"), F.col("ts").alias("publish_time"),
                                    F.base64(F.encode("props", "UTF-8")).alias("data"))
    root = ST.stage_files(spark, msgs, "publish_time", FILES)
    schema = StructType([StructField("message_id", LongType()), StructField("publish_time", TimestampNTZType()),
                         StructField("data", StringType())])
    s = io.stream_messages(spark, root, schema).select(
        "message_id", "publish_time", F.decode(F.unbase64("data"), "UTF-8").alias("payload"))
    return spark.read.parquet(ST.run_available_now(s))


@register("t7_stream_sustained", f"""
WITH b AS (SELECT *, CAST(epoch(window_start) / 3600 AS BIGINT) AS idx FROM {HOURLY_BREACH_SQL}
           WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '7200 seconds'),
i AS (SELECT *, idx - row_number() OVER (PARTITION BY event_type ORDER BY idx) AS island FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type, island ORDER BY idx) AS run_length FROM i)
SELECT window_start, window_end, event_type, value, CAST(run_length AS BIGINT) AS run_length
FROM r WHERE run_length >= 2""")
def t7_stream_sustained(spark, d):
    from quarry.streaming.alerts import stream_sustained
    a = ST.stream_align(_event_stream(spark, d), 3600, ["event_type"], "count")
    br = a.filter(F.col("value") > 4).drop("w")
    out = ST.run_available_now(stream_sustained(br, 7200, 3600, ["event_type"]), state_partitions=_slots(spark))
    return spark.read.parquet(out).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "value", "run_length")


MARK = "(SELECT max(ts) - INTERVAL '7200 seconds' FROM events)"


def _life_cycle_sql(incidents: str, series: str = "") -> str:
    """OPEN rows of all incidents, CLOSE rows of those that the watermark has closed."""
    own = f"{series}, " if series else ""
    return f"""WITH inc AS ({incidents})
SELECT {own}'OPEN' AS event, opened_at, opened_at AS at, CAST(0 AS BIGINT) AS n_windows FROM inc
UNION ALL SELECT {own}'CLOSE', opened_at, closed_at, n_windows FROM inc WHERE closed_at <= {MARK}"""


def _plain(life, *series):
    ntz = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("opened_at", "at")]
    return life.select(*series, "event", *ntz, "n_windows")


CLOSED_BREACHES = f"""(SELECT * FROM (SELECT {_bucket(3600)}, event_type, CAST(count(*) AS DOUBLE) AS value
                FROM events GROUP BY 1, 2, event_type) WHERE value > 4 AND window_end <= {MARK})"""


@register("t10_stream_life_cycle", _life_cycle_sql(_incidents_sql(CLOSED_BREACHES, "event_type", 7200), "event_type"))
def t10_stream_life_cycle(spark, d):
    a = ST.stream_align(_event_stream(spark, d), 3600, ["event_type"], "count")
    fired = a.filter(F.col("value") > 4).withColumn("at", F.window_time("w")).drop("w")
    out = ST.run_available_now(P.stream_life_cycle(fired, 7200, ["event_type"]), state_partitions=_slots(spark))
    return _plain(spark.read.parquet(out), "event_type")


@register("t11_stream_policy", f"SELECT * FROM {_fired_sql(f'AND window_end <= {MARK}')}")
def t11_stream_policy(spark, d):
    fired = P.stream_fired(_event_stream(spark, d), P.parse(JSON_POLICY, FIELDS), ["event_type"])
    out = ST.run_available_now(fired, state_partitions=_slots(spark))
    return spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.col("window_end").cast("timestamp_ntz").alias("window_end"))
