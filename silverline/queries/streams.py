"""Streams that share a target, keep keyed state, or aggregate by event time, run over file drops."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverline.queries.registry import query
from silverline.sources.shared import fresh_path
from silverline.streaming import loads, state


def _drops(d, columns, *conditions):
    """The events as file drops in one folder, in this order."""
    path = fresh_path(d.spark, "drops")
    rows = d.events.select(*columns)
    return path, rows.schema, [lambda c=c: rows.filter(c).write.mode("append").parquet(path) for c in conditions]


def _stream(d, path, schema):
    return loads.file_stream(d.spark, path, schema)


@query("stream_unique_state", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def _(d):
    known = d.events.agg(F.min("event_id")).first()[0]
    source, schema, drops = _drops(d, ["event_id", "user_id"], F.col("event_id") <= known + 500, F.col("event_id") > known + 500)
    target, log = fresh_path(d.spark, "state"), fresh_path(d.spark, "state-log")
    for drop in drops:
        drop()
        state.stateful_unique(_stream(d, source, schema), target, log, "user_id", ["event_id"]).awaitTermination()
    return state.batch_rows(d.spark, target, schema)


_LATEST = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 4 END AS flush FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY flush DESC, event_id DESC) = 1"""


def _alternating(d, rows_a_bucket=None):
    """Two streams that flush into one target in turn: a, b, a, b."""
    columns = ["event_id", "user_id", "event_type", "value"]
    target = fresh_path(d.spark, "shared")
    part = lambda n: F.col("event_id") % 4 == n
    one, schema, first = _drops(d, columns, part(0), part(2))
    two, _, second = _drops(d, columns, part(1), part(3))
    logs = {one: fresh_path(d.spark, "log-a"), two: fresh_path(d.spark, "log-b")}
    for drop, source in ((first[0], one), (second[0], two), (first[1], one), (second[1], two)):
        drop()
        loads.stream_upsert(_stream(d, source, schema), target, logs[source], ["user_id"], ["event_id"]).awaitTermination()
        if rows_a_bucket:
            loads.compact(d.spark, target, schema, ["user_id"], ["event_id"], rows_a_bucket)
    return loads.current_rows(d.spark, target, schema, ["user_id"], ["event_id"])


@query("stream_upsert_two_sources", _LATEST)
def _(d):
    return _alternating(d)


@query("stream_upsert_split_buckets", _LATEST)
def _(d):
    return _alternating(d, rows_a_bucket=8)


# ---- Event time: every seventh event comes with the second drop, mostly late ----

_DROPPED = """
WITH dropped AS (
  SELECT *, event_id % 7 = 3 OR event_id > (SELECT max(event_id) // 2 FROM events) AS second FROM events),
marks AS (
  SELECT max(ts) FILTER (WHERE NOT second) - INTERVAL 1 HOUR AS one, max(ts) - INTERVAL 1 HOUR AS two FROM dropped)"""


def _two_late_drops(d):
    half = d.events.agg(F.expr("max(event_id) div 2")).first()[0]
    second = (F.col("event_id") % 7 == 3) | (F.col("event_id") > half)
    return _drops(d, ["event_id", "ts", "user_id", "event_type", "value"], ~second, second)


def _windowed(d, over, keys):
    source, schema, drops = _two_late_drops(d)
    target, log = fresh_path(d.spark, "windows"), fresh_path(d.spark, "windows-log")
    out = StructType().add("window_start", "timestamp").add("window_end", "timestamp")
    for k in keys:
        out = out.add(schema[k])
    for drop in drops:
        drop()
        state.windowed(_stream(d, source, schema), target, log, "ts", "1 hour", over, keys,
                       [F.count(F.lit(1)).alias("n"), F.max("value").alias("most")]).awaitTermination()
    rows = state.batch_rows(d.spark, target, out.add("n", "long").add("most", "double"))
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("tumbling_windows", _DROPPED + """
SELECT time_bucket(INTERVAL 6 HOURS, ts) AS window_start, time_bucket(INTERVAL 6 HOURS, ts) + INTERVAL 6 HOURS AS window_end,
  event_type, count(*) AS n, max(value) AS most
FROM dropped, marks
WHERE (NOT second OR time_bucket(INTERVAL 6 HOURS, ts) + INTERVAL 6 HOURS > one)
  AND time_bucket(INTERVAL 6 HOURS, ts) + INTERVAL 6 HOURS <= two
GROUP BY ALL""")
def _(d):
    return _windowed(d, F.window("ts", "6 hours"), ["event_type"])


@query("session_windows", _DROPPED + """,
first_gaps AS (
  SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL 2 HOURS, true)::INT AS new FROM dropped WHERE NOT second
  WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
first_runs AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM first_gaps),
first_sessions AS (SELECT *, max(ts) OVER (PARTITION BY user_id, run) + INTERVAL 2 HOURS AS done FROM first_runs),
closed AS (
  SELECT min(ts) AS window_start, done AS window_end, user_id, count(*) AS n, max(value) AS most
  FROM first_sessions, marks WHERE done <= one GROUP BY user_id, run, done),
still AS (
  SELECT user_id, ts, value FROM first_sessions, marks WHERE done > one UNION ALL
  SELECT user_id, ts, value FROM dropped, marks WHERE second AND ts + INTERVAL 2 HOURS > one),
gaps AS (
  SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL 2 HOURS, true)::INT AS new FROM still
  WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM gaps),
ended AS (
  SELECT min(ts) AS window_start, max(ts) + INTERVAL 2 HOURS AS window_end, user_id, count(*) AS n, max(value) AS most
  FROM runs GROUP BY user_id, run)
SELECT * FROM closed UNION ALL SELECT ended.* FROM ended, marks WHERE window_end <= two""")
def _(d):
    return _windowed(d, F.session_window("ts", "2 hours"), ["user_id"])


@query("late_rows", _DROPPED + """
SELECT event_id, ts, user_id, event_type, value FROM dropped, marks
WHERE second AND time_bucket(INTERVAL 6 HOURS, ts) + INTERVAL 6 HOURS <= one""")
def _(d):
    source, schema, drops = _two_late_drops(d)
    target, log = fresh_path(d.spark, "late"), fresh_path(d.spark, "late-log")
    for drop in drops:
        drop()
        state.late_rows(_stream(d, source, schema), target, log, "ts", "1 hour",
                        F.window("ts", "6 hours")["end"]).awaitTermination()
    return state.batch_rows(d.spark, target, schema)
