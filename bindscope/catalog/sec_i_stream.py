"""Streaming views, run over everything available so that batch SQL applies."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindscope.catalog.base import query
from bindscope.streaming import tasks as ST


def events(c):
    kind = (
        F.when(F.col("event_type") == "signup", "claim").when(F.col("event_type") == "purchase", "completed")
        .when(F.col("event_type") == "error", "failed").otherwise("heartbeat")
    )
    raw = ST.read_events(c.spark, c.folder, "events.parquet")
    return raw.select("event_id", F.col("user_id").alias("task_id"), "ts", kind.alias("kind"))


SPELLS = """e AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 90 SECOND THEN 1 ELSE 0 END AS fresh FROM v_task_events WINDOW w AS (PARTITION BY task_id ORDER BY ts, event_id)),
    n AS (SELECT *, sum(fresh) OVER (PARTITION BY task_id ORDER BY ts, event_id) AS spell FROM e),
    s AS (SELECT task_id, min(ts) AS started, max(ts) AS last_seen, max_by(kind, (ts, event_id)) AS last_kind, count(*) FILTER (kind = 'claim') AS claims, count(*) AS events
      FROM n GROUP BY task_id, spell)"""


def spells(c):
    return ST.drain(ST.stream_spells(events(c), 90.0), "complete", "spells")


@query("i8_stream_spells", f"WITH {SPELLS} SELECT task_id, epoch_us(started) AS started_us, epoch_us(last_seen) AS last_seen_us, last_kind, claims, events FROM s")
def i8s(c):
    return spells(c).select("task_id", F.unix_micros("started").alias("started_us"), F.unix_micros("last_seen").alias("last_seen_us"), "last_kind", "claims", "events")


@query("i8_stream_task_state", f"""WITH {SPELLS}, t AS (SELECT task_id, max_by(last_kind, last_seen) AS k, max(last_seen) AS seen, cast(sum(claims) AS bigint) AS claims,
    cast(sum(events) AS bigint) AS events, count(*) AS spells FROM s GROUP BY 1)
    SELECT task_id, CASE WHEN k IN ('completed', 'failed') THEN k WHEN seen + INTERVAL 90 SECOND <= (SELECT max(ts) FROM v_task_events) THEN 'stale' ELSE 'running' END AS status,
    claims, events, spells FROM t""")
def i8(c):
    rows = spells(c)
    now = rows.agg(F.max("last_seen")).scalar()
    return ST.task_state(rows, now, 90.0).select("task_id", "status", "claims", "events", "spells")


@query("i8_stream_latest", """SELECT task_id, max_by(kind, (ts, event_id)) AS last_kind, count(*) FILTER (kind = 'claim') AS claims, count(*) AS events FROM v_task_events GROUP BY 1""")
def i8b(c):
    return ST.drain(ST.stream_latest(events(c)), "complete", "latest").select("task_id", "last_kind", "claims", "events")


@query("i9_stream_status", """SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS "start", kind, count(*) AS n FROM v_task_events GROUP BY 1, 2""")
def i9(c):
    out = ST.drain(ST.stream_status(events(c), "1 hour"), "complete", "status")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "kind", "n")


@query("i9_stream_status_sliding", """WITH s AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) - o * INTERVAL 15 MINUTE AS st, kind FROM v_task_events, range(0, 4) t(o))
    SELECT strftime(st, '%Y-%m-%d %H:%M') AS "start", kind, count(*) AS n FROM s GROUP BY 1, 2""")
def i9s(c):
    out = ST.drain(ST.stream_status(events(c), "1 hour", "15 minutes"), "complete", "status")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "kind", "n")
