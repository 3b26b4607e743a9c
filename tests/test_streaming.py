"""Live task state: ends, late heartbeats and the stale timer."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from bindscope.streaming import tasks as S

SCHEMA = "event_id bigint, task_id bigint, ts timestamp, kind string"
T0 = dt.datetime(2024, 1, 1)


def write(spark, folder, name, rows, age):
    path = f"{folder}/{name}"
    spark.createDataFrame([(i, t, T0 + dt.timedelta(seconds=s), k) for i, (t, s, k) in enumerate(rows)], SCHEMA).coalesce(1).write.parquet(f"{path}-tmp")
    part = next(f for f in os.listdir(f"{path}-tmp") if f.startswith("part"))
    os.makedirs(f"{folder}/in", exist_ok=True)
    os.rename(f"{path}-tmp/{part}", f"{folder}/in/{name}.parquet")
    os.utime(f"{folder}/in/{name}.parquet", (age, age))


def three_files(spark, folder):
    write(spark, folder, "a", [(1, 0, "claim"), (2, 0, "claim"), (2, 30, "completed"), (2, 20, "heartbeat")], 1000)
    write(spark, folder, "b", [(3, 7200, "claim"), (1, 10, "heartbeat"), (1, 7100, "claim")], 2000)
    write(spark, folder, "c", [(3, 7230, "heartbeat"), (2, 40, "heartbeat"), (1, 7110, "heartbeat")], 3000)
    write(spark, folder, "d", [(2, 50, "claim"), (3, 7240, "heartbeat")], 4000)
    return S.read_events(spark, f"{folder}/in", "*.parquet", files_per_trigger=1)


def test_spells_close_and_their_state_expires(spark, tmp_path):
    events = three_files(spark, str(tmp_path))
    progress = []
    base = str(tmp_path / "run")
    run = (
        S.stream_spells(events, 90.0, "10 minutes").writeStream.outputMode("append").option("checkpointLocation", f"{base}/cp")
        .trigger(availableNow=True).foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{base}/out/number={n}")).start()
    )
    run.awaitTermination()
    progress = [p.stateOperators[0].numRowsTotal for p in run.recentProgress if p.stateOperators]
    out = {(r.task_id, r.claims): r for r in spark.read.parquet(f"{base}/out").collect()}
    # The first spells of 1 and 2 are closed; the last claim of 2 came behind the watermark.
    assert (out[1, 1].last_kind, out[1, 1].events) == ("heartbeat", 2) and (out[2, 1].last_kind, out[2, 1].events) == ("heartbeat", 4)
    assert len(out) == 2 and progress[-1] == 2  # only the open spells of 1 and 3 are held
    late = S.drain_late(events, "10 minutes", "late-test").collect()
    assert sorted((r.task_id, r.kind, r.batch) for r in late) == [(2, "claim", 3), (2, "heartbeat", 2)]


def test_claims_survive_staleness(spark, tmp_path):
    spells = S.drain(S.stream_spells(three_files(spark, str(tmp_path)), 90.0), "complete", "spells-test")
    assert spells.count() == 4
    now = F.lit(T0 + dt.timedelta(seconds=7199)).cast("timestamp")
    state = {r.task_id: r for r in S.task_state(spells, now, 90.0).collect()}
    assert (state[1].status, state[1].claims, state[1].spells) == ("running", 2, 2)
    assert state[3].status == "running" and state[2].claims == 2 and state[2].events == 5
    late = {r.task_id: r.status for r in S.task_state(spells, now + F.expr("INTERVAL 1 HOUR"), 90.0).collect()}
    assert late == {1: "stale", 2: "stale", 3: "stale"}


def test_windows_count_every_event(spark, tmp_path):
    folder = str(tmp_path)
    write(spark, folder, "a", [(1, 0, "claim"), (1, 3599, "heartbeat"), (1, 3600, "heartbeat")], 1000)
    events = S.read_events(spark, f"{folder}/in", "*.parquet")
    out = S.drain(S.stream_status(events, "1 hour"), "complete", "status-test")
    assert out.agg(F.sum("n")).first()[0] == 3 and out.count() == 3
