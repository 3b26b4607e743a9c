"""Live task state and activity from a stream of claim, heartbeat and end events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindscope.session import scratch

ENDED = ("completed", "failed")


def stream_spells(events: DataFrame, timeout_seconds: float, lateness: str | None = None) -> DataFrame:
    """One row per task and spell: a run of events none of which comes ``timeout_seconds`` or
    more after the one before. Needs event_id, task_id, ts, kind.

    The state is Spark's own session windows, combined before the exchange, so a busy task
    is one row per spell and input partition. With ``lateness`` (append mode) a spell is
    written once the watermark has passed its end, and its state is dropped: ended and stale
    tasks leave nothing behind, and a task that is claimed anew begins another spell. Rows
    behind the watermark are not counted; ``drain_late`` keeps them. Without it (complete
    mode) every spell is kept.
    """
    timed = events.select("event_id", "task_id", F.col("ts").cast("timestamp").alias("ts"), "kind")
    if lateness is not None:
        timed = timed.withWatermark("ts", lateness)
    spell = F.session_window("ts", f"{int(timeout_seconds * 1000)} milliseconds")
    return timed.groupBy("task_id", spell).agg(
        F.max("ts").alias("last_seen"), F.max_by("kind", F.struct("ts", "event_id")).alias("last_kind"),
        F.count_if(F.col("kind") == "claim").alias("claims"), F.count(F.lit(1)).alias("events"),
    ).select("task_id", F.col("session_window.start").alias("started"), "last_seen", "last_kind", "claims", "events")


def task_state(spells: DataFrame, now: Column, timeout_seconds: float) -> DataFrame:
    """State per task from its spells: as its last event says if that ended it, else stale when
    nothing came for ``timeout_seconds`` up to ``now``, else running. Claims and events count
    over all spells, so those before a stale phase remain."""
    last = F.max(F.struct("last_seen", "last_kind")).alias("l")
    out = spells.groupBy("task_id").agg(last, F.sum("claims").alias("claims"), F.sum("events").alias("events"), F.count(F.lit(1)).alias("spells"))
    limit = F.col("l.last_seen") + F.make_dt_interval(secs=F.lit(timeout_seconds))
    status = F.when(F.col("l.last_kind").isin(*ENDED), F.col("l.last_kind")).when(limit <= now, "stale").otherwise("running")
    return out.select("task_id", status.alias("status"), F.col("l.last_seen").alias("last_seen"), "claims", "events", "spells")


def drain_late(events: DataFrame, lateness: str, name: str) -> DataFrame:
    """The rows of a stream older than the latest time of all earlier batches less ``lateness``.
    Every row that a watermark of that lateness drops is among them; some still count, as a
    batch is judged by the watermark of the one before. Each batch stores its latest time, and
    a batch that is run again writes the same folders again."""
    spark = events.sparkSession
    base = scratch(spark, name)
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(f"{base}/marks/number={number}")
        marks = spark.read.parquet(f"{base}/marks").filter(F.col("number") < number)
        floor = marks.agg(F.max("latest") - F.expr(f"INTERVAL {lateness}")).scalar()
        batch.filter(F.col("ts") < floor).write.mode("overwrite").parquet(f"{base}/late/number={number}")

    run = rows.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start()
    run.awaitTermination()
    return spark.read.parquet(f"{base}/late").withColumnRenamed("number", "batch")


def stream_latest(events: DataFrame) -> DataFrame:
    """Latest event and claim count per task with native, partially aggregated state."""
    order = F.struct("ts", "event_id")
    return events.groupBy("task_id").agg(
        F.max_by("kind", order).alias("last_kind"), F.count_if(F.col("kind") == "claim").alias("claims"), F.count(F.lit(1)).alias("events")
    )


def stream_status(events: DataFrame, width: str, slide: str | None = None, lateness: str | None = None) -> DataFrame:
    """Counts per event-time window and kind; ``lateness`` bounds the state of a live run."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if lateness is not None:
        timed = timed.withWatermark("ts", lateness)
    win = F.window("ts", width, slide) if slide else F.window("ts", width)
    return timed.groupBy(win, "kind").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), "kind", "n"
    )


def read_events(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the files in ``folder`` that match ``name``, with the schema of those files."""
    schema = spark.read.option("pathGlobFilter", name).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def drain(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Run a stream over everything available and return what it wrote.

    ``complete`` keeps the last batch only; ``update`` and ``append`` keep every batch with
    its number. Checkpoint and output live in the shared folder.
    """
    spark = stream.sparkSession
    base = scratch(spark, name)

    def keep(batch: DataFrame, number: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(f"{base}/out")
        else:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/out/number={number}")

    run = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).foreachBatch(keep).start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{base}/out")
