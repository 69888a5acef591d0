"""Progress events of jobs: the same operators on a table and on a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Statuses that end a job (fixed values).
TERMINAL = ("done", "error", "complete", "no_data")
#: Start and width of each step's share of the progress in per cent (fixed values).
BANDS = {"download": (0, 60), "parse": (60, 30), "merge": (91, 0), "dedup": (93, 0), "save": (95, 0), "sync": (98, 0), "done": (100, 0)}


def from_events(events: DataFrame) -> DataFrame:
    """events read as progress: job = user, seq = event number, status by the event's type."""
    status = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "done").otherwise("running")
    return events.select(F.col("user_id").alias("job_id"), F.col("event_id").alias("seq"), "ts", F.col("event_type").alias("step"), F.pmod(F.floor("value"), F.lit(101)).cast("int").alias("pct"), status.alias("status"))


def last_events(progress: DataFrame, n: int = 500) -> DataFrame:
    """The newest n events of each job: the bounded history (the bound is the feature)."""
    w = Window.partitionBy("job_id").orderBy(F.desc("seq"))
    return progress.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def until_terminal(progress: DataFrame) -> DataFrame:
    """Events up to the first terminal one of each job, as a consumer sees them."""
    cut = progress.groupBy("job_id").agg(F.min(F.when(F.col("status").isin(*TERMINAL), F.col("seq"))).alias("__cut"))
    return progress.join(cut, "job_id").where("__cut is null or seq <= __cut").drop("__cut")


def latest_status(progress: DataFrame) -> DataFrame:
    """One row a job with its last event; works on a stream in complete or update mode."""
    return progress.groupBy("job_id").agg(F.max_by(F.struct("step", "pct", "status", "ts"), "seq").alias("m"), F.count(F.lit(1)).alias("events")).select("job_id", "m.*", "events")


def band_percent(step, share):
    """Overall per cent of a step done to share (0-1)."""
    start = F.coalesce(F.get(F.map_values(F.map_filter(_bands(0), lambda k, v: k == step)), F.lit(0)), F.lit(0))
    width = F.coalesce(F.get(F.map_values(F.map_filter(_bands(1), lambda k, v: k == step)), F.lit(0)), F.lit(0))
    return (start + width * F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))).cast("int")


def _bands(i: int):
    return F.create_map(*[F.lit(x) for k, v in BANDS.items() for x in (k, v[i])])


def throughput(progress: DataFrame, total: int) -> DataFrame:
    """Events an hour and the hours left of total, per job, from the first to the last event."""
    g = progress.groupBy("job_id").agg(F.count(F.lit(1)).alias("n"), (F.max(F.unix_timestamp(F.col("ts").cast("timestamp"))) - F.min(F.unix_timestamp(F.col("ts").cast("timestamp")))).alias("s"))
    rate = F.when(F.col("s") > 0, F.round(F.col("n") * 3600.0 / F.col("s"), 4))
    return g.select("job_id", "n", rate.alias("per_hour"), F.when(F.col("s") > 0, F.round((total - F.col("n")) * F.col("s") / (F.col("n") * 3600.0), 4)).alias("hours_left"))


def too_soon(progress: DataFrame, key: str, seconds: float) -> DataFrame:
    """Events that follow the one before with the same key too closely: the audit of a rate limit."""
    w = Window.partitionBy(key).orderBy("ts", "seq")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))
    return progress.withColumn("gap_us", gap).where(F.col("gap_us") < int(seconds * 1_000_000))


def running_counts(progress: DataFrame) -> DataFrame:
    """Counters after each event of a job: total, failed."""
    w = Window.partitionBy("job_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return progress.select("job_id", "seq", F.count(F.lit(1)).over(w).alias("total"), F.sum((F.col("status") == "error").cast("int")).over(w).alias("failed"))


# ---- streams -----------------------------------------------------------------------------------


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """New parquet files of a folder as a stream of progress events."""
    schema = spark.read.parquet(path).schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return from_events(s).withColumn("ts", F.col("ts").cast("timestamp"))


def counts_by_window(stream: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling counts by step with a watermark: windows close when events are late by more than late."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", every), "step").agg(F.count(F.lit(1)).alias("n"), F.max("pct").alias("furthest")).select(F.col("window.start").alias("start"), "step", "n", "furthest")


def terminal_stream(stream: DataFrame, late: str = "2 hours", forget_hours: int = 168) -> DataFrame:
    """Emits each job once, when its first terminal event arrives, with the events counted until then.

    Custom state per job (events so far, ended or not), kept by the state store and thus by the
    streaming checkpoint; a job without events for forget_hours of event time is dropped from state
    (if it comes back after that it counts as new).
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        n, ended = state.get if state.exists else (0, False)
        rows = pd.concat(list(batches)).sort_values("seq")
        for status, seq in zip(rows["status"], rows["seq"]):
            if ended:
                break
            n += 1
            if status in TERMINAL:
                ended = True
                yield pd.DataFrame({"job_id": [key[0]], "end_seq": [seq], "status": [status], "events": [n]})
        state.update((n, ended))
        mark = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(mark + 1, int(rows["ts"].max().timestamp() * 1000)) + forget_hours * 3_600_000)

    return stream.withWatermark("ts", late).groupBy("job_id").applyInPandasWithState(
        step, "job_id long, end_seq long, status string, events long", "events long, ended boolean", "append", GroupStateTimeout.EventTimeTimeout
    )


def run_once(df: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet"):
    """Processes all there is and stops; started again with the same checkpoint it goes on where it was."""
    q = df.writeStream.outputMode(mode).format(fmt).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
