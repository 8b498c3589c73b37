"""Following a run's log: durable file sinks and the rolling metrics stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corploom.session import delete, releasing, stage
from corploom.streaming.metrics import windowed_metrics, with_speed


def follow_to(stream: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append a stream to Parquet; a restart from the checkpoint adds nothing twice."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def follow_windows(
    metrics: DataFrame,
    out: str,
    checkpoint: str,
    width: str = "1 hour",
    late: str = "10 minutes",
    available_now: bool = False,
) -> StreamingQuery:
    """Windows of a followed log, open ones included: each trigger writes the windows
    it changed under its own number, and :func:`read_windows` takes the newest row
    of each. Lines later than ``late`` behind the newest are dropped by the watermark."""

    def step(rows: DataFrame, trigger: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/trigger={trigger}")

    writer = windowed_metrics(metrics, width, late).writeStream.outputMode("update").foreachBatch(step)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_windows(spark: SparkSession, out: str) -> DataFrame:
    """One row per run and window, as of its last change."""
    rows = spark.read.parquet(out)
    values = [c for c in rows.columns if c not in ("run_id", "window_start", "trigger")]
    newest = F.max_by(F.struct(*values), "trigger").alias("v")
    return rows.groupBy("run_id", "window_start").agg(newest).select("run_id", "window_start", "v.*")


def follow_rolling(
    metrics: DataFrame,
    out: str,
    state: str,
    checkpoint: str,
    window: int = 10,
    available_now: bool = False,
    expire: float | None = None,
) -> StreamingQuery:
    """Exact last-``window`` rates over a followed log, each batch once.

    Triggers may cut a batch anywhere: the newest batch of a run stays open, as
    partial sums under ``state``, until a later one arrives or
    :func:`finish_rolling` is called after the stream has ended. Each trigger runs
    the batch operator on the batches it closes and the last ``window - 1`` rows of
    their runs. Lines of a batch that was closed before are kept under
    ``state``-late and change nothing. Output and state are keyed by trigger, so
    one that is run again overwrites its own; of the state only the folder before
    is kept. With ``expire``, a run whose newest line is that many seconds behind
    the newest of all is closed and forgotten.
    """
    keep = window - 1

    def step(rows: DataFrame, trigger: int) -> None:
        spark = rows.sparkSession
        sums = [F.max("ts").alias("ts"), F.sum("tokens").alias("tokens")]
        partial = rows.groupBy("run_id", "batch").agg(*sums)
        closed = None
        if trigger > 0:
            old = spark.read.parquet(f"{state}/trigger={trigger - 1}")
            closed = old.where("not open").drop("open")
            partial = partial.unionByName(old.where("open").drop("open")).groupBy("run_id", "batch").agg(*sums)
        with releasing(spark):
            runs = partial.groupBy("run_id").agg(F.max("batch").alias("_newest"), F.max("ts").alias("_seen"))
            marked = partial.join(runs, "run_id")
            if closed is not None:
                done = closed.groupBy("run_id").agg(F.max("batch").alias("_done"))
                marked = marked.join(done, "run_id", "left")
            else:
                marked = marked.withColumn("_done", F.lit(None).cast("bigint"))
            marked = stage(marked, "follow")
            last = marked.agg(F.max("_seen")).first()[0] if expire is not None else None
            gone = F.lit(False)
            if last is not None:
                gone = F.unix_micros("_seen") < F.unix_micros(F.lit(last)) - int(expire * 1_000_000)
            was = F.coalesce(F.col("batch") <= F.col("_done"), F.lit(False))
            late = marked.where(was).select("run_id", "batch", "ts", "tokens")
            if not late.isEmpty():
                late.write.mode("overwrite").parquet(f"{state}-late/trigger={trigger}")
            is_open = (F.col("batch") == F.col("_newest")) & ~gone
            fresh = marked.where(~was)
            both = fresh.where(~is_open).select("run_id", "batch", "ts", "tokens", gone.alias("_gone"), F.lit(True).alias("_new"))
            if closed is not None:
                both = both.unionByName(closed.select("*", F.lit(False).alias("_gone"), F.lit(False).alias("_new")))
            with_speed(both, window).where("_new").drop("_new", "_gone").write.mode("overwrite").parquet(f"{out}/trigger={trigger}")
            left = both.join(both.where("_gone").select("run_id").distinct(), "run_id", "left_anti")
            if last is not None:  # also runs of which this trigger had nothing
                newest = left.groupBy("run_id").agg(F.max("ts").alias("_ts")).unionByName(
                    fresh.where(is_open).select("run_id", F.col("ts").alias("_ts"))
                )
                alive = newest.where(F.unix_micros("_ts") >= F.unix_micros(F.lit(last)) - int(expire * 1_000_000))
                left = left.join(alive.select("run_id").distinct(), "run_id", "left_semi")
            kept = last_rows(left.drop("_new", "_gone"), keep).withColumn("open", F.lit(False))
            kept = kept.unionByName(fresh.where(is_open).select("run_id", "batch", "ts", "tokens", F.lit(True).alias("open")))
            kept.write.mode("overwrite").parquet(f"{state}/trigger={trigger}")
        delete(spark, f"{state}/trigger={trigger - 2}")

    writer = metrics.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def finish_rolling(spark: SparkSession, out: str, state: str, window: int = 10) -> None:
    """Write the open batches of a stream that has ended, under the number of the next
    trigger: if the stream goes on after all, that trigger writes them anew."""
    rows = spark.read.parquet(state)
    trigger = rows.agg(F.max("trigger")).first()[0]
    if trigger is None:
        return
    now = rows.where(F.col("trigger") == trigger).drop("trigger")
    rates = with_speed(now, window).where("open").drop("open")
    rates.write.mode("overwrite").parquet(f"{out}/trigger={trigger + 1}")


def last_rows(rows: DataFrame, n: int, block: int = 4096) -> DataFrame:
    """Last ``n`` batches of every run: first within blocks of a run, then over
    what the blocks kept, so that no task sorts a whole run."""
    part = F.floor(F.col("batch") / block)
    in_block = Window.partitionBy("run_id", part).orderBy(F.desc("batch"))
    in_run = Window.partitionBy("run_id").orderBy(F.desc("batch"))
    few = rows.withColumn("_n", F.row_number().over(in_block)).where(F.col("_n") <= n)
    return few.withColumn("_n", F.row_number().over(in_run)).where(F.col("_n") <= n).drop("_n")


def stop(query: StreamingQuery) -> None:
    """Stop following; the checkpoint keeps the position."""
    query.stop()
