"""Run metrics from log lines, in batch and as a stream.

A log line is JSON ``{run_id, batch, ts, device, tokens, loss, lr, mem_bytes}``;
any other line is kept as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.functions.numbers import int_div

# The log line.
METRIC_FIELDS = (
    "run_id string, batch bigint, ts timestamp, device int, tokens bigint,"
    " loss double, lr double, mem_bytes bigint"
)
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
BATCHES_PER_BLOCK = 4096


def _fields(lines: DataFrame, line: str) -> DataFrame:
    """The line and its fields. A generator's output is computed once per row,
    where a plain column would be parsed again for every filter on it."""
    parsed = F.from_json(F.col(line), METRIC_FIELDS, {"timestampFormat": TIME_FORMAT})
    return lines.select(F.col(line).alias("_line"), F.inline(F.array(parsed)))


IS_METRIC = "run_id IS NOT NULL AND batch IS NOT NULL"


def parse_metrics(lines: DataFrame, line: str = "line") -> DataFrame:
    """Metric columns of each line; ``text`` holds lines that are no metric."""
    rows = _fields(lines, line).withColumn("_ok", F.expr(IS_METRIC))
    fields = [F.when(F.col("_ok"), F.col(c)).alias(c) for c in rows.columns if c[0] != "_"]
    return rows.select(*fields, F.when(~F.col("_ok"), F.col("_line")).alias("text"))


def metric_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """Metric lines only."""
    return _fields(lines, line).where(IS_METRIC).drop("_line")


def per_batch(metrics: DataFrame) -> DataFrame:
    """Devices folded together: one row per run and batch."""
    return metrics.groupBy("run_id", "batch").agg(
        F.max("ts").alias("ts"),
        F.sum("tokens").alias("tokens"),
        F.max_by("lr", F.struct("ts", "device")).alias("lr"),
        F.max("mem_bytes").alias("peak_bytes"),
    )


def rolling_speed(metrics: DataFrame, window: int = 10, block: int = BATCHES_PER_BLOCK) -> DataFrame:
    """Tokens and batches per second over the last ``window`` batches of the run."""
    return with_speed(per_batch(metrics), window, block).select(
        "run_id", "batch", "ts", "tokens", "tokens_per_sec", "batches_per_sec"
    )


def with_speed(rows: DataFrame, window: int = 10, block: int = BATCHES_PER_BLOCK) -> DataFrame:
    """:func:`rolling_speed` for :func:`per_batch` rows, other columns kept.

    The window spans ``window`` rows and so ``window - 1`` batch durations; the
    rate is null until it is full. A run may hold most of the log, so it is cut
    into blocks of batch numbers, at most ``block`` rows each. The last rows of
    each block are what the next block needs to look back on, however many
    batch numbers are missing in between.
    """
    rows = rows.withColumn("_block", int_div("batch", block))
    back = window - 1
    newest = Window.partitionBy("run_id", "_block").orderBy(F.desc("batch"))
    tails = (
        rows.select("run_id", "_block", "batch", "ts", "tokens")
        .withColumn("_n", F.row_number().over(newest))
        .where(F.col("_n") <= back)
    )
    # among the tails of a run, the rows before a block's first tail are the
    # last rows of the blocks before it
    in_run = Window.partitionBy("run_id").orderBy("batch")
    kept = F.struct("batch", "ts", "tokens")
    lead_in = (
        tails.withColumn("_first", F.lag("_block").over(in_run) != F.col("_block"))
        .withColumn("_before", F.collect_list(kept).over(in_run.rowsBetween(-back, -1)))
        .where("_first")
        .select("run_id", "_block", F.inline("_before"))
        .withColumn("_own", F.lit(False))
    )
    both = rows.withColumn("_own", F.lit(True)).unionByName(lead_in, allowMissingColumns=True)
    w = Window.partitionBy("run_id", "_block").orderBy("batch").rowsBetween(-back, 0)
    span = F.unix_micros("ts") - F.unix_micros("_ts0")
    full = (F.col("_rows") == window) & (span > 0)
    seconds = span / F.lit(1e6)
    return (
        both.withColumns(
            {
                "_rows": F.count("*").over(w),
                "_sum": F.sum("tokens").over(w),
                "_tok0": F.first("tokens").over(w),
                "_ts0": F.first("ts").over(w),
            }
        )
        .where("_own")
        .withColumn("tokens_per_sec", F.when(full, (F.col("_sum") - F.col("_tok0")) / seconds))
        .withColumn("batches_per_sec", F.when(full, F.lit(back) / seconds))
        .drop("_own", "_block", "_rows", "_sum", "_tok0", "_ts0")
    )


def lr_series(metrics: DataFrame) -> DataFrame:
    """Learning rate of each batch of each run, from its latest line."""
    return metrics.groupBy("run_id", "batch").agg(F.max_by("lr", F.struct("ts", "device")).alias("lr"))


def memory_peak(metrics: DataFrame) -> DataFrame:
    """Highest memory use of any device, per run and batch."""
    return metrics.groupBy("run_id", "batch").agg(F.max("mem_bytes").alias("peak_bytes"))


def with_eta(rows: DataFrame, max_batches: int) -> DataFrame:
    """Seconds left at the current batch rate; null until there is a rate."""
    left = F.greatest(F.lit(max_batches) - F.col("batch") - 1, F.lit(0))
    return rows.withColumn("eta_sec", left / F.col("batches_per_sec"))


def eta(metrics: DataFrame, max_batches: int, window: int = 10) -> DataFrame:
    return with_eta(rolling_speed(metrics, window), max_batches)


def run_metrics(metrics: DataFrame, max_batches: int, window: int = 10) -> DataFrame:
    """Rates, time left, learning rate and peak memory of every batch, from one
    aggregate over the log."""
    return with_eta(with_speed(per_batch(metrics), window), max_batches)


def windowed_metrics(metrics: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tumbling event-time totals per run; works on a stream and on a table."""
    return (
        metrics.withWatermark("ts", late)
        .groupBy(F.window("ts", width), "run_id")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("tokens").alias("tokens"),
            F.max("mem_bytes").alias("peak_bytes"),
            F.max("batch").alias("last_batch"),
        )
        .select("run_id", F.col("window.start").alias("window_start"), "n_lines", "tokens", "peak_bytes", "last_batch")
    )
