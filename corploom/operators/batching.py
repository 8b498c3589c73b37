"""From ranks to batches, devices and microbatches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.functions.numbers import int_div


def batches_per_epoch(rows: int, batch_size: int, drop_last: bool) -> int:
    return rows // batch_size if drop_last else -(-rows // batch_size)


def assign_batches(
    df: DataFrame, batch_size: int, drop_last: bool, rows: int | Column, rank: str = "rank"
) -> DataFrame:
    """``batch`` of each 0-based rank; the short last batch goes if ``drop_last``."""
    rows = rows if isinstance(rows, Column) else F.lit(rows).cast("bigint")
    done = df.withColumn("batch", int_div(rank, batch_size))
    if drop_last:
        done = done.where(F.col("batch") < int_div(rows, batch_size))
    return done


def assign_devices(
    df: DataFrame, batch_size: int, devices: int, micro_size: int, rank: str = "rank"
) -> DataFrame:
    """Position in the batch, and the device and microbatch that read it."""
    if not isinstance(micro_size, int):
        raise ValueError("microbatch size must be a number; 'auto' needs the device")
    if batch_size % devices:
        raise ValueError(f"batch size {batch_size} does not divide over {devices} devices")
    per_device = batch_size // devices
    return (
        df.withColumn("pos", (F.col(rank) % batch_size).cast("int"))
        .withColumn("device", int_div("pos", per_device).cast("int"))
        .withColumn("micro", int_div(F.col("pos") % per_device, micro_size).cast("int"))
    )


def with_markers(
    plan: DataFrame, eval_every: int, save_every: int, eval_first: bool = False
) -> DataFrame:
    """Flag the batches after which evaluation and saving happen."""
    done = F.col("global_batch") + 1
    is_eval = done % eval_every == 0
    if eval_first:
        is_eval = is_eval | (F.col("global_batch") == 0)
    return plan.withColumn("is_eval", is_eval).withColumn("is_save", done % save_every == 0)


def eval_subset(plan: DataFrame, n: int) -> DataFrame:
    """First ``n`` batches; -1 keeps all."""
    return plan if n == -1 else plan.where(F.col("batch") < n)


def console_batches(df: DataFrame, every: int, batch: str = "batch") -> DataFrame:
    """Every n-th batch, as the console interval prints."""
    return df.where(F.col(batch) % every == 0)


def _sizes(used: str, padded: str) -> list[Column]:
    return [
        F.count("*").alias("n_rows"),
        F.sum(used).alias("n_tokens"),
        F.sum(padded).alias("n_positions"),
        F.sum(F.col(padded) - F.col(used)).alias("n_padding"),
    ]


def plan_stats(plan: DataFrame, used: str = "n_tokens", padded: str = "n_padded") -> DataFrame:
    """Rows, tokens and padding per batch of a plan with both lengths."""
    return plan.groupBy("epoch", "batch").agg(*_sizes(used, padded))


def run_totals(plan: DataFrame, used: str = "n_tokens", padded: str = "n_padded") -> DataFrame:
    """The same over the whole run, with the share of padding."""
    share = F.col("n_padding") / F.col("n_positions")
    return plan.agg(*_sizes(used, padded)).withColumn("padding_share", share)
