"""Recipe and samples to the plan of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.functions.durations import duration_batches, interval_batches
from corploom.operators.batching import (
    assign_batches,
    assign_devices,
    batches_per_epoch,
    eval_subset,
    with_markers,
)
from corploom.operators.ordering import shuffled_rank, with_rank
from corploom.plans.recipe import Recipe

PLAN_COLUMNS = (
    "epoch", "global_batch", "batch", "device", "micro", "pos", "sample_id", "is_eval", "is_save",
)


def epoch_plan(
    samples: DataFrame, recipe: Recipe, rows: int | None = None, key: str = "sample_id"
) -> DataFrame:
    """Epochs repeated until ``max_duration``, each row with its batch.

    ``samples`` is a written table; only its key column is read, and token
    arrays never move.
    """
    ids = samples.select(key)
    rows = ids.count() if rows is None else rows
    per_epoch = batches_per_epoch(rows, recipe.global_batch, recipe.drop_last)
    if per_epoch == 0:
        raise ValueError(f"{rows} samples do not fill one batch of {recipe.global_batch}")
    limit = duration_batches(recipe.max_duration, per_epoch)
    epochs = -(-limit // per_epoch)
    if recipe.shuffle:
        left = F.lit(limit) - F.col("epoch") * per_epoch
        wanted = F.least(left, F.lit(per_epoch)) * recipe.global_batch
        ranked = shuffled_rank(ids, key, recipe.seed, epochs, rows, below=wanted)
    else:
        ranked = with_rank(ids, key, written=True).withColumn(
            "epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
        )
    batched = assign_batches(ranked, recipe.global_batch, recipe.drop_last, rows)
    return batched.withColumn("global_batch", F.col("epoch") * per_epoch + F.col("batch")).where(
        F.col("global_batch") < limit
    )


def training_plan(
    samples: DataFrame, recipe: Recipe, rows: int | None = None, key: str = "sample_id"
) -> DataFrame:
    """Full plan: epoch, batch, device, microbatch and position of every read."""
    rows = samples.select(key).count() if rows is None else rows
    plan = epoch_plan(samples, recipe, rows, key)
    plan = assign_devices(plan, recipe.global_batch, recipe.devices, recipe.micro_size)
    per_epoch = batches_per_epoch(rows, recipe.global_batch, recipe.drop_last)
    evals, saves = (interval_batches(i, per_epoch) for i in (recipe.eval_interval, recipe.save_interval))
    plan = with_markers(plan, evals, saves, recipe.eval_first)
    return plan.withColumnRenamed(key, "sample_id").select(*PLAN_COLUMNS)


def evaluation_plan(
    samples: DataFrame, recipe: Recipe, batch_size: int | None = None, key: str = "sample_id"
) -> DataFrame:
    """Evaluation batches in key order, cut to the configured subset."""
    batch_size = batch_size or recipe.eval_batch or recipe.global_batch
    ids = samples.select(key)
    plan = assign_batches(with_rank(ids, key, written=True), batch_size, recipe.eval_drop_last, ids.count())
    return eval_subset(plan, recipe.eval_subset_batches)


def evaluation_reads(samples: DataFrame, recipe: Recipe, key: str = "sample_id") -> DataFrame:
    """:func:`evaluation_plan` with the device, microbatch and position of every read."""
    plan = evaluation_plan(samples, recipe, key=key)
    plan = assign_devices(plan, recipe.eval_batch or recipe.global_batch, recipe.devices, recipe.micro_size)
    return plan.select("batch", "device", "micro", "pos", F.col(key).alias("sample_id"))
