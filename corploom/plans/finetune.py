"""Fine-tuning jobs: instruction records to pairs, samples and a padded plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions.arrays import fill, to_decoder_only, truncate
from corploom.functions.tokenizers import tokenizer, tokens_of
from corploom.operators.instructions import default_template, format_instructions
from corploom.operators.ordering import with_rank
from corploom.plans.recipe import Recipe
from corploom.plans.training import evaluation_reads, training_plan
from corploom.session import stage
from corploom.sources.readers import fix_scan_order, scan_instructions, scan_shards
from corploom.sources.writers import write_pairs


def instructions_to_pairs(
    spark: SparkSession,
    root: str,
    out_root: str,
    splits: tuple[str, ...] = ("train",),
    preprocessor=default_template,
) -> DataFrame:
    """Instruction dataset to raw prompt/response shards."""
    for name in splits:
        pairs = format_instructions(scan_instructions(spark, root, name), preprocessor)
        written = write_pairs(pairs, out_root, split=name)
    return written


def pair_samples(pairs: DataFrame, recipe: Recipe, key: str = "sample_id") -> DataFrame:
    """Tokenized, joined and truncated pairs: the arrays before padding."""
    tok = recipe.tokenizer
    ids = pairs.select(
        F.col(key).alias("sample_id"),
        tokens_of("prompt", tok).alias("prompt_ids"),
        tokens_of("response", tok).alias("response_ids"),
    )
    return truncate(to_decoder_only(ids), recipe.max_seq_len)


def finetune_plan(
    pairs: DataFrame, recipe: Recipe, key: str = "sample_id", pad_id: int | None = None
) -> DataFrame:
    """Plan rows joined to their padded samples.

    Samples are tokenized once; ordering and batching move only their ids, and
    one join brings the arrays to the plan. The samples are staged; the caller's job
    deletes them.
    """
    samples = _measured(pairs, recipe, key)
    return _padded(training_plan(samples, recipe), samples, recipe, pad_id, ("epoch", "batch"))


def finetune_evaluation(
    pairs: DataFrame, recipe: Recipe, key: str = "sample_id", pad_id: int | None = None
) -> DataFrame:
    """Evaluation reads joined to their padded samples; staged as in :func:`finetune_plan`."""
    samples = _measured(pairs, recipe, key)
    return _padded(evaluation_reads(samples, recipe), samples, recipe, pad_id, ("batch",))


def finetune_from_shards(spark: SparkSession, root: str, split: str, recipe: Recipe, evaluation: bool = False) -> DataFrame:
    """The plan over prepared pair shards; pairs without ``sample_id`` are numbered in the
    order of their files."""
    pairs = scan_shards(spark, root, split)
    if "sample_id" not in pairs.columns:
        pairs = with_rank(fix_scan_order(pairs), "ord", "sample_id", written=True).drop("ord")
    return (finetune_evaluation if evaluation else finetune_plan)(pairs, recipe)


def _measured(pairs: DataFrame, recipe: Recipe, key: str) -> DataFrame:
    return stage(pair_samples(pairs, recipe, key).withColumn("n_tokens", F.size("input_ids")), "pair-samples")


def _padded(plan: DataFrame, samples: DataFrame, recipe: Recipe, pad_id: int | None, batch: tuple[str, ...]) -> DataFrame:
    """Arrays joined to the plan once; how far to pad is known from the lengths before."""
    pad_id = tokenizer(recipe.tokenizer).eos_id if pad_id is None else pad_id
    length = F.lit(recipe.max_seq_len)
    if recipe.allow_pad_trimming:
        sizes = plan.join(samples.select("sample_id", "n_tokens"), "sample_id")
        plan = plan.join(sizes.groupBy(*batch).agg(F.max("n_tokens").alias("_pad_to")), list(batch))
        length = F.col("_pad_to")
    padded = fill(plan.join(samples, "sample_id"), length, pad_id)
    return padded.withColumn("n_padded", F.size("input_ids")).drop("_pad_to")
