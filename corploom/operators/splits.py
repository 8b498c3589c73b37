"""Splits by name, by copy and by weight."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.functions.numbers import int_div


def keep_splits(df: DataFrame, *names: str, split_col: str = "split") -> DataFrame:
    return df.where(F.col(split_col).isin(*names))


def keep_subset(df: DataFrame, subset: str, subset_col: str = "subset") -> DataFrame:
    return df.where(F.col(subset_col) == subset)


def split_copy(df: DataFrame, names: list[str]) -> DataFrame:
    """The same rows under every name. Evaluation data then equals training
    data; :func:`split_weighted` keeps them apart."""
    return df.withColumn("split", F.explode(F.array(*[F.lit(n) for n in names])))


def weight_bounds(weights, total: Column | int) -> list[Column]:
    """First rank past each split: cumulative share of ``total``, half up."""
    whole = sum(weights)
    total = total if isinstance(total, Column) else F.lit(total).cast("bigint")
    return [int_div(total * (2 * c) + whole, 2 * whole) for c in accumulate(weights)]


def split_weighted(
    df: DataFrame,
    weights=(949, 50, 1),
    names=("train", "valid", "test"),
    rank: str = "doc_ord",
    total: Column | int | str = "n_docs",
) -> DataFrame:
    """Contiguous split of 0-based ranks in proportion to integer weights."""
    total = F.col(total) if isinstance(total, str) else total
    bounds = weight_bounds(weights, total)
    label = F.lit(names[-1])
    for name, bound in reversed(list(zip(names[:-1], bounds[:-1]))):
        label = F.when(F.col(rank) < bound, F.lit(name)).otherwise(label)
    return df.withColumn("split", label)
