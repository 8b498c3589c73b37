"""Instruction records: pairing, preprocessing functions, templates."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.functions.numbers import int_div

# The prompt template.
INSTRUCTION_HEAD = "### Instruction:\n"
CONTEXT_HEAD = "\n\n### Context:\n"
RESPONSE_HEAD = "\n\n### Response:\n"

TURNS_PER_CHUNK = 1024


def default_template(df: DataFrame) -> DataFrame:
    """``instruction, context, response`` to ``prompt, response``; a blank
    context leaves its section out."""
    blank = F.coalesce(F.trim("context"), F.lit("")) == ""
    head = F.concat(F.lit(INSTRUCTION_HEAD), F.col("instruction"))
    section = F.when(blank, F.lit("")).otherwise(F.concat(F.lit(CONTEXT_HEAD), F.col("context")))
    return df.withColumn("prompt", F.concat(head, section, F.lit(RESPONSE_HEAD))).drop(
        "instruction", "context"
    )


def resolve(path: str) -> Callable:
    """The function a ``module:function`` path names."""
    module, _, name = path.partition(":")
    if not name:
        raise ValueError(f"expected 'module:function', got {path!r}")
    return getattr(importlib.import_module(module), name)


def rowwise(fn: Callable[[dict], dict], schema: str) -> Callable[[DataFrame], DataFrame]:
    """Lift a row-dict function to a DataFrame step, run in Arrow batches."""

    def apply(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                yield pd.DataFrame([fn(r) for r in rows.to_dict("records")])

        return df.mapInPandas(run, schema)

    return apply


def format_instructions(df: DataFrame, preprocessor=default_template, schema: str | None = None) -> DataFrame:
    """Apply a preprocessor: a DataFrame function, its ``module:function``
    path, or, with ``schema``, a function from row dict to row dict."""
    fn = resolve(preprocessor) if isinstance(preprocessor, str) else preprocessor
    return df.transform(rowwise(fn, schema) if schema else fn)


def instruction_rows(turns: DataFrame, chunk: int = TURNS_PER_CHUNK) -> DataFrame:
    """Records from chat turns ``(conv_id, turn, role, text)``: each user turn
    the assistant answers next, with the system text at turn 0 as context.

    Turns pair up on ``(conv_id, turn)``. The context of a conversation goes to
    chunks of at most ``chunk`` turns, one copy each, so a conversation of any
    length spreads over tasks while an ordinary one needs a single copy.
    """
    answers = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    pairs = (
        turns.where("role = 'user'")
        .select("conv_id", "turn", F.col("text").alias("instruction"))
        .join(answers, ["conv_id", "turn"])
        .withColumn("_chunk", int_div("turn", chunk))
    )
    chunks = turns.groupBy("conv_id").agg(int_div(F.max("turn"), chunk).alias("_last"))
    system = (
        turns.where("role = 'system' and turn = 0")
        .select("conv_id", F.col("text").alias("context"))
        .join(chunks, "conv_id")
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")))
        .drop("_last")
    )
    return (
        pairs.join(system, ["conv_id", "_chunk"], "left")
        .withColumn("context", F.coalesce("context", F.lit("")))
        .drop("_chunk")
    )
