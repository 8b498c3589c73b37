"""Column-only steps on token arrays: end marks, truncation, padding, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.functions.tokenizers import DEFAULT_EOS_TEXT, literal_ids, tokenizer

IGNORE_LABEL = -100  # fixed value: label of positions that carry no loss


def int_array(ids) -> Column:
    return F.array(*[F.lit(int(i)) for i in ids]).cast("array<int>")


def append_eos(
    df: DataFrame,
    tok="words",
    eos_text: str | None = None,
    use_tokenizer_eos: bool = False,
    tokens: str = "tokens",
) -> DataFrame:
    """End every document with an end mark.

    ``eos_text`` is encoded once and its ids appended to every row;
    ``use_tokenizer_eos`` appends the tokenizer's own id. Choose one.
    """
    if bool(eos_text) == bool(use_tokenizer_eos):
        raise ValueError("give either eos_text or use_tokenizer_eos=True")
    chosen = tokenizer(tok)
    ids = [chosen.eos_id] if use_tokenizer_eos else literal_ids(df.sparkSession, eos_text, chosen)
    return df.withColumn(tokens, F.concat(F.col(tokens), int_array(ids)))


def append_eos_text(df: DataFrame, tok="words", eos_text: str = DEFAULT_EOS_TEXT) -> DataFrame:
    return append_eos(df, tok, eos_text=eos_text)


def append_eod(df: DataFrame, tok="words", tokens: str = "tokens") -> DataFrame:
    """End-of-document id, as the indexed dataset wants it."""
    return append_eos(df, tok, use_tokenizer_eos=True, tokens=tokens)


def to_decoder_only(
    df: DataFrame, prompt: str = "prompt_ids", response: str = "response_ids"
) -> DataFrame:
    """One sequence per pair; the prompt part carries no label."""
    hidden = F.array_repeat(F.lit(IGNORE_LABEL), F.size(prompt))
    joined = F.concat(F.col(prompt), F.col(response))
    return (
        df.withColumn("input_ids", joined)
        .withColumn("labels", F.concat(hidden, F.col(response)))
        .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size(prompt) + F.size(response)))
        .drop(prompt, response)
    )


def truncate(df: DataFrame, max_len: int, cols=("input_ids", "labels", "attention_mask")) -> DataFrame:
    """Keep the first ``max_len`` positions of every array."""
    return df.withColumns({c: F.slice(c, 1, max_len) for c in cols if c in df.columns})


def _filled(col: str, length: Column, value: int) -> Column:
    missing = F.greatest(length - F.size(col), F.lit(0))
    return F.concat(F.col(col), F.array_repeat(F.lit(int(value)), missing.cast("int")))


def pad(
    df: DataFrame, max_len: int, pad_id: int, trim: bool = False, batch_cols=("epoch", "batch")
) -> DataFrame:
    """Right-pad to ``max_len``; with ``trim`` only to the longest row of the batch.

    A batch holds at most the configured batch size, so the window is small.
    """
    if not trim:
        return fill(df, F.lit(max_len), pad_id)
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(*batch_cols))
    return fill(df.withColumn("_pad_to", F.least(longest, F.lit(max_len))), F.col("_pad_to"), pad_id).drop("_pad_to")


def fill(df: DataFrame, length: Column, pad_id: int) -> DataFrame:
    """Right-pad every array to ``length``."""
    fills = {"input_ids": pad_id, "labels": IGNORE_LABEL, "attention_mask": 0}
    return df.withColumns({c: _filled(c, length, v) for c, v in fills.items() if c in df.columns})
