"""Packing: the corpus as one token stream, cut every ``seq_len`` tokens.

Documents come to a task in order, a slot at a time, so nearly every sample lies
inside one task and is cut there from the Arrow buffers. Only the pieces at the
two ends of a slot go through a shuffle, where they are joined by sample number.

Cutting is done in Arrow because Spark's ``slice`` copies the whole array for
each piece it takes, which is quadratic for a long document, and because lists
collected per sample would put every token through a second shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.functions.numbers import int_div
from corploom.functions.workers import frugal
from corploom.operators.ordering import placed


def _runs(batch: pa.RecordBatch):
    """(slot, stream position, token values) of each unbroken run of rows; a
    run ends with its slot, if the batch has a third column to tell."""
    starts = batch.column(0).to_numpy()
    lists = batch.column(1)
    slots = batch.column(2).to_numpy() if batch.num_columns > 2 else np.zeros_like(starts)
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    values = lists.flatten().to_numpy()
    if not len(starts):
        return
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    broken = (starts[1:] != starts[:-1] + sizes[:-1]) | (slots[1:] != slots[:-1])
    edges = [0, *(np.flatnonzero(broken) + 1).tolist(), len(starts)]
    for lo, hi in zip(edges, edges[1:]):
        yield int(slots[lo]), int(starts[lo]), values[ends[lo] : ends[hi]]


def _cut(batches: Iterator[pa.RecordBatch], seq_len: int):
    """("whole", first sample, matrix) and ("piece", position, values) in turn."""
    held_slot, held_at, held = 0, 0, np.empty(0, np.int32)
    for batch in batches:
        for slot, at, values in _runs(batch):
            if held.size and (slot, at) == (held_slot, held_at + held.size):
                at, values = held_at, np.concatenate([held, values])
            elif held.size:
                yield "piece", held_at, held
            to_next = -at % seq_len
            if 0 < to_next <= values.size:
                yield "piece", at, values[:to_next]
                at, values = at + to_next, values[to_next:]
            if at % seq_len == 0:
                full = values.size // seq_len
                if full:
                    yield "whole", at // seq_len, values[: full * seq_len].reshape(full, seq_len)
                at, values = at + full * seq_len, values[full * seq_len :]
            held_slot, held_at, held = slot, at, values.copy()
    if held.size:
        yield "piece", held_at, held


SAMPLE = "sample_id bigint, tokens array<int>"
GROUP_SAMPLES = 1 << 40  # more than a group has


def _whole_batch(first: int, rows: np.ndarray) -> pa.RecordBatch:
    n, seq_len = rows.shape
    ends = np.arange(0, (n + 1) * seq_len, seq_len, dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel(), pa.int32()))
    ids = pa.array(np.arange(first, first + n, dtype=np.int64))
    return pa.RecordBatch.from_arrays([ids, lists], ["sample_id", "tokens"])


def _join_pieces(pieces: DataFrame, seq_len: int, keep_tail: bool) -> DataFrame:
    """Samples from ``(sample_id, at, tokens)``; at most ``seq_len`` pieces each."""
    in_order = F.array_sort(F.collect_list(F.struct("at", "tokens")))
    joined = pieces.groupBy("sample_id").agg(F.flatten(in_order["tokens"]).alias("tokens"))
    return joined if keep_tail else joined.where(F.size("tokens") == seq_len)


def pack_in_order(
    df: DataFrame,
    key: str,
    seq_len: int,
    keep_tail: bool = False,
    slots: int | None = None,
    written: bool = False,
    group: str | None = None,
    groups: int = 1,
) -> DataFrame:
    """Samples ``(sample_id, tokens)`` of exactly ``seq_len`` tokens from the
    ``tokens`` of documents in ``key`` order.

    The incomplete last sample is dropped unless ``keep_tail``. The token rows
    are shuffled once and pass through Python once. With ``group`` (numbers below
    ``groups``) each group is packed by itself and goes along as a column.
    """
    docs = placed(df, key, slots=slots, written=written, group=group, groups=groups).where("n_tokens > 0")
    apart = GROUP_SAMPLES * seq_len
    if group:  # positions of different groups never meet in a sample
        docs = docs.withColumns({c: F.col(c) + F.col(group) * apart for c in ("tok_offset", "slot_from", "slot_to")})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, first, rows in _cut(batches, seq_len):
            if kind == "whole":
                yield _whole_batch(first, rows)

    # the sample a slot starts in the middle of, and the one it ends in; they
    # are one and the same where no sample begins inside the slot
    next_start = int_div(F.col("slot_from") + (seq_len - 1), seq_len) * seq_len
    head_to = F.least(next_start, F.col("slot_to"))
    tail_from = F.greatest(int_div("slot_to", seq_len) * seq_len, head_to)
    at, end = F.col("tok_offset"), F.col("tok_offset") + F.col("n_tokens")
    skip = F.greatest(tail_from - at, F.lit(0))
    take = F.greatest(F.least(head_to - at, "n_tokens"), F.lit(0))
    head = F.struct(
        int_div("slot_from", seq_len).alias("sample_id"),
        at.alias("at"),
        F.slice("tokens", F.lit(1), take.cast("int")).alias("tokens"),
    )
    tail = F.struct(
        int_div(tail_from, seq_len).alias("sample_id"),
        (at + skip).alias("at"),
        F.slice("tokens", (skip + 1).cast("int"), F.col("n_tokens")).alias("tokens"),
    )
    at_an_end = docs.where((at < head_to) | (end > tail_from))
    pieces = at_an_end.select(F.inline(F.array(head, tail))).where(F.size("tokens") > 0)
    inner = docs.select("tok_offset", "tokens", "slot_from").mapInArrow(frugal(cut), SAMPLE)
    samples = inner.unionByName(_join_pieces(pieces, seq_len, keep_tail))
    if not group:
        return samples
    return samples.withColumn(group, int_div("sample_id", GROUP_SAMPLES).cast("int")).withColumn(
        "sample_id", F.col("sample_id") % GROUP_SAMPLES
    )


def pack(df: DataFrame, seq_len: int, keep_tail: bool = False) -> DataFrame:
    """:func:`pack_in_order` for rows that already have ``tok_offset`` and
    ``tokens``, wherever they lie: each task cuts the unbroken runs it holds,
    and what is left at their ends is joined."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, first, rows in _cut(batches, seq_len):
            if kind == "whole":
                yield _whole_batch(first, rows)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, at, values in _cut(batches, seq_len):
            if kind == "piece":
                columns = [
                    pa.array([at // seq_len], pa.int64()),
                    pa.array([at], pa.int64()),
                    pa.array([values], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["sample_id", "at", "tokens"])

    stream = df.select("tok_offset", "tokens")
    inner = stream.mapInArrow(frugal(whole), SAMPLE)
    ends = stream.mapInArrow(frugal(pieces), "sample_id bigint, at bigint, tokens array<int>")
    return inner.unionByName(_join_pieces(ends, seq_len, keep_tail))


def concat_order(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """No packing: one raw-text sample per document."""
    return df.where(F.col(text_col).isNotNull()).select(key, F.col(text_col).alias("text"))
