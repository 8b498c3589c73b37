"""Packing documents into sequences by minimum bin slack.

A document's ids (with its end id) are one piece, or pieces of ``capacity`` ids if
they are more. Bins are filled one after the other: the longest piece left, then
the combination of lengths left that fills the rest of the bin best, found by
subset sums over a bitset, then all of these are taken away.

What a bin's search looks at is how many pieces of each length are left, at most
``capacity`` numbers whatever the corpus, so the driver searches on these counts. A
combination that is best once stays best while its lengths last, so it is taken
as often as the counts allow, which gives a plan of some thousands of patterns
for any number of bins. Pieces then find their own place in Spark: the rank of a
piece among those of its length says which pattern, which bin and which offset.

Null text counts as empty: its end id alone is a piece. Repeated rows are packed
as often as they occur. Only the identifier and the text are read. An empty table
gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corploom.llm.encode import encoder
from corploom.llm.frames import pick, stage_small, text_of


class Pattern(NamedTuple):
    """``repeats`` bins, each with ``copies[length]`` pieces of a length, longest first."""

    copies: dict[int, int]
    repeats: int


def fullest(counts: np.ndarray, room: int) -> dict[int, int]:
    """The lengths (with copies) whose sum is the largest not above ``room``."""
    lengths = [int(x) for x in np.flatnonzero(counts[: room + 1])[::-1] if x]
    reach, steps = 1, []
    keep = (1 << (room + 1)) - 1
    for length in lengths:
        steps.append((length, reach))
        left, some = min(int(counts[length]), room // length), 1
        while left:  # copies in powers of two
            some = min(some, left)
            reach |= (reach << (some * length)) & keep
            left -= some
            some *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        copies = 0
        while not before >> total & 1:
            copies, total = copies + 1, total - length
        if copies:
            chosen[length] = copies
    return chosen


def minimum_slack(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use up ``counts`` pieces of each length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns = []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            left[longest] -= 1  # the seed is not there to be chosen again
            copies = Counter(fullest(left, capacity - longest))
            left[longest] += 1
            copies[longest] += 1
            repeats = min(int(left[length]) // n for length, n in copies.items())
            for length, n in copies.items():
                left[length] -= repeats * n
            patterns.append(Pattern(dict(sorted(copies.items(), reverse=True)), repeats))
    return patterns


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, ids, part, rank)``: the pieces of every
    document; ``rank`` counts pieces of one length within the task's ``part``."""
    source = pick(docs, id=id_col, text=text_col).select("id", text_of().alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    names = ["id", "piece", "start", "length", "ids_crc32", "ids", "part", "rank"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
        for batch in batches:
            for few, ids, edges in codec.batches(batch, 1, end_id):
                rows = []
                for i, (begin, end) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
                    for piece, at in enumerate(range(begin, end, capacity)):
                        own = ids[at : min(end, at + capacity)]
                        length, crc = own.size, zlib.crc32(own.astype("<u4"))
                        rows.append((i, piece, at - begin, length, crc, own.tobytes(), part, seen[length]))
                        seen[length] += 1
                columns = list(zip(*rows)) if rows else [()] * 8
                keys = few.column(0).take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [keys, *(pa.array(c, t) for c, t in zip(columns[1:], types))], names
                )

    return source.mapInArrow(
        cut,
        f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, part int, rank bigint",
    ).withColumnRenamed("id", id_col)


def place(cut: DataFrame, capacity: int) -> DataFrame:
    """``sequence_id`` and ``offset`` for the rows of :func:`pieces`, staged or otherwise
    fixed, since they are read twice."""
    per_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_part.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    # at most ``capacity`` rows
    counts = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    patterns = minimum_slack(counts, capacity)

    # where the ranks of a length pass from one pattern to the next
    taken, first, starts = Counter(), 0, []
    for copies, repeats in patterns:
        offset = 0
        for length, n in copies.items():
            starts.append((length, taken[length], n, first, offset))
            taken[length] += n * repeats
            offset += n * length
        first += repeats
    starts.sort()
    table = np.array(starts, np.int64).reshape(-1, 5)
    span = 1 + max(counts.values(), default=0)
    keys = table[:, 0] * span + table[:, 1]

    def locate(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lengths, ranks in columns:
            length, rank = lengths.to_numpy(), ranks.to_numpy()
            row = table[np.searchsorted(keys, length * span + rank, side="right") - 1]
            bin_, copy = np.divmod(rank - row[:, 1], row[:, 2])
            yield pa.StructArray.from_arrays(
                [pa.array(row[:, 3] + bin_), pa.array(row[:, 4] + copy * length)], ["sequence_id", "offset"]
            )

    where = F.arrow_udf(locate, "sequence_id bigint, offset bigint")
    ranked = cut.join(shifts, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("shift"))
    return ranked.withColumn("place", where("length", "rank")).select(
        *[c for c in cut.columns if c not in ("part", "rank")], "place.sequence_id", "place.offset"
    )


def pack_slack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids`` (little-endian,
    as wide as the vocabulary needs), ``sequence_id`` and ``offset``. The pieces are
    staged; the caller's job deletes them."""
    return place(stage_small(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the sequences themselves. A group is a bin, at
    most ``capacity`` pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.unhex(F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "")).alias("ids"),
    )
