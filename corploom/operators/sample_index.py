"""Reading fixed-length samples by number from an indexed token table.

The index says for each sample in which document it begins and ends, and where. It comes from
document offsets alone: a task holds documents in order and merges their bounds with the bounds of
samples; only samples that begin in one task's documents and end in another's are joined. Tokens
are read only for the samples that are asked for, each document once however many samples it is in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.operators.packing import _join_pieces

INDEX = "sample_id bigint, first_doc bigint, first_offset bigint, last_doc bigint, last_end bigint"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, starts and ends of each unbroken stretch of the stream."""
    docs, starts, sizes = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
    ends = starts + sizes
    edges = [0, *(np.flatnonzero(starts[1:] != ends[:-1]) + 1).tolist(), len(docs)]
    for lo, hi in zip(edges, edges[1:]):
        if lo < hi:
            yield docs[lo:hi], starts[lo:hi], ends[lo:hi]


def sample_index(indexed: DataFrame, seq_len: int, keep_tail: bool = False) -> DataFrame:
    """``(sample_id, first_doc, first_offset, last_doc, last_end)`` of every sample of ``seq_len`` tokens over
    ``indexed (doc_ord, tok_offset, n_tokens)``: it begins at ``first_offset`` of document ``first_doc`` and ends before
    ``last_end`` of ``last_doc``. The incomplete last sample is left out unless ``keep_tail``. Documents without
    tokens are in no sample."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, starts, ends in _runs(batch):
                # samples that begin here, then those that end here
                firsts = np.arange(-(-starts[0] // seq_len), -(-ends[-1] // seq_len))
                lasts = np.arange(starts[0] // seq_len, ends[-1] // seq_len)
                if keep_tail and ends[-1] % seq_len:  # the stretch may be the end of the stream
                    lasts = np.append(lasts, ends[-1] // seq_len)
                begin = np.searchsorted(ends, firsts * seq_len, side="right")
                stop = np.minimum((lasts + 1) * seq_len, ends[-1])
                end = np.searchsorted(ends, stop, side="left")
                n = firsts.size
                null = np.concatenate([np.zeros(n, bool), np.ones(lasts.size, bool)])
                here = np.concatenate([docs[begin], docs[end]])
                place = np.concatenate([firsts * seq_len - starts[begin], stop - starts[end]])
                columns = [
                    pa.array(np.concatenate([firsts, lasts])),
                    *[pa.array(v, mask=null) for v in (here, place)],
                    *[pa.array(v, mask=~null) for v in (here, place)],
                    pa.array(np.concatenate([firsts, lasts]) * 0 + ends[-1]),
                ]
                table = pa.Table.from_arrays(columns, [*(c.split()[0] for c in INDEX.split(", ")), "upto"])
                # both ends of most samples are here, so a task sends few rows that wait for others
                met = table.group_by("sample_id").aggregate([(c, "max") for c in table.column_names[1:]])
                met = met.rename_columns([c.removesuffix("_max") for c in met.column_names]).select(table.column_names)
                yield from met.combine_chunks().to_batches()

    parts = indexed.select("doc_ord", "tok_offset", "n_tokens").where("n_tokens > 0").mapInArrow(merge, f"{INDEX}, upto bigint")
    whole = F.col("first_doc").isNotNull() & F.col("last_doc").isNotNull()
    full = whole & (F.col("upto") >= (F.col("sample_id") + 1) * seq_len)
    names = [c.split()[0] for c in INDEX.split(", ")]
    waiting = parts.where(~full)
    # a stretch may end in the middle of a sample: what is farthest in the stream is its end
    ends = F.max(F.when(F.col("last_doc").isNotNull(), F.struct("last_doc", "last_end"))).alias("end")
    met = waiting.groupBy("sample_id").agg(F.max("first_doc").alias("first_doc"), F.max("first_offset").alias("first_offset"), ends)
    met = met.where("end is not null").select("sample_id", "first_doc", "first_offset", F.col("end.last_doc").alias("last_doc"), F.col("end.last_end").alias("last_end"))
    return parts.where(full).select(*names).unionByName(met)


def read_samples(indexed: DataFrame, index: DataFrame, seq_len: int, keep_tail: bool = False) -> DataFrame:
    """``(sample_id, tokens)`` of the samples in ``index``, a selection of :func:`sample_index`. Only documents that
    are in one of them are read, and each is sent what is wanted of it."""
    docs = index.select("*", F.explode(F.sequence("first_doc", "last_doc")).alias("doc_ord"))
    wanted = docs.groupBy("doc_ord").agg(F.collect_set("sample_id").alias("wanted"))
    rows = indexed.select("doc_ord", "tok_offset", "tokens").where("size(tokens) > 0").join(wanted, "doc_ord")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, lists, asked = (batch.column(i) for i in range(3))
            for row in range(batch.num_rows):
                start, values = offsets[row].as_py(), lists[row].values
                ids = sorted(asked[row].as_py())
                lows = [max(i * seq_len - start, 0) for i in ids]
                pieces = [values.slice(low, max(0, (i + 1) * seq_len - start - low)) for i, low in zip(ids, lows)]
                sizes = np.cumsum([0, *map(len, pieces)]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(sizes), pa.concat_arrays(pieces).cast(pa.int32()))
                at = pa.array([start + low for low in lows], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), at, tokens], ["sample_id", "at", "tokens"])

    pieces = rows.select("tok_offset", "tokens", "wanted").mapInArrow(cut, "sample_id bigint, at bigint, tokens array<int>")
    return _join_pieces(pieces, seq_len, keep_tail)
