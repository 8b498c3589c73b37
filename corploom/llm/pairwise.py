"""Comparing given pairs of texts, one side of which may be in very many pairs.

Pairs are grouped by their pivot, in chunks of ``CHUNK`` partners; the pivot's text goes
to each of its chunks once and the partners' texts stream past it, so a task holds
one prepared pivot and a batch, however many partners it has.

Very many pairs are compared by groups of pivots: a group's texts are held together and each partner of any of them
streams past once, so texts move once for a group and not for a pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.llm.frames import frugal
from corploom.llm.shingles import slices

CHUNK = 200
PARTNERS = 2000  # of a group that meet it in one task


def compare_pairs(pairs: DataFrame, texts: DataFrame, prepare: Callable, compare: Callable, schema: str) -> DataFrame:
    """``schema`` rows from ``compare(pivot, prepared, nodes, prepared)`` for the rows of
    ``pairs (pivot, node)``, with ``prepare(texts)`` giving a list from an Arrow array of texts
    of ``texts (node, text)``."""
    sizes = pairs.groupBy("pivot").agg(F.count("*").alias("_n"))
    chunks = F.ceil(F.col("_n") / CHUNK)
    dealt = pairs.join(sizes, "pivot").select("pivot", F.pmod(F.xxhash64("node"), chunks).alias("chunk"), "node")
    members = dealt.join(texts, "node").select("pivot", "chunk", F.lit(1).alias("side"), "node", "text")
    pivots = dealt.select("pivot", "chunk").distinct().withColumn("node", F.col("pivot"))
    pivots = pivots.join(texts, "node").select("pivot", "chunk", F.lit(0).alias("side"), "node", "text")
    rows = pivots.unionByName(members).repartition("pivot", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head = None, None
        for batch in batches:
            pivots, chunks, sides, nodes = (batch.column(i).to_pylist() for i in range(4))
            prepared = [one for few in slices(batch, 4) for one in prepare(few.column(4))]
            at = 0
            while at < len(nodes):
                if sides[at] == 0:
                    key, head = (pivots[at], chunks[at]), prepared[at]
                    at += 1
                    continue
                to = at
                while to < len(nodes) and sides[to] == 1 and (pivots[to], chunks[to]) == key:
                    to += 1
                if to == at:
                    raise ValueError(f"the text of {pivots[at]} is missing")
                yield from compare(key[0], head, nodes[at:to], prepared[at:to])
                at = to

    return rows.sortWithinPartitions("pivot", "chunk", "side", "node").mapInArrow(frugal(run), schema)


def compare_groups(pairs: DataFrame, groups: DataFrame, texts: DataFrame, prepare: Callable, gather: Callable, compare: Callable, schema: str) -> DataFrame:
    """``schema`` rows from ``compare(gathered, pivots, node, prepared)`` for each node and its pivots of a group, by the rows of
    ``pairs (pivot, node)``; ``groups (pivot, of)`` are to be small enough for a task and ``gather`` takes
    the list of ``(pivot, prepared)`` of one."""
    dealt = pairs.join(groups, "pivot")
    met = dealt.groupBy("of", "node").agg(F.collect_list("pivot").alias("pivots"))
    return compare_met(met, texts, prepare, gather, compare, schema)


def compare_met(met: DataFrame, texts: DataFrame, prepare: Callable, gather: Callable, compare: Callable, schema: str, finish: Callable | None = None) -> DataFrame:
    """:func:`compare_groups` of ``met (of, node, pivots)``. After the last node of a group come the rows of ``finish(gathered)``."""
    sizes = met.groupBy("of").agg(F.ceil(F.count("*") / PARTNERS).alias("_n"))
    met = met.join(sizes, "of").select("of", F.pmod(F.xxhash64("node"), "_n").alias("chunk"), F.lit(1).alias("side"), "node", "pivots")
    heads = met.select("of", "chunk", F.explode("pivots").alias("node")).distinct()
    heads = heads.select("of", "chunk", F.lit(0).alias("side"), "node", F.lit(None).cast("array<bigint>").alias("pivots"))
    rows = heads.unionByName(met).join(texts.select("node", "text"), "node").select("of", "chunk", "side", "node", "pivots", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, heads, gathered = None, [], None
        for batch in batches:
            for few in slices(batch, 5):
                keys = list(zip(*(few.column(i).to_pylist() for i in range(2))))
                sides, nodes, pivots = (few.column(i).to_pylist() for i in range(2, 5))
                for at, one in enumerate(prepare(few.column(5))):
                    if keys[at] != key:
                        if finish and gathered is not None:
                            yield from finish(gathered)
                        key, heads, gathered = keys[at], [], None
                    if not sides[at]:
                        heads.append((nodes[at], one))
                        continue
                    if gathered is None:
                        gathered, heads = gather(heads), []
                    yield from compare(gathered, pivots[at], nodes[at], one)
        if finish and gathered is not None:
            yield from finish(gathered)

    return rows.repartition("of", "chunk").sortWithinPartitions("of", "chunk", "side", "node").mapInArrow(frugal(run), schema)
