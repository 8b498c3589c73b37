"""Near-duplicates by circulant MinHash, banding and exact verification.

A text's set is its distinct shingles of five words (hashed to 64 bits). C-MinHash
needs two permutations only: one shuffles the shingles once, the other, shifted round
by k, gives coordinate k of the signature. Sets that agree in a band of ``ROWS``
coordinates are candidates, and a pair is linked if its full sets have a Jaccard
similarity of 0.75 or more. At that similarity a pair agrees in none of the
``BANDS`` bands with probability 5e-6.

Texts with the same set are one node from the start, so copies cost one row each.
In a bucket of a band, all members are compared with one of them; that links most of
a group of near copies with as many comparisons as it has members. While buckets
have members in different components and comparing them all would take more than
``PAIRS_PER_ROW`` pairs for each, the one with most links so far is compared with the
members of other components, again at one comparison each (``STARS`` times at most).
Then those outside a bucket's largest component are compared with all members of
other components, unless the sizes or a bitmap of the sets already show that they
cannot be similar. So every candidate pair is compared, excluded by an exact bound,
or already connected.

Null and empty texts and texts without words have an empty set and are linked with
nothing. A text of fewer than five words is one shingle. Repeated rows are equal
texts. A null identifier sorts last; a component of nulls only has a null
``component_id``. Only the identifier and the text are read; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.components import components
from corploom.llm.frames import frugal, numbered, pick, restored, stage_small, text_of
from corploom.llm.pairwise import compare_pairs
from corploom.llm.shingles import Words, mix, slices
from corploom.session import stage

WORDS = 5
PERCENT = 75
ROWS, BANDS = 4, 32
BITMAP = 16  # longs
STARS, PAIRS_PER_ROW = 1, 8
_U = np.uint64
_SHUFFLE, _SHIFTED = _U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F)
_SHIFTS = np.arange(ROWS * BANDS, dtype=np.uint64)


def signature(members: np.ndarray) -> np.ndarray:
    """The circulant MinHash of a set of 64-bit members."""
    low = np.full(_SHIFTS.size, ~_U(0))
    first = mix(members ^ _SHUFFLE)
    for at in range(0, first.size, 512):  # stays in the cache
        np.minimum(low, mix((first[at : at + 512, None] - _SHIFTS) ^ _SHIFTED).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T:
        keys = mix(keys * _U(0x9E3779B97F4A7C15) + row)
    return keys.view(np.int64)


def _sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    found, begins = Words(texts, lower=True).shingles(WORDS, short=True)
    return [np.unique(found[a:b]) for a, b in zip(begins.tolist(), begins[1:].tolist())]


def _bitmap(members: np.ndarray) -> np.ndarray:
    words = np.zeros(BITMAP, _U)
    np.bitwise_or.at(words, (members >> _U(58)).astype(np.int64) % BITMAP, _U(1) << (members & _U(63)))
    return words.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    for batch in batches:
        for few in slices(batch, 2):
            sizes, names, bands, maps = [], [], [], []
            for members in _sets(few.column(2)):
                sizes.append(members.size)
                if members.size:
                    names.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(signature(members)))
                    maps.append(_bitmap(members))
                else:
                    names.append(None)
                    bands.append(None)
                    maps.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    few.column(0),
                    few.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(bands, longs),
                    pa.array(maps, longs),
                ],
                ["id", "tie", "n_shingles", "set_id", "bands", "bitmap"],
            )


def _similar(pivot, head, nodes, others) -> Iterator[pa.RecordBatch]:
    linked = []
    for node, members in zip(nodes, others):
        both = np.intersect1d(head, members, assume_unique=True).size
        if 100 * both >= PERCENT * (head.size + members.size - both):
            linked.append(node)
    if linked:
        yield pa.RecordBatch.from_arrays([pa.array([pivot] * len(linked), pa.int64()), pa.array(linked, pa.int64())], ["a", "b"])


def _may_be_similar() -> Column:
    """Exact bounds: similar sets have similar sizes, and each bit in which the bitmaps
    differ stands for a member of one set only."""
    small, large = F.least("l.n", "r.n"), F.greatest("l.n", "r.n")
    apart = sum((F.bit_count(F.col("l.bitmap")[i].bitwiseXOR(F.col("r.bitmap")[i])) for i in range(BITMAP)), F.lit(0))
    # inter >= p * union gives apart <= (1 - p) / (1 + p) * (n + n)
    return (100 * small >= PERCENT * large) & ((100 + PERCENT) * apart <= (100 - PERCENT) * (F.col("l.n") + F.col("r.n")))


def link_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, links)``: ``id, tie, n_shingles, node`` per document (``node`` null for an empty
    set, ``tie`` a hash of the text) and verified links ``a, b`` between nodes that connect all
    that are similar."""
    source = pick(docs, id=id_col, text=text_col).select("id", text_of().alias("text"))
    source = source.withColumn("tie", F.xxhash64("text"))
    kind = source.schema["id"].dataType.simpleString()
    columns = f"id {kind}, tie bigint, n_shingles bigint, set_id binary, bands array<bigint>, bitmap array<bigint>"
    signed = stage_small(source.select("id", "tie", "text").mapInArrow(frugal(_signed), columns), "near-signed")

    sets = signed.where("set_id is not null")
    # numbered once and written, so the numbers stay
    nodes = sets.groupBy("set_id").agg(
        F.min(F.struct("id", "tie")).alias("row"),
        F.first("bands").alias("bands"),
        F.first("bitmap").alias("bitmap"),
        F.first("n_shingles").alias("n"),
    )
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    members = stage(banded.join(buckets.drop("n"), "key").where("node <> pivot"), "near-buckets")
    stars = stage(members.select("pivot", "node").distinct(), "near-pairs")
    texts = stage(_texts(stars, nodes, source), "near-texts")
    links = stage_small(verify(stars, texts), "near-links")

    # what comparing with one member left open; a member compared with all others leaves its bucket
    members = members.select("key", "node")
    for turn in range(STARS + 1):
        open_, rows, most = _open(members, components(links), nodes)
        if not rows:
            break
        last = turn == STARS or most <= PAIRS_PER_ROW * rows
        if last:
            pairs = _rest(open_)
        else:
            ends = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy("a").agg(F.count("*").alias("links"))
            linked = open_.join(ends.withColumnRenamed("a", "node"), "node", "left")
            hub = F.max(F.struct(F.coalesce("links", F.lit(0)).alias("links"), "node")).alias("hub")
            hubs = stage(linked.groupBy("key").agg(hub).select("key", F.col("hub.node").alias("node")), "near-hubs")
            pairs = _around(open_, hubs)
        more = stage_small(verify(stage(pairs, "near-pairs"), texts), "near-links")
        links = links.unionByName(more)
        if last:
            break
        members = stage(members.join(hubs, ["key", "node"], "left_anti"), "near-buckets")
    rows = signed.join(nodes.select("set_id", "node"), "set_id", "left").select("id", "tie", "n_shingles", "node")
    return rows, links


def _open(members: DataFrame, roots: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int, int]:
    """Members of buckets whose members are in different components, with the bucket's
    largest component; how many, and at most how many pairs are to be compared."""
    rooted = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    per_root = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    largest = per_root.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("here"), F.count("*").alias("roots")
    )
    largest = largest.where("roots > 1").select("key", F.col("most.root").alias("largest"), (F.col("here") - F.col("most.n")).alias("outside"))
    sets = nodes.select("node", "n", "bitmap", "bands")
    open_ = stage(rooted.join(largest, "key").join(sets, "node"), "near-open")
    sums = open_.agg(F.count("*").alias("rows"), F.sum("outside").alias("most")).first()
    return open_, sums["rows"], sums["most"] or 0


def _around(open_: DataFrame, hubs: DataFrame) -> DataFrame:
    """Each bucket's hub with its members of other components."""
    left = open_.join(hubs, ["key", "node"]).alias("l")
    on = (F.col("l.key") == F.col("r.key")) & (F.col("l.root") != F.col("r.root")) & _may_be_similar()
    return left.join(open_.alias("r"), on).select(F.col("l.node").alias("pivot"), F.col("r.node").alias("node")).distinct()


def _rest(open_: DataFrame) -> DataFrame:
    """Members outside their bucket's largest component with those of other components;
    a pair that meets in several buckets comes from one of them."""
    left, right = open_.where("root <> largest").alias("l"), open_.alias("r")
    once = (F.col("r.root") == F.col("r.largest")) | (F.col("l.root") < F.col("r.root"))
    here = F.array_min(F.array_intersect("l.bands", "r.bands")) == F.col("l.key")
    on = (F.col("l.key") == F.col("r.key")) & (F.col("l.root") != F.col("r.root")) & once & _may_be_similar() & here
    return left.join(right, on).select(F.col("l.node").alias("pivot"), F.col("r.node").alias("node"))


def _texts(pairs: DataFrame, nodes: DataFrame, source: DataFrame) -> DataFrame:
    """``(node, text)`` of the nodes in ``pairs``, the only texts that are moved."""
    needed = pairs.select("node").unionByName(pairs.select(F.col("pivot").alias("node"))).distinct()
    wanted = needed.join(nodes.select("node", "row"), "node").select("node", F.col("row.id").alias("of"), F.col("row.tie").alias("of_tie"))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("of_tie"))
    return source.join(wanted, same).select("node", "text").dropDuplicates(["node"])


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among ``pairs (pivot, node)``: those whose full sets are similar."""
    return compare_pairs(pairs, texts, _sets, _similar, "a bigint, b bigint")


def dedup_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id`` (the smallest identifier
    that can be reached), ``kept`` (one row of each component) and ``tie``. Intermediate
    tables are staged; the caller's job deletes them."""
    rows, links = link_near(docs, id_col, text_col)
    rooted = rows.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stage(rooted, "near-rooted")
    best = rooted.where("root is not null").groupBy("root").agg(
        F.min("id").alias("component_id"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "tie")).alias("best")
    )
    alone = F.col("root").isNull()
    first = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("tie") == F.col("best.tie"))
    return rooted.join(best, "root", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | F.coalesce(first, F.lit(False))).alias("kept"),
        "tie",
    )


def keep_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows alike in identifier
    and text one."""
    stays = dedup_near(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_id"), F.col("tie").alias("_tie"))
    mine, names = numbered(docs)
    mine = mine.withColumn("tie", F.xxhash64(text_of(names[text_col])))
    on = F.col(names[id_col]).eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    return restored(mine.join(stays, on, "left_semi").dropDuplicates([names[id_col], "tie"]), names)
