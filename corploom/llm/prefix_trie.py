"""Prefix trie of conversations, built as burst tries.

A conversation is a string of turn ids, each a hash of the role and the text. A container holds,
under the head of a trie node, what follows the head in every conversation that begins with it.
The root's container holds all conversations. Containers of more than ``LIMIT`` conversations burst:
they are dealt out by the next turn id to containers one turn below, by counts and hashes only, so that a
container never meets in one task. The containers that remain are sorted by their suffixes and
swept once, which gives their nodes. A suffix container holds ``CHUNK`` turns of each conversation; where
two or more still agree at the end of a chunk they are a container of the next round, so
a task holds ``LIMIT * CHUNK`` ids at most however long conversations are. A conversation that shares its
way with no other is a tail and ends there.

Rounds go down first, which says who is in which container, and then up again, which gives the
nodes with what lies below them; each round's table is written. There are as many rounds as turns
that more than ``LIMIT`` conversations have in common, and one for each ``CHUNK`` turns that two have.

Turns stand by their number, nulls first, then by their id. A null or empty role or text is an empty
string; texts are hashed whole. Rows without a conversation id belong to no conversation and
are left out; repeated rows are turns of their own. Only the named columns are read. An empty table
gives the root alone if there are conversations without turns, else nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.frames import pick, stage_small, text_of
from corploom.llm.ranks import ranked
from corploom.session import stage

LIMIT = 1000
CHUNK = 256
DIGITS = 32  # of a turn id, 128 bits of a hash
PIECE = 1 << 16  # identifiers in a row of ends
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint"
END = "node bigint, depth bigint, conv_id bigint"


class Trie(NamedTuple):
    nodes: DataFrame
    """``NODE``: a node is named by its smallest member and its depth."""
    ends: DataFrame
    """``END``: the node at which each conversation ends."""


def turn_id(role: Column, text: Column) -> Column:
    """The same for the same role and text only."""
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGITS)


def turns_of(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, pos, n_turns, id, size)``: each turn's place (from 1), its id and the UTF-8 bytes of its text."""
    source = pick(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv_id is not null")
    source = source.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        turn_id(text_of("role"), text_of("text")).alias("id"),
        F.octet_length(text_of("text")).cast("bigint").alias("size"),
    )
    placed = ranked(source, "conv_id", ["turn", "id"], "turns", out="pos", size="n_turns")
    return placed.select("conv_id", (F.col("pos") + 1).alias("pos"), "n_turns", "id", "size")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``turns`` of conversations rebuilt on others: the first h turns of conversation c - c % 5, then
    its own after its first h, with h = crc32(c) % 9; ``n_turns`` are the new ones. Conversations that
    come to no turns have one row with a null ``pos``."""
    turns = stage(turns, "trie-turns")
    convs = turns.where("pos = 1").select("conv_id", F.col("n_turns").alias("own"))
    head = F.crc32(F.col("conv_id").cast("string")) % 9
    base = F.col("conv_id") - F.col("conv_id") % 5
    convs = convs.select("conv_id", "own", head.alias("head"), base.alias("base"))
    of_base = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = convs.join(of_base, "base", "left").withColumn("taken", F.least("head", F.coalesce("there", F.lit(0))))
    total = F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    convs = stage(convs.select("conv_id", "base", "head", "taken", total.alias("total")), "trie-convs")
    # at most 8 turns of a base go to its few conversations
    first = turns.where("pos <= 8").withColumnRenamed("conv_id", "base").join(convs, "base").where("pos <= head")
    rest = turns.join(convs, "conv_id").where("pos > head").withColumn("pos", F.col("pos") - F.col("head") + F.col("taken"))
    none = convs.where("total = 0").select(
        "conv_id", *[F.lit(None).cast(t).alias(c) for c, t in (("pos", "bigint"), ("id", "string"), ("size", "bigint"))], "total"
    )
    columns = ("conv_id", "pos", "id", "size", "total")
    out = first.select(*columns).unionByName(rest.select(*columns)).unionByName(none.select(*columns))
    return out.withColumnRenamed("total", "n_turns")


def _chunks(turns: DataFrame) -> DataFrame:
    """``(conv_id, chunk, n_turns, ids, sizes)``: ``CHUNK`` turns a row, ids as one string. A conversation whose
    turns end with a chunk has an empty row after it, one without turns an empty row."""
    chunk = F.floor((F.col("pos") - 1) / CHUNK).alias("chunk")
    row = F.array_sort(F.collect_list(F.struct("pos", "id", "size")))
    full = turns.where("pos is not null").groupBy("conv_id", chunk, "n_turns").agg(row.alias("row"))
    full = full.select("conv_id", "chunk", "n_turns", F.array_join(F.col("row")["id"], "").alias("ids"), F.col("row")["size"].alias("sizes"))
    over = turns.where(F.when(F.col("pos").isNull(), True).otherwise((F.col("pos") == F.col("n_turns")) & (F.col("pos") % CHUNK == 0)))
    over = over.select(
        "conv_id",
        F.floor(F.col("n_turns") / CHUNK).alias("chunk"),
        "n_turns",
        F.lit("").alias("ids"),
        F.array().cast("array<bigint>").alias("sizes"),
    )
    return full.unionByName(over)


def _next_key(key: Column, ids: Column) -> Column:
    return F.substring(F.sha2(F.concat(key, ids), 256), 1, DIGITS)


def _containers(members: DataFrame) -> DataFrame:
    """``members`` with the number ``n`` of their container's conversations and the ``first`` of them."""
    counts = members.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("first"))
    # written, so that a container of very many is split in the join
    return members.join(stage(counts, "trie-counts"), "key")


def build(turns: DataFrame, limit: int = LIMIT) -> Trie:
    """The trie over ``turns (conv_id, pos, n_turns, id, size)``. Tables between are staged; the caller's job
    deletes them."""
    turns = stage(turns, "trie-rebuilt")
    chunks = stage_small(_chunks(turns), "trie-chunks")
    members = chunks.where("chunk = 0").select(F.lit("").alias("key"), F.lit(0).cast("bigint").alias("depth"), "conv_id", "n_turns", "ids", "sizes")
    members = _containers(members)
    rounds, tails = [], []
    while True:
        # a burst goes down one turn, a sweep to the end of the chunk
        at = F.col("depth") % CHUNK
        step = F.when(F.col("n") > limit, F.lit(1)).otherwise(CHUNK - at).cast("int")
        now = members.withColumn("step", step).withColumn("way", F.substring("ids", (at * DIGITS + 1).cast("int"), F.col("step") * DIGITS))
        there = F.length("way") == F.col("step") * DIGITS
        now = stage_small(now.withColumn("next", F.when(there, _next_key(F.col("key"), F.col("way")))), "trie-round")
        if now.isEmpty():
            break
        rounds.append(now)
        below = now.where("next is not null").select(
            "conv_id", F.col("next").alias("key"), (F.col("depth") + F.col("step")).alias("depth"), "n_turns", "ids", "sizes"
        )
        below = _containers(below)
        tails.append(below.where("n = 1").select("conv_id", "depth"))
        shared = below.where("n > 1")
        fresh = shared.where(F.col("depth") % CHUNK == 0).drop("ids", "sizes").withColumn("chunk", F.floor(F.col("depth") / CHUNK))
        fresh = fresh.join(chunks.select("conv_id", "chunk", "ids", "sizes"), ["conv_id", "chunk"])
        members = shared.where(F.col("depth") % CHUNK != 0).unionByName(fresh.drop("chunk"))
    spark = turns.sparkSession
    nodes, ends = spark.createDataFrame([], NODE), spark.createDataFrame([], END)
    totals = spark.createDataFrame([], "key string, children bigint, leaves bigint, saved bigint")
    for now in reversed(rounds):
        more, ended, totals = _risen(now, totals.withColumnRenamed("key", "next"), limit)
        nodes, ends = nodes.unionByName(more), ends.unionByName(ended)
    if not rounds:
        return Trie(nodes, ends)
    none = F.lit(None).cast("bigint")
    top = rounds[0].select("key", "first", "n").limit(1).join(totals, "key")
    top = top.select(
        F.col("first").alias("conv_id"),
        F.lit(0).cast("bigint").alias("depth"),
        none.alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        "saved",
    )
    # from where a conversation is alone its nodes are its turns
    alone = tails[0]
    for more in tails[1:]:
        alone = alone.unionByName(more)
    alone = stage(alone, "trie-tails")
    own = turns.drop("id", "size").join(alone, "conv_id").where("pos > depth")
    own = own.select(
        "conv_id",
        F.col("pos").alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
        F.lit(1).cast("bigint").alias("n_convs"),
        (F.col("pos") < F.col("n_turns")).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved"),
    )
    lengths = chunks.where("chunk = 0").select("conv_id", F.col("n_turns").alias("depth"))
    last = alone.select("conv_id").join(lengths, "conv_id").select(F.col("conv_id").alias("node"), "depth", "conv_id")
    return Trie(nodes.unionByName(top).unionByName(own), ends.unionByName(last))


TOTALS = ("children", "leaves", "saved")
ROW = "kind int, key string, conv_id bigint, depth bigint, other bigint, n bigint, children bigint, leaves bigint, saved bigint"


def _risen(now: DataFrame, below: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, ends and totals ``(key, children, leaves, saved)`` of a round's containers from the totals
    ``below (next, ...)`` of the next one's. Whoever goes on and is in none of these is alone from there on."""
    wide, narrow = now.where(F.col("n") > limit), now.where(F.col("n") <= limit)

    # burst: the nodes one turn below, made of counts
    one = F.get(F.col("sizes"), (F.col("depth") % CHUNK).cast("int"))
    parts = wide.where("next is not null").groupBy("key", "next").agg(
        F.min("conv_id").alias("conv_id"),
        F.first(F.col("depth") + 1).alias("depth"),
        F.first("first").alias("other"),
        F.count("*").alias("n"),
        F.first(one).alias("size"),
        F.max("n_turns").alias("n_turns"),
    )
    parts = stage(parts.join(below, "next", "left"), "trie-burst")
    alone = (F.col("n_turns") > F.col("depth")).cast("bigint")
    nodes = parts.select(
        "key",
        "conv_id",
        "depth",
        F.col("other").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.coalesce("children", alone).alias("n_children"),
        F.coalesce("leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
        (F.coalesce("saved", F.lit(0)) + (F.col("n") - 1) * F.col("size")).alias("saved"),
    )
    sums = nodes.groupBy("key").agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    heads = wide.select("key").distinct().join(sums, "key", "left")
    burst_totals = heads.select(
        "key", F.coalesce("children", F.lit(0)).alias("children"), F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved")
    )
    burst_ends = wide.where("next is null").select(F.col("first").alias("node"), "depth", "conv_id")

    # sweep: containers of ``limit`` conversations at most, each in a row of its task
    rows = narrow.join(below, "next", "left").select("key", "depth", "step", "way", "sizes", "conv_id", "n_turns", F.col("next").isNotNull().alias("on"), *TOTALS)
    rows = rows.repartition("key").sortWithinPartitions("key", "way", "conv_id")
    swept = stage_small(rows.mapInArrow(_sweep, ROW), "trie-swept")
    swept_nodes = swept.where("kind = 0").select(
        "conv_id", "depth", F.col("other").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), "saved",
    )
    swept_ends = swept.where("kind = 1").select(F.col("conv_id").alias("node"), "depth", F.col("other").alias("conv_id"))
    totals = burst_totals.unionByName(swept.where("kind = 2").select("key", *TOTALS))
    return nodes.drop("key").unionByName(swept_nodes), burst_ends.unionByName(swept_ends), totals


class _Node:
    __slots__ = ("conv", "depth", "n", "size", "ended", "kids", "children", "leaves", "saved")

    def __init__(self, conv: int, depth: int, size: int):
        self.conv, self.depth, self.size = conv, depth, size
        self.n, self.children, self.leaves, self.saved = 0, 0, 0, 0
        self.ended: list[int] = []
        self.kids: list[tuple] = []


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes (kind 0), ends (1) and the head's totals (2) of containers, whose rows are sorted."""
    key, before, open_, out = None, "", [], []

    def close() -> None:
        node = open_.pop()
        if not node.leaves:
            node.leaves = 1
        out.extend((0, None, kid[0], node.depth + 1, node.conv, *kid[1:]) for kid in node.kids)
        out.extend((1, None, node.conv, node.depth, conv, None, None, None, None) for conv in node.ended)
        if open_:
            up = open_[-1]
            saved = node.saved + (node.n - 1) * node.size
            up.kids.append((node.conv, node.n, node.children, node.leaves, saved))
            up.conv, up.n = min(up.conv, node.conv), up.n + node.n
            up.children, up.leaves, up.saved = up.children + 1, up.leaves + node.leaves, up.saved + saved
        else:
            out.append((2, key, None, None, None, None, node.children, node.leaves, node.saved))

    for batch in batches:
        columns = (column.to_pylist() for column in batch.columns)
        for name, depth, step, way, sizes, conv, n_turns, goes_on, *given in zip(*columns):
            if name != key:
                while open_:
                    close()
                key, before = name, ""
                open_.append(_Node(conv, depth, 0))
            length = len(way) // DIGITS
            same = 0
            while same < length and way[same * DIGITS : (same + 1) * DIGITS] == before[same * DIGITS : (same + 1) * DIGITS]:
                same += 1
            while len(open_) > same + 1:
                close()
            for i in range(same, length):
                open_.append(_Node(conv, depth + i + 1, sizes[depth % CHUNK + i]))
            before, last = way, open_[-1]
            last.n, last.conv = last.n + 1, min(last.conv, conv)
            if not goes_on:
                last.ended.append(conv)
            elif given[0] is None:  # nobody else goes on here
                last.children, last.leaves = int(n_turns > depth + step), 1
            else:
                last.children, last.leaves, last.saved = given
        if len(out) > 1 << 14:
            yield _rows(out)
            out.clear()
    while open_:
        close()
    if out:
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in ROW.split(", ")))
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*out), types)], list(names))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(node, depth, first, text)``: sorted identifiers of a node, comma-joined, up to ``PIECE`` a row."""
    at, held, out = None, [], []

    def row() -> tuple:
        return (*at, held[0], ",".join(map(str, held)))

    for batch in batches:
        for node, depth, conv in zip(*(column.to_pylist() for column in batch.columns)):
            if (node, depth) != at or len(held) == PIECE:
                if held:
                    out.append(row())
                at, held = (node, depth), []
            held.append(conv)
        if out:
            yield _batch(out)
            out = []
    if held:
        yield _batch([row()])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["node", "depth", "first", "text"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order."""
    at, digest, out = None, None, []

    def rows() -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["conv_id", "depth", "ends_sha256"])

    for batch in batches:
        nodes, depths, texts = (batch.column(i).to_pylist() for i in (0, 1, 3))
        for node, depth, text in zip(nodes, depths, texts):
            if (node, depth) != at:
                if at is not None:
                    out.append((*at, digest.hexdigest()))
                at, digest = (node, depth), hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if out:
            yield rows()
            out = []
    if at is not None:
        out.append((*at, digest.hexdigest()))
        yield rows()


def ends_hash(ends: DataFrame) -> DataFrame:
    """``(conv_id, depth, ends_sha256)`` of the nodes at which conversations end: the hash of their identifiers,
    ascending and comma-joined. They are sorted and joined in ranges, so a node's last step has a row
    for ``PIECE`` of them, hashed as they pass."""
    keys = ["node", "depth", "conv_id"]
    dealt = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    pieces = dealt.mapInArrow(_pieces, "node bigint, depth bigint, first bigint, text string")
    met = pieces.repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return met.mapInArrow(_digests, "conv_id bigint, depth bigint, ends_sha256 string")


def with_ends(trie: Trie) -> DataFrame:
    """The nodes, each with the hash of the conversations that end there."""
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    hashed = trie.nodes.join(ends_hash(trie.ends), ["conv_id", "depth"], "left")
    return hashed.withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node of the trie of conversations as they are, with ``ends_sha256``."""
    return with_ends(build(turns_of(rows, conv_col, turn_col, role_col, text_col)))
