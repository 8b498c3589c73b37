"""Merkle manifest of a dataset by sibling-shift self-joins.

Each row is a leaf, a hash of its fields. In every group (a null one is one) leaves stand by
identifier, and runs of ``arity`` consecutive nodes become their hash, the last run also
where it is shorter, until one node is left, the group's root; the groups' roots in
the order of groups are treated likewise and give the dataset's root. A level of all groups
at once is one equijoin of its nodes with themselves at computed sibling indices (the index
XOR 1 for two in a run, else each slot shifted round the run), after which every node holds its
siblings and those in slot zero emit the parents. Levels are written, each a fraction of the
one before, so nothing is collected and no group meets in one task.

Proofs go down the same levels: a node's proof is its siblings and its parent's proof,
so only the lowest levels have many rows. Folding a leaf with its proof gives the
root, of the dataset as it was if leaf and proof are right.

Hashes are SHA-256, taken over the lowercase hex text of digests. A field is ``-`` if it is
null, else the number of its UTF-8 bytes, ``:`` and the value, so null, empty and very long texts are
told apart and hashed whole. Groups stand in the bytewise order of
their text, the null one first. Rows with the same identifier stand by their leaves; repeated rows
are leaves of their own; a null identifier comes first. Only the named columns are read. An
empty table has no nodes and gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.frames import pick
from corploom.llm.ranks import ranked
from corploom.session import stage

STEP = "struct<left:binary,right:binary>"
PLAN_LEVELS = 6  # of proofs in one job


class Tree(NamedTuple):
    levels: list[DataFrame]
    """``(tree, idx, n, hash, left, right)``: node ``idx`` of ``n`` of a level, and its siblings."""
    roots: DataFrame
    """``(tree, root)``."""


def hex_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def field(column: Column) -> Column:
    """A field as it is hashed."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def _up(idx: Column, arity: int) -> Column:
    """The index a level above, in whole numbers."""
    return ((idx - idx % arity) / arity).cast("bigint") if arity != 2 else F.shiftright(idx, 1)


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes (tree, idx, n, hash)`` with the hashes ``left`` and ``right`` of them in their run."""
    others = nodes.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("hash").alias("_hash"))
    slot, run = F.col("idx") % arity, F.col("idx") - F.col("idx") % arity
    left, right = [], []
    for shift in range(1, arity):
        at = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else run + (slot + shift) % arity
        side = others.withColumnRenamed("_hash", f"_s{shift}")
        nodes = nodes.join(side, (F.col("tree") == F.col("_tree")) & (at == F.col("_idx")), "left").drop("_tree", "_idx")
        turned = slot + shift >= arity  # round the end of the run, so on the left
        found = F.coalesce(F.col(f"_s{shift}"), F.lit(b""))
        left.append(F.when(turned, found).otherwise(F.lit(b"")))
        right.append(F.when(turned, F.lit(b"")).otherwise(found))
    return nodes.select("tree", "idx", "n", "hash", F.concat(*left).alias("left"), F.concat(*right).alias("right"))


def parents(level: DataFrame, arity: int) -> DataFrame:
    """Slot-zero nodes emit the node above; trees of one node are done."""
    up = F.unhex(F.sha2(F.concat(hex_of(F.col("hash")), hex_of(F.col("right"))), 256))
    heads = level.where((F.col("n") > 1) & (F.col("idx") % arity == 0))
    n = _up(F.col("n") + (arity - 1), arity)
    return heads.select("tree", _up(F.col("idx"), arity).alias("idx"), n.alias("n"), up.alias("hash"))


def grow(nodes: DataFrame, arity: int = 2) -> Tree:
    """The trees over ``nodes (tree, idx, n, hash)``: ``n`` nodes of a ``tree``, ``idx`` from 0."""
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    levels = [stage(with_siblings(nodes, arity), "merkle-level")]
    most = levels[0].agg(F.max("n")).first()[0] or 0  # one number: how many levels there are
    while most > 1:
        levels.append(stage(with_siblings(parents(levels[-1], arity), arity), "merkle-level"))
        most = -(-most // arity)
    roots = [level.where("n = 1").select("tree", F.col("hash").alias("root")) for level in levels]
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return Tree(levels, stage(found, "merkle-roots"))


def proofs(tree: Tree, above: DataFrame | None = None, arity: int = 2) -> DataFrame:
    """``(tree, idx, root, proof)`` of every leaf: its tree's root, the siblings of the nodes on the
    way up, and then ``above (tree, proof)``, the proof of the tree's root in a tree over it."""
    none = F.array().cast(f"array<{STEP}>")

    def top(level: DataFrame) -> DataFrame:
        roots = level.where("n = 1").select("tree", "idx", F.col("hash").alias("root"))
        return roots.withColumn("proof", none) if above is None else roots.join(above, "tree")

    found = top(tree.levels[-1])
    for k, level in enumerate(reversed(tree.levels[:-1]), 1):
        step = F.array(F.struct("left", "right"))
        parent = found.select("tree", F.col("idx").alias("_up"), "root", F.col("proof").alias("_proof"))
        inner = level.where("n > 1").withColumn("_up", _up(F.col("idx"), arity)).join(parent, ["tree", "_up"])
        found = inner.select("tree", "idx", "root", F.concat(step, "_proof").alias("proof")).unionByName(top(level))
        if k % PLAN_LEVELS == 0:
            found = stage(found, "merkle-proofs")
    return found


def proof_hash(proof: Column) -> Column:
    """Hash of a proof's siblings from below to the top, left to right, as hex."""
    steps = F.transform(proof, lambda s: F.concat(hex_of(s["left"]), hex_of(s["right"])))
    return F.sha2(F.array_join(steps, ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to, as hex."""
    up = lambda h, s: F.sha2(F.concat(hex_of(s["left"]), h, hex_of(s["right"])), 256)
    return F.aggregate(proof, hex_of(leaf), up)


def manifest(
    docs: DataFrame,
    fields: list[str],
    group: str = "lang",
    id_col: str = "doc_id",
    arity: int = 2,
    claimed: Column | None = None,
) -> DataFrame:
    """One row per document: ``id``, ``leaf``, ``subroot`` (its group's), ``root``, ``proof`` and
    ``claimed``. ``fields`` are hashed in their order. ``claimed``, over columns ``f0``, ``f1``, ...
    (the fields), is a leaf to be checked, by default the document's own. Tables between are
    staged; the caller's job deletes them."""
    named = {f"f{i}": name for i, name in enumerate(fields)}
    source = pick(docs, id=id_col, group=group, **named)
    leaf = leaf_of([F.col(c) for c in named])
    # a name for each group, in the order of groups, also the null one
    tree = F.when(F.col("group").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("group").cast("string")))
    leaves = source.select("id", tree.alias("tree"), leaf.alias("leaf"), (leaf if claimed is None else claimed).alias("claimed"))
    leaves = stage(ranked(leaves, "tree", ["id", "leaf", "claimed"], "merkle-rows"), "merkle-leaves")
    lower = grow(leaves.select("tree", "idx", "n", F.col("leaf").alias("hash")), arity)

    over = lower.roots.select(F.lit("").alias("all"), "tree", "root")
    over = stage(ranked(over, "all", ["tree"], "merkle-groups"), "merkle-groups")
    upper = grow(over.select(F.col("all").alias("tree"), "idx", "n", F.col("root").alias("hash")), arity)
    top = upper.roots.first()  # one hash
    above = over.join(proofs(upper, arity=arity).select("idx", "proof"), "idx").select("tree", "proof")
    found = leaves.join(proofs(lower, stage(above, "merkle-above"), arity), ["tree", "idx"])
    return found.select(
        F.col("id").alias(id_col),
        hex_of(F.col("leaf")).alias("leaf"),
        hex_of(F.col("root")).alias("subroot"),
        hex_of(F.lit(bytes(top["root"]) if top else None)).alias("root"),
        "proof",
        "claimed",
    )
