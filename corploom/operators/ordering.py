"""Global order at scale: running offsets and ranks.

One window over the whole table would put every row in one task. Instead rows
are cut into slots that are consecutive in the wanted order, each slot small
enough for a task. A partial aggregate gives the total per slot, the running
sum of those totals gives each slot's start, and a window inside the slot does
the rest. There are at most ``MAX_SLOTS`` slots, so the table of starts is
small by construction and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.functions.numbers import int_div
from corploom.functions.workers import frugal
from corploom.session import stage

MAX_SLOTS = 1 << 17
DOCS_PER_SLOT = 20_000
TOKENS_PER_SLOT = 1 << 24
KEYS_PER_SLOT = 500_000
KEYS_PER_CUT = 1_000


def slots_for(df: DataFrame, rows: int, per_slot: int, weight: int = 0) -> int:
    """Enough slots to keep each one task-sized, by rows and by ``weight`` (tokens),
    and every core busy."""
    by_size = max(-(-rows // per_slot), -(-weight // TOKENS_PER_SLOT))
    by_cores = min(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // 64))
    return max(1, min(MAX_SLOTS, max(by_size, by_cores)))


def key_cuts(df: DataFrame, key: str, slots: int, rows: int, weight: str | None = None) -> list:
    """Lowest key of every slot but the first; at most ``slots - 1`` values.

    Only the key and weight columns are read. Where to cut decides how even the
    slots are and nothing else, so on a large table some keys are enough to find
    the cuts. With ``weight`` the key range is first cut finer, and neighbouring
    pieces are joined until they weigh a slot. Because the cuts are constants
    afterwards, a recomputed task puts each row in the same slot again.
    """
    if slots == 1:
        return []
    pieces = slots if weight is None else min(MAX_SLOTS, 4 * slots)
    load = F.lit(1) if weight is None else F.col(weight) + 1
    keys = df.select(key, load.alias("_load")).where(F.col(key).isNotNull())
    if rows > pieces * KEYS_PER_CUT:
        keys = keys.sample(pieces * KEYS_PER_CUT / rows, seed=slots)
    ranged = keys.repartitionByRange(pieces, key)
    # at most MAX_SLOTS rows
    found = ranged.groupBy(F.spark_partition_id()).agg(F.min(key).alias("low"), F.sum("_load").alias("load"))
    found = sorted((r.low, r.load) for r in found.collect())
    if weight is None:
        return [low for low, _ in found][1:]
    share, cuts, held = sum(load for _, load in found) / slots, [], 0
    for (_, load), (low, _) in zip(found, found[1:]):
        held += load
        if held >= share:
            cuts.append(low)
            held = 0
    return cuts


def slot_of(key: Column | str, cuts: list) -> Column:
    """Number of the slot a key falls in."""
    if not cuts:
        return F.lit(0)
    edges = np.array(cuts, dtype=object if isinstance(cuts[0], str) else None)

    def locate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            if keys.null_count:
                raise ValueError("the order key must not be null")
            found = np.searchsorted(edges, keys.to_numpy(zero_copy_only=False), side="right")
            yield pa.array(found.astype(np.int32))

    return F.arrow_udf(frugal(locate), "int")(key)


def _starts(
    slotted: DataFrame, sums: dict[str, Column], group=(), total: str | None = None
) -> DataFrame:
    """Per slot: the running total of each sum over the slots before it, the
    slot's own sum as ``<name>_here``, and under the name ``total`` the first
    sum over all slots."""
    totals = slotted.groupBy(*group, "_slot").agg(*[c.alias(n) for n, c in sums.items()])
    w = Window.partitionBy(*group).orderBy("_slot")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *group,
        "_slot",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums],
        *[F.col(n).alias(f"{n}_here") for n in sums],
        *([F.sum(next(iter(sums))).over(Window.partitionBy(*group)).alias(total)] if total else []),
    )


def _checked(key: str, w, value: Column) -> Column:
    """``value``, failing the job if an order key is null or two rows share one,
    however few the rows and slots."""
    same = F.col(key) == F.lag(key).over(w)
    return (
        F.when(F.col(key).isNull(), F.raise_error(F.lit(f"the order key {key} must not be null")))
        .when(same, F.raise_error(F.lit(f"order key {key} is not unique")))
        .otherwise(value)
    )


def in_slots(
    df: DataFrame,
    key: str,
    per_slot: int,
    slots: int | None = None,
    written: bool = False,
    weight: str | None = None,
) -> tuple[DataFrame, int]:
    """``df`` with its slot number, and the number of slots.

    The upstream plan (scan, tokenizer) is evaluated once, when ``df`` is written
    (unless it is a plain read of a ``written`` table); rows are counted and cuts
    taken from the written key and ``weight`` columns, and the slot is computed as
    the table is read back. The caller's job deletes the table.
    """
    staged = df if written else stage(df, "slots")
    sums = staged.agg(F.count("*").alias("rows"), (F.sum(weight) if weight else F.lit(0)).alias("load")).first()
    slots = slots_for(df, sums.rows, per_slot, sums.load or 0) if slots is None else slots
    cuts = key_cuts(staged, key, slots, sums.rows, weight)
    return staged.withColumn("_slot", slot_of(F.col(key), cuts)), len(cuts) + 1


def placed(
    df: DataFrame,
    key: str,
    tokens: str = "tokens",
    slots: int | None = None,
    written: bool = False,
    group: str | None = None,
    groups: int = 1,
) -> DataFrame:
    """:func:`with_offsets`, with the token range of each row's slot as
    ``slot_from`` and ``slot_to``; a task holds whole slots, in ``key`` order. A
    ``written`` table has its ``n_tokens`` already. With ``group``, a column of
    numbers below ``groups``, every group is a stream of its own."""
    if not written:
        df = df.withColumn("n_tokens", F.coalesce(F.size(F.col(tokens)), F.lit(0)))
    staged, n = in_slots(df, key, DOCS_PER_SLOT, slots, written, weight="n_tokens")
    by = (group,) if group else ()
    if group:
        staged = staged.withColumn("_slot", (F.col(group) * n + F.col("_slot")).cast("int"))
    starts = _starts(staged, {"_docs": F.count("*"), "_toks": F.sum("n_tokens")}, by, total="n_docs").drop(*by)
    w = Window.partitionBy("_slot").orderBy(key)
    run = F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    return (
        staged.repartitionById(n * groups, F.col("_slot"))
        .withColumn("_in_slot", _checked(key, w, run.cast("bigint")))
        .withColumn("_row", F.row_number().over(w))
        .join(F.broadcast(starts), "_slot")
        .withColumn("doc_ord", F.col("_docs") + F.col("_row") - 1)
        .withColumn("tok_offset", F.col("_toks") + F.col("_in_slot"))
        .withColumn("slot_from", F.col("_toks"))
        .withColumn("slot_to", F.col("_toks") + F.col("_toks_here"))
        .drop("_slot", "_docs", "_toks", "_docs_here", "_toks_here", "_in_slot", "_row")
    )


def in_scan_order(tokens: DataFrame, label: str = "scanned") -> DataFrame:
    """Offsets in the order in which files are scanned, without a shuffle of tokens.

    ``tokens`` comes from :func:`corploom.sources.readers.scan_order` without a
    shuffle, so a task holds whole blocks of a file with their rows in order and
    counts along each block. The rows are written once; what comes before a block
    is a running sum over one row per block. These sums are broadcast, ``MAX_SLOTS`` blocks
    in a row at a time, each to the files it is about, so tokens stay where they
    are however many blocks there are. Adds ``doc_ord``, ``tok_offset`` and ``n_docs``; rows whose
    ``tokens`` are null are left out and may be read from the written table,
    ``_scanned`` of the result. The caller's job deletes it.
    """
    kinds = tokens.schema.simpleString().removeprefix("struct<").removesuffix(">")
    names = tokens.columns
    at_file, at_block, at_tokens = (names.index(c) for c in ("file_path", "file_block_start", "tokens"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen, docs = None, 0, 0
        for batch in batches:
            sizes = batch.column(at_tokens).value_lengths().fill_null(0).to_numpy()
            there = batch.column(at_tokens).is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            files, starts = batch.column(at_file), batch.column(at_block)
            n = batch.num_rows
            before, rows = np.empty(n, np.int64), np.empty(n, np.int64)
            edges = [0, *(i for i in range(1, n) if starts[i] != starts[i - 1] or files[i] != files[i - 1]), n]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if (files[lo].as_py(), starts[lo].as_py()) != block:
                    block, seen, docs = (files[lo].as_py(), starts[lo].as_py()), 0, 0
                ends, ranks = np.cumsum(sizes[lo:hi]) + seen, np.cumsum(there[lo:hi]) + docs
                before[lo:hi], rows[lo:hi] = ends - sizes[lo:hi], ranks - there[lo:hi]
                seen, docs = int(ends[-1]), int(ranks[-1])
            more = [pa.array(sizes.astype(np.int32)), pa.array(before), pa.array(rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*names, "n_tokens", "_before", "_row"])

    written = stage(tokens.mapInArrow(frugal(count), kinds.replace(":", " ") + ",n_tokens int,_before bigint,_row bigint"), label)
    block = ["file_path", "file_block_start"]
    here = [F.sum("n_tokens").alias("_toks"), F.count("tokens").alias("_docs")]
    sums = written.groupBy(*block).agg(*here)
    order = Window.orderBy(*block)  # one row per block
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *block,
        F.coalesce(F.sum("_toks").over(before), F.lit(0)).alias("_toks"),
        F.coalesce(F.sum("_docs").over(before), F.lit(0)).alias("_docs"),
        F.sum("_docs").over(Window.partitionBy()).alias("n_docs"),
        int_div(F.row_number().over(order) - 1, MAX_SLOTS).alias("_part"),
    )
    starts = stage(starts, f"{label}-starts")
    ends = starts.groupBy("_part").agg(F.min("file_path").alias("low"), F.max("file_path").alias("high")).collect()
    there, placed_rows = written.where("tokens is not null"), None
    for part in sorted(ends, key=lambda r: r["_part"]):
        few = starts.where(F.col("_part") == part["_part"]).drop("_part")
        near = there.where(F.col("file_path").between(part["low"], part["high"])).join(F.broadcast(few), block)
        placed_rows = near if placed_rows is None else placed_rows.unionByName(near)
    if placed_rows is None:
        placed_rows = there.join(starts.drop("_part"), block)
    placed_rows = (
        placed_rows.withColumn("doc_ord", F.col("_docs") + F.col("_row"))
        .withColumn("tok_offset", F.col("_toks") + F.col("_before"))
        .drop("_docs", "_row", "_toks", "_before")
    )
    placed_rows._scanned = written
    return placed_rows


def with_offsets(
    df: DataFrame, key: str, tokens: str = "tokens", slots: int | None = None, written: bool = False
) -> DataFrame:
    """Add ``n_tokens``, the dense document ordinal ``doc_ord``, the running
    token offset ``tok_offset`` in ``key`` order, and ``n_docs``.

    One shuffle of the token rows. Output tasks hold consecutive documents.
    """
    return placed(df, key, tokens, slots, written).drop("slot_from", "slot_to")


def with_rank(
    df: DataFrame, key: str, out: str = "rank", slots: int | None = None, written: bool = False
) -> DataFrame:
    """Dense 0-based rank in ``key`` order; ``written`` as in :func:`in_slots`."""
    staged, n = in_slots(df, key, KEYS_PER_SLOT, slots, written=written)
    starts = _starts(staged, {"_rows": F.count("*")})
    w = Window.partitionBy("_slot").orderBy(key)
    placed = staged.repartitionById(n, F.col("_slot")).withColumn(
        "_row", _checked(key, w, F.row_number().over(w))
    )
    return (
        placed.join(F.broadcast(starts), "_slot")
        .withColumn(out, (F.col("_rows") + F.col("_row") - 1).cast("bigint"))
        .drop("_slot", "_rows", "_rows_here", "_row")
    )


def order_hash(seed: int, epoch: Column, key: Column | str) -> Column:
    """Seeded sort key as 32 hex digits; uniform, and the same whatever the
    partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key.cast("string")))


def shuffled_rank(
    df: DataFrame,
    key: str,
    seed: int,
    epochs: int = 1,
    rows: int | None = None,
    below: Column | None = None,
    slots: int | None = None,
) -> DataFrame:
    """Rank of every row in each epoch's own seeded order.

    Adds ``epoch`` (0-based) and ``rank`` (0-based), ordered by the hash of
    (seed, epoch, key) with the key as tie break. The hash is uniform, so its
    leading 16 bits cut the rows into even slots without looking at the data.
    ``below`` (may use ``epoch``) keeps the ranks under it; slots that start
    past it are left out before the sort.
    """
    if slots is None:
        slots = slots_for(df, rows if rows is not None else df.select(key).count(), KEYS_PER_SLOT)
    slots = max(1, min(slots, 1 << 16))
    digits = order_hash(seed, F.col("epoch"), key)
    lead = F.coalesce(F.conv(F.substring(digits, 1, 4), 16, 10).cast("bigint"), F.lit(0))
    hashed = (
        df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("_h", F.unhex(digits))
        .withColumn("_slot", F.shiftright(lead * slots, 16).cast("int"))
    )
    starts = _starts(hashed.select("epoch", "_slot"), {"_rows": F.count("*")}, group=("epoch",))
    if below is not None:
        starts = starts.where(F.col("_rows") < below)
    if epochs * slots <= MAX_SLOTS:
        starts = F.broadcast(starts)
    w = Window.partitionBy("epoch", "_slot").orderBy("_h", key)
    ranked = (
        hashed.join(starts, ["epoch", "_slot"])
        .withColumn("rank", (F.col("_rows") + F.row_number().over(w) - 1).cast("bigint"))
        .drop("_h", "_slot", "_rows", "_rows_here")
    )
    return ranked if below is None else ranked.where(F.col("rank") < below)


def rank_in_group(
    df: DataFrame, group: str, order: list[str], slot: Column, out: str = "rank"
) -> DataFrame:
    """0-based rank inside each group, for groups too large for one task.

    ``slot`` must not decrease along ``order``; it cuts a group into parts that
    are ranked apart and then shifted by the size of the parts before them.
    """
    slotted = df.withColumn("_slot", slot)
    starts = _starts(slotted.select(group, "_slot"), {"_rows": F.count("*")}, group=(group,))
    w = Window.partitionBy(group, "_slot").orderBy(*order)
    return (
        slotted.withColumn("_row", F.row_number().over(w))
        .join(starts, [group, "_slot"])
        .withColumn(out, (F.col("_rows") + F.col("_row") - 1).cast("bigint"))
        .drop("_slot", "_row", "_rows", "_rows_here")
    )
