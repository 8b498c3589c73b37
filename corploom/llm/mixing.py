"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target in words. The target is filled with as many complete
epochs of the source as fit and a part of one more: documents in the order of
exponential keys, ``-ln(u) / weight`` with ``u`` from a seeded hash of the identifier
and ``weight`` the document's quality, are taken up to the budget that is left. The
document at which the budget ends is taken if more than half of it fits, so a
source misses its target by half a document at most.

No source is sorted in one task: keys fall into ``BUCKETS`` ranges, sums per range
decide all ranges but the one where the budget ends, and only that one is sorted.

Null text has size 0; documents of size 0 are in the complete epochs and take
nothing. A null source is a source of its own, the last. A null identifier is hashed
as empty. Repeated rows are documents of their own; of equal keys the smaller
identifier goes first, then the smaller hash of the text. Only the identifier, source
and text are read. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.llm.frames import numbered, pick, restored, text_of
from corploom.session import stage

BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def cleanness(text: Column, size: Column) -> Column:
    """Quality weight in (0, 1]: falls with the share of symbols per word."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.when(size > 0, size / (size + 20 * symbols)).otherwise(F.lit(1.0))


def targets(sizes: DataFrame, weights: tuple[int, ...], most_epochs: int) -> DataFrame:
    """``target`` for ``(source, source_size)``, one row a source: the total shared by weight
    (given in turn, in the order of the sources), none above ``most_epochs`` times its
    size. The table of sources is small; it is ordered in one task."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(w).cast("bigint") for w in weights])
    weighed = sizes.withColumn("weight", turn[(F.row_number().over(by_name) - 1) % len(weights)])
    weighed = weighed.withColumn("cap", most_epochs * F.col("source_size"))
    # sources fill up in the order of cap / weight; the rest share what is left
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levelled = weighed.withColumn("level", level).withColumn("full", F.col("cap") / F.col("weight") <= level)
    final = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(every)["level"]
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * final)
    return levelled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    seed: int = 0,
    weights: tuple[int, ...] = (1, 2, 3),
    most_epochs: int = 3,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``
    (how often the mix has it), ``taken`` (words it takes) and ``text_hash``. Sizes and
    keys are staged without the texts; the caller's job deletes them."""
    source = pick(docs, id=id_col, source=source_col, text=text_col).withColumn("text", text_of())
    sized = source.withColumn("size", n_words(F.col("text"))).withColumn("text_hash", F.xxhash64("text"))
    digits = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digits, 1, 12), 16, 10).cast("bigint") + 0.5) / float(1 << 48)
    keyed = sized.withColumn("key", -F.ln(u) / cleanness(F.col("text"), F.col("size"))).drop("text")
    bucket = F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    rows = stage(keyed.withColumn("bucket", bucket), "mix-keys")

    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("here"))
    goals = targets(sums.groupBy("source").agg(F.sum("here").alias("source_size")), weights, most_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = goals.withColumn("epochs", epochs.cast("bigint"))
    goals = goals.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    below = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.withColumn("before", F.coalesce(F.sum("here").over(below), F.lit(0)))
    ranges = ranges.join(goals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    ranges = ranges.withColumnsRenamed({"source": "of", "bucket": "range"})

    found = rows.join(ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("range")))
    ends_here = (F.col("before") <= F.col("budget")) & (F.col("before") + F.col("here") >= F.col("budget"))
    in_order = Window.partitionBy("source", "bucket").orderBy("key", "id", "text_hash")
    passed = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    last = found.where(ends_here).withColumn("more", 2 * (F.col("before") + passed) + F.col("size") < 2 * F.col("budget"))
    others = found.where(~ends_here).withColumn("more", F.col("before") < F.col("budget"))
    copies = F.col("epochs") + F.col("more").cast("bigint")
    return others.unionByName(last).select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
        "text_hash",
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix has it."""
    plan = mix(docs, id_col=id_col, text_col=text_col, **options)
    # rows alike in identifier and text are taken together
    plan = plan.groupBy(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.sum("copies").alias("_copies")
    )
    mine, names = numbered(docs)
    mine = mine.withColumn("here", F.xxhash64(text_of(names[text_col]))).dropDuplicates([names[id_col], "here"])
    on = F.col(names[id_col]).eqNullSafe(F.col("_id")) & (F.col("here") == F.col("_hash"))
    taken = mine.join(plan.where("_copies > 0"), on)
    return restored(taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))), names)
