"""Exact deduplication by a content sort.

Rows are range-partitioned and sorted by their normalised bytes, so that equal
texts lie side by side, and neighbours are compared in full. The sort key is the
first letters, a digest, the whole text and the identifier: splitters come from
Spark's bounded sample of the short parts (first letters, digest, identifier), and
because the identifier is among them, a text that a third of all rows share is
cut over many partitions like any other stretch. Runs that go on from one
partition to the next are joined by comparing the texts at the two edges.

Normalising deletes white space (``[\\x20\\x09-\\x0D]``); null counts as empty, so null
and blank texts are equal. Of equal texts the longest stays, of those the
smallest identifier (null last), of those (repeated rows) one row. Only the
identifier and the text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corploom.llm.frames import BLANKS, frugal, numbered, pick, restored, stage_small, text_of

HEAD = 16


def normalised(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers rows and runs of equal neighbours in a sorted partition. The first
    and the last row come a second time, as edges, with their texts."""
    part, row, run, last, end = TaskContext.get().partitionId(), 0, -1, None, None
    for batch in batches:
        runs = []
        for norm in batch.column("norm").to_pylist():
            if run < 0 or norm != last:
                run, last = run + 1, norm
            runs.append(run)
        n = batch.num_rows
        if not n:
            continue
        rows = pa.array(range(row, row + n), pa.int64())
        columns = [
            pa.array([part] * n, pa.int32()),
            rows,
            pa.array(runs, pa.int64()),
            batch.column("id"),
            batch.column("sha"),
            batch.column("chars"),
            batch.column("norm"),
        ]
        out = pa.RecordBatch.from_arrays(columns, ["part", "row", "run", "id", "sha", "chars", "norm"])
        if not row:
            yield _marked(out.slice(0, 1), "first")
        yield _marked(out, None)
        row, end = row + n, out.slice(n - 1, 1)
    if end is not None:
        yield _marked(end, "last")


def _marked(rows: pa.RecordBatch, edge: str | None) -> pa.RecordBatch:
    n = rows.num_rows
    texts = rows.column("norm") if edge else pa.nulls(n, rows.column("norm").type)
    columns = [*rows.columns[:-1], pa.array([edge] * n, pa.string()), texts]
    return pa.RecordBatch.from_arrays(columns, [*rows.schema.names[:-1], "edge", "norm"])


def _origins(edges: DataFrame) -> DataFrame:
    """For each partition whose first run began in an earlier one: the partition
    and run where it began. One row a partition, so the ordering window is small."""
    side = lambda e, c: F.max(F.when(F.col("edge") == e, F.col(c)))
    texts = edges.groupBy("part").agg(
        side("first", "norm").alias("head"), side("last", "norm").alias("tail"), side("last", "run").alias("last_run")
    )
    order = edges.where("edge = 'last'").select("part", F.lag("part").over(Window.orderBy("part")).alias("before"))
    before = texts.select(F.col("part").alias("before"), "tail", F.col("last_run").alias("before_run"))
    linked = (
        order.join(texts.select("part", "head"), "part")
        .join(before, "before", "left")
        .select(
            "part",
            F.when(
                F.coalesce(F.col("head") == F.col("tail"), F.lit(False)),
                # a partition that is one run all through hands its own origin on
                F.when(F.col("before_run") > 0, F.struct(F.col("before").alias("part"), F.col("before_run").alias("run"))),
            )
            .otherwise(F.struct(F.col("part").alias("part"), F.lit(0).cast("bigint").alias("run")))
            .alias("begins"),
        )
    )
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    return linked.select("part", F.last("begins", ignorenulls=True).over(so_far).alias("begins"))


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``
    of the normalised text and ``chars``, the code points of the original. The
    sorted table is staged without its texts; the caller's job deletes it."""
    text = text_of("text")
    keyed = pick(docs, id=id_col, text=text_col).select(
        "id", F.length(text).cast("bigint").alias("chars"), normalised(text).alias("norm")
    )
    keyed = keyed.withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
    keyed = keyed.withColumn("head", F.substring("norm", 1, HEAD))
    ordered = keyed.repartitionByRange("head", "sha", "id").sortWithinPartitions("head", "sha", "norm", "id")
    kind = keyed.schema["id"].dataType.simpleString()
    columns = f"part int, row bigint, run bigint, id {kind}, sha string, chars bigint, edge string, norm string"
    runs = stage_small(ordered.mapInArrow(frugal(_runs), columns), "content-sort")

    origins = _origins(runs.where("edge is not null"))
    rows = runs.where("edge is null").drop("edge", "norm")
    # one row a partition, whatever the number of rows
    rows = rows.join(F.broadcast(origins), "part").select(
        "id",
        "sha",
        "chars",
        F.struct("part", "row").alias("at"),
        F.when(F.col("run") == 0, F.col("begins.part")).otherwise(F.col("part")).alias("run_part"),
        F.when(F.col("run") == 0, F.col("begins.run")).otherwise(F.col("run")).alias("run"),
    )
    best = F.struct((-F.col("chars")).alias("short"), F.col("id").isNull().alias("no_id"), "id", "at")
    groups = rows.groupBy("run_part", "run").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
    return rows.join(groups, ["run_part", "run"]).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("at") == F.col("best.at")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "chars",
    )


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stays = dedup_exact(docs, id_col, text_col).where("kept")
    stays = stays.select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha"), F.col("chars").alias("_chars"))
    mine, names = numbered(docs)
    text, key = text_of(names[text_col]), names[id_col]
    mine = mine.withColumn("sha", F.sha2(normalised(text).cast("binary"), 256))
    on = F.col(key).eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")) & (F.length(text) == F.col("_chars"))
    # repeated rows match alike; the key has them side by side already
    return restored(mine.join(stays, on, "left_semi").dropDuplicates([key, "sha"]), names)
