"""Places of rows within groups of any size.

A window over a group would put all of it in one task. Here rows are dealt out by ranges
of the group and the order, written, and counted for each group and partition; what
is before a partition is a running sum over at most one row a partition. A group that
holds most rows lies in many partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corploom.session import stage


def ranked(rows: DataFrame, group: str, order: list[str], label: str, out: str = "idx", size: str = "n") -> DataFrame:
    """``rows`` with their place ``out`` (from 0) in ``group`` by ``order`` (nulls first), and the
    number ``size`` of the group's rows. A null group is a group. Rows that are alike in
    ``order`` stand in any order, so ``order`` has to name whatever tells them apart."""
    tie = F.monotonically_increasing_id()  # spreads rows that are alike over partitions
    dealt = rows.withColumn("_tie", tie).repartitionByRange(group, *order, "_tie").sortWithinPartitions(group, *order, "_tie")
    dealt = dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()).drop("_tie")
    dealt = stage(dealt, label)
    counts = dealt.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_in")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_here")
    )
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "_group",
        "_in",
        (F.coalesce(F.sum("_here").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_here").over(whole).alias(size),
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_in"))
    return dealt.join(counts, same).withColumn(out, F.col("_at") + F.col("_shift")).drop("_group", "_in", "_part", "_at", "_shift")
