"""Connected components by alternating large and small stars, all in Spark.

Every round hangs a node's neighbours on the least of them; a round's links are
written to the shared folder, which cuts the lineage. The rounds are few (they grow
with the logarithm of the longest path). Nothing is collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.session import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``links (a, b)``; the root is the least node that can
    be reached."""
    now = stage(_down(links), "links")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stage(_down(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(_down(hung.unionByName(least.withColumnRenamed("m", "b"))), "links")
        if (new := _mark(now)) == mark:
            break
        mark = new
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _down(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return down.where("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
