"""Seals: what a split holds, whatever the order of its rows, so that a changed copy is refused.

A row's hash is taken over all its columns, and a seal is the sum of these hashes with their number. Sums do
not depend on order or files, and differ if a row is missing, doubled or changed. Every
shard has its seal beside the split's, which tells where to look.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEALS = "shard string, n_rows bigint, seal string, split string"
NULL, BETWEEN = "\u0000", "\u0001"


def row_hash(columns: list[str]) -> Column:
    """60 bits of an md5 over the columns in the order of their names."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL)) for c in sorted(columns)]
    return F.conv(F.substring(F.md5(F.concat_ws(BETWEEN, *parts)), 1, 15), 16, 10).cast("bigint")


def seals_of(spark: SparkSession, root: str, split: str) -> DataFrame:
    """``(shard, n_rows, seal)`` of every file of a split, as it is now."""
    rows = spark.read.parquet(f"{root}/split={split}")
    hashed = rows.select(F.col("_metadata.file_name").alias("shard"), row_hash(rows.columns).cast("decimal(38,0)").alias("hash"))
    return hashed.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("hash").cast("string").alias("seal"))


def total(seals: DataFrame) -> DataFrame:
    """``(split, n_rows, seal)`` from seals of shards."""
    sums = seals.groupBy("split").agg(F.sum("n_rows").alias("n_rows"), F.sum(F.col("seal").cast("decimal(38,0)")).alias("seal"))
    return sums.select("split", "n_rows", F.col("seal").cast("string").alias("seal"))


def write_seals(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Seal a split: its seals are written beside the manifest. Returns all seals of the root."""
    seals_of(spark, root, split).coalesce(1).write.mode("overwrite").parquet(f"{root}/_seals/split={split}")
    return read_seals(spark, root)


def read_seals(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SEALS).parquet(f"{root}/_seals")


def check_seals(spark: SparkSession, root: str, split: str) -> None:
    """Read a split whole and refuse it if it does not hold what was sealed. Rows that were put in another order or
    in other files are the same."""
    written = read_seals(spark, root).where(F.col("split") == split)
    now = seals_of(spark, root, split).withColumn("split", F.lit(split))
    was, there = (total(s).first() for s in (written, now))
    if was is None:
        raise ValueError(f"split {split!r} of {root} was never sealed")
    if there is None or (there.n_rows, there.seal) != (was.n_rows, was.seal):
        old = written.select("shard", F.struct("n_rows", "seal").alias("old"))
        new = now.select("shard", F.struct("n_rows", "seal").alias("new"))
        other = old.join(new, "shard", "full").where(~F.col("old").eqNullSafe(F.col("new"))).orderBy("shard").limit(5)
        names = [r.shard for r in other.select("shard").collect()]
        raise ValueError(f"split {split!r} holds {there.n_rows if there else 0} rows, not the {was.n_rows} sealed; look at {names}")
