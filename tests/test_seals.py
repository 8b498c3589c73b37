import pytest
from pyspark.sql import functions as F

from corploom.sources import seals, writers
from corploom.sources.readers import read_manifest


def rows(spark, *numbers):
    return spark.createDataFrame([(i, [i, i + 1] if i else None, "x" if i % 2 else None) for i in numbers], "id bigint, ids array<int>, note string")


def test_what_is_refused(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(Exception):
        seals.check_seals(spark, root, "train")
    writers.write_shards(rows(spark, *range(50)).repartition(4), root, split="train")
    seals.write_seals(spark, root, "train")
    seals.check_seals(spark, root, "train")
    changed = rows(spark, *range(49)).unionByName(rows(spark, 49).withColumn("note", F.lit("y")))
    swapped = rows(spark, *range(50)).withColumn("note", F.when(F.col("id") < 2, F.when(F.col("id") == 0, "x")).otherwise(F.col("note")))
    for other, right in (
        (rows(spark, *reversed(range(50))).repartition(3), True),
        (rows(spark, *range(49)), False),
        (rows(spark, *range(50), 7), False),
        (rows(spark, *range(49), 48), False),
        (changed, False),
        (swapped, False),
    ):
        other.write.mode("overwrite").parquet(f"{root}/split=train")
        if right:
            seals.check_seals(spark, root, "train")
        else:
            with pytest.raises(ValueError, match="sealed"):
                seals.check_seals(spark, root, "train")
    writers.write_shards(rows(spark, 1), root, split="val")
    with pytest.raises(ValueError, match="never sealed"):
        seals.check_seals(spark, root, "val")


def test_a_write_by_column_leaves_other_splits_rows(spark, tmp_path):
    root = str(tmp_path)
    writers.write_shards(rows(spark, 1, 2), root, split="train", n_bad=5)
    more = rows(spark, 3).withColumn("split", F.lit("val")).unionByName(rows(spark, 4).withColumn("split", F.lit("test")))
    writers.write_shards(more, root, mode="append")
    found = {r.split: (r.n_samples, r.n_bad) for r in read_manifest(spark, root).collect()}
    assert found == {"train": (2, 5), "val": (1, None), "test": (1, None)}
    writers.write_shards(rows(spark, 5).withColumn("split", F.lit("val")), root, mode="append", n_bad=1)
    found = {r.split: (r.n_samples, r.n_bad) for r in read_manifest(spark, root).collect()}
    assert found == {"train": (2, 5), "val": (2, 1), "test": (1, None)}
