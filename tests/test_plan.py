"""Order, batches, devices and epochs against plain Python."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corploom.functions.durations import duration_batches
from corploom.operators import batching, ordering
from corploom.plans.recipe import Recipe
from corploom.plans.training import epoch_plan, evaluation_plan, training_plan


def ids(spark, n):
    return spark.range(n).withColumnRenamed("id", "sample_id").repartition(5)


def sequential_plan(keys, r):
    n, b = len(keys), r.global_batch
    per = n // b if r.drop_last else -(-n // b)
    limit = duration_batches(r.max_duration, per)
    out, batch_no, epoch = [], 0, 0
    while batch_no < limit:
        order = sorted(keys)
        if r.shuffle:
            order.sort(key=lambda k: (hashlib.md5(f"{r.seed}:{epoch}:{k}".encode()).hexdigest(), k))
        for batch in range(per):
            if batch_no == limit:
                break
            for pos, key in enumerate(order[batch * b : (batch + 1) * b]):
                share = b // r.devices
                out.append(
                    (epoch, batch_no, batch, pos // share, pos % share // r.micro_size, pos, key,
                     (batch_no + 1) % r.eval_interval == 0 or (r.eval_first and batch_no == 0),
                     (batch_no + 1) % r.save_interval == 0)
                )
            batch_no += 1
        epoch += 1
    return out


@pytest.mark.parametrize(
    "n, recipe",
    [
        (100, Recipe(global_batch=16, max_duration="2ep", devices=4, micro_size=2)),
        (100, Recipe(global_batch=16, max_duration="2ep", devices=4, micro_size=2, drop_last=False)),
        (100, Recipe(global_batch=16, max_duration="15ba", devices=8, micro_size=1, seed=3, eval_first=True)),
        (64, Recipe(global_batch=16, max_duration="3ba", devices=2, micro_size=3)),
        (50, Recipe(global_batch=8, max_duration="9ba", devices=8, shuffle=False)),
        (1000, Recipe(global_batch=8, max_duration="2ba", devices=8)),
    ],
)
def test_training_plan(spark, n, recipe):
    got = sorted(tuple(r) for r in training_plan(ids(spark, n), recipe).collect())
    assert got == sorted(sequential_plan(range(n), recipe))


def test_every_epoch_is_a_permutation(spark):
    rows = ordering.shuffled_rank(ids(spark, 500), "sample_id", 17, epochs=3, slots=7).collect()
    orders = []
    for e in range(3):
        mine = sorted((r["rank"], r.sample_id) for r in rows if r.epoch == e)
        assert [k for k, _ in mine] == list(range(500))
        orders.append([s for _, s in mine])
        assert sorted(orders[-1]) == list(range(500))
    assert orders[0] != orders[1] != orders[2]


@pytest.mark.parametrize("slots", [1, 3, 100])
def test_slots_do_not_matter(spark, slots):
    rows = ordering.shuffled_rank(ids(spark, 200), "sample_id", 5, epochs=2, slots=slots).collect()
    want = ordering.shuffled_rank(ids(spark, 200), "sample_id", 5, epochs=2).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, want))


def test_device_shares(spark):
    ranked = ordering.with_rank(ids(spark, 192), "sample_id")
    batched = batching.assign_batches(ranked, 48, True, 192)
    rows = batching.assign_devices(batched, 48, 8, 4).collect()
    counts = Counter((r.batch, r.device, r.micro) for r in rows)
    assert set(counts) == {(b, d, m) for b in range(4) for d in range(8) for m in range(2)}
    assert all(c == (4 if k[2] == 0 else 2) for k, c in counts.items())


def test_refused_settings(spark):
    df = ids(spark, 10).withColumn("rank", F.col("sample_id"))
    with pytest.raises(ValueError, match="divide"):
        batching.assign_devices(df, 10, 3, 1)
    with pytest.raises(ValueError, match="auto"):
        batching.assign_devices(df, 8, 4, "auto")
    with pytest.raises(ValueError, match="fill"):
        epoch_plan(ids(spark, 3), Recipe(global_batch=4))
    with pytest.raises(ValueError, match="duration"):
        duration_batches("3tok", 4)


def test_evaluation_batches(spark):
    r = Recipe(drop_last=False, eval_subset_batches=2)
    assert evaluation_plan(ids(spark, 30), r, 8).count() == 16
    assert evaluation_plan(ids(spark, 30), Recipe(drop_last=False), 8).count() == 30


def test_rank_in_a_hot_group(spark):
    """A third of the rows in one group, ranked in parts."""
    rows = spark.range(900).selectExpr("if(id % 3 = 0, 0, id % 30) as g", "900 - id as o")
    got = ordering.rank_in_group(rows, "g", ["o"], F.expr("o div 50")).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r["rank"], r.o))
    for members in by_group.values():
        members.sort()
        assert [k for k, _ in members] == list(range(len(members)))
        assert [o for _, o in members] == sorted(o for _, o in members)


def test_short_run_sorts_few_rows(spark):
    """A run of few batches leaves slots out before the shuffle and sort."""
    plan = epoch_plan(ids(spark, 20000), Recipe(global_batch=8, max_duration="2ba"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Window [row_number") < text.index("BroadcastHashJoin")
    assert plan.count() == 16


def test_tables_of_many_files_are_not_spread(spark, tmp_path):
    from checks.fixtures import spread

    cores = spark.sparkContext.defaultParallelism
    for files in (1, cores):
        spark.range(1000).repartition(files).write.parquet(f"{tmp_path}/{files}")
        read = spark.read.parquet(f"{tmp_path}/{files}")
        plan = spread(read)._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == (files == 1)
        assert spread(read).count() == 1000
