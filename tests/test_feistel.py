import numpy as np
import pytest

from corploom.operators.feistel import feistel_epochs, permuted


@pytest.mark.parametrize("rows", [*range(1, 70), 255, 256, 257, 1000, 65_537])
def test_a_permutation_for_every_size(rows):
    for seed, epoch in ((0, 0), (17, 3)):
        assert sorted(permuted(np.arange(rows), rows, seed, epoch).tolist()) == list(range(rows))


def test_orders_differ_and_look_random():
    n = 10_000
    orders = [permuted(np.arange(n), n, seed, epoch) for seed, epoch in ((1, 0), (1, 1), (2, 0))]
    for i, a in enumerate(orders):
        assert abs(np.corrcoef(np.arange(n), a)[0, 1]) < 0.05
        assert (a[1:] - a[:-1] == 1).sum() < 20  # neighbours part
        assert all((a == b).sum() < 20 for b in orders[:i])
    large = permuted(np.array([0, 1 << 40, (1 << 50) - 1]), 1 << 50, 3, 0)
    assert len(set(large.tolist())) == 3 and (large < 1 << 50).all()


def test_wrong_ranks_are_refused():
    for numbers, rows in ((np.array([3]), 3), (np.array([-1]), 3), (np.array([0]), 0)):
        with pytest.raises(ValueError):
            permuted(numbers, rows, 0, 0)


def test_no_exchange(spark):
    out = feistel_epochs(spark.range(100, numPartitions=3), "id", 100, 5, 2)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    assert sorted((r.epoch, r.position) for r in rows) == [(e, p) for e in range(2) for p in range(100)]
