"""Seeded shuffles without a sort: each rank's place comes from a keyed permutation.

A Feistel network permutes the numbers of an even count of bits, the least that holds all rows; a place past the last row
is put through again until it is inside, which keeps it a permutation of the rows. A row's place
depends on its rank, the seed and the epoch only, so nothing is exchanged and nothing is
sorted, and one row of an epoch can be found without the others. Ranks are from 0 on without gaps, as
sample numbers are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
MOST_ROWS = 1 << 60
# A prime modulus and two multipliers that mix a half.
MODULUS, FIRST, SECOND = 2147483647, 48271, 69621


def keys(seed: int, epoch: int) -> list[int]:
    """The key of each round."""
    return [int(hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest()[:8], 16) % MODULUS for i in range(ROUNDS)]


def half_bits(rows: int) -> int:
    bits = 1
    while 1 << 2 * bits < rows:
        bits += 1
    return bits


def permuted(numbers: np.ndarray, rows: int, seed: int, epoch: int) -> np.ndarray:
    """Places of ``numbers`` below ``rows``."""
    if not 0 < rows <= MOST_ROWS:
        raise ValueError(f"from 1 to {MOST_ROWS} rows can be permuted")
    if numbers.size and not (0 <= numbers.min() and numbers.max() < rows):
        raise ValueError("a rank is not among those of the rows")
    bits = half_bits(rows)
    mask = (1 << bits) - 1
    out, todo = numbers.astype(np.int64), np.arange(numbers.size)
    while todo.size:
        left, right = out[todo] >> bits, out[todo] & mask
        for key in keys(seed, epoch):
            x = (right * FIRST + key) % MODULUS
            x = (x ^ (x >> 15)) * SECOND % MODULUS
            left, right = right, left ^ ((x ^ (x >> 13)) & mask)
        out[todo] = left << bits | right
        todo = todo[out[todo] >= rows]
    return out


def feistel_epochs(df: DataFrame, rank: str, rows: int, seed: int, epochs: int = 1) -> DataFrame:
    """``df`` once an epoch (from 0) with ``position``, its place there (from 0). ``rank`` numbers the ``rows`` from 0."""

    def place(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ranks, of in batches:
            numbers, which = ranks.to_numpy(), of.to_numpy()
            out = np.empty(numbers.size, np.int64)
            for epoch in np.unique(which).tolist():
                out[which == epoch] = permuted(numbers[which == epoch], rows, seed, epoch)
            yield pa.array(out)

    each = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    return each.withColumn("position", F.arrow_udf(place, "bigint")(F.col(rank).cast("bigint"), F.col("epoch")))
