"""Words and word shingles of whole texts as 64-bit hashes, computed on the bytes of a
batch. Words are runs of other than ``[\\x20\\x09-\\x0D]``; with ``lower`` A-Z count as a-z."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 512 << 10
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers_of(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or have.size < n:
        size = max(n + (n >> 2), SLICE_BYTES + (SLICE_BYTES >> 2))
        factors = np.full(size, _U(base))
        factors[0] = 1
        _powers[base] = have = np.cumprod(factors)
    return have[:n]


class Words:
    """Words of some texts: their hashes, byte places, and per text where they begin."""

    def __init__(self, texts: pa.Array, lower: bool):
        n = len(texts)
        texts = texts.cast(pa.string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
        offsets -= offsets[0]
        if lower:
            data = _LOWER[data]
        word = np.zeros(data.size + 1, bool)
        word[:-1] = ~_BLANK[data]
        fresh = np.zeros(data.size + 1, bool)
        fresh[offsets] = True  # a text begins here
        before = np.zeros(data.size + 1, bool)
        before[1:] = word[:-1]
        self.starts = np.flatnonzero(word & (~before | fresh))
        self.ends = np.flatnonzero(before & (~word | fresh))
        if data.size:
            prefix = np.zeros(data.size + 1, _U)
            np.cumsum((data.astype(_U) + _U(1)) * _powers_of(_BASE, data.size), out=prefix[1:])
            sums = (prefix[self.ends] - prefix[self.starts]) * _powers_of(_INVERSE, data.size)[self.starts]
            sizes = (self.ends - self.starts).astype(_U)
            self.hashes = mix(sums ^ mix(sizes))
        else:
            self.hashes = np.empty(0, _U)
        self.data, self.offsets = data, offsets
        self.begins = np.searchsorted(self.starts, offsets)

    def shingles(self, k: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``k`` words in a text, and per text where they begin.
        With ``short`` a text of fewer words has them all as one run."""
        counts = np.diff(self.begins)
        runs = np.maximum(counts - (k - 1), 0)
        if short:
            runs = np.where((counts > 0) & (counts < k), 1, runs)
        begins = np.concatenate([[0], np.cumsum(runs)])
        at = np.repeat(self.begins[:-1] - begins[:-1], runs) + np.arange(begins[-1])
        end = np.repeat(self.begins[1:], runs)
        total = np.zeros(at.size, _U)
        factor = 1
        for i in range(k):
            factor = factor * 0xD1342543DE82EF95 % (1 << 64)
            inside = at + i < end
            if inside.all():
                total += self.hashes[at + i] * _U(factor)
            else:  # a number no word has stands for none
                total += np.where(inside, self.hashes[np.minimum(at + i, self.hashes.size - 1)], _U(0)) * _U(factor)
        return mix(total), begins


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``size`` bytes of text, or one text."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        so_far = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, so_far + size, side="right")))
        yield batch.slice(at, to - at)
        at = to
