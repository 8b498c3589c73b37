"""Python workers that keep no memory of their tasks."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

TRIM_BYTES = 32 << 20
PART_BYTES = 4 << 20


def give_back() -> None:
    """Let the C library return freed memory to the system."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def frugal(work: Callable) -> Callable:
    """``work`` over batches (or arrays) so that the worker, which stays for later tasks, keeps no memory of it: Arrow takes from
    and gives to the C library, which returns what is free every ``TRIM_BYTES`` and at the end."""

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        pa.set_memory_pool(pa.system_memory_pool())
        seen = 0

        def counted() -> Iterator:
            nonlocal seen
            for batch in batches:
                seen += batch.nbytes
                if seen > TRIM_BYTES:
                    give_back()
                    seen = 0
                yield batch

        try:
            yield from work(counted())
        finally:
            give_back()

    return run


def in_slices(rows: pa.Array, size: int = PART_BYTES) -> Iterator[pa.Array]:
    """``rows`` in slices of about ``size`` bytes, by the mean size of a row; one at least."""
    step = max(1, int(size * len(rows) // max(1, rows.nbytes)))
    for at in range(0, max(1, len(rows)), step):
        yield rows.slice(at, step)
