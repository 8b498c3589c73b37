"""Durations such as ``30ba`` (batches) and ``2ep`` (epochs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_FORM = r"^(\d+)(ba|ep)$"


def duration_batches(text: str, batches_per_epoch: int) -> int:
    found = re.match(_FORM, text)
    if not found:
        raise ValueError(f"not a duration: {text!r}")
    count = int(found[1])
    return count * batches_per_epoch if found[2] == "ep" else count


def interval_batches(every: int | str, batches_per_epoch: int) -> int:
    """An interval given as batches or as a duration."""
    return every if isinstance(every, int) else duration_batches(every, batches_per_epoch)


def duration_batches_col(text: Column | str, batches_per_epoch: Column | int) -> Column:
    """The same over a column; null where the text is no duration."""
    text = F.col(text) if isinstance(text, str) else text
    per_epoch = F.lit(batches_per_epoch) if isinstance(batches_per_epoch, int) else batches_per_epoch
    count = F.regexp_extract(text, _FORM, 1).try_cast("bigint")
    unit = F.regexp_extract(text, _FORM, 2)
    return F.when(unit == "ep", count * per_epoch).when(unit == "ba", count)
