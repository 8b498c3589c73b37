"""Integer arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column | str, b: Column | int) -> Column:
    """Integral division, without the detour over doubles."""
    a = F.col(a) if isinstance(a, str) else a
    b = b if isinstance(b, Column) else F.lit(b)
    return F.call_function("div", a, b)
