"""Numeric helpers shared by the fractional reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(col: str | Column, digits: int = 0) -> Column:
    """R's `round` (half to even, F11) of a float sum.

    The sum's last bits depend on the order of addition, so it is first
    rounded to 6 decimals; only then is the half-to-even rule applied (T9).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.bround(F.round(c, 6), digits)
