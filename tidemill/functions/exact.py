"""Sums of doubles that do not depend on the order of rows.

A double is cut at fixed places into whole numbers: its integer part and two times 53 bits of its fraction. Their sums
are exact, so any plan that adds the same rows gets the same bits. What lies below 2**-106 is cut off, row by row.
Defined for finite values below 1e38 / rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP = float(1 << 53)


def _toward_zero(x: Column) -> Column:
    return F.when(x < 0, F.ceil(x).cast("double")).otherwise(F.floor(x).cast("double"))


def cut(x: Column) -> list[Column]:
    """The three whole numbers of ``x``, NULL for a missing or non-finite value."""
    x = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
    # From 2**53 on there is no fraction, and floor would not fit a long for ever.
    whole = F.when(F.abs(x) < _STEP, _toward_zero(x)).otherwise(x)
    rest = (x - whole) * _STEP
    upper = _toward_zero(rest)
    lower = _toward_zero((rest - upper) * _STEP)
    return [whole.cast("decimal(38,0)"), upper.cast("decimal(18,0)"), lower.cast("decimal(18,0)")]


def joined(sums: Sequence[Column]) -> Column:
    """The double of three exact sums."""
    whole, upper, lower = (s.cast("double") for s in sums)
    return whole + (upper + lower / _STEP) / _STEP
