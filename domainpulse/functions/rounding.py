"""Deterministic decimal rounding.

Averages of doubles depend on summation order, so a plain ``round`` of an
average can land on either side of a tie depending on partitioning.
Casting to a fixed-scale decimal first makes the result independent of the
order (and equal to the same recipe in other SQL engines).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DEC = "decimal(28,12)"


def round_half_up(col: Column | str, digits: int) -> Column:
    """SQL ``ROUND``: half away from zero, via a decimal(28,12) cast."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast(_DEC), digits).cast("double")


def round_half_even(col: Column | str, digits: int) -> Column:
    """Banker's rounding (as numpy/pandas ``round``), via decimal(28,12)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.bround(c.cast(_DEC), digits).cast("double")
