"""Missing numbers: null, or not a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(c: str) -> Column:
    """A column as a double; a value that is not a number is null."""
    value = F.col(c).cast("double")
    return F.when(~F.isnan(value), value)
