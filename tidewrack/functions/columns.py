"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(c: Column) -> Column:
    """The value where it is neither null nor NaN, else null."""
    return F.when(~F.isnan(c), c)


def in_range(c: Column, low: float, high: float) -> Column:
    """The value where it lies on its scale; null, NaN and values off the scale count as missing."""
    v = usable(c)
    return F.when((v >= F.lit(low)) & (v <= F.lit(high)), v)
