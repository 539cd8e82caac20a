"""Statistics with a value for empty and short groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0))), F.lit(0.0))


def mean0(c: Column) -> Column:
    return F.coalesce(F.avg(c), F.lit(0.0))


def stdev0(c: Column) -> Column:
    """Sample deviation; 0 below two values."""
    return F.coalesce(F.stddev_samp(c), F.lit(0.0))


def regularity(mean: Column, deviation: Column) -> Column:
    """1 / (1 + coefficient of variation); 0 without a mean."""
    return F.when(mean > 0, 1 / (1 + deviation / mean)).otherwise(0.0)


def count_where(c: Column) -> Column:
    return F.count_if(F.coalesce(c, F.lit(False)))
