"""Seconds from and to the notations that detectors use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_seconds(c: Column) -> Column:
    """``a-bs`` (its start), ``5``, ``5s``, ``M:SS``, ``H:M:S`` → seconds, at least 0; anything else null."""
    s = F.trim(c)
    num = lambda p, i: F.regexp_extract(s, p, i).try_cast("double")
    span, plain, ms, hms = r"^(\d+(?:\.\d+)?)-(\d+(?:\.\d+)?)s?$", r"^(-?\d+(?:\.\d+)?)s?$", r"^(\d+):(\d+(?:\.\d+)?)$", r"^(\d+):(\d+):(\d+(?:\.\d+)?)$"
    value = (
        F.when(s.rlike(span), num(span, 1))
        .when(s.rlike(plain), num(plain, 1))
        .when(s.rlike(ms), num(ms, 1) * 60 + num(ms, 2))
        .when(s.rlike(hms), num(hms, 1) * 3600 + num(hms, 2) * 60 + num(hms, 3))
    )
    return F.greatest(value, F.when(value.isNotNull(), F.lit(0.0)))


def format_range(start: Column, end: Column) -> Column:
    """``5-6s``."""
    return F.concat(F.floor(start).cast("string"), F.lit("-"), F.floor(end).cast("string"), F.lit("s"))


def format_clock(seconds: Column) -> Column:
    """``M:SS``."""
    whole = F.floor(seconds)
    return F.concat(F.floor(whole / 60).cast("string"), F.lit(":"), F.lpad((whole % 60).cast("string"), 2, "0"))


def key_start(key: Column, or_zero: bool = False) -> Column:
    """The first second of a ``X-Ys`` key: a whole number or null; ``or_zero`` takes fractions down and failures as 0."""
    head = F.split_part(key, F.lit("-"), F.lit(1))
    if or_zero:
        return F.coalesce(F.floor(head.try_cast("double")).cast("int"), F.lit(0))
    return F.when(head.rlike(r"^\d+$"), head.try_cast("int"))


def clamp(c: Column, low: Column | float, high: Column | float) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.least(F.greatest(c, as_col(low)), as_col(high))
