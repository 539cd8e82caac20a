"""Rule tables that turn a number into a class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_threshold(c: Column, steps: list[tuple[float, str]], otherwise: str, inclusive: bool = False) -> Column:
    """The class of the first threshold that ``c`` is over (``inclusive``: or at), from the top down."""
    out = None
    for limit, name in steps:
        hit = c >= limit if inclusive else c > limit
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(otherwise)


def face_shot(area: Column) -> Column:
    return by_threshold(area, [(25, "close"), (8, "medium"), (0, "wide")], "none")


def face_average(area: Column) -> Column:
    return by_threshold(area, [(30, "close_up"), (10, "medium_shot")], "wide_shot")


def pacing(cuts_per_minute: Column) -> Column:
    return F.when(cuts_per_minute < 10, "slow").when(cuts_per_minute < 20, "moderate").when(cuts_per_minute < 40, "fast").otherwise("very_fast")


def gap(seconds: Column) -> Column:
    return by_threshold(seconds, [(3, "awkward"), (2, "dramatic")], "strategic")


def hashtag_strategy(n: Column) -> Column:
    return F.when(n == 0, "none").when(n < 3, "minimal").when(n <= 7, "moderate").when(n <= 15, "heavy").otherwise("spam")


def pixel_row(y: Column) -> Column:
    return F.when(y > 400, "bottom").when(y < 200, "top").otherwise("center")


def density_level(n: Column) -> Column:
    return F.when(n < 2, "low").when(n < 5, "medium").otherwise("high")


def shot_length(seconds: Column) -> Column:
    return F.when(seconds < 2, "short").when(seconds < 5, "medium").otherwise("long")
