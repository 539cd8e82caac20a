"""Operators over one timeline per item. Every one keys on ``video_id``, so an item's rows meet in one task at most once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_order(*tie: str) -> Window:
    return Window.partitionBy("video_id").orderBy("t", *(tie or ("seq",)))


def spine(videos: DataFrame, seconds: Column | int, step: int = 1, name: str = "sec") -> DataFrame:
    """A row per item and second (or step) from 0 to the last whole one; items of no length have none."""
    n = F.lit(seconds) if isinstance(seconds, int) else seconds
    return videos.select("*", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step)))).alias(name))


def islands(rows: DataFrame, value: Column, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """``rows`` with ``run``: the number of the run of equal ``value`` that the row is in, in ``order``, from 0."""
    w = Window.partitionBy(*(keys or ["video_id"])).orderBy(*order)
    changed = (~value.eqNullSafe(F.lag(value).over(w))) & (F.row_number().over(w) > 1)
    return rows.withColumn("__c", changed.cast("int")).withColumn("run", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__c")


def sessions(rows: DataFrame, gap: float, time: str = "t", keys: list[str] | None = None) -> DataFrame:
    """``rows`` with ``session``: a row at ``gap`` seconds or more after the one before it begins a new one."""
    w = Window.partitionBy(*(keys or ["video_id"])).orderBy(time, "seq")
    new = F.coalesce((F.col(time) - F.lag(time).over(w) >= gap).cast("int"), F.lit(0))
    return rows.withColumn("__n", new).withColumn("session", F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__n")


def band_bucketed(left: DataFrame, right: DataFrame, width: float, lt: str = "t", rt: str = "rt") -> DataFrame:
    """Inner join of rows of one item at most ``width`` apart in time.

    Both sides are dealt by (item, bucket of ``width``); the right side goes to the neighbouring buckets too, so a task
    holds a few buckets of an item and not the product of all of its rows. ``right`` has ``video_id`` and ``rt``.
    """
    b = lambda c: F.floor(F.col(c) / width)
    spread = right.withColumn("__b", F.explode(F.array(b(rt) - 1, b(rt), b(rt) + 1)))
    joined = left.withColumn("__b", b(lt)).join(spread, ["video_id", "__b"])
    return joined.where(F.abs(F.col(lt) - F.col(rt)) <= width).drop("__b")


def band_exists(left: DataFrame, right: DataFrame, width: float, strict: bool = False, anti: bool = False) -> DataFrame:
    """Rows of ``left`` with (or without) a row of ``right`` of the same item at most, or less than, ``width`` away."""
    b = lambda c: F.floor(F.col(c) / width)
    spread = right.select(F.col("video_id").alias("__v"), F.col("t").alias("__t")).withColumn("__b", F.explode(F.array(b("__t") - 1, b("__t"), b("__t") + 1)))
    near = F.abs(F.col("t") - F.col("__t"))
    cond = (F.col("video_id") == F.col("__v")) & (b("t") == F.col("__b")) & ((near < width) if strict else (near <= width))
    return left.join(spread, cond, "left_anti" if anti else "left_semi")


def first_by(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of every group in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def top_k(rows: DataFrame, k: int, order: list[Column | str], keys: list[str] | None = None, name: str = "rank") -> DataFrame:
    w = Window.partitionBy(*(keys or ["video_id"])).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(w).cast("long")).where(F.col(name) <= k)
