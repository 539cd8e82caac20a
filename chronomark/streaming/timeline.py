"""The bucket, session and transition operators over streams of timeline events.

The batch forms key on seconds of media time; over a stream the same keys are windows of event time under a watermark:
rows later than it are left out, and state of closed windows is dropped, so state is bounded by the open windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """A stream of the events files that arrive in ``folder``."""
    reader = spark.readStream.schema(EVENTS)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(folder)


def windowed_density(events: DataFrame, width: str = "1 day", delay: str = "1 day", slide: str | None = None) -> DataFrame:
    """``video_id, start, n, total``: entries per item and window; ``slide`` makes windows overlap."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    counts = events.withWatermark("ts", delay).groupBy(F.col("user_id").alias("video_id"), w.alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counts.select("video_id", F.col("w.start").alias("start"), "n", "total")


def session_clusters(events: DataFrame, gap: str = "5 days", delay: str = "1 day", least: int = 2) -> DataFrame:
    """Sessions that a gap splits, of ``least`` entries at least."""
    s = F.session_window("ts", gap)
    found = events.withWatermark("ts", delay).groupBy(F.col("user_id").alias("video_id"), s.alias("s")).agg(F.count("*").alias("n"))
    return found.where(F.col("n") >= least).select("video_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def deduplicated(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each event once, though it may arrive again within the watermark."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


_STATE = T.StructType([T.StructField("last", T.StringType()), T.StructField("changes", T.LongType())])


def transitions(events: DataFrame) -> DataFrame:
    """``video_id, changes``: how often the type of an item's events changed so far; one value an item is kept as state."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, changes = state.get if state.exists else (None, 0)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for kind in rows["event_type"]:
            changes += int(last is not None and kind != last)
            last = kind
        state.update((last, changes))
        yield pd.DataFrame({"video_id": [key[0]], "changes": [changes]})

    return events.groupBy("user_id").applyInPandasWithState(step, "video_id long, changes long", _STATE, "update", "NoTimeout")


def run_available(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Run a streaming frame over what is there and return the rows of its sink."""
    writer = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True)
    query = (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
    query.awaitTermination()
    return df.sparkSession.table(name)
