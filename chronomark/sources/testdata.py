"""Silver tables over the driver's Parquet files: timeline, videos, speech segments, captions, boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Seconds of media time that every item lasts; one day of events plays one second.
DURATION = 30
EPOCH, EPOCH_US = "2024-01-01 00:00:00", 1_704_067_200_000_000
ENTRY_TYPES = {"click": "gesture", "view": "object", "purchase": "text", "error": "scene_change", "signup": "emotion"}
#: Class of an object or label of an emotion, by number.
EMOTIONS = ["joy", "sadness", "anger", "fear", "surprise", "disgust", "neutral"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, seq, t, entry_type, conf, label``: detections of all kinds as instants in seconds."""
    e = table(spark, sf_dir, "events")
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in ENTRY_TYPES.items() for x in kv]), F.col("event_type"))
    return e.select(
        F.col("user_id").alias("video_id"),
        F.col("event_id").alias("seq"),
        (F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz")) / F.lit(86_400_000_000.0)).alias("t"),
        kind.alias("entry_type"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("conf"),
        (F.get_json_object("props", "$.k").cast("long") % 7).alias("label"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, seq, start_s, end_s, words, role, text``: turns as speech of 0.3 s a word, with pauses between."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\n\\t\\r]+"), lambda w: w != "")).alias("words"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    length, gap = F.col("words") * 3, (F.col("turn") % 3) * 15
    start = F.coalesce(F.sum(length + gap).over(before), F.lit(0))
    return c.select(F.col("conv_id").alias("video_id"), F.col("turn").alias("seq"), (start / 10).alias("start_s"), ((start + length) / 10).alias("end_s"), "words", "role", "text")


#: The same tables for DuckDB, as common table expressions.
TL_SQL = f"""tl AS (SELECT user_id AS video_id, event_id AS seq, (epoch_us(ts) - {EPOCH_US}) / 86400000000.0 AS t,
  CASE event_type WHEN 'click' THEN 'gesture' WHEN 'view' THEN 'object' WHEN 'purchase' THEN 'text' WHEN 'error' THEN 'scene_change' WHEN 'signup' THEN 'emotion' END AS entry_type,
  least(value / 100, 1.0) AS conf, CAST(props ->> '$.k' AS BIGINT) % 7 AS label FROM events)"""
SEG_SQL = """turns AS (SELECT conv_id, turn, role, text, len(regexp_extract_all(coalesce(text, ''), '[^ \\n\\t\\r]+')) AS words FROM conversations),
seg AS (SELECT conv_id AS video_id, turn AS seq, s / 10 AS start_s, (s + words * 3) / 10 AS end_s, words, role, text FROM (
  SELECT *, CAST(coalesce(sum(words * 3 + (turn % 3) * 15) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM turns))"""
