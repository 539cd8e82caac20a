"""Readers of detector and log files, writers of reports. All go through Spark's data sources and committers."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPEECH_RAW = "video_id string, result struct<language: string>, transcription array<struct<offsets: struct<`from`: bigint, `to`: bigint>, text: string>>"
OVERLAYS = "video_id string, textAnnotations array<struct<text: string, confidence: double, timestamp: double, bbox: array<double>, frame_number: int>>"
SCENES = "video_id string, scenes array<struct<scene_number: int, start_time: double, end_time: double, duration: double>>, scene_changes array<double>"
METADATA = "id string, url string, description string, text string, duration int, views bigint, playCount bigint, likes bigint, diggCount bigint, comments bigint, commentCount bigint, shares bigint, shareCount bigint, createTime string, createTimeISO string, hashtags array<struct<name: string>>"
ERROR_LOG = "timestamp string, error_type string, service string, video_id string, dump_id string, expected string, got string"


_NUMBER, _LOCAL = itertools.count(), []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, under ``spark.checkpoint.dir``; only a local session may do without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="chronomark-files-"))
        root = _LOCAL[0]
    return f"{root.rstrip('/')}/chronomark-files/{spark.sparkContext.applicationId}/{next(_NUMBER):05d}-{uuid.uuid4().hex[:8]}-{name}"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One document per line; a broken line becomes a row of nulls with its text in ``_corrupt``, and the others stay."""
    return spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_speech(spark: SparkSession, path: str) -> DataFrame:
    """Recogniser output → ``video_id, seq, start_s, end_s, text``: milliseconds to seconds, trimmed texts."""
    raw = read_json(spark, path, SPEECH_RAW).where("_corrupt is null")
    x = raw.select("video_id", F.posexplode("transcription").alias("seq", "s"))
    return x.select("video_id", "seq", (F.col("s.offsets.from") / 1000).alias("start_s"), (F.col("s.offsets.to") / 1000).alias("end_s"), F.trim("s.text").alias("text"))


def speech_document(segments: DataFrame) -> DataFrame:
    """``video_id, text, duration``: the joined transcript and the last end."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", "text", "end_s")))
    return segments.groupBy("video_id").agg(ordered.alias("x")).select("video_id", F.array_join(F.transform("x", lambda s: s["text"]), " ").alias("text"), F.coalesce(F.try_element_at("x", F.lit(-1))["end_s"], F.lit(0.0)).alias("duration"))


def read_overlays(spark: SparkSession, path: str) -> DataFrame:
    """Text annotations as intervals: at least a second, a tenth of one a character."""
    x = read_json(spark, path, OVERLAYS).where("_corrupt is null").select("video_id", F.posexplode("textAnnotations").alias("seq", "a"))
    return x.select("video_id", "seq", F.col("a.timestamp").alias("start_s"), (F.col("a.timestamp") + F.greatest(F.lit(1.0), F.char_length("a.text") * 0.1)).alias("end_s"), "a.text", "a.confidence", "a.bbox")


def read_scenes(spark: SparkSession, path: str) -> DataFrame:
    """Scene changes, derived from the scenes' starts where a file does not give them."""
    x = read_json(spark, path, SCENES).where("_corrupt is null")
    changes = F.coalesce("scene_changes", F.transform("scenes", lambda s: s["start_time"]))
    return x.select("video_id", F.posexplode(changes).alias("seq", "t"))


def map_metadata(raw: DataFrame) -> DataFrame:
    """Scraper keys to the canonical columns, each with its fallbacks in order; a zero counter gives way to the next."""
    count = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit(0)) for n in names], F.lit(0)).alias(names[0])
    created = F.try_to_timestamp(F.coalesce("createTimeISO", "createTime"))
    return raw.select(
        "id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("description", "text", F.lit("")).alias("description"), F.coalesce("duration", F.lit(0)).alias("duration"),
        count("views", "playCount"), count("likes", "diggCount"), count("comments", "commentCount"), count("shares", "shareCount"),
        F.coalesce(F.hour(created), F.lit(0)).alias("publish_hour"), F.coalesce(F.weekday(created), F.lit(0)).alias("publish_weekday"),
        F.coalesce(F.transform("hashtags", lambda h: h["name"]), F.array().cast("array<string>")).alias("hashtags"),
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return map_metadata(read_json(spark, path, METADATA).where("_corrupt is null"))


def read_error_log(spark: SparkSession, paths: str | list[str], since: str | None = None) -> DataFrame:
    """Line-delimited error log, from ``since`` (an ISO day) on."""
    log = spark.read.schema(ERROR_LOG).json(paths)
    return log.where(F.col("timestamp") >= since) if since else log


def last_line(spark: SparkSession, path: str, marker: str) -> DataFrame:
    """The last line of every file that has the marker."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"), "value").where(F.contains("value", F.lit(marker)))
    return lines.groupBy("file").agg(F.max(F.struct("n", "value"))["value"].alias("value"))


def missing(items: DataFrame, done: DataFrame, key: str = "video_id") -> DataFrame:
    """Items whose detector file is not there yet: the cached ones are reused."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def write_reports(reports: DataFrame, path: str, day: str) -> None:
    """One JSON document an item under the day's partition; a day is replaced whole, other days stay."""
    documents = reports.withColumn("day", F.lit(day))
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").json(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def newest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The newest row of every key; of equally new ones the greatest."""
    w = Window.partitionBy(key).orderBy(F.desc(order), *[F.desc(c) for c in rows.columns if c not in (key, order)])
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def retained(rows: DataFrame, path: str, day: str, keep_from: str) -> DataFrame:
    """``rows`` written by their ``day`` column, and read back without the days before ``keep_from``: what retention leaves.

    A day is a folder; leaving it out prunes its files, deleting it is the store's matter.
    """
    rows.write.mode("overwrite").partitionBy(day).parquet(path)
    return rows.sparkSession.read.parquet(path).where(f"{day} >= '{keep_from}'")


def committed(spark: SparkSession, path: str) -> bool:
    """Whether the job that writes a folder has ended well, in whatever store the folder is."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """Files as ``name, length, sha256, content``; a file that is there is read, not fetched again."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.sha2("content", 256).alias("sha256"), "content")


def batched(rows: DataFrame, key: str, order: str, size: int) -> DataFrame:
    """``rows`` with ``batch``: consecutive batches of ``size`` rows of every key, the last one shorter."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    return rows.withColumn("batch", F.floor(n / size).cast("long"))


def frame_checksums(frames: DataFrame, step: int = 1) -> DataFrame:
    """``frames(name, content)`` → ``name, frame, crc``: a container's frames (lines here), every ``step``-th one, streamed in Arrow batches."""
    import pyarrow as pa

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in it:
            names, at, crcs = [], [], []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k, frame in enumerate((content or b"").split(b"\n")):
                    if k % step == 0:
                        names.append(name)
                        at.append(k)
                        crcs.append(zlib.crc32(frame))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at, pa.int64()), pa.array(crcs, pa.int64())], names=["name", "frame", "crc"])

    return frames.select("name", "content").mapInArrow(batches, "name string, frame long, crc long")

