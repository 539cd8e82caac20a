"""Sources and sinks as queries: the driver's tables are written in a detector's or a log's format and read back as silver tables.

Every query writes to a folder of its own that all executors share, through Spark's committers, and reads what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomark.plans._base import QUERIES, big, dec, query
from chronomark.sources import files
from chronomark.sources.testdata import DURATION, SEG_SQL, TL_SQL, segments, table, timeline


def _landed(rows: DataFrame, name: str) -> str:
    path = files.scratch(rows.sparkSession, name)
    rows.write.json(path)
    return path


@query("src_detector_json", f"WITH {TL_SQL} SELECT video_id, count(*) AS detections, CAST(sum(CAST(conf AS DECIMAL(18,6))) AS DECIMAL(18,6)) AS confidence FROM tl WHERE entry_type = 'object' GROUP BY video_id")
def src_detector_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of detections an item; items whose document is there already are not computed again."""
    d = timeline(spark, sf_dir).where("entry_type = 'object'").select("video_id", F.struct("seq", dec("conf").alias("conf")).alias("x"))
    documents = d.groupBy("video_id").agg(F.collect_list("x").alias("detections"))
    cached = _landed(documents.where("video_id % 2 = 0"), "detector-cached")
    schema = "video_id long, detections array<struct<seq: long, conf: decimal(18,6)>>"
    have = files.read_json(spark, cached, schema)
    new = _landed(files.missing(documents, have), "detector-new")
    whole = have.unionByName(files.read_json(spark, new, schema)).where("_corrupt is null")
    return whole.select("video_id", F.explode("detections").alias("x")).groupBy("video_id").agg(F.count("*").alias("detections"), F.sum("x.conf").cast("decimal(18,6)").alias("confidence"))


@query("src_whisper_json", f"WITH {SEG_SQL} SELECT video_id, seq, CAST(start_s AS DECIMAL(18,4)) AS start_s, CAST(end_s AS DECIMAL(18,4)) AS end_s, trim(coalesce(text, ''), chr(32)) AS text FROM seg")
def src_whisper_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recogniser output in milliseconds, one document an item, as segments in seconds."""
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    s = segments(spark, sf_dir).select(F.col("video_id").cast("string").alias("video_id"), "seq", F.struct(F.struct(ms("start_s").alias("from"), ms("end_s").alias("to")).alias("offsets"), F.coalesce("text", F.lit("")).alias("text")).alias("x"))
    d = s.groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "x"))), lambda v: v["x"]).alias("transcription")).withColumn("result", F.struct(F.lit("en").alias("language")))
    back = files.read_speech(spark, _landed(d, "speech"))
    return back.select(F.col("video_id").cast("long").alias("video_id"), F.col("seq").cast("long").alias("seq"), dec("start_s", 4).alias("start_s"), dec("end_s", 4).alias("end_s"), "text")


@query("src_api_batch", "SELECT event_id FROM events WHERE event_id % 97 <> 0")
def src_api_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of scraped items of which some lines are broken: these are left out, the others stay."""
    line = F.when(F.col("event_id") % 97 == 0, F.lit('{"event_id": 1, "props":')).otherwise(F.to_json(F.struct("event_id", "event_type")))
    path = files.scratch(spark, "scraped")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return files.read_json(spark, path, "event_id long, event_type string").where("_corrupt is null").select("event_id")


@query("src_api_scrape", "SELECT event_id, event_type, user_id FROM events WHERE event_type <> 'error'")
def src_api_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of finished scrape jobs: a job's state and its items have landed as JSON; items of failed jobs are not taken."""
    e = table(spark, sf_dir, "events")
    jobs = _landed(e.select(F.col("event_type").alias("job"), F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("state")).distinct(), "scrape-jobs")
    items = _landed(e.select(F.col("event_type").alias("job"), "event_id", "user_id"), "scrape-items")
    done = spark.read.schema("job string, state string").json(jobs).where("state = 'SUCCEEDED'").select("job")
    return spark.read.schema("job string, event_id long, user_id long").json(items).join(done, "job", "left_semi").select("event_id", F.col("job").alias("event_type"), "user_id")


@query("src_metadata_map", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_custkey END AS first_views, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey * 2 ELSE o_custkey END AS views, o_orderpriority AS description FROM orders")
def src_metadata_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped metadata mapped to canonical columns; a counter of nought gives way to its other name."""
    o = table(spark, sf_dir, "orders")
    raw = o.select(F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(0)).otherwise(F.col("o_custkey")).cast("long").alias("views"), (F.col("o_custkey") * 2).cast("long").alias("playCount"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("description"), F.col("o_orderpriority").alias("text"))
    path = _landed(raw, "metadata")
    first = files.read_json(spark, path, files.METADATA).select("id", F.col("views").alias("first_views"))
    m = files.read_metadata(spark, path).join(first, "id")
    return m.select(F.col("id").cast("long").alias("id"), "first_views", "views", "description")


@query("prj_metadata_summary", "SELECT o_orderkey AS id, o_custkey AS views, '#' || lower(o_orderstatus) || ',#' || CAST(o_orderkey % 7 AS VARCHAR) AS hashtags, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, '') AS description FROM orders")
def prj_metadata_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of an item's metadata: counters, hashtag names, description or nothing."""
    o = table(spark, sf_dir, "orders")
    tags = F.array(F.struct(F.lower("o_orderstatus").alias("name")), F.struct((F.col("o_orderkey") % 7).cast("string").alias("name")))
    raw = o.select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("long").alias("views"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("description"), tags.alias("hashtags"))
    m = files.read_metadata(spark, _landed(raw, "metadata-summary"))
    return m.select(F.col("id").cast("long").alias("id"), "views", F.array_join(F.transform("hashtags", lambda h: F.concat(F.lit("#"), h)), ",").alias("hashtags"), "description")


@query("src_ndjson_log", "SELECT event_type AS error_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY event_type")
def src_ndjson_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a line-delimited log from a day on."""
    e = table(spark, sf_dir, "events")
    log = e.select(F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), F.col("event_type").alias("error_type"), F.col("user_id").cast("string").alias("video_id"))
    return files.read_error_log(spark, _landed(log, "errors"), "2024-01-10").groupBy("error_type").agg(F.count("*").alias("n"))


@query("src_text_log_last", "SELECT event_type, CAST(max(event_id) AS BIGINT) AS last_event FROM events GROUP BY event_type")
def src_text_log_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last line of every text log that has a marker; a log is a file, in the order of its lines."""
    path = files.scratch(spark, "logs")
    e = table(spark, sf_dir, "events").select("event_type", "event_id", F.concat(F.lit("done event="), F.col("event_id").cast("string")).alias("value"))
    e.repartition("event_type").sortWithinPartitions("event_type", "event_id").select("event_type", "value").write.partitionBy("event_type").text(path)
    last = files.last_line(spark, path, "done event=")
    return last.select(F.regexp_extract("file", r"event_type=([^/]+)", 1).alias("event_type"), F.regexp_extract("value", r"event=([0-9]+)", 1).cast("long").alias("last_event")).groupBy("event_type").agg(F.max("last_event").alias("last_event"))


@query("src_unified_load", f"WITH {TL_SQL} SELECT video_id, count(*) AS objects, {DURATION} AS duration FROM tl WHERE entry_type = 'object' GROUP BY video_id")
def src_unified_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved analysis loaded again: of its detectors only the objects, and the markers' metadata, come back."""
    d = timeline(spark, sf_dir).where("entry_type = 'object'").groupBy("video_id").agg(F.collect_list(F.struct("seq", "t", "label")).alias("yolo"))
    m = QUERIES["rpt_markers"](spark, sf_dir).select("video_id", F.col("metadata").alias("markers"))
    saved = _landed(d.join(m, "video_id").withColumn("whisper", F.lit("not loaded")), "unified")
    back = spark.read.schema("video_id long, yolo array<struct<seq: long, t: double, label: long>>, markers string").json(saved)
    return back.select("video_id", big(F.size("yolo")).alias("objects"), F.from_json("markers", "duration int")["duration"].alias("duration"))


@query("src_binary_download", "SELECT count(*) AS files, CAST(sum(length(n_name)) AS BIGINT) AS bytes, count(DISTINCT n_name) AS names FROM nation")
def src_binary_download(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed binary files, a file an item, with their lengths and digests."""
    path = files.scratch(spark, "binary")
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("value"))
    n.repartition("n_nationkey").write.partitionBy("n_nationkey").option("lineSep", "\n").text(path)
    got = files.read_binary(spark, f"{path}/*/*.txt")
    return got.agg(F.count("*").alias("files"), F.sum(F.col("length") - 1).alias("bytes"), F.countDistinct("sha256").alias("names"))


_FRAMES = 3


@query("src_frame_decode", f"WITH l AS (SELECT page_id, string_split(coalesce(html, ''), chr(10)) AS f FROM pages) SELECT page_id, CAST(len(f) AS BIGINT) AS frames, CAST((len(f) + {_FRAMES - 1}) // {_FRAMES} AS BIGINT) AS decoded FROM l")
def src_frame_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third frame of a container, decoded in Arrow batches; here a page's lines are its frames."""
    p = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("name"), F.coalesce("html", F.lit("")).cast("binary").alias("content"))
    every = files.frame_checksums(p).groupBy("name").agg(F.count("*").alias("frames"))
    some = files.frame_checksums(p, _FRAMES).groupBy("name").agg(F.count("*").alias("decoded"))
    return every.join(some, "name").select(F.col("name").cast("long").alias("page_id"), "frames", "decoded")


@query("src_frame_stream", f"WITH {TL_SQL}, n AS (SELECT video_id, seq, (row_number() OVER (PARTITION BY video_id ORDER BY seq) - 1) // 8 AS b FROM tl) SELECT video_id, CAST(b AS BIGINT) AS batch, count(*) AS frames, min(seq) AS first_seq FROM n GROUP BY video_id, b")
def src_frame_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item's frames in batches of eight."""
    return files.batched(timeline(spark, sf_dir).select("video_id", "seq"), "video_id", "seq", 8).groupBy("video_id", "batch").agg(F.count("*").alias("frames"), F.min("seq").alias("first_seq"))


_REPORT_SQL = f"WITH {TL_SQL} SELECT video_id, count(*) AS entries FROM tl GROUP BY video_id"


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("entries"))


@query("sink_three_files", f"WITH x AS ({_REPORT_SQL}) SELECT video_id, kind, entries FROM x CROSS JOIN (VALUES ('complete'), ('ml'), ('result')) k(kind)")
def sink_three_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report as three documents (complete, ml, result), each in a folder of its kind."""
    path = files.scratch(spark, "three")
    _reports(spark, sf_dir).select("*", F.explode(F.array(*map(F.lit, ["complete", "ml", "result"]))).alias("kind")).write.partitionBy("kind").json(path)
    return spark.read.schema("video_id long, entries long, kind string").json(path).select("video_id", "kind", "entries")


@query("sink_unified", _REPORT_SQL)
def sink_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document an item under the day's partition; writing a day again replaces it."""
    path = files.scratch(spark, "unified-sink")
    for _ in range(2):
        files.write_reports(_reports(spark, sf_dir), path, "2024-01-01")
    return spark.read.schema("video_id long, entries long").json(path).select("video_id", "entries")


@query("sink_atomic_json", _REPORT_SQL)
def sink_atomic_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files appear when the job commits, whole or not at all: a folder without the commit's marker is not read."""
    path = _landed(_reports(spark, sf_dir), "atomic")
    if not files.committed(spark, path):
        raise RuntimeError("the write has not been committed")
    return spark.read.schema("video_id long, entries long").json(path)


@query("sink_append_log", "SELECT event_type, count(*) * 2 AS lines FROM events GROUP BY event_type")
def sink_append_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines added to a log by two runs."""
    path = files.scratch(spark, "appended")
    for _ in range(2):
        files.append_log(table(spark, sf_dir, "events").select("event_type", "event_id"), path)
    return spark.read.schema("event_type string, event_id long").json(path).groupBy("event_type").agg(F.count("*").alias("lines"))


@query("sink_retention", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE strftime(ts, '%Y-%m-%d') >= '2024-01-20' GROUP BY 1")
def sink_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a store by days when older days are dropped."""
    e = table(spark, sf_dir, "events").select(F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd").alias("day"), "event_id")
    return files.retained(e, files.scratch(spark, "retention"), "day", "2024-01-20").groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query("sink_frame_disk", f"WITH {TL_SQL}, n AS (SELECT video_id, count(*) AS n FROM tl GROUP BY video_id) SELECT video_id, n AS frames, n > 60 AS on_disk FROM n")
def sink_frame_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of many frames have them in files with an index; the frames of others stay in the row."""
    f = timeline(spark, sf_dir).groupBy("video_id").agg(F.collect_list("seq").alias("frames"))
    large = files.scratch(spark, "frames")
    f.where(F.size("frames") > 60).select("video_id", F.posexplode("frames").alias("at", "frame")).write.parquet(large)
    disk = spark.read.parquet(large).groupBy("video_id").agg(F.count("*").alias("frames")).withColumn("on_disk", F.lit(True))
    return disk.unionByName(f.where(F.size("frames") <= 60).select("video_id", big(F.size("frames")).alias("frames"), F.lit(False).alias("on_disk")))


@query("tl_scene_change_derive", f"WITH {TL_SQL}, s AS (SELECT video_id, t, lead(t) OVER (PARTITION BY video_id ORDER BY t, seq) AS e FROM tl WHERE entry_type = 'scene_change') SELECT video_id, CAST(t AS DECIMAL(18,6)) AS at_s FROM s")
def tl_scene_change_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene changes of files that only give scenes: all their start times."""
    s = timeline(spark, sf_dir).where("entry_type = 'scene_change'").select(F.col("video_id").cast("string").alias("video_id"), F.struct(F.col("t").alias("start_time"), F.col("seq").cast("int").alias("scene_number")).alias("x"))
    d = s.groupBy("video_id").agg(F.array_sort(F.collect_list("x")).alias("scenes"))
    back = files.read_scenes(spark, _landed(d, "scenes"))
    return back.select(F.col("video_id").cast("long").alias("video_id"), dec("t").alias("at_s"))


@query("src_audio_extract", f"WITH {SEG_SQL} SELECT video_id, CAST(round(sum(end_s - start_s) * 16000) AS BIGINT) AS samples FROM seg GROUP BY video_id")
def src_audio_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One track an item, extracted once and read by all that need it; here the samples of its speech at 16 kHz."""
    path = files.scratch(spark, "audio")
    segments(spark, sf_dir).groupBy("video_id").agg(F.round(F.sum(F.col("end_s") - F.col("start_s")) * 16000).cast("long").alias("samples")).write.parquet(path)
    return spark.read.parquet(path)
