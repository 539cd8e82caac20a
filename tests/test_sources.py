"""Files in, rows out, and back."""

import json

from pyspark.sql import functions as F

from chronomark.sources import files


def put(tmp_path, name, *docs):
    path = tmp_path / name
    path.write_text("".join((d if isinstance(d, str) else json.dumps(d)) + "\n" for d in docs))
    return str(path)


def test_speech(spark, tmp_path):
    path = put(tmp_path, "s.json", {"video_id": "v", "result": {"language": "en"}, "transcription": [{"offsets": {"from": 0, "to": 1500}, "text": " Hello "}, {"offsets": {"from": 1500, "to": 3000}, "text": "there"}]}, "{broken", {"video_id": "w"})
    rows = files.read_speech(spark, path)
    assert [tuple(r) for r in rows.orderBy("seq").collect()] == [("v", 0, 0.0, 1.5, "Hello"), ("v", 1, 1.5, 3.0, "there")]
    assert [tuple(r) for r in files.speech_document(rows).collect()] == [("v", "Hello there", 3.0)]


def test_overlays_and_scenes(spark, tmp_path):
    path = put(tmp_path, "o.json", {"video_id": "v", "textAnnotations": [{"text": "x" * 25, "confidence": 0.9, "timestamp": 2.0}, {"text": "y", "confidence": 0.1, "timestamp": 3.0}]})
    assert [(r["start_s"], r["end_s"]) for r in files.read_overlays(spark, path).orderBy("seq").collect()] == [(2.0, 4.5), (3.0, 4.0)]
    path = put(tmp_path, "c.json", {"video_id": "v", "scenes": [{"start_time": 0.0, "end_time": 2.0}, {"start_time": 2.0, "end_time": 5.0}]}, {"video_id": "w", "scene_changes": [1.5], "scenes": []})
    assert sorted((r["video_id"], r["t"]) for r in files.read_scenes(spark, path).collect()) == [("v", 0.0), ("v", 2.0), ("w", 1.5)]


def test_metadata_fallbacks(spark, tmp_path):
    path = put(tmp_path, "m.json", {"id": "1", "text": "cap", "views": 0, "playCount": 7, "likes": 3, "createTimeISO": "2024-01-01T12:00:00Z", "hashtags": [{"name": "a"}]}, {"id": "2", "createTime": "never"})
    a, b = files.read_metadata(spark, path).orderBy("id").collect()
    assert (a["description"], a["views"], a["likes"], a["publish_hour"], a["publish_weekday"], a["hashtags"]) == ("cap", 7, 3, 12, 0, ["a"])
    assert (b["views"], b["publish_hour"], b["hashtags"], b["description"]) == (0, 0, [], "")


def test_logs(spark, tmp_path):
    path = put(tmp_path, "e.ndjson", {"timestamp": "2024-01-01T00:00:00", "error_type": "a"}, {"timestamp": "2024-01-09T00:00:00", "error_type": "b"})
    assert [r["error_type"] for r in files.read_error_log(spark, path, "2024-01-05").collect()] == ["b"]
    out = str(tmp_path / "log")
    for k in range(2):
        files.append_log(spark.createDataFrame([(k,)], "k int"), out)
    assert spark.read.json(out).count() == 2
    path = put(tmp_path, "t.txt", "one MARK", "two", "three MARK", "four")
    assert [r["value"] for r in files.last_line(spark, path, "MARK").collect()] == ["three MARK"]


def test_reports_replace_their_day_only(spark, tmp_path):
    out = str(tmp_path / "reports")
    docs = spark.createDataFrame([("v", 1), ("w", 2)], "video_id string, n int").select("video_id", F.struct("n").alias("densityCoreMetrics"))
    files.write_reports(docs, out, "2024-01-01")
    files.write_reports(docs, out, "2024-01-02")
    files.write_reports(docs.where("video_id = 'v'"), out, "2024-01-02")
    assert sorted((str(r["day"]), r["video_id"]) for r in spark.read.json(out).collect()) == [("2024-01-01", "v"), ("2024-01-01", "w"), ("2024-01-02", "v")]


def test_missing_and_newest(spark):
    items = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "video_id string, n int")
    assert [r["video_id"] for r in files.missing(items, items.where("n = 1")).collect()] == ["b", "b"]
    assert sorted(tuple(r) for r in files.newest(items, "video_id", "n").collect()) == [("a", 1), ("b", 3)]
