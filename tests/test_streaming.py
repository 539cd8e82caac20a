"""Streams give what the same operators give on the same rows at rest."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronomark.streaming import timeline as st


@pytest.fixture()
def folder(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(hours=7 * i), i % 3, ["click", "view", "error"][i // 3 % 3], 1.0, "{}") for i in range(60)]
    path = str(tmp_path / "events")
    df = spark.createDataFrame(rows, st.EVENTS)
    for k in range(3):
        df.where(F.col("event_id").between(20 * k, 20 * k + 19)).coalesce(1).write.mode("append").parquet(path)
    return path


def test_windows(spark, folder):
    got = st.run_available(st.windowed_density(st.read_events(spark, folder, 1)), "win", "complete")
    want = spark.read.parquet(folder).groupBy(F.col("user_id").alias("video_id"), F.window("ts", "1 day")["start"].alias("start")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("video_id", "start", "n", "total").collect()))


def test_sessions_close_under_the_watermark(spark, tmp_path):
    hours = {0: [0, 1, 2, 100, 101, 500], 1: [0, 50, 51, 500]}
    base = dt.datetime(2024, 1, 1)
    rows = sorted((h, v) for v, hs in hours.items() for h in hs)
    path = str(tmp_path / "sessions")
    for k in range(3):
        part = [(10 * n + k, base + dt.timedelta(hours=h), v, "click", 1.0, "{}") for n, (h, v) in enumerate(rows) if (h >= 50) + (h >= 500) == k]
        spark.createDataFrame(part, st.EVENTS).coalesce(1).write.mode("append").parquet(path)
    got = st.run_available(st.session_clusters(st.read_events(spark, path, 1), gap="5 hours", delay="1 hour"), "ses")
    closed = sorted((r["video_id"], int((r["start"] - base).total_seconds()) // 3600, int((r["end"] - base).total_seconds()) // 3600, r["n"]) for r in got.collect())
    assert closed == [(0, 0, 7, 3), (0, 100, 106, 2), (1, 50, 56, 2)]  # the sessions at 500 hours are open, single ones are none


def test_duplicates_within_the_watermark(spark, folder):
    spark.read.parquet(folder).write.mode("append").parquet(folder + "2")
    spark.read.parquet(folder).write.mode("append").parquet(folder + "2")
    assert st.run_available(st.deduplicated(st.read_events(spark, folder + "2")), "dup").count() == 60


def test_transitions(spark, folder):
    got = st.run_available(st.transitions(st.read_events(spark, folder)), "tra", "update").groupBy("video_id").agg(F.max("changes").alias("n")).collect()
    rows = sorted((r["user_id"], r["ts"], r["event_type"]) for r in spark.read.parquet(folder).collect())
    for r in got:
        kinds = [k for v, _, k in rows if v == r["video_id"]]
        assert r["n"] == sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
