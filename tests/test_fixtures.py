"""Literal inputs with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from chronomark.functions import classes, stats, text, time
from chronomark.operators.timeline import band_bucketed, band_exists, islands, sessions, spine


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("notation", "seconds"), [("0-1s", 0), ("1.5-2.5s", 1.5), ("0.5s", 0.5), ("5", 5), ("1:30", 90), ("00:01:05", 65), ("-2", 0), ("", None), ("x", None), (None, None)])
def test_parse_seconds(spark, notation, seconds):
    assert one(spark, time.parse_seconds(F.col("s")), s=notation) == seconds


@pytest.mark.parametrize(("area", "shot"), [(0, "none"), (0.01, "wide"), (8, "wide"), (8.01, "medium"), (25, "medium"), (25.01, "close"), (100, "close")])
def test_face_shot(spark, area, shot):
    assert one(spark, classes.face_shot(F.col("a")), a=float(area)) == shot


def test_key_start(spark):
    assert one(spark, time.key_start(F.col("k")), k="10-11s") == 10
    assert one(spark, time.key_start(F.col("k")), k="0.001-0.002s") is None
    assert one(spark, time.key_start(F.col("k"), True), k="2.5-3s") == 2
    assert one(spark, time.key_start(F.col("k"), True), k="bad") == 0


def test_cta_clusters(spark):
    rows = spark.createDataFrame([(1, t, i) for i, t in enumerate([1.0, 3.0, 7.9, 13.0])], "video_id long, t double, seq long")
    got = sessions(rows, 5.0).groupBy("session").agg(F.min("t"), F.max("t"), F.count("*")).where("count(1) >= 2").collect()
    assert [tuple(r)[1:] for r in got] == [(1.0, 7.9, 3)]


def test_gap_classes(spark):
    assert [one(spark, classes.gap(F.col("g")), g=g) for g in (1.5, 2.5, 3.5)] == ["strategic", "dramatic", "awkward"]


def test_framing_runs(spark):
    rows = spark.createDataFrame([(1, i, s) for i, s in enumerate(["close", "medium", "none", "wide", "close"])], "video_id long, seq long, shot string")
    assert islands(rows, F.col("shot"), ["seq"]).select("run").distinct().count() == 5


def test_islands_with_nulls(spark):
    rows = spark.createDataFrame([(1, i, s) for i, s in enumerate(["a", None, None, "a", "a"])], "video_id long, seq long, x string")
    assert [r["run"] for r in islands(rows, F.col("x"), ["seq"]).orderBy("seq").collect()] == [0, 1, 1, 2, 2]


def test_band_joins_against_all_pairs(spark):
    left = [(v, i, (i * 37 % 100) / 7) for v in range(3) for i in range(30)]
    right = [(v, i, (i * 53 % 100) / 7) for v in range(3) for i in range(30)]
    a = spark.createDataFrame(left, "video_id long, seq long, t double")
    b = spark.createDataFrame(right, "video_id long, rseq long, rt double")
    for width in (0.5, 1.0, 3.0):
        want = {(v, i, j) for v, i, t in left for w, j, u in right if v == w and abs(t - u) <= width}
        assert {(r["video_id"], r["seq"], r["rseq"]) for r in band_bucketed(a, b, width).collect()} == want
        assert {(r["video_id"], r["seq"]) for r in band_exists(a, b.select("video_id", F.col("rt").alias("t")), width).collect()} == {x[:2] for x in want}


def test_spine_of_nothing(spark):
    assert spine(spark.createDataFrame([(1, 0), (2, 3)], "video_id long, n int"), F.col("n")).groupBy("video_id").count().collect()[0][1] == 3


def test_safe_div(spark):
    assert one(spark, stats.safe_div(F.col("a"), F.col("b")), a=1.0, b=0.0) == 0
    assert one(spark, stats.safe_div(F.col("a"), F.col("b")), a=1.0, b=4.0) == 0.25


def test_text(spark):
    assert one(spark, F.size(text.words(F.col("s"))), s="") == 0
    assert one(spark, F.size(text.words(F.col("s"))), s=" a  b\n") == 2
    assert one(spark, text.emoji_runs(F.col("s")), s="Depuff with me 🌺") == 1
    assert one(spark, text.mentions(F.col("s")), s="@élan and @bob") == ["@élan", "@bob"]
    assert one(spark, text.ngrams(text.words(F.col("s")), 2), s="a b c") == ["a b", "b c"]
    assert one(spark, text.ngrams(text.words(F.col("s")), 2), s="a") == []
    assert one(spark, text.truncated(F.col("s"), 3), s="abcd") == "abc..."


def test_rounding_is_that_of_the_double(spark):
    import random

    from chronomark.plans.formats import round_half_even

    rng = random.Random(4)
    xs = [2.675, 1.005, 0.125, 0.375, 2.5, 1.115, 0.0, -2.675, -0.125] + [rng.randrange(1, 10**6) / 1000 for _ in range(2000)] + [rng.uniform(0.01, 9e5) for _ in range(2000)]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select("i", round_half_even(F.col("x")).alias("r")).collect()
    assert all(float(r["r"]) == round(xs[r["i"]], 2) for r in got)


@pytest.mark.parametrize(("said", "category", "topic"), [
    ("Follow for more", "cta", "other_text"), ("SHOP NOW", "headline", "urgency_phrases"), ("#fyp", "hashtag", "other_text"), ("50 percent off", "numbers", "other_text"),
    ("What is this?", "caption", "questions"), ("twenty character item", "subtitle", "product_mentions"), ("x" * 31, "headline", "other_text"), ("ok", "caption", "other_text"),
])
def test_overlay_classes(spark, said, category, topic):
    from chronomark.plans import overlays

    assert one(spark, overlays.category(F.col("s")), s=said) == category
    assert one(spark, overlays.topic(F.col("s")), s=said) == topic


def test_dominant_size_moves_by_over_half_the_mean(spark):
    from chronomark.plans.overlays import dominant

    row = spark.createDataFrame([([10, 14, 30, 20, 12], 8.6)], "s array<long>, h double").select(dominant().alias("f")).first()["f"]
    assert (row["size"], row["moves"]) == (20, 2)  # 10, 10, 30, 20 and 20: 12 is less than 8.6 away


def test_text_blocks(spark):
    from chronomark.plans.formats import text_blocks

    text = "before\nCoreMetrics:\n a\nb \nDynamics\n\nother\nQuality::\nz"
    got = spark.createDataFrame([(text,)], "t string").select(text_blocks(F.col("t")).alias("b")).first()["b"]
    assert [(r["block"], r["content"]) for r in got] == [("CoreMetrics", "a\nb"), ("Dynamics", "\nother"), ("Quality", "z")]


def test_prefix_and_paths(spark):
    from chronomark.plans.formats import key_paths, strip_prefix

    assert [one(spark, strip_prefix(F.col("s"), "density"), s=x) for x in ("densityCoreMetrics", "densityx", "density", "other")] == ["CoreMetrics", "X", "density", "other"]
    paths = spark.createDataFrame([('{"a":1,"b":{"c":1},"d":[{"e":2},{"f":3}],"g":[1]}',)], "j string").select(F.expr(key_paths("j")).alias("p")).first()["p"]
    assert sorted(paths) == ["a", "b", "b.c", "d", "d[0].e", "g"]


def test_phrases_and_their_times(spark):
    from chronomark.plans.rules import CTA_PATTERNS, phrases

    df = spark.createDataFrame([(1, "please follow me, unfollow no; share with a friend", 9, 18.0)], "video_id long, low string, words int, speech_s double")
    got = [tuple(r) for r in df.select(phrases(CTA_PATTERNS).alias("p")).first()["p"]]
    assert got == [("engagement", "follow", 7, 2.0), ("engagement", "share", 31, 10.0), ("viral", "share with", 31, 10.0)]


def test_decimals_round_the_scaled_double(spark):
    from decimal import Decimal

    import duckdb

    from chronomark.plans._base import dec

    xs = [0.3025625, 0.2692875, 2.5e-6, -2.5e-6, 1.0000005, 123456.7890125, 0.0, None, *[(i + 0.5) / 1e6 for i in range(1000, 9000, 7)], *[-(i + 0.5) / 1e6 for i in range(1000, 9000, 7)]]
    want = [r[0] for r in duckdb.sql(f"SELECT CAST(CAST(unnest({[x for x in xs if x is not None]}::DOUBLE[]) AS DOUBLE) AS DECIMAL(18,6))").fetchall()]
    got = spark.createDataFrame(list(enumerate(xs)), "i int, x double").select("i", dec("x").alias("d")).orderBy("i").collect()
    assert [r["d"] for r in got if r["d"] is not None] == want and got[7]["d"] is None
    assert one(spark, dec(F.col("x")), x=float("nan")) is None and one(spark, dec(F.col("x"), 2), x=1.005) == Decimal("1.00")


def events(spark, tmp_path, rows):
    """A folder with an ``events`` table of (id, seconds of media time, user, kind, value)."""
    at = "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, cast(t * 86400 as decimal(18,6)))"
    df = spark.createDataFrame(rows, "event_id long, t double, user_id long, event_type string, value double")
    df.select("event_id", F.expr(f"cast({at} as timestamp_ntz)").alias("ts"), "user_id", "event_type", "value", F.format_string('{"k": %d}', F.col("event_id") % 7).alias("props")).repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_mean_confidence_is_added_in_order_of_time(spark, tmp_path):
    """In another order the sum of these confidences has other last bits, and the mean falls on the other side of a rounding tie."""
    from chronomark.plans.rules import emotion_facts

    rows = [(i, 0.5 + i * 1e-3, v, "signup", 100 * ((i * 7919 + v) % 9973) / 1e4) for v in range(20) for i in range(200)]
    got = {r["video_id"]: r["sure"] for r in emotion_facts(spark, events(spark, tmp_path, rows)).collect()}
    for v in range(20):
        total = 0.0
        for _, _, w, _, value in rows:
            total += value / 100 if w == v else 0.0
        assert got[v] == total / 200


def test_deviation_at_ties(spark):
    """Means of 3 and deviations of 1.5, exactly: not over half the mean, in any order."""
    from chronomark.plans.rules import density_facts

    import random

    rows = []
    for v in range(60):
        n = [1] * 9 + [5] * 9 + [3] * 2 + [2] * 2 + [4] * 2 + [1, 5] * 3
        n[:2] = [1, 5]
        random.Random(v).shuffle(n)
        rows += [(v, s, x) for s, x in enumerate(n)]
    d = spark.createDataFrame(rows, "video_id long, sec int, n long")
    n = [x for v, _, x in rows if v == 0]
    s = (len(n) * sum(x * x for x in n) - sum(n) ** 2) ** 0.5 / len(n)
    assert {r["s"] for r in density_facts(d).collect()} == {s}


def test_peaks_of_a_mean_added_in_order_of_time(spark, tmp_path):
    """The least value is 1.2 times the mean or just beside it; only the order of time says which."""
    from chronomark.plans.classes import win_emotion_peaks

    rows = []
    for v in range(60):
        low = [float((i * 7919 + v * 31) % 60 + 1) for i in range(47)]
        while sum(low) * 1.2 % (48 - 1.2) > 1e-9 and len(low) < 60:  # until the tie is a whole number
            low[0] += 1.0
            if low[0] > 60:
                low[0], low[1] = 1.0, low[1] + 1.0
            if low[1] > 60:
                break
        top = round(1.2 * sum(low) / (48 - 1.2))
        rows += [(i, 0.5 + i * 1e-3, v, "signup", float(x)) for i, x in enumerate([*low, top])]
    got = {(r["video_id"], r["seq"]) for r in win_emotion_peaks(spark, events(spark, tmp_path, rows)).collect()}
    want = set()
    for v in range(60):
        conf = [x / 100 for _, _, w, _, x in rows if w == v]
        total = 0.0
        for c in conf:
            total += c
        want |= {(v, i) for i in [i for i, c in enumerate(conf) if c > 1.2 * (total / 48)][:3]}
    assert got == want
