"""Band, point, interval, anti, theta and outer joins within an item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.operators.timeline import band_bucketed, band_exists, first_by
from chronomark.plans._base import big, dec, query
from chronomark.plans.aggregates import DENS_SQL, density
from chronomark.plans.windows import SHOT_SQL, shots
from chronomark.sources.testdata import DURATION, SEG_SQL, TL_SQL, segments, table, timeline


def kind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return timeline(spark, sf_dir).where(F.col("entry_type") == name)


_KINDS = f"""WITH {TL_SQL}, tx AS (SELECT * FROM tl WHERE entry_type = 'text'), ge AS (SELECT * FROM tl WHERE entry_type = 'gesture'), ob AS (SELECT * FROM tl WHERE entry_type = 'object'), em AS (SELECT * FROM tl WHERE entry_type = 'emotion'), sc AS (SELECT * FROM tl WHERE entry_type = 'scene_change')"""


@query("join_equi_key", f"{_KINDS} SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, seq FROM ge WHERE EXISTS (SELECT 1 FROM tx WHERE tx.video_id = ge.video_id AND floor(tx.t) = floor(ge.t))")
def join_equi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    sec = F.floor("t").cast("long").alias("sec")
    return kind(spark, sf_dir, "gesture").select("video_id", sec, "seq").join(kind(spark, sf_dir, "text").select("video_id", sec), ["video_id", "sec"], "left_semi")


@query("join_equi_expr_gesture", f"{_KINDS} SELECT em.video_id, em.seq AS emotion_seq, ge.seq AS gesture_seq, em.label = ge.label AS agrees FROM em JOIN ge ON em.video_id = ge.video_id AND floor(em.t) = floor(ge.t)")
def join_equi_expr_gesture(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda name: kind(spark, sf_dir, name).select("video_id", F.floor("t").alias("sec"), F.col("seq").alias(f"{name}_seq"), F.col("label").alias(f"{name}_label"))
    joined = of("emotion").join(of("gesture"), ["video_id", "sec"])
    return joined.select("video_id", "emotion_seq", "gesture_seq", (F.col("emotion_label") == F.col("gesture_label")).alias("agrees"))


@query("join_equi_expr_speech", f"""{_KINDS} SELECT em.video_id, em.seq AS emotion_seq, tx.seq AS text_seq FROM em JOIN tx ON em.video_id = tx.video_id AND floor(em.t) = floor(tx.t) WHERE (em.label IN (0, 4)) <> (tx.conf >= 0.5)""")
def join_equi_expr_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kind(spark, sf_dir, "emotion").select("video_id", F.floor("t").alias("sec"), F.col("seq").alias("emotion_seq"), F.col("label").isin(0, 4).alias("up"))
    x = kind(spark, sf_dir, "text").select("video_id", F.floor("t").alias("sec"), F.col("seq").alias("text_seq"), (F.col("conf") >= 0.5).alias("good"))
    return e.join(x, ["video_id", "sec"]).where("up <> good").select("video_id", "emotion_seq", "text_seq")


@query("join_band_le1", f"{_KINDS} SELECT video_id, seq FROM tx WHERE EXISTS (SELECT 1 FROM ge WHERE ge.video_id = tx.video_id AND abs(ge.t - tx.t) <= 1)")
def join_band_le1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return band_exists(kind(spark, sf_dir, "text"), kind(spark, sf_dir, "gesture"), 1.0).select("video_id", "seq")


@query("join_band_emotion", f"{_KINDS} SELECT video_id, seq FROM em WHERE EXISTS (SELECT 1 FROM ge WHERE ge.video_id = em.video_id AND abs(ge.t - em.t) <= 1)")
def join_band_emotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return band_exists(kind(spark, sf_dir, "emotion"), kind(spark, sf_dir, "gesture"), 1.0).select("video_id", "seq")


@query("join_band_lt1_first", f"""{_KINDS}, m AS (SELECT tx.video_id, tx.seq, ge.seq AS gesture_seq, CASE WHEN ge.label = tx.label THEN 'aligned' ELSE 'neutral' END AS kind, row_number() OVER (PARTITION BY tx.video_id, tx.seq ORDER BY ge.t, ge.seq) AS r FROM tx JOIN ge ON ge.video_id = tx.video_id AND abs(ge.t - tx.t) < 1)
SELECT tx.video_id, tx.seq, coalesce(m.kind, 'misaligned') AS coordination FROM tx LEFT JOIN m ON m.video_id = tx.video_id AND m.seq = tx.seq AND m.r = 1""")
def join_band_lt1_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx, ge = kind(spark, sf_dir, "text"), kind(spark, sf_dir, "gesture").select("video_id", F.col("t").alias("rt"), F.col("seq").alias("rseq"), F.col("label").alias("rlabel"))
    near = band_bucketed(tx, ge, 1.0).where(F.abs(F.col("t") - F.col("rt")) < 1)
    first = near.groupBy("video_id", "seq").agg(F.min(F.struct("rt", "rseq", (F.col("label") == F.col("rlabel")).alias("same"))).alias("x"))
    return tx.select("video_id", "seq").join(first, ["video_id", "seq"], "left").select("video_id", "seq", F.when(F.col("x").isNull(), "misaligned").when(F.col("x.same"), "aligned").otherwise("neutral").alias("coordination"))


@query("join_band_half", f"""{_KINDS} SELECT video_id, seq, gesture_seq FROM (SELECT tx.video_id, tx.seq, ge.seq AS gesture_seq, row_number() OVER (PARTITION BY tx.video_id ORDER BY tx.t, tx.seq, ge.t, ge.seq) AS r FROM tx JOIN ge ON ge.video_id = tx.video_id AND abs(ge.t - tx.t) < 0.5) WHERE r = 1""")
def join_band_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    ge = kind(spark, sf_dir, "gesture").select("video_id", F.col("t").alias("rt"), F.col("seq").alias("gesture_seq"))
    near = band_bucketed(kind(spark, sf_dir, "text"), ge, 0.5).where(F.abs(F.col("t") - F.col("rt")) < 0.5)
    return first_by(near, ["video_id"], ["t", "seq", "rt", "gesture_seq"]).select("video_id", "seq", "gesture_seq")


@query("join_theta_words", f"""WITH {SEG_SQL}, u AS (SELECT * FROM seg WHERE role = 'user'), a AS (SELECT * FROM seg WHERE role = 'assistant'),
m AS (SELECT u.video_id, u.seq, a.seq AS reply, CASE WHEN a.start_s - u.start_s > 1 THEN 'follow' WHEN u.start_s - a.start_s > 1 THEN 'precede' ELSE 'match' END AS kind, row_number() OVER (PARTITION BY u.video_id, u.seq ORDER BY a.seq) AS r
FROM u JOIN a ON u.video_id = a.video_id AND len(list_intersect(string_split(lower(u.text), ' '), string_split(lower(a.text), ' '))) > 0)
SELECT u.video_id, u.seq, coalesce(m.kind, 'contradicts') AS alignment FROM u LEFT JOIN m ON m.video_id = u.video_id AND m.seq = u.seq AND m.r = 1""")
def join_theta_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reply that shares a word; turns meet by (item, word), not all of an item's with each other."""
    s = segments(spark, sf_dir).select("video_id", "seq", "role", "start_s", F.array_distinct(F.split(F.lower("text"), " ")).alias("w"))
    u = s.where("role = 'user'")
    first = s.where("role = 'assistant'").select("video_id", F.explode("w").alias("word"), F.struct("seq", "start_s").alias("r")).groupBy("video_id", "word").agg(F.min("r").alias("r"))
    m = u.select("video_id", "seq", "start_s", F.explode("w").alias("word")).join(first, ["video_id", "word"]).groupBy("video_id", "seq").agg(F.min("r").alias("r"), F.any_value("start_s").alias("start_s"))
    d = F.col("r.start_s") - F.col("start_s")
    kinds = m.select("video_id", "seq", F.when(d > 1, "follow").when(d < -1, "precede").otherwise("match").alias("kind"))
    return u.select("video_id", "seq").join(kinds, ["video_id", "seq"], "left").select("video_id", "seq", F.coalesce("kind", F.lit("contradicts")).alias("alignment"))


@query("join_self_pairs", f"{_KINDS} SELECT a.video_id, count(*) AS occlusions FROM tx a JOIN tx b ON a.video_id = b.video_id AND a.seq < b.seq AND abs(b.t - a.t) < 1 GROUP BY a.video_id")
def join_self_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = kind(spark, sf_dir, "text")
    near = band_bucketed(tx, tx.select("video_id", F.col("t").alias("rt"), F.col("seq").alias("rseq")), 1.0).where((F.col("seq") < F.col("rseq")) & (F.abs(F.col("t") - F.col("rt")) < 1))
    return near.groupBy("video_id").agg(F.count("*").alias("occlusions"))


_POINTS = f"WITH {TL_SQL}, {SEG_SQL}, pt AS (SELECT video_id, floor(t) AS sec, entry_type, label, seq FROM tl)"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).select("video_id", F.floor("t").alias("sec"), "entry_type", "label", F.col("seq").alias("event"))


def inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and the speech segments that they are in; second 0 never matches.

    A segment is dealt to the whole seconds that it covers and met there by (item, second), so no item's points meet all of
    its segments.
    """
    s = segments(spark, sf_dir).select("video_id", "seq", "start_s", "end_s").where("floor(end_s) >= ceil(start_s)")
    s = s.select("video_id", "seq", F.explode(F.sequence(F.ceil("start_s"), F.floor("end_s"))).alias("sec"))
    return _points(spark, sf_dir).where("sec <> 0").join(s, ["video_id", "sec"])


@query("join_point_in_interval", f"{_POINTS} SELECT DISTINCT p.video_id, p.seq AS event FROM pt p JOIN seg s ON p.video_id = s.video_id AND p.sec BETWEEN s.start_s AND s.end_s WHERE p.entry_type = 'gesture' AND p.sec <> 0")
def join_point_in_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inside(spark, sf_dir).where("entry_type = 'gesture'").select("video_id", "event").distinct()


@query("join_point_interval_count", f"{_POINTS} SELECT s.video_id, s.seq, count(*) AS hits FROM pt p JOIN seg s ON p.video_id = s.video_id AND p.sec BETWEEN s.start_s AND s.end_s WHERE p.sec <> 0 GROUP BY ALL")
def join_point_interval_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inside(spark, sf_dir).groupBy("video_id", "seq").agg(F.count("*").alias("hits"))


@query("join_anti_offcamera", f"{_POINTS} SELECT video_id, seq FROM seg s WHERE NOT EXISTS (SELECT 1 FROM pt p WHERE p.video_id = s.video_id AND p.entry_type = 'object' AND p.sec <> 0 AND p.sec BETWEEN s.start_s AND s.end_s)")
def join_anti_offcamera(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = inside(spark, sf_dir).where("entry_type = 'object'").select("video_id", "seq").distinct()
    return segments(spark, sf_dir).select("video_id", "seq").join(seen, ["video_id", "seq"], "left_anti")


@query("join_distinct_during", f"{_POINTS} SELECT s.video_id, CAST(count(DISTINCT p.label) / 10.0 AS DECIMAL(18,6)) AS variety FROM pt p JOIN seg s ON p.video_id = s.video_id AND p.sec BETWEEN s.start_s AND s.end_s WHERE p.sec <> 0 AND p.entry_type = 'emotion' GROUP BY s.video_id")
def join_distinct_during(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inside(spark, sf_dir).where("entry_type = 'emotion'").groupBy("video_id").agg(dec(F.countDistinct("label") / 10.0).alias("variety"))


@query("join_interval_overlap", f"""WITH {SEG_SQL}, x AS (SELECT video_id, seq, words, start_s, end_s, unnest(range(CAST(floor(start_s) AS BIGINT), CAST(ceil(end_s) AS BIGINT))) AS sec FROM seg WHERE end_s > start_s)
SELECT video_id, sec, CAST(sum(floor(words * (least(end_s, sec + 1) - greatest(start_s, sec)) / (end_s - start_s) + 1e-9)) AS BIGINT) AS words FROM x GROUP BY video_id, sec""")
def join_interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each second: a segment gives its share of words to every second that it overlaps, whole words only."""
    s = segments(spark, sf_dir).where("end_s > start_s")
    x = s.select("*", F.explode(F.sequence(F.floor("start_s"), F.ceil("end_s") - 1)).alias("sec"))
    inside = F.least(F.col("end_s"), F.col("sec") + 1) - F.greatest(F.col("start_s"), F.col("sec"))
    whole = F.floor(F.col("words") * inside / (F.col("end_s") - F.col("start_s")) + 1e-9)
    return x.groupBy("video_id", "sec").agg(F.sum(whole).cast("long").alias("words"))


@query("join_cut_camera", f"{_KINDS} SELECT video_id, seq FROM sc WHERE EXISTS (SELECT 1 FROM ob WHERE ob.video_id = sc.video_id AND abs(ob.t - sc.t) < 0.5)")
def join_cut_camera(spark: SparkSession, sf_dir: str) -> DataFrame:
    return band_exists(kind(spark, sf_dir, "scene_change"), kind(spark, sf_dir, "object"), 0.5, strict=True).select("video_id", "seq")


@query("join_prev_key_lookup", f"""{SHOT_SQL}, o AS (SELECT video_id, floor(t) AS sec, count(*) AS n FROM tl WHERE entry_type = 'object' GROUP BY ALL), j AS (SELECT s.video_id, s.seq, s.t, coalesce(o.n, 0) AS n FROM shot s LEFT JOIN o ON o.video_id = s.video_id AND o.sec = floor(s.t)),
l AS (SELECT *, lag(n) OVER (PARTITION BY video_id ORDER BY t, seq) AS p FROM j) SELECT video_id, seq, n - p AS jump FROM l WHERE abs(n - p) > 2""")
def join_prev_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = kind(spark, sf_dir, "object").groupBy("video_id", F.floor("t").alias("sec")).agg(F.count("*").alias("n"))
    j = shots(spark, sf_dir).withColumn("sec", F.floor("t")).join(o, ["video_id", "sec"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    l = j.withColumn("p", F.lag("n").over(Window.partitionBy("video_id").orderBy("t", "seq")))
    return l.where("abs(n - p) > 2").select("video_id", "seq", (F.col("n") - F.col("p")).alias("jump"))


@query("join_spine_left", f"""{DENS_SQL}, f AS (SELECT video_id, floor(t) AS sec, max(conf) AS face FROM tl WHERE entry_type = 'object' GROUP BY ALL), m AS (SELECT video_id, floor(t) AS sec, count(*) AS moods FROM tl WHERE entry_type = 'emotion' GROUP BY ALL)
SELECT d.video_id, CAST(d.sec AS BIGINT) AS sec, CAST(coalesce(face, 0) AS DECIMAL(18,6)) AS face, coalesce(moods, 0) AS moods, face IS NULL AND moods IS NULL AS absent FROM dens d LEFT JOIN f ON f.video_id = d.video_id AND f.sec = d.sec LEFT JOIN m ON m.video_id = d.video_id AND m.sec = d.sec""")
def join_spine_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second with its best face and its expressions; one aggregation of both maps, then one outer join to the spine."""
    is_ = lambda k: F.col("entry_type") == k
    maps = timeline(spark, sf_dir).where("entry_type in ('object', 'emotion')").groupBy("video_id", F.floor("t").alias("sec")).agg(F.max(F.when(is_("object"), F.col("conf"))).alias("face"), F.count_if(is_("emotion")).alias("moods"))
    x = density(spark, sf_dir).select("video_id", big("sec").alias("sec")).join(maps, ["video_id", "sec"], "left")
    return x.select("video_id", "sec", dec(F.coalesce("face", F.lit(0.0))).alias("face"), F.coalesce("moods", F.lit(0)).alias("moods"), F.col("moods").isNull().alias("absent"))


@query("join_events_at", f"{_KINDS} SELECT sc.video_id, sc.seq, count(*) AS active FROM sc JOIN tl ON tl.video_id = sc.video_id AND floor(tl.t) = floor(sc.t) WHERE tl.seq <> sc.seq GROUP BY ALL")
def join_events_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    sc = kind(spark, sf_dir, "scene_change").select("video_id", F.floor("t").alias("sec"), "seq")
    o = timeline(spark, sf_dir).select("video_id", F.floor("t").alias("sec"), F.col("seq").alias("other"))
    return sc.join(o, ["video_id", "sec"]).where("seq <> other").groupBy("video_id", "seq").agg(F.count("*").alias("active"))


@query("join_golden", """WITH e AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders), a AS (SELECT l_orderkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS v FROM lineitem WHERE l_discount < 0.09 GROUP BY l_orderkey)
SELECT coalesce(e.k, a.k) AS k, CASE WHEN e.k IS NULL THEN 'unexpected' WHEN a.k IS NULL THEN 'missing' WHEN e.v = a.v THEN 'exact' WHEN abs(e.v - a.v) <= 0.15 * abs(e.v) THEN 'within' ELSE 'differs' END AS status FROM e FULL JOIN a ON e.k = a.k""")
def join_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected totals of orders against what their lines (those of small discounts) add up to, by key, in a full outer join."""
    money = lambda c: F.col(c).cast("decimal(18,2)")
    e = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), money("o_totalprice").alias("ev"))
    a = table(spark, sf_dir, "lineitem").where("l_discount < 0.09").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum(money("l_extendedprice")).cast("decimal(18,2)").alias("av"))
    status = F.when(F.col("ev").isNull(), "unexpected").when(F.col("av").isNull(), "missing").when(F.col("ev") == F.col("av"), "exact").when(F.abs(F.col("ev") - F.col("av")) <= F.lit(0.15).cast("decimal(4,2)") * F.abs("ev"), "within").otherwise("differs")
    return e.join(a, "k", "full").select("k", status.alias("status"))


@query("map_merge_face_pose", f"{_KINDS}, p AS (SELECT video_id, floor(t) AS sec, count(*) AS poses FROM ge GROUP BY ALL), f AS (SELECT video_id, floor(t) AS sec, count(*) AS faces FROM ob GROUP BY ALL) SELECT coalesce(p.video_id, f.video_id) AS video_id, CAST(coalesce(p.sec, f.sec) AS BIGINT) AS sec, coalesce(poses, 0) AS poses, coalesce(faces, 0) AS faces FROM p FULL JOIN f ON p.video_id = f.video_id AND p.sec = f.sec")
def map_merge_face_pose(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda name, c: kind(spark, sf_dir, name).groupBy("video_id", F.floor("t").cast("long").alias("sec")).agg(F.count("*").alias(c))
    return of("gesture", "poses").join(of("object", "faces"), ["video_id", "sec"], "full").select("video_id", "sec", F.coalesce("poses", F.lit(0)).alias("poses"), F.coalesce("faces", F.lit(0)).alias("faces"))


@query("agg_breathing", f"{_KINDS}, b AS (SELECT video_id, count(DISTINCT floor(t)) AS n FROM tx GROUP BY video_id), v AS (SELECT DISTINCT video_id FROM tl) SELECT v.video_id, CAST(({DURATION} - coalesce(n, 0)) / {DURATION}.0 AS DECIMAL(18,6)) AS breathing FROM v LEFT JOIN b USING (video_id)")
def agg_breathing(spark: SparkSession, sf_dir: str) -> DataFrame:
    busy = F.countDistinct(F.when(F.col("entry_type") == "text", F.floor("t")))
    return timeline(spark, sf_dir).groupBy("video_id").agg(dec((DURATION - busy) / float(DURATION)).alias("breathing"))


@query("agg_simultaneous", f"{_KINDS}, x AS (SELECT video_id, sec FROM (SELECT video_id, unnest(range(CAST(floor(t) AS BIGINT), least(CAST(floor(t) AS BIGINT) + 2, {DURATION}))) AS sec FROM tx)), c AS (SELECT video_id, sec, count(*) AS n FROM x GROUP BY ALL) SELECT video_id, CAST(avg(n) AS DECIMAL(18,6)) AS simultaneous FROM c GROUP BY video_id")
def agg_simultaneous(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = kind(spark, sf_dir, "text").select("video_id", F.explode(F.sequence(F.floor("t"), F.least(F.floor("t") + 1, F.lit(DURATION - 1)))).alias("sec"))
    return active.groupBy("video_id", "sec").agg(F.count("*").alias("n")).groupBy("video_id").agg(dec(F.avg("n")).alias("simultaneous"))

