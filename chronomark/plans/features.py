"""Overlay, emotion, framing, pacing and speech features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.functions.classes import face_shot
from chronomark.operators.timeline import first_by, top_k
from chronomark.plans._base import big, dec, query
from chronomark.plans.aggregates import DENS_SQL, density
from chronomark.plans.windows import SHOT_SQL, shots
from chronomark.sources.testdata import DURATION, EMOTIONS, SEG_SQL, TL_SQL, segments, table, timeline

_HALF = DURATION / 2


def _of(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return timeline(spark, sf_dir).where(F.col("entry_type") == kind)


def _by_time() -> Window:
    return Window.partitionBy("video_id").orderBy("t", "seq")


def _instants(name: str, kind: str) -> None:
    @query(name, f"WITH {TL_SQL} SELECT video_id, seq, CAST(t AS DECIMAL(18,6)) AS at_s, label FROM tl WHERE entry_type = '{kind}'")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _of(spark, sf_dir, kind).select("video_id", "seq", dec("t").alias("at_s"), "label")


_instants("tl_pose", "gesture")
_instants("tl_face", "object")


@query("tl_gaze", f"WITH {TL_SQL} SELECT video_id, seq, CAST(t AS DECIMAL(18,6)) AS at_s, CASE WHEN conf > 0.5 THEN 'camera' ELSE 'away' END AS direction, CAST(conf AS DECIMAL(18,6)) AS eye_contact FROM tl WHERE entry_type IN ('object', 'emotion') AND label % 2 = 0")
def tl_gaze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaze entries: faces and expressions with even classes, their score the eye contact."""
    g = timeline(spark, sf_dir).where("entry_type in ('object', 'emotion') and label % 2 = 0")
    return g.select("video_id", "seq", dec("t").alias("at_s"), F.when(F.col("conf") > 0.5, "camera").otherwise("away").alias("direction"), dec("conf").alias("eye_contact"))


@query("tl_scene", f"""WITH {TL_SQL}, c AS (SELECT video_id, seq, t, lead(t) OVER (PARTITION BY video_id ORDER BY t, seq) AS x FROM tl WHERE entry_type = 'scene_change')
SELECT video_id, seq, 'scene_change' AS kind, CAST(t AS DECIMAL(18,6)) AS start_s, CAST(NULL AS DECIMAL(18,6)) AS end_s FROM c UNION ALL SELECT video_id, seq, 'scene', CAST(t AS DECIMAL(18,6)), CAST(coalesce(x, {DURATION}) AS DECIMAL(18,6)) FROM c""")
def tl_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _of(spark, sf_dir, "scene_change").select("video_id", "seq", "t", F.lead("t", 1, float(DURATION)).over(_by_time()).alias("x"))
    change = c.select("video_id", "seq", F.lit("scene_change").alias("kind"), dec("t").alias("start_s"), F.lit(None).cast("decimal(18,6)").alias("end_s"))
    return change.unionByName(c.select("video_id", "seq", F.lit("scene").alias("kind"), dec("t").alias("start_s"), dec("x").alias("end_s")))


@query("map_gaze_override", f"""WITH {TL_SQL}, a AS (SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, max(conf) AS c FROM tl WHERE entry_type = 'object' GROUP BY ALL), b AS (SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, max(conf) AS c FROM tl WHERE entry_type = 'gesture' GROUP BY ALL)
SELECT coalesce(a.video_id, b.video_id) AS video_id, coalesce(a.sec, b.sec) AS sec, CAST(coalesce(b.c, a.c) AS DECIMAL(18,6)) AS eye_contact FROM a FULL JOIN b ON a.video_id = b.video_id AND a.sec = b.sec""")
def map_gaze_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda k, c: _of(spark, sf_dir, k).groupBy("video_id", F.floor("t").cast("long").alias("sec")).agg(F.max("conf").alias(c))
    return of("object", "detector").join(of("gesture", "entry"), ["video_id", "sec"], "full").select("video_id", "sec", dec(F.coalesce("entry", "detector")).alias("eye_contact"))


def _emotion_windows(spark: SparkSession, sf_dir: str, step: int) -> DataFrame:
    c = _of(spark, sf_dir, "emotion").groupBy("video_id", (F.floor(F.col("t") / step)).cast("long").alias("win"), "label").agg(F.count("*").alias("n"))
    return c.groupBy("video_id", "win").agg(F.min(F.struct((-F.col("n")).alias("m"), "label"))["label"].alias("mode_label"))


def _emotion_window_sql(step: int) -> str:
    return f"WITH {TL_SQL}, c AS (SELECT video_id, CAST(floor(t / {step}) AS BIGINT) AS win, label, count(*) AS n FROM tl WHERE entry_type = 'emotion' GROUP BY ALL) SELECT video_id, win, label AS mode_label FROM (SELECT *, row_number() OVER (PARTITION BY video_id, win ORDER BY n DESC, label) AS r FROM c) WHERE r = 1"


@query("agg_emotion_mode_window", _emotion_window_sql(5))
def agg_emotion_mode_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emotion_windows(spark, sf_dir, 5)


@query("bkt_n_windows_emotion", _emotion_window_sql(DURATION // 10))
def bkt_n_windows_emotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emotion_windows(spark, sf_dir, DURATION // 10)


@query("agg_emotion_stats", f"WITH {TL_SQL} SELECT video_id, CAST(avg(CASE WHEN entry_type = 'emotion' THEN 1.0 ELSE 0 END) AS DECIMAL(18,6)) AS success_rate, avg(CASE WHEN entry_type = 'emotion' THEN 0.0 ELSE 1 END) > 0.8 AS no_people FROM tl GROUP BY video_id")
def agg_emotion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes = F.avg((F.col("entry_type") == "emotion").cast("double"))
    no = F.avg((F.col("entry_type") != "emotion").cast("double"))
    return timeline(spark, sf_dir).groupBy("video_id").agg(dec(yes).alias("success_rate"), (no > 0.8).alias("no_people"))


_BOX_SQL = "b AS (SELECT l_suppkey AS video_id, l_orderkey * 8 + l_linenumber AS seq, l_partkey AS p, l_extendedprice AS x, CASE WHEN a > 25 THEN 'close' WHEN a > 8 THEN 'medium' WHEN a > 0 THEN 'wide' ELSE 'none' END AS shot, a FROM (SELECT *, l_quantity * l_discount * 10 AS a FROM lineitem))"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, seq, p, x, shot, a``: detection boxes with their area; (seq, p, x) tells ties apart."""
    a = (F.col("l_quantity") * F.col("l_discount") * 10).alias("a")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("video_id"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), F.col("l_partkey").alias("p"), F.col("l_extendedprice").alias("x"), a)
    return rows.withColumn("shot", face_shot(F.col("a")))


@query("agg_distance_dist", f"WITH {_BOX_SQL}, c AS (SELECT video_id, shot, count(*) AS n FROM b GROUP BY ALL) SELECT video_id, shot, CAST(n / sum(n) OVER (PARTITION BY video_id) AS DECIMAL(18,6)) AS share, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, shot) = 1 AS dominant FROM c")
def agg_distance_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("video_id")
    c = boxes(spark, sf_dir).groupBy("video_id", "shot").agg(F.count("*").alias("n"))
    return c.select("video_id", "shot", dec(F.col("n") / F.sum("n").over(w)).alias("share"), (F.row_number().over(w.orderBy(F.desc("n"), "shot")) == 1).alias("dominant"))


@query("agg_thirds", f"WITH {TL_SQL}, b AS (SELECT video_id, CASE WHEN t < {DURATION / 3} THEN 'first' WHEN t < {DURATION * 2 / 3} THEN 'second' ELSE 'third' END AS third FROM tl WHERE entry_type = 'object') SELECT video_id, third, count(*) AS n FROM b GROUP BY ALL")
def agg_thirds(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.when(F.col("t") < DURATION / 3, "first").when(F.col("t") < DURATION * 2 / 3, "second").otherwise("third")
    return _of(spark, sf_dir, "object").groupBy("video_id", third.alias("third")).agg(F.count("*").alias("n"))


@query("agg_detection_rate", f"WITH {TL_SQL} SELECT video_id, CAST(count(DISTINCT floor(t)) FILTER (entry_type = 'object') / {DURATION}.0 AS DECIMAL(18,6)) AS rate FROM tl GROUP BY video_id")
def agg_detection_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = F.countDistinct(F.when(F.col("entry_type") == "object", F.floor("t")))
    return timeline(spark, sf_dir).groupBy("video_id").agg(dec(seen / float(DURATION)).alias("rate"))


@query("agg_tempo_balance", f"{SHOT_SQL} SELECT video_id, CAST(coalesce(count(*) FILTER (t < {_HALF}) / nullif(count(*) FILTER (t >= {_HALF}), 0), 0) AS DECIMAL(18,6)) AS balance FROM shot GROUP BY video_id")
def agg_tempo_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = F.count_if(F.col("t") < _HALF)
    return shots(spark, sf_dir).groupBy("video_id").agg(dec(F.coalesce(F.try_divide(early, F.count("*") - early), F.lit(0.0))).alias("balance"))


@query("agg_visual_load", f"{SHOT_SQL}, s AS (SELECT video_id, count(*) AS shots FROM shot GROUP BY video_id), o AS (SELECT video_id, count(*) AS n FROM tl WHERE entry_type = 'object' GROUP BY video_id) SELECT s.video_id, CAST(coalesce(n, 0) / shots AS DECIMAL(18,6)) AS load FROM s LEFT JOIN o USING (video_id)")
def agg_visual_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shots(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("shots"))
    o = _of(spark, sf_dir, "object").groupBy("video_id").agg(F.count("*").alias("n"))
    return s.join(o, "video_id", "left").select("video_id", dec(F.coalesce("n", F.lit(0)) / F.col("shots")).alias("load"))


@query("agg_clarity_window", f"WITH {TL_SQL} SELECT video_id, CAST(floor(t / 5) AS BIGINT) AS win, CAST(avg(conf) AS DECIMAL(18,2)) AS clarity FROM tl WHERE entry_type = 'text' GROUP BY ALL")
def agg_clarity_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "text").groupBy("video_id", F.floor(F.col("t") / 5).cast("long").alias("win")).agg(dec(F.avg("conf"), 2).alias("clarity"))


@query("agg_speech_emphasis", f"WITH {SEG_SQL} SELECT video_id, count(*) AS segments, CAST(sum(words) AS BIGINT) AS words, CAST(sum(end_s - start_s) AS DECIMAL(18,4)) AS speech_s, CAST(coalesce(sum(words) / nullif(sum(end_s - start_s), 0), 0) AS DECIMAL(18,4)) AS words_per_s FROM seg GROUP BY video_id")
def agg_speech_emphasis(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.sum(F.col("end_s") - F.col("start_s"))
    return segments(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("segments"), big(F.sum("words")).alias("words"), dec(time, 4).alias("speech_s"), dec(F.coalesce(F.try_divide(F.sum("words"), time), F.lit(0.0)), 4).alias("words_per_s"))


@query("agg_label_summary", f"WITH {TL_SQL} SELECT label, CAST(avg(conf) AS DECIMAL(18,4)) AS mean_conf, count(*) AS n, array_to_string(list(CAST(seq AS VARCHAR) ORDER BY seq)[1:5], ',') AS first_frames FROM tl WHERE conf >= 0.3 GROUP BY label")
def agg_label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = timeline(spark, sf_dir).where("conf >= 0.3")
    first = top_k(t, 5, ["seq"], ["label"]).groupBy("label").agg(F.array_join(F.transform(F.array_sort(F.collect_list("seq")), lambda x: x.cast("string")), ",").alias("first_frames"))
    return t.groupBy("label").agg(dec(F.avg("conf"), 4).alias("mean_conf"), F.count("*").alias("n")).join(first, "label")


@query("agg_presence_pct", f"WITH {TL_SQL} SELECT video_id, CAST(count(*) FILTER (entry_type = 'gesture') * 100.0 / count(*) AS DECIMAL(18,4)) AS pose_pct FROM tl GROUP BY video_id")
def agg_presence_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).groupBy("video_id").agg(dec(F.count_if(F.col("entry_type") == "gesture") * 100.0 / F.count("*"), 4).alias("pose_pct"))


@query("win_momentum", f"WITH {TL_SQL}, v AS (SELECT video_id, t, seq, CASE WHEN label IN (0, 4) THEN 1 WHEN label = 6 THEN 0 ELSE -1 END AS v FROM tl WHERE entry_type = 'emotion'), d AS (SELECT video_id, v - lag(v) OVER (PARTITION BY video_id ORDER BY t, seq) AS d FROM v) SELECT video_id, CAST(avg(d) AS DECIMAL(18,4)) AS momentum, max(d) AS rise, min(d) AS fall FROM d WHERE d IS NOT NULL GROUP BY video_id")
def win_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _of(spark, sf_dir, "emotion").withColumn("v", F.when(F.col("label").isin(0, 4), 1).when(F.col("label") == 6, 0).otherwise(-1))
    d = v.select("video_id", (F.col("v") - F.lag("v").over(_by_time())).alias("d")).where("d is not null")
    return d.groupBy("video_id").agg(dec(F.avg("d"), 4).alias("momentum"), F.max("d").alias("rise"), F.min("d").alias("fall"))


@query("win_islands_valence", f"""WITH {TL_SQL}, e AS (SELECT video_id, t, seq, label IN (1, 2, 3, 5) AS low, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) AS i FROM tl WHERE entry_type = 'emotion'), g AS (SELECT *, i - row_number() OVER (PARTITION BY video_id ORDER BY i) AS g FROM e WHERE low)
SELECT video_id, CAST(min(t) AS DECIMAL(18,6)) AS start_s, CAST(max(t) AS DECIMAL(18,6)) AS end_s, count(*) AS n FROM g GROUP BY video_id, g HAVING count(*) >= 2""")
def win_islands_valence(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _of(spark, sf_dir, "emotion").withColumn("i", F.row_number().over(_by_time())).where(F.col("label").isin(1, 2, 3, 5))
    g = e.withColumn("g", F.col("i") - F.row_number().over(Window.partitionBy("video_id").orderBy("i")))
    return g.groupBy("video_id", "g").agg(dec(F.min("t")).alias("start_s"), dec(F.max("t")).alias("end_s"), F.count("*").alias("n")).where("n >= 2").drop("g")


@query("win_emotion_trajectory", f"""WITH {TL_SQL}, e AS (SELECT video_id, label IN (0, 4) AS up, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) AS i, count(*) OVER (PARTITION BY video_id) AS c FROM tl WHERE entry_type = 'emotion')
SELECT video_id, count(*) FILTER (up AND i <= c // 3) AS early, count(*) FILTER (up AND i > c - (c + 2) // 3) AS late FROM e GROUP BY video_id""")
def win_emotion_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _of(spark, sf_dir, "emotion").select("video_id", F.col("label").isin(0, 4).alias("up"), F.row_number().over(_by_time()).alias("i"), F.count("*").over(Window.partitionBy("video_id")).alias("c"))
    return e.groupBy("video_id").agg(F.count_if(F.expr("up and i <= c div 3")).alias("early"), F.count_if(F.expr("up and i > c - (c + 2) div 3")).alias("late"))


@query("flt_resolution", f"WITH {TL_SQL}, e AS (SELECT video_id, t, seq, label, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) AS i, count(*) OVER (PARTITION BY video_id) AS c FROM tl WHERE entry_type = 'emotion'), r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) AS k FROM e WHERE c >= 5 AND i > floor(0.8 * c) AND label IN (0, 6)) SELECT video_id, CAST(t AS DECIMAL(18,6)) AS at_s, label FROM r WHERE k = 1")
def flt_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _of(spark, sf_dir, "emotion").select("video_id", "t", "seq", "label", F.row_number().over(_by_time()).alias("i"), F.count("*").over(Window.partitionBy("video_id")).alias("c"))
    return first_by(e.where("c >= 5 and i > floor(0.8 * c) and label in (0, 6)"), ["video_id"], ["t", "seq"]).select("video_id", dec("t").alias("at_s"), "label")


@query("agg_overlay_accel", f"{DENS_SQL}, w AS (SELECT video_id, avg(n) FILTER (sec < {DURATION // 2}) AS a, avg(n) FILTER (sec >= {DURATION // 2}) AS b FROM dens GROUP BY video_id) SELECT video_id, CASE WHEN b > 1.3 * a THEN 'accelerating' WHEN b < 0.7 * a THEN 'decelerating' ELSE 'even' END AS pattern FROM w")
def agg_overlay_accel(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda c, n: F.avg(F.when(F.expr(c), F.col("n"))).alias(n)
    w = density(spark, sf_dir).groupBy("video_id").agg(part(f"sec < {DURATION // 2}", "a"), part(f"sec >= {DURATION // 2}", "b"))
    return w.select("video_id", F.when(F.expr("b > 1.3 * a"), "accelerating").when(F.expr("b < 0.7 * a"), "decelerating").otherwise("even").alias("pattern"))


@query("win_overlay_peaks", f"{DENS_SQL}, w AS (SELECT video_id, CAST(sec // 3 AS BIGINT) AS win, CAST(sum(n) AS BIGINT) AS n FROM dens GROUP BY ALL), m AS (SELECT *, avg(n) OVER (PARTITION BY video_id) AS a, max(n) OVER (PARTITION BY video_id) AS x FROM w) SELECT video_id, win, n, CAST(n / x AS DECIMAL(18,6)) AS intensity FROM m WHERE n > 1.5 * a AND n > 0")
def win_overlay_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = Window.partitionBy("video_id")
    w = density(spark, sf_dir).groupBy("video_id", F.expr("cast(sec div 3 as bigint)").alias("win")).agg(F.sum("n").alias("n"))
    m = w.select("*", F.avg("n").over(whole).alias("a"), F.max("n").over(whole).alias("x")).where("n > 1.5 * a and n > 0")
    return m.select("video_id", "win", "n", dec(F.col("n") / F.col("x")).alias("intensity"))


@query("agg_burst_intervals", f"WITH {TL_SQL}, g AS (SELECT video_id, t - lag(t) OVER (PARTITION BY video_id ORDER BY t, seq) AS g FROM tl WHERE entry_type = 'text') SELECT video_id, count(*) FILTER (g < 2) AS bursts FROM g GROUP BY video_id")
def agg_burst_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _of(spark, sf_dir, "text").select("video_id", (F.col("t") - F.lag("t").over(_by_time())).alias("g"))
    return g.groupBy("video_id").agg(F.count_if(F.coalesce(F.col("g") < 2, F.lit(False))).alias("bursts"))


@query("agg_early_late", f"WITH {TL_SQL} SELECT video_id, CAST(count(*) FILTER (t < {DURATION / 3}) / {DURATION / 3} AS DECIMAL(18,6)) AS early, CAST(count(*) FILTER (t >= {DURATION * 2 / 3}) / {DURATION / 3} AS DECIMAL(18,6)) AS late FROM tl WHERE entry_type = 'text' GROUP BY video_id")
def agg_early_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda c: dec(F.count_if(c) / (DURATION / 3))
    return _of(spark, sf_dir, "text").groupBy("video_id").agg(n(F.col("t") < DURATION / 3).alias("early"), n(F.col("t") >= DURATION * 2 / 3).alias("late"))


@query("flt_energy_burst", f"{DENS_SQL}, w AS (SELECT video_id, CAST(sec // 5 AS BIGINT) AS win, avg(n) AS e FROM dens GROUP BY ALL), m AS (SELECT *, max(e) OVER (PARTITION BY video_id) AS x FROM w) SELECT video_id, win * 5 AS start_s, win * 5 + 5 AS end_s FROM m WHERE x > 0 AND e / x > 0.9")
def flt_energy_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = density(spark, sf_dir).groupBy("video_id", F.expr("cast(sec div 5 as bigint)").alias("win")).agg(F.avg("n").alias("e"))
    m = w.withColumn("x", F.max("e").over(Window.partitionBy("video_id"))).where("x > 0 and e / x > 0.9")
    return m.select("video_id", (F.col("win") * 5).alias("start_s"), (F.col("win") * 5 + 5).alias("end_s"))


@query("agg_zone_shots", f"{SHOT_SQL}, c AS (SELECT video_id, floor(t / 10) AS z, count(*) AS n FROM shot GROUP BY ALL), d AS (SELECT video_id, z FROM (SELECT *, max(n) OVER (PARTITION BY video_id) AS m FROM c) WHERE n >= 0.8 * m) SELECT s.video_id, CAST(avg(s.d) AS DECIMAL(18,6)) AS mean_s FROM shot s JOIN d ON d.video_id = s.video_id AND d.z = floor(s.t / 10) GROUP BY s.video_id")
def agg_zone_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = shots(spark, sf_dir).groupBy("video_id", F.floor(F.col("t") / 10).alias("z")).agg(F.count("*").alias("n"), F.sum("d").alias("s"))
    dense = zones.withColumn("m", F.max("n").over(Window.partitionBy("video_id"))).where("n >= 0.8 * m")
    return dense.groupBy("video_id").agg(dec(F.sum("s") / F.sum("n")).alias("mean_s"))


@query("agg_pacing_quality", f"{SHOT_SQL} SELECT video_id, CAST(least(1, count(*) / ({DURATION} / 2.0)) AS DECIMAL(18,6)) AS quality FROM shot GROUP BY video_id")
def agg_pacing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shots(spark, sf_dir).groupBy("video_id").agg(dec(F.least(F.lit(1.0), F.count("*") / (DURATION / 2.0))).alias("quality"))


@query("smp_adaptive_thirds", f"""WITH {TL_SQL}, n AS (SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) AS i, count(*) OVER (PARTITION BY video_id) AS c FROM tl) SELECT video_id, seq FROM n WHERE i <= 3 OR i > c - 3 OR (i > c // 3 AND i <= 2 * (c // 3) AND i % 4 = 0)""")
def smp_adaptive_thirds(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = timeline(spark, sf_dir).select("video_id", "seq", F.row_number().over(_by_time()).alias("i"), F.count("*").over(Window.partitionBy("video_id")).alias("c"))
    return n.where("i <= 3 or i > c - 3 or (i > c div 3 and i <= 2 * (c div 3) and i % 4 = 0)").select("video_id", "seq")


@query("sort_stable", f"WITH {TL_SQL} SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY floor(t), seq) AS place FROM tl")
def sort_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).select("video_id", "seq", F.row_number().over(Window.partitionBy("video_id").orderBy(F.floor("t"), "seq")).cast("long").alias("place"))


@query("prj_keyframe", f"{SHOT_SQL} SELECT video_id, seq, CAST(floor((floor(t * 30) + floor((t + d) * 30)) / 2) AS BIGINT) AS frame FROM shot")
def prj_keyframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shots(spark, sf_dir).select("video_id", "seq", F.floor((F.floor(F.col("t") * 30) + F.floor((F.col("t") + F.col("d")) * 30)) / 2).cast("long").alias("frame"))


@query("txt_mumble", f"WITH {TL_SQL} SELECT video_id, seq FROM tl WHERE entry_type = 'text' AND coalesce(conf, 1) < 0.6")
def txt_mumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "text").where("coalesce(conf, 1) < 0.6").select("video_id", "seq")


@query("txt_sentiment_kw", "SELECT conv_id, turn, CASE WHEN regexp_matches(lower(text), 'love|great|happy|amazing') THEN 'positive' WHEN regexp_matches(lower(text), 'hate|bad|sad|terrible') THEN 'negative' ELSE 'neutral' END AS sentiment FROM conversations")
def txt_sentiment_kw(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.lower("text")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(low.rlike("love|great|happy|amazing"), "positive").when(low.rlike("hate|bad|sad|terrible"), "negative").otherwise("neutral").alias("sentiment"))


@query("cls_emotion_arc", f"""WITH {TL_SQL}, v AS (SELECT video_id, t, CASE WHEN label IN (0, 4) THEN 1 WHEN label = 6 THEN 0 ELSE -1 END AS v FROM tl WHERE entry_type = 'emotion'), a AS (SELECT video_id, avg(v) FILTER (t < {DURATION / 3}) AS a, avg(v) FILTER (t >= {DURATION * 2 / 3}) AS z, coalesce(stddev_samp(v), 0) AS s FROM v GROUP BY video_id)
SELECT video_id, CASE WHEN z - a > 0.3 THEN 'rising' WHEN z - a < -0.3 THEN 'falling' WHEN s > 0.5 THEN 'dynamic' ELSE 'stable' END AS arc FROM a""")
def cls_emotion_arc(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _of(spark, sf_dir, "emotion").withColumn("v", F.when(F.col("label").isin(0, 4), 1).when(F.col("label") == 6, 0).otherwise(-1))
    part = lambda c: F.avg(F.when(F.expr(c), F.col("v")))
    a = v.groupBy("video_id").agg(part(f"t < {DURATION / 3}").alias("a"), part(f"t >= {DURATION * 2 / 3}").alias("z"), F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("s"))
    return a.select("video_id", F.when(F.expr("z - a > 0.3"), "rising").when(F.expr("z - a < -0.3"), "falling").when(F.expr("s > 0.5"), "dynamic").otherwise("stable").alias("arc"))


@query("jsn_keys", "SELECT event_id, array_to_string(json_keys(props), ',') AS keys FROM events")
def jsn_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.json_object_keys("props"), ",").alias("keys"))


# --- validation, comparison, logs ---------------------------------------------------------------------------------


@query("val_input", f"WITH {SEG_SQL} SELECT video_id, seq, array_to_string(list_filter([CASE WHEN end_s < start_s THEN 'reversed' END, CASE WHEN end_s > 3600 THEN 'too_long' END, CASE WHEN start_s < 0 THEN 'negative' END, CASE WHEN words = 0 THEN 'no_words' END], lambda x: x IS NOT NULL), ',') AS violations FROM seg")
def val_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).select("video_id", "seq", F.array_join(violations(reversed="end_s < start_s", too_long="end_s > 3600", negative="start_s < 0", no_words="words = 0"), ",").alias("violations"))


def violations(**rules: str) -> F.Column:
    """The names of the rules that hold for a row."""
    return F.array_compact(F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in rules.items()]))


@query("val_emotion", f"WITH {TL_SQL} SELECT video_id, seq, conf BETWEEN 0 AND 1 AND label BETWEEN 0 AND {len(EMOTIONS) - 1} AS valid FROM tl WHERE entry_type = 'emotion'")
def val_emotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of(spark, sf_dir, "emotion").select("video_id", "seq", (F.col("conf").between(0, 1) & F.col("label").between(0, len(EMOTIONS) - 1)).alias("valid"))


@query("val_scene", f"""WITH {TL_SQL}, s AS (SELECT video_id, seq, t AS a, lead(t) OVER (PARTITION BY video_id ORDER BY t, seq) - CASE WHEN seq % 5 = 0 THEN 0.5 ELSE 0 END AS b FROM tl WHERE entry_type = 'scene_change'), l AS (SELECT *, lag(b) OVER (PARTITION BY video_id ORDER BY a, seq) AS p FROM s) SELECT video_id, seq FROM l WHERE abs(a - p) > 0.01""")
def val_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes that leave a gap after the one before them, or overlap it."""
    s = _of(spark, sf_dir, "scene_change").select("video_id", "seq", F.col("t").alias("a"), (F.lead("t").over(_by_time()) - F.when(F.col("seq") % 5 == 0, 0.5).otherwise(0.0)).alias("b"))
    return s.withColumn("p", F.lag("b").over(Window.partitionBy("video_id").orderBy("a", "seq"))).where("abs(a - p) > 0.01").select("video_id", "seq")


@query("val_quality_limits", "SELECT page_id FROM pages WHERE length(html) BETWEEN 500 AND 20000")
def val_quality_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").where(F.char_length("html").between(500, 20000)).select("page_id")


@query("cmp_tolerance", """WITH x AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS e, l_extendedprice * (1 + l_discount * 2) AS a FROM lineitem) SELECT l_orderkey, l_linenumber, CASE WHEN a = e THEN 'exact' WHEN abs(a - e) / abs(e) <= 0.1501 THEN 'within' ELSE 'outside' END AS status FROM x""")
def cmp_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, a = F.col("l_extendedprice"), F.col("l_extendedprice") * (1 + F.col("l_discount") * 2)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(a == e, "exact").when(F.abs(a - e) / F.abs(e) <= 0.1501, "within").otherwise("outside").alias("status"))


@query("agg_golden_stats", """WITH x AS (SELECT l_suppkey, CASE WHEN l_discount = 0 THEN 'exact' WHEN l_discount * 2 <= 0.1501 THEN 'within' ELSE 'outside' END AS s FROM lineitem) SELECT l_suppkey, count(*) FILTER (s = 'exact') AS exact, count(*) FILTER (s = 'within') AS within, count(*) FILTER (s = 'outside') AS outside, CASE WHEN count(*) FILTER (s <> 'outside') / count(*) >= 0.9 THEN 'pass' WHEN count(*) FILTER (s <> 'outside') / count(*) >= 0.75 THEN 'review' ELSE 'fail' END AS verdict FROM x GROUP BY l_suppkey""")
def agg_golden_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("l_discount")
    x = table(spark, sf_dir, "lineitem").select("l_suppkey", F.when(d == 0, "exact").when(d * 2 <= 0.1501, "within").otherwise("outside").alias("s"))
    n = lambda k: F.count_if(F.col("s") == k)
    rate = F.count_if(F.col("s") != "outside") / F.count("*")
    return x.groupBy("l_suppkey").agg(n("exact").alias("exact"), n("within").alias("within"), n("outside").alias("outside"), F.when(rate >= 0.9, "pass").when(rate >= 0.75, "review").otherwise("fail").alias("verdict"))


@query("cmp_curve", f"{DENS_SQL}, p AS (SELECT a.video_id, a.sec, a.n - b.n AS d FROM dens a JOIN dens b ON b.video_id = a.video_id + 1 AND a.sec = b.sec) SELECT video_id, CAST(avg(d) AS DECIMAL(18,6)) AS mean_difference, max(abs(d)) AS most FROM p GROUP BY video_id")
def cmp_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = density(spark, sf_dir)
    b = a.select((F.col("video_id") - 1).alias("video_id"), "sec", F.col("n").alias("m"))
    return a.join(b, ["video_id", "sec"]).groupBy("video_id").agg(dec(F.avg(F.col("n") - F.col("m"))).alias("mean_difference"), F.max(F.abs(F.col("n") - F.col("m"))).alias("most"))


@query("agg_error_types", "SELECT event_type AS error_type, count(*) AS n, count(DISTINCT user_id) AS items FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY event_type")
def agg_error_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the last seven days."""
    return table(spark, sf_dir, "events").where(F.col("ts") >= F.lit("2024-01-24 00:00:00").cast("timestamp_ntz")).groupBy(F.col("event_type").alias("error_type")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("items"))


@query("log_patterns", "SELECT user_id, list_filter([CASE WHEN count(*) FILTER (event_type = 'error') > 3 THEN 'contract' END, CASE WHEN count(*) FILTER (event_type = 'purchase') > 5 THEN 'timeout' END], lambda x: x IS NOT NULL) <> [] AS flagged FROM events GROUP BY user_id")
def log_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda k: F.count_if(F.col("event_type") == k)
    return table(spark, sf_dir, "events").groupBy("user_id").agg(((n("error") > 3) | (n("purchase") > 5)).alias("flagged"))


@query("agg_run_metrics", "SELECT o_orderstatus AS model, CAST(avg(o_totalprice) AS DECIMAL(18,2)) AS mean_time, count(*) AS runs FROM orders GROUP BY o_orderstatus")
def agg_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("model")).agg(dec(F.avg("o_totalprice"), 2).alias("mean_time"), F.count("*").alias("runs"))
