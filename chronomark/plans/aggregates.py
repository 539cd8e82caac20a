"""Density and per-item statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.functions.stats import count_where
from chronomark.operators.timeline import first_by, spine, top_k
from chronomark.plans._base import big, dec, query
from chronomark.sources.testdata import DURATION, SEG_SQL, TL_SQL, segments, timeline

#: Seconds of every item with the number of entries that begin in them.
DENS_SQL = f"""WITH {TL_SQL}, vids AS (SELECT DISTINCT video_id FROM tl), spine AS (SELECT video_id, sec FROM vids CROSS JOIN range({DURATION}) s(sec)),
dens AS (SELECT s.video_id, s.sec, count(t.seq) AS n FROM spine s LEFT JOIN tl t ON t.video_id = s.video_id AND floor(t.t) = s.sec GROUP BY ALL)"""


def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, sec, n`` over the dense spine."""
    tl = timeline(spark, sf_dir)
    counts = tl.groupBy("video_id", F.floor("t").cast("int").alias("sec")).agg(F.count("*").alias("n"))
    seconds = spine(counts.select("video_id").distinct(), DURATION)
    return seconds.join(counts, ["video_id", "sec"], "left").select("video_id", "sec", F.coalesce("n", F.lit(0)).alias("n"))


@query("agg_density_core", f"""{DENS_SQL} SELECT video_id, CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) / {DURATION}.0 AS DECIMAL(18,6)) AS mean_density, max(n) AS max_density, min(n) AS min_density, CAST(stddev_pop(n) AS DECIMAL(18,6)) AS std_density FROM dens GROUP BY video_id""")
def agg_density_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir).groupBy("video_id").agg(F.sum("n").alias("total"), dec(F.sum("n") / float(DURATION)).alias("mean_density"), F.max("n").alias("max_density"), F.min("n").alias("min_density"), dec(F.stddev_pop("n")).alias("std_density"))


@query("agg_coverage", f"""{DENS_SQL} SELECT video_id, CAST(count(*) FILTER (n > 0) / {DURATION}.0 AS DECIMAL(18,6)) AS coverage FROM dens GROUP BY video_id""")
def agg_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir).groupBy("video_id").agg(dec(F.count_if(F.col("n") > 0) / float(DURATION)).alias("coverage"))


@query("agg_element_counts", f"WITH {TL_SQL} SELECT video_id, entry_type, count(*) AS n FROM tl GROUP BY ALL")
def agg_element_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).groupBy("video_id", "entry_type").agg(F.count("*").alias("n"))


@query("tl_summary", f"WITH {TL_SQL} SELECT entry_type, count(*) AS n, count(DISTINCT video_id) AS videos FROM tl GROUP BY ALL")
def tl_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).groupBy("entry_type").agg(F.count("*").alias("n"), F.countDistinct("video_id").alias("videos"))


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted set of the kinds that begin in a second."""
    return timeline(spark, sf_dir).groupBy("video_id", F.floor("t").cast("long").alias("sec")).agg(F.array_sort(F.collect_set("entry_type")).alias("kinds"))


def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.flatten(F.transform("kinds", lambda a, i: F.transform(F.slice("kinds", i + 2, F.size("kinds")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return _active(spark, sf_dir).select("video_id", F.explode(pairs).alias("p")).groupBy("video_id", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n"))


_PAIRS_SQL = f"""WITH {TL_SQL}, act AS (SELECT DISTINCT video_id, CAST(floor(t) AS BIGINT) AS sec, entry_type FROM tl),
pairs AS (SELECT x.video_id, x.entry_type AS a, y.entry_type AS b, count(*) AS n FROM act x JOIN act y ON x.video_id = y.video_id AND x.sec = y.sec AND x.entry_type < y.entry_type GROUP BY ALL)"""


@query("agg_cooccurrence", f"{_PAIRS_SQL} SELECT * FROM pairs")
def agg_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cooccurrence(spark, sf_dir)


@query("agg_dominant_pair", f"{_PAIRS_SQL} SELECT video_id, a, b, n FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, a, b) AS r FROM pairs) WHERE r = 1")
def agg_dominant_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_by(cooccurrence(spark, sf_dir), ["video_id"], [F.desc("n"), "a", "b"])


@query("agg_multimodal", f"""WITH {TL_SQL}, k AS (SELECT video_id, floor(t) AS sec, count(DISTINCT entry_type) AS kinds FROM tl GROUP BY ALL)
SELECT video_id, count(*) FILTER (kinds >= 3) AS multimodal, count(*) FILTER (kinds >= 4) AS reinforcing FROM k GROUP BY video_id""")
def agg_multimodal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _active(spark, sf_dir).groupBy("video_id").agg(F.count_if(F.size("kinds") >= 3).alias("multimodal"), F.count_if(F.size("kinds") >= 4).alias("reinforcing"))


@query("agg_primary_element", f"""WITH {TL_SQL}, k AS (SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, entry_type, count(*) AS n FROM tl GROUP BY ALL)
SELECT video_id, sec, entry_type AS primary_element, n FROM (SELECT *, row_number() OVER (PARTITION BY video_id, sec ORDER BY n DESC, entry_type) AS r FROM k) WHERE r = 1""")
def agg_primary_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = timeline(spark, sf_dir).groupBy("video_id", F.floor("t").cast("long").alias("sec"), "entry_type").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("entry_type").alias("primary_element"))).alias("x")
    return counts.groupBy("video_id", "sec").agg(best).select("video_id", "sec", "x.primary_element", (-F.col("x.m")).alias("n"))


@query("agg_emotion_core", f"""WITH {TL_SQL}, e AS (SELECT *, lag(label) OVER (PARTITION BY video_id ORDER BY t, seq) AS prev FROM tl WHERE entry_type = 'emotion'),
c AS (SELECT video_id, label, count(*) AS n FROM e GROUP BY ALL), d AS (SELECT video_id, label AS dominant FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, label) AS r FROM c) WHERE r = 1)
SELECT e.video_id, count(DISTINCT e.label) AS unique_emotions, any_value(d.dominant) AS dominant, count(*) FILTER (e.prev <> e.label) AS transitions,
  CAST((count(DISTINCT e.label) - 1) / 6.0 AS DECIMAL(18,6)) AS diversity, CAST(avg(e.conf) AS DECIMAL(18,3)) AS intensity FROM e JOIN d USING (video_id) GROUP BY e.video_id""")
def agg_emotion_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("video_id").orderBy("t", "seq")
    e = timeline(spark, sf_dir).where("entry_type = 'emotion'").withColumn("prev", F.lag("label").over(w))
    counts = e.groupBy("video_id", "label").agg(F.count("*").alias("n"), F.sum("conf").alias("s"), count_where(F.col("prev") != F.col("label")).alias("c"))
    return counts.groupBy("video_id").agg(
        F.count("*").alias("unique_emotions"), F.min(F.struct((-F.col("n")).alias("m"), F.col("label").alias("label")))["label"].alias("dominant"), F.sum("c").alias("transitions"),
        dec((F.count("*") - 1) / 6.0).alias("diversity"), dec(F.sum("s") / F.sum("n"), 3).alias("intensity"),
    )


@query("agg_transition_matrix", f"""WITH {TL_SQL}, e AS (SELECT video_id, label, lead(label) OVER (PARTITION BY video_id ORDER BY t, seq) AS nxt FROM tl WHERE entry_type = 'emotion'),
m AS (SELECT video_id, label AS from_label, nxt AS to_label, count(*) AS n FROM e WHERE nxt IS NOT NULL GROUP BY ALL)
SELECT *, CAST(n / sum(n) OVER (PARTITION BY video_id) AS DECIMAL(18,6)) AS share FROM m""")
def agg_transition_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("video_id").orderBy("t", "seq")
    e = timeline(spark, sf_dir).where("entry_type = 'emotion'").select("video_id", F.col("label").alias("from_label"), F.lead("label").over(w).alias("to_label"))
    m = e.where("to_label is not null").groupBy("video_id", "from_label", "to_label").agg(F.count("*").alias("n"))
    return m.withColumn("share", dec(F.col("n") / F.sum("n").over(Window.partitionBy("video_id"))))


@query("agg_entropy", f"""WITH {TL_SQL}, c AS (SELECT video_id, label, count(*) AS n FROM tl WHERE entry_type = 'emotion' GROUP BY ALL), p AS (SELECT video_id, n / sum(n) OVER (PARTITION BY video_id) AS p FROM c)
SELECT video_id, CAST(CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) ELSE 0 END AS DECIMAL(18,6)) AS entropy FROM p GROUP BY video_id""")
def agg_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = timeline(spark, sf_dir).where("entry_type = 'emotion'").groupBy("video_id", "label").agg(F.count("*").alias("n"))
    p = c.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("video_id")))
    value = F.try_divide(-F.sum(F.col("p") * F.ln("p")), F.ln(F.count("*")))
    return p.groupBy("video_id").agg(dec(F.when(F.count("*") > 1, value).otherwise(0.0)).alias("entropy"))


@query("agg_au_top5", f"""WITH {TL_SQL}, c AS (SELECT video_id, label AS unit, count(*) AS n FROM tl WHERE entry_type = 'emotion' GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, unit) AS rank FROM c) WHERE rank <= 5""")
def agg_au_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = timeline(spark, sf_dir).where("entry_type = 'emotion'").groupBy("video_id", F.col("label").alias("unit")).agg(F.count("*").alias("n"))
    return top_k(c, 5, [F.desc("n"), "unit"])


@query("agg_object_top", f"""WITH {TL_SQL}, c AS (SELECT video_id, label, min(t) AS first_t, count(*) AS n FROM tl WHERE entry_type = 'object' GROUP BY ALL)
SELECT video_id, label, CAST(first_t AS DECIMAL(18,6)) AS first_seen, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, first_t, label) AS rank FROM c) WHERE rank <= 5""")
def agg_object_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = timeline(spark, sf_dir).where("entry_type = 'object'").groupBy("video_id", "label").agg(F.min("t").alias("first_t"), F.count("*").alias("n"))
    return top_k(c, 5, [F.desc("n"), "first_t", "label"]).select("video_id", "label", dec("first_t").alias("first_seen"), "n", "rank")


@query("agg_gesture_ratio", f"""WITH {TL_SQL} SELECT video_id, CAST(coalesce(count(*) FILTER (entry_type = 'gesture') / nullif(count(*) FILTER (entry_type = 'text'), 0), 0) AS DECIMAL(18,6)) AS ratio FROM tl WHERE t <= 5 GROUP BY video_id""")
def agg_gesture_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda k: F.count_if(F.col("entry_type") == k)
    return timeline(spark, sf_dir).where("t <= 5").groupBy("video_id").agg(dec(F.coalesce(F.try_divide(of("gesture"), of("text")), F.lit(0.0))).alias("ratio"))


WEIGHT_SQL = "CASE entry_type WHEN 'text' THEN 3 WHEN 'scene_change' THEN 2 WHEN 'speech' THEN 1.5 ELSE 1 END"


def weighted_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = F.when(F.col("entry_type") == "text", 3.0).when(F.col("entry_type") == "scene_change", 2.0).when(F.col("entry_type") == "speech", 1.5).otherwise(1.0)
    tl = timeline(spark, sf_dir)
    sums = tl.groupBy("video_id", F.floor("t").cast("int").alias("sec")).agg(F.sum(weight).alias("w"))
    return spine(sums.select("video_id").distinct(), DURATION).join(sums, ["video_id", "sec"], "left").select("video_id", "sec", F.coalesce("w", F.lit(0.0)).alias("activity"))


ACT_SQL = f"""WITH {TL_SQL}, vids AS (SELECT DISTINCT video_id FROM tl), spine AS (SELECT video_id, sec FROM vids CROSS JOIN range({DURATION}) s(sec)),
act AS (SELECT s.video_id, s.sec, CAST(coalesce(sum({WEIGHT_SQL}) FILTER (t.seq IS NOT NULL), 0) AS DOUBLE) AS activity FROM spine s LEFT JOIN tl t ON t.video_id = s.video_id AND floor(t.t) = s.sec GROUP BY ALL)"""


@query("agg_activity_weighted", f"{ACT_SQL} SELECT video_id, CAST(sec AS BIGINT) AS sec, CAST(activity AS DECIMAL(18,6)) AS activity FROM act")
def agg_activity_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_activity(spark, sf_dir).select("video_id", big("sec").alias("sec"), dec("activity").alias("activity"))


@query("agg_halves", f"""{DENS_SQL} SELECT video_id, CAST(coalesce(sum(n) FILTER (sec >= {DURATION // 2}) / nullif(sum(n) FILTER (sec < {DURATION // 2}), 0), 0) AS DECIMAL(18,6)) AS acceleration FROM dens GROUP BY video_id""")
def agg_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return density(spark, sf_dir).groupBy("video_id").agg(dec(F.coalesce(F.try_divide(part(F.col("sec") >= DURATION // 2), part(F.col("sec") < DURATION // 2)), F.lit(0.0))).alias("acceleration"))


@query("agg_intro_outro", f"""WITH {TL_SQL} SELECT video_id, count(*) FILTER (t < 3) AS intro, count(*) FILTER (t >= {DURATION - 3}) AS outro FROM tl GROUP BY video_id""")
def agg_intro_outro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).groupBy("video_id").agg(F.count_if(F.col("t") < 3).alias("intro"), F.count_if(F.col("t") >= DURATION - 3).alias("outro"))


_SPEECH = f"WITH {SEG_SQL}"


@query("agg_speech_core", f"""{_SPEECH}, w AS (SELECT conv_id AS video_id, lower(w) AS w FROM (SELECT conv_id, unnest(regexp_extract_all(coalesce(text, ''), '[^ \\n\\t\\r]+')) AS w FROM conversations)),
u AS (SELECT video_id, count(DISTINCT w) AS distinct_words FROM w GROUP BY video_id)
SELECT s.video_id, CAST(sum(words) AS BIGINT) AS words, coalesce(any_value(u.distinct_words), 0) AS distinct_words, CAST(sum(end_s - start_s) AS DECIMAL(18,4)) AS speech_s, CAST(max(end_s) AS DECIMAL(18,4)) AS last_s
FROM seg s LEFT JOIN u USING (video_id) GROUP BY s.video_id""")
def agg_speech_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = segments(spark, sf_dir)
    tokens = F.flatten(F.collect_list(F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\n\\t\\r]+"), lambda w: w != "")))
    distinct = F.size(F.array_distinct(F.transform(tokens, F.lower))).cast("long")
    return s.groupBy("video_id").agg(big(F.sum("words")).alias("words"), distinct.alias("distinct_words"), dec(F.sum(F.col("end_s") - F.col("start_s")), 4).alias("speech_s"), dec(F.max("end_s"), 4).alias("last_s"))


@query("agg_segment_stats", f"""{_SPEECH} SELECT video_id, CAST(avg(end_s - start_s) AS DECIMAL(18,4)) AS mean_s, CAST(max(end_s - start_s) AS DECIMAL(18,4)) AS max_s, CAST(min(end_s - start_s) AS DECIMAL(18,4)) AS min_s, CAST(avg(words) AS DECIMAL(18,4)) AS mean_words FROM seg GROUP BY video_id""")
def agg_segment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("end_s") - F.col("start_s")
    return segments(spark, sf_dir).groupBy("video_id").agg(dec(F.avg(n), 4).alias("mean_s"), dec(F.max(n), 4).alias("max_s"), dec(F.min(n), 4).alias("min_s"), dec(F.avg("words"), 4).alias("mean_words"))


@query("agg_front_load", f"""{_SPEECH}, d AS (SELECT video_id, max(end_s) AS last_s FROM seg GROUP BY video_id)
SELECT video_id, CAST(coalesce(sum(words) FILTER (start_s < last_s * 0.2) / nullif(sum(words), 0), 0) AS DECIMAL(18,6)) AS front_load FROM seg JOIN d USING (video_id) GROUP BY video_id""")
def agg_front_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = segments(spark, sf_dir).withColumn("last_s", F.max("end_s").over(Window.partitionBy("video_id")))
    early = F.sum(F.when(F.col("start_s") < F.col("last_s") * 0.2, F.col("words")).otherwise(0))
    return s.groupBy("video_id").agg(dec(F.coalesce(F.try_divide(early, F.sum("words")), F.lit(0.0))).alias("front_load"))


@query("agg_energy_norm", f"""{DENS_SQL}, w AS (SELECT video_id, sec // 5 AS win, avg(n) AS energy FROM dens GROUP BY ALL), p AS (SELECT video_id, quantile_cont(energy, 0.95) AS p95, max(energy) AS top FROM w GROUP BY video_id)
SELECT video_id, CAST(win AS BIGINT) AS win, CAST(CASE WHEN p95 > 0 THEN least(energy / p95, 1) ELSE 0 END AS DECIMAL(18,6)) AS energy FROM w JOIN p USING (video_id)""")
def agg_energy_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = density(spark, sf_dir).groupBy("video_id", F.expr("sec div 5").alias("win")).agg(F.avg("n").alias("e"))
    p = F.percentile("e", F.lit(0.95)).over(Window.partitionBy("video_id"))
    return w.withColumn("p", p).select("video_id", big("win").alias("win"), dec(F.when(F.col("p") > 0, F.least(F.col("e") / F.col("p"), F.lit(1.0))).otherwise(0.0)).alias("energy"))


@query("agg_track_mean_conf", f"""WITH {TL_SQL}, tr AS (SELECT video_id, label AS track, avg(conf) AS c, max(t) - min(t) AS d FROM tl WHERE entry_type = 'object' GROUP BY ALL)
SELECT track, count(*) AS tracks, CAST(avg(c) AS DECIMAL(18,6)) AS mean_conf, CAST(avg(d) AS DECIMAL(18,6)) AS mean_duration FROM tr GROUP BY track""")
def agg_track_mean_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    tr = timeline(spark, sf_dir).where("entry_type = 'object'").groupBy("video_id", F.col("label").alias("track")).agg(F.avg("conf").alias("c"), (F.max("t") - F.min("t")).alias("d"))
    return tr.groupBy("track").agg(F.count("*").alias("tracks"), dec(F.avg("c")).alias("mean_conf"), dec(F.avg("d")).alias("mean_duration"))


@query("agg_nsfw_summary", """SELECT d.source, count(*) AS rated, CAST(avg(l.toxic) AS DECIMAL(18,6)) AS mean_score, max(l.toxic) AS max_score, count(*) FILTER (l.toxic = 1) AS unsafe,
  CASE WHEN avg(l.toxic) > 0.5 THEN 'unsafe' WHEN avg(l.toxic) > 0.1 THEN 'review' ELSE 'safe' END AS rating FROM labels l JOIN documents d USING (doc_id) GROUP BY d.source""")
def agg_nsfw_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, d = spark.read.parquet(f"{sf_dir}/labels.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    mean = F.avg("toxic")
    rating = F.when(mean > 0.5, "unsafe").when(mean > 0.1, "review").otherwise("safe")
    return l.join(d, "doc_id").groupBy("source").agg(F.count("*").alias("rated"), dec(mean).alias("mean_score"), F.max("toxic").alias("max_score"), F.count_if(F.col("toxic") == 1).alias("unsafe"), rating.alias("rating"))


@query("agg_face_presence", "SELECT l_suppkey AS video_id, count(DISTINCT l_orderkey) AS frames, max(l_linenumber) AS max_faces, CAST(avg(l_quantity * l_discount) AS DECIMAL(18,6)) AS mean_area FROM lineitem WHERE l_discount > 0 GROUP BY l_suppkey")
def agg_face_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_discount > 0")
    return x.groupBy(F.col("l_suppkey").alias("video_id")).agg(F.countDistinct("l_orderkey").alias("frames"), F.max("l_linenumber").alias("max_faces"), dec(F.avg(F.col("l_quantity") * F.col("l_discount"))).alias("mean_area"))


@query("agg_eye_contact", f"""WITH {TL_SQL} SELECT video_id, CAST(count(*) FILTER (conf > 0.5) / {DURATION}.0 AS DECIMAL(18,6)) AS share, CAST(var_samp(conf) AS DECIMAL(18,6)) AS variance,
  CASE WHEN coalesce(var_samp(conf), 0) < 0.1 THEN 'high' WHEN coalesce(var_samp(conf), 0) < 0.3 THEN 'medium' ELSE 'low' END AS steadiness FROM tl WHERE entry_type = 'gesture' AND conf > 0 GROUP BY video_id""")
def agg_eye_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.coalesce(F.var_samp("conf"), F.lit(0.0))
    g = timeline(spark, sf_dir).where("entry_type = 'gesture' and conf > 0").groupBy("video_id")
    return g.agg(dec(F.count_if(F.col("conf") > 0.5) / float(DURATION)).alias("share"), dec(F.var_samp("conf")).alias("variance"), F.when(v < 0.1, "high").when(v < 0.3, "medium").otherwise("low").alias("steadiness"))
