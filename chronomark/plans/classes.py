"""Classes, scores and metadata features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.functions.classes import face_average, face_shot, hashtag_strategy, pacing
from chronomark.functions.stats import safe_div
from chronomark.operators.timeline import top_k
from chronomark.plans._base import dec, query
from chronomark.plans.aggregates import DENS_SQL, density
from chronomark.plans.windows import SHOT_SQL, shots
from chronomark.sources.testdata import DURATION, TL_SQL, table, timeline


@query("dt_publish", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS publish_hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday FROM events")
def dt_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour and weekday (Monday 0) of an ISO time with Z; 0 if it can't be read."""
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    at = F.try_to_timestamp(iso)
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(F.hour(at), F.lit(0)).alias("publish_hour"), F.coalesce(F.weekday(at), F.lit(0)).alias("weekday"))


@query("mth_safe_div", "SELECT l_orderkey, l_linenumber, CAST(coalesce(l_extendedprice / nullif(l_discount, 0), 0) AS DECIMAL(18,4)) AS ratio FROM lineitem")
def mth_safe_div(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", dec(safe_div(F.col("l_extendedprice"), F.col("l_discount")), 4).alias("ratio"))


@query("mth_int_trunc", f"WITH {TL_SQL} SELECT video_id, seq, CAST(trunc(t - 15) AS BIGINT) AS whole FROM tl")
def mth_int_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).select("video_id", "seq", (F.col("t") - 15).cast("long").alias("whole"))


@query("mth_clamp", "SELECT l_orderkey, l_linenumber, CAST(least(greatest(l_quantity, 10), 40) AS DECIMAL(18,4)) AS clamped FROM lineitem")
def mth_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", dec(F.least(F.greatest(F.col("l_quantity"), F.lit(10.0)), F.lit(40.0)), 4).alias("clamped"))


@query("mth_mean0", f"WITH {TL_SQL}, v AS (SELECT DISTINCT video_id FROM tl) SELECT v.video_id, CAST(coalesce(avg(tl.conf), 0) AS DECIMAL(18,6)) AS mean, CAST(coalesce(stddev_samp(tl.conf), 0) AS DECIMAL(18,6)) AS deviation FROM v LEFT JOIN tl ON tl.video_id = v.video_id AND tl.entry_type = 'emotion' AND tl.t < 2 GROUP BY v.video_id")
def mth_mean0(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.when((F.col("entry_type") == "emotion") & (F.col("t") < 2), F.col("conf"))
    return timeline(spark, sf_dir).groupBy("video_id").agg(dec(F.coalesce(F.avg(c), F.lit(0.0))).alias("mean"), dec(F.coalesce(F.stddev_samp(c), F.lit(0.0))).alias("deviation"))


@query("mth_engagement", "SELECT c.c_custkey, CAST(coalesce((count(*) FILTER (o_orderstatus = 'F') + count(*) FILTER (o_orderstatus = 'O') + count(*) FILTER (o_orderstatus = 'P')) / nullif(sum(o_totalprice), 0) * 100, 0) AS DECIMAL(18,6)) AS engagement FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey")
def mth_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    n = F.count_if(F.col("o_orderstatus").isin("F", "O", "P"))
    return o.groupBy("c_custkey").agg(dec(F.coalesce(F.try_divide(n, F.sum("o_totalprice")) * 100, F.lit(0.0))).alias("engagement"))


@query("mth_regularity", f"{DENS_SQL} SELECT video_id, CAST(CASE WHEN avg(n) > 0 THEN 1 / (1 + stddev_samp(n) / avg(n)) ELSE 0 END AS DECIMAL(18,6)) AS regularity FROM dens GROUP BY video_id")
def mth_regularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, s = F.avg("n"), F.stddev_samp("n")
    return density(spark, sf_dir).groupBy("video_id").agg(dec(F.when(m > 0, 1 / (1 + s / m)).otherwise(0.0)).alias("regularity"))


@query("mth_noise", f"{DENS_SQL} SELECT video_id, CAST(least(1, var_pop(n / 10.0) * 100) AS DECIMAL(18,6)) AS noise FROM dens GROUP BY video_id")
def mth_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir).groupBy("video_id").agg(dec(F.least(F.lit(1.0), F.var_pop(F.col("n") / 10.0) * 100)).alias("noise"))


_AREA = "l_quantity * l_discount * 10"


@query("cls_face_shot", f"SELECT l_orderkey, l_linenumber, CASE WHEN {_AREA} > 25 THEN 'close' WHEN {_AREA} > 8 THEN 'medium' WHEN {_AREA} > 0 THEN 'wide' ELSE 'none' END AS shot FROM lineitem")
def cls_face_shot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", face_shot(F.expr(_AREA)).alias("shot"))


@query("cls_face_avg", f"SELECT l_suppkey, CASE WHEN avg({_AREA}) > 30 THEN 'close_up' WHEN avg({_AREA}) > 10 THEN 'medium_shot' ELSE 'wide_shot' END AS framing FROM lineitem GROUP BY l_suppkey")
def cls_face_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(face_average(F.avg(F.expr(_AREA))).alias("framing"))


@query("cls_transition", f"""WITH s AS (SELECT l_suppkey AS video_id, l_orderkey * 8 + l_linenumber AS seq, l_partkey AS k, l_extendedprice AS x, CASE WHEN {_AREA} > 25 THEN 3 WHEN {_AREA} > 8 THEN 2 WHEN {_AREA} > 0 THEN 1 ELSE 0 END AS o FROM lineitem), n AS (SELECT *, lag(o) OVER (PARTITION BY video_id ORDER BY seq, k, x) AS p FROM s)
SELECT video_id, seq, CASE WHEN o > p THEN 'zoom_in' WHEN o < p THEN 'zoom_out' ELSE 'cut' END AS transition FROM n WHERE p IS NOT NULL""")
def cls_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.create_map(*[F.lit(x) for kv in {"none": 0, "wide": 1, "medium": 2, "close": 3}.items() for x in kv])
    s = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("video_id"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), F.col("l_partkey").alias("k"), F.col("l_extendedprice").alias("x"), F.element_at(order, face_shot(F.expr(_AREA))).alias("o"))
    n = s.withColumn("p", F.lag("o").over(Window.partitionBy("video_id").orderBy("seq", "k", "x"))).where("p is not null")
    return n.select("video_id", "seq", F.when(F.col("o") > F.col("p"), "zoom_in").when(F.col("o") < F.col("p"), "zoom_out").otherwise("cut").alias("transition"))


@query("cls_hashtag", "SELECT o_custkey, CASE WHEN count(*) = 0 THEN 'none' WHEN count(*) < 3 THEN 'minimal' WHEN count(*) <= 7 THEN 'moderate' WHEN count(*) <= 15 THEN 'heavy' ELSE 'spam' END AS strategy FROM orders GROUP BY o_custkey")
def cls_hashtag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(hashtag_strategy(F.count("*")).alias("strategy"))


@query("agg_cut_rate", f"{SHOT_SQL} SELECT video_id, CAST(count(*) * 60 / {DURATION}.0 AS DECIMAL(18,6)) AS cuts_per_minute, CASE WHEN count(*) * 60 / {DURATION}.0 < 10 THEN 'slow' WHEN count(*) * 60 / {DURATION}.0 < 20 THEN 'moderate' WHEN count(*) * 60 / {DURATION}.0 < 40 THEN 'fast' ELSE 'very_fast' END AS pacing FROM shot GROUP BY video_id")
def agg_cut_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = F.count("*") * 60 / float(DURATION)
    return shots(spark, sf_dir).groupBy("video_id").agg(dec(rate).alias("cuts_per_minute"), pacing(rate).alias("pacing"))


@query("cls_burst_pattern", f"""{DENS_SQL}, b AS (SELECT video_id, avg(n) FILTER (sec < 10) AS a, avg(n) FILTER (sec >= 10 AND sec < 20) AS m, avg(n) FILTER (sec >= 20) AS z FROM dens GROUP BY video_id)
SELECT video_id, CASE WHEN a > 1.2 * m AND a > 1.2 * z THEN 'front_loaded' WHEN z > 1.2 * a AND z > 1.2 * m THEN 'back_loaded' WHEN m > 1.2 * a AND m > 1.2 * z THEN 'middle_peak' ELSE 'steady' END AS pattern FROM b""")
def cls_burst_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda c, n: F.avg(F.when(F.expr(c), F.col("n"))).alias(n)
    b = density(spark, sf_dir).groupBy("video_id").agg(part("sec < 10", "a"), part("sec >= 10 and sec < 20", "m"), part("sec >= 20", "z"))
    over = lambda x, y, z: F.expr(f"{x} > 1.2 * {y} and {x} > 1.2 * {z}")
    return b.select("video_id", F.when(over("a", "m", "z"), "front_loaded").when(over("z", "a", "m"), "back_loaded").when(over("m", "a", "z"), "middle_peak").otherwise("steady").alias("pattern"))


#: Labels whose centroids are broadcast at most, and copies of the others.
MOST_CENTROIDS, SALTS = 4_096, 64


@query("topk_cosine", """WITH c AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS v FROM (SELECT label, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY ALL), n AS (SELECT label, sqrt(sum(v * v)) AS n FROM c GROUP BY label),
e AS (SELECT vec_id, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings), en AS (SELECT vec_id, sqrt(sum(CAST(v AS DOUBLE) * v)) AS n FROM e GROUP BY vec_id),
s AS (SELECT e.vec_id, c.label, sum(CAST(e.v AS DOUBLE) * c.v) / (any_value(n.n) * any_value(en.n)) AS s FROM e JOIN c USING (i) JOIN n USING (label) JOIN en USING (vec_id) GROUP BY e.vec_id, c.label)
SELECT vec_id, label, CAST(s AS DECIMAL(18,4)) AS cosine FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, label) AS r FROM s) WHERE r = 1""")
def topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label whose centroid is nearest by cosine. Centroids are broadcast while there are few labels; more of them are dealt
    to salted copies, so that the one key that all rows share falls into as many tasks."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    means = e.select("label", F.posexplode("e").alias("i", "v")).groupBy("label", "i").agg(F.avg("v").alias("v"))
    c = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("x")).select(F.col("label").alias("centroid"), F.transform("x", lambda p: p["v"]).alias("c"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    if e.select("label").distinct().count() <= MOST_CENTROIDS:
        both = e.drop("label").join(F.broadcast(c), F.size("e") == F.size("c"))
    else:
        salted = c.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = e.drop("label").withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")).join(salted, "salt").where(F.size("e") == F.size("c"))
    scored = both.select("vec_id", F.col("centroid").alias("label"), (dot(F.col("e"), F.col("c")) / (F.sqrt(dot(F.col("e"), F.col("e"))) * F.sqrt(dot(F.col("c"), F.col("c"))))).alias("s"))
    best = F.min(F.struct((-F.round("s", 9)).alias("m"), "label", "s")).alias("x")
    return scored.groupBy("vec_id").agg(best).select("vec_id", "x.label", dec("x.s", 4).alias("cosine"))


@query("pick_largest_face", "SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity * l_discount DESC, l_linenumber) AS r FROM lineitem) WHERE r = 1")
def pick_largest_face(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.min(F.struct((-(F.col("l_quantity") * F.col("l_discount"))).alias("a"), "l_linenumber"))["l_linenumber"]
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(best.alias("l_linenumber"))


@query("smp_uniform", f"WITH {TL_SQL}, n AS (SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) - 1 AS i, greatest(count(*) OVER (PARTITION BY video_id) // 10, 1) AS s FROM tl) SELECT video_id, seq FROM n WHERE i % s = 0 AND i // s < 10")
def smp_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = timeline(spark, sf_dir).select("video_id", "seq", (F.row_number().over(Window.partitionBy("video_id").orderBy("t", "seq")) - 1).alias("i"), F.expr("greatest(count(*) over (partition by video_id) div 10, 1)").alias("s"))
    return n.where("i % s = 0 and i div s < 10").select("video_id", "seq")


@query("smp_adaptive_fps", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 10 THEN 5 WHEN l_quantity <= 20 THEN 3 WHEN l_quantity <= 40 THEN 2 ELSE 1 END AS fps FROM lineitem")
def smp_adaptive_fps(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(q <= 10, 5).when(q <= 20, 3).when(q <= 40, 2).otherwise(1).alias("fps"))


@query("topk_per_video", f"WITH {TL_SQL} SELECT video_id, seq, rank FROM (SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY conf DESC, seq) AS rank FROM tl) WHERE rank <= 5")
def topk_per_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(timeline(spark, sf_dir), 5, [F.desc("conf"), "seq"]).select("video_id", "seq", "rank")


@query("sort_lexical_key", f"WITH {TL_SQL}, k AS (SELECT DISTINCT video_id, CAST(CAST(floor(t) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(floor(t) AS BIGINT) + 1 AS VARCHAR) || 's' AS key FROM tl) SELECT video_id, key, row_number() OVER (PARTITION BY video_id ORDER BY key) AS place FROM k")
def sort_lexical_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.floor("t").cast("string"), F.lit("-"), (F.floor("t") + 1).cast("string"), F.lit("s"))
    k = timeline(spark, sf_dir).select("video_id", key.alias("key")).distinct()
    return k.select("video_id", "key", F.row_number().over(Window.partitionBy("video_id").orderBy("key")).cast("long").alias("place"))


@query("win_emotion_peaks", f"WITH {TL_SQL}, e AS (SELECT *, avg(conf) OVER (PARTITION BY video_id) AS m FROM tl WHERE entry_type = 'emotion') SELECT video_id, seq, rank FROM (SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) AS rank FROM e WHERE conf > 1.2 * m) WHERE rank <= 3")
def win_emotion_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidences are added up in order of time: where one is 1.2 times the mean, the sum's last bits decide, and no other order may."""
    w = Window.partitionBy("video_id").orderBy("t", "seq")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    e = timeline(spark, sf_dir).where("entry_type = 'emotion'").withColumn("so_far", F.sum("conf").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    e = e.withColumn("m", F.last("so_far").over(whole) / F.count("conf").over(whole)).where("conf > 1.2 * m")
    return top_k(e, 3, ["t", "seq"]).select("video_id", "seq", "rank")


@query("topk_emotion_peaks", f"WITH {TL_SQL} SELECT video_id, seq, rank FROM (SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY conf DESC, seq) AS rank FROM tl WHERE entry_type = 'emotion' AND conf > 0.6) WHERE rank <= 5")
def topk_emotion_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(timeline(spark, sf_dir).where("entry_type = 'emotion' and conf > 0.6"), 5, [F.desc("conf"), "seq"]).select("video_id", "seq", "rank")


@query("agg_stability", f"WITH {TL_SQL}, e AS (SELECT video_id, label, lag(label) OVER (PARTITION BY video_id ORDER BY t, seq) AS p FROM tl WHERE entry_type = 'emotion') SELECT video_id, CAST(CASE WHEN count(*) > 1 THEN 1 - count(*) FILTER (p <> label) / (count(*) - 1) ELSE 1 END AS DECIMAL(18,6)) AS stability FROM e GROUP BY video_id")
def agg_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = timeline(spark, sf_dir).where("entry_type = 'emotion'").select("video_id", "label", F.lag("label").over(Window.partitionBy("video_id").orderBy("t", "seq")).alias("p"))
    n = F.count("*")
    return e.groupBy("video_id").agg(dec(F.when(n > 1, 1 - F.try_divide(F.count_if(F.coalesce(F.expr("p <> label"), F.lit(False))), n - 1)).otherwise(1.0)).alias("stability"))
