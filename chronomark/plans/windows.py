"""Sequences: neighbours, runs, sessions, local peaks, level shifts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.functions.classes import density_level, face_shot, gap
from chronomark.functions.stats import regularity
from chronomark.operators.timeline import islands, sessions, top_k
from chronomark.plans._base import big, dec, query
from chronomark.plans.aggregates import ACT_SQL, DENS_SQL, density, weighted_activity
from chronomark.sources.testdata import DURATION, SEG_SQL, TL_SQL, segments, timeline


def _w() -> Window:
    return Window.partitionBy("video_id").orderBy("t", "seq")


def _sec() -> Window:
    return Window.partitionBy("video_id").orderBy("sec")


@query("win_local_max", f"""{ACT_SQL}, n AS (SELECT *, lag(activity) OVER w AS p, lead(activity) OVER w AS x, avg(activity) OVER (PARTITION BY video_id) AS m FROM act WINDOW w AS (PARTITION BY video_id ORDER BY sec))
SELECT * FROM (SELECT video_id, CAST(sec AS BIGINT) AS sec, CAST(activity AS DECIMAL(18,6)) AS activity, row_number() OVER (PARTITION BY video_id ORDER BY activity DESC, sec) AS rank FROM n WHERE activity > p AND activity > x AND activity > 1.5 * m) WHERE rank <= 5""")
def win_local_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict local maxima of weighted activity over 1.5 times the mean, the five highest of an item."""
    n = weighted_activity(spark, sf_dir).select("*", F.lag("activity").over(_sec()).alias("p"), F.lead("activity").over(_sec()).alias("x"), F.avg("activity").over(Window.partitionBy("video_id")).alias("m"))
    peaks = n.where("activity > p and activity > x and activity > 1.5 * m")
    return top_k(peaks, 5, [F.desc("activity"), "sec"]).select("video_id", big("sec").alias("sec"), dec("activity").alias("activity"), "rank")


@query("win_local_max_k", f"""{DENS_SQL}, n AS (SELECT *, max(n) OVER (PARTITION BY video_id ORDER BY sec ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM dens) SELECT video_id, CAST(sec AS BIGINT) AS sec, n FROM n WHERE n >= m AND n >= 2""")
def win_local_max_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = density(spark, sf_dir).withColumn("m", F.max("n").over(_sec().rowsBetween(-2, 2)))
    return n.where("n >= m and n >= 2").select("video_id", big("sec").alias("sec"), "n")


@query("win_lag_interval", f"""WITH {TL_SQL} SELECT video_id, seq, CAST(t - lag(t) OVER (PARTITION BY video_id ORDER BY t, seq) AS DECIMAL(18,6)) AS gap_s FROM tl WHERE entry_type = 'text'""")
def win_lag_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("entry_type = 'text'").select("video_id", "seq", dec(F.col("t") - F.lag("t").over(_w())).alias("gap_s"))


@query("win_lead_duration", f"""WITH {TL_SQL}, s AS (SELECT video_id, seq, t, coalesce(lead(t) OVER (PARTITION BY video_id ORDER BY t, seq), {DURATION}) - t AS d FROM tl WHERE entry_type = 'scene_change')
SELECT video_id, seq, CAST(d AS DECIMAL(18,6)) AS shot_s FROM s WHERE d > 0""")
def win_lead_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shots(spark, sf_dir).select("video_id", "seq", dec("d").alias("shot_s"))


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, seq, t, d``: every cut and how long the shot after it is; the last one ends with the item."""
    cuts = timeline(spark, sf_dir).where("entry_type = 'scene_change'")
    return cuts.select("video_id", "seq", "t", (F.coalesce(F.lead("t").over(_w()), F.lit(float(DURATION))) - F.col("t")).alias("d")).where("d > 0")


SHOT_SQL = f"""WITH {TL_SQL}, shot AS (SELECT * FROM (SELECT video_id, seq, t, coalesce(lead(t) OVER (PARTITION BY video_id ORDER BY t, seq), {DURATION}) - t AS d FROM tl WHERE entry_type = 'scene_change') WHERE d > 0)"""


@query("win_change_flag", f"""WITH {TL_SQL}, e AS (SELECT video_id, label, lag(label) OVER (PARTITION BY video_id ORDER BY t, seq) AS p FROM tl WHERE entry_type = 'emotion') SELECT video_id, count(*) FILTER (p <> label) AS changes FROM e GROUP BY video_id""")
def win_change_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = timeline(spark, sf_dir).where("entry_type = 'emotion'").select("video_id", "label", F.lag("label").over(_w()).alias("p"))
    return e.groupBy("video_id").agg(F.count_if(F.coalesce(F.col("p") != F.col("label"), F.lit(False))).alias("changes"))


@query("win_transition_rows", f"""WITH {TL_SQL}, e AS (SELECT video_id, seq, t, label, lead(label) OVER (PARTITION BY video_id ORDER BY t, seq) AS x FROM tl WHERE entry_type = 'emotion')
SELECT video_id, seq, CAST(t AS DECIMAL(18,6)) AS at_s, label AS from_label, x AS to_label FROM e WHERE x <> label""")
def win_transition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = timeline(spark, sf_dir).where("entry_type = 'emotion'").select("video_id", "seq", "t", "label", F.lead("label").over(_w()).alias("x"))
    return e.where("x <> label").select("video_id", "seq", dec("t").alias("at_s"), F.col("label").alias("from_label"), F.col("x").alias("to_label"))


@query("win_contrast", f"""WITH {TL_SQL}, e AS (SELECT video_id, seq, t, CASE WHEN label IN (0, 4) THEN 1 WHEN label IN (1, 2, 3, 5) THEN -1 ELSE 0 END AS v FROM tl WHERE entry_type = 'emotion'),
n AS (SELECT *, lead(v) OVER (PARTITION BY video_id ORDER BY t, seq) AS x FROM e) SELECT video_id, seq, v AS from_valence, x AS to_valence FROM n WHERE v * x < 0""")
def win_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("label").isin(0, 4), 1).when(F.col("label").isin(1, 2, 3, 5), -1).otherwise(0)
    e = timeline(spark, sf_dir).where("entry_type = 'emotion'").withColumn("v", v)
    return e.select("video_id", "seq", F.col("v").alias("from_valence"), F.lead("v").over(_w()).alias("to_valence")).where("from_valence * to_valence < 0")


@query("win_gaps_islands_shot", """WITH b AS (SELECT l_suppkey AS video_id, l_orderkey * 8 + l_linenumber AS seq, l_partkey AS p, l_extendedprice AS x, CASE WHEN a > 25 THEN 'close' WHEN a > 8 THEN 'medium' WHEN a > 0 THEN 'wide' ELSE 'none' END AS shot FROM (SELECT *, l_quantity * l_discount * 10 AS a FROM lineitem)),
c AS (SELECT *, CASE WHEN lag(shot) OVER w IS DISTINCT FROM shot AND row_number() OVER w > 1 THEN 1 ELSE 0 END AS c FROM b WINDOW w AS (PARTITION BY video_id ORDER BY seq, p, x)),
r AS (SELECT *, CAST(sum(c) OVER (PARTITION BY video_id ORDER BY seq, p, x ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM c) SELECT video_id, run, any_value(shot) AS shot, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n FROM r GROUP BY video_id, run""")
def win_gaps_islands_shot(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    b = x.select(F.col("l_suppkey").alias("video_id"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), F.col("l_partkey").alias("p"), F.col("l_extendedprice").alias("x"), face_shot(F.col("l_quantity") * F.col("l_discount") * 10).alias("shot"))
    return islands(b, F.col("shot"), ["seq", "p", "x"]).groupBy("video_id", "run").agg(F.min("shot").alias("shot"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("n"))


_ZERO_SQL = f"{DENS_SQL}, z AS (SELECT video_id, sec, sec - row_number() OVER (PARTITION BY video_id ORDER BY sec) AS g FROM dens WHERE n = 0), runs AS (SELECT video_id, min(sec) AS start_s, max(sec) + 1 AS end_s, count(*) AS len FROM z GROUP BY video_id, g)"


def empty_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of seconds in which nothing begins."""
    z = density(spark, sf_dir).where("n = 0").withColumn("g", F.col("sec") - F.row_number().over(_sec()))
    return z.groupBy("video_id", "g").agg(big(F.min("sec")).alias("start_s"), big(F.max("sec") + 1).alias("end_s"), F.count("*").alias("len")).drop("g")


@query("win_islands_dead", f"{_ZERO_SQL} SELECT video_id, CAST(start_s AS BIGINT) AS start_s, CAST(end_s AS BIGINT) AS end_s, len FROM runs WHERE len >= 2")
def win_islands_dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return empty_runs(spark, sf_dir).where("len >= 2")


@query("win_islands_absence", f"{_ZERO_SQL} SELECT video_id, count(*) AS runs, max(len) AS longest, count(*) FILTER (len > 5) AS long_runs FROM runs GROUP BY video_id")
def win_islands_absence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return empty_runs(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("runs"), F.max("len").alias("longest"), F.count_if(F.col("len") > 5).alias("long_runs"))


@query("win_islands_montage", f"""{SHOT_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) AS i FROM shot), g AS (SELECT *, i - row_number() OVER (PARTITION BY video_id ORDER BY i) AS g FROM f WHERE d < 1.5)
SELECT video_id, min(seq) AS first_seq, CAST(min(t) AS DECIMAL(18,6)) AS start_s, count(*) AS shots FROM g GROUP BY video_id, g HAVING count(*) >= 3""")
def win_islands_montage(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = shots(spark, sf_dir).withColumn("i", F.row_number().over(_w())).where("d < 1.5").withColumn("g", F.col("i") - F.row_number().over(Window.partitionBy("video_id").orderBy("i")))
    return f.groupBy("video_id", "g").agg(F.min("seq").alias("first_seq"), dec(F.min("t")).alias("start_s"), F.count("*").alias("shots")).where("shots >= 3").drop("g")


@query("win_cluster_gap", f"""WITH {TL_SQL}, s AS (SELECT *, sum(CASE WHEN p IS NOT NULL AND t - p >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY t, seq) AS session FROM (SELECT *, lag(t) OVER (PARTITION BY video_id ORDER BY t, seq) AS p FROM tl WHERE entry_type = 'text'))
SELECT video_id, CAST(min(t) AS DECIMAL(18,6)) AS start_s, CAST(max(t) AS DECIMAL(18,6)) AS end_s, count(*) AS n FROM s GROUP BY video_id, session HAVING count(*) >= 2""")
def win_cluster_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(timeline(spark, sf_dir).where("entry_type = 'text'"), 5.0)
    return s.groupBy("video_id", "session").agg(dec(F.min("t")).alias("start_s"), dec(F.max("t")).alias("end_s"), F.count("*").alias("n")).where("n >= 2").drop("session")


@query("win_three_decreasing", f"{SHOT_SQL}, n AS (SELECT video_id, seq, d, lead(d, 1) OVER w AS d1, lead(d, 2) OVER w AS d2 FROM shot WINDOW w AS (PARTITION BY video_id ORDER BY t, seq)) SELECT video_id, seq FROM n WHERE d > d1 AND d1 > d2")
def win_three_decreasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = shots(spark, sf_dir).select("video_id", "seq", "d", F.lead("d", 1).over(_w()).alias("d1"), F.lead("d", 2).over(_w()).alias("d2"))
    return n.where("d > d1 and d1 > d2").select("video_id", "seq")


@query("win_moving_avg3", f"""{SHOT_SQL}, n AS (SELECT *, avg(d) OVER (PARTITION BY video_id ORDER BY t, seq ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS m3, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) AS i, count(*) OVER (PARTITION BY video_id) AS c, avg(d) OVER (PARTITION BY video_id) AS m FROM shot)
SELECT video_id, seq, CAST(m3 AS DECIMAL(18,6)) AS mean3 FROM n WHERE i <= c - 3 AND m3 < 0.5 * m""")
def win_moving_avg3(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = Window.partitionBy("video_id")
    n = shots(spark, sf_dir).select("video_id", "seq", F.avg("d").over(_w().rowsBetween(0, 2)).alias("m3"), F.row_number().over(_w()).alias("i"), F.count("*").over(whole).alias("c"), F.avg("d").over(whole).alias("m"))
    return n.where("i <= c - 3 and m3 < 0.5 * m").select("video_id", "seq", dec("m3").alias("mean3"))


@query("win_cumsum", f"{SHOT_SQL} SELECT video_id, seq, CAST(coalesce(sum(d) OVER (PARTITION BY video_id ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DECIMAL(18,6)) AS elapsed FROM shot")
def win_cumsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shots(spark, sf_dir).select("video_id", "seq", dec(F.coalesce(F.sum("d").over(_w().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).alias("elapsed"))


@query("win_shot_energy", f"{SHOT_SQL} SELECT video_id, seq, CAST(1 / d AS DECIMAL(18,4)) AS energy FROM shot WHERE d > 0.001")
def win_shot_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shots(spark, sf_dir).where("d > 0.001").select("video_id", "seq", dec(1 / F.col("d"), 4).alias("energy"))


@query("win_outlier", f"""{DENS_SQL}, n AS (SELECT *, avg(n) OVER (PARTITION BY video_id) AS m, stddev_pop(n) OVER (PARTITION BY video_id) AS s FROM dens) SELECT video_id, CAST(sec AS BIGINT) AS sec, n, CAST((n - m) / s AS DECIMAL(18,6)) AS z FROM n WHERE n > m + s AND s > 0""")
def win_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = Window.partitionBy("video_id")
    n = density(spark, sf_dir).select("*", F.avg("n").over(whole).alias("m"), F.stddev_pop("n").over(whole).alias("s")).where("n > m + s and s > 0")
    return n.select("video_id", big("sec").alias("sec"), "n", dec((F.col("n") - F.col("m")) / F.col("s")).alias("z"))


_LEVEL_SQL = "CASE WHEN {0} = 0 THEN 'none' WHEN {0} <= 2 THEN 'low' WHEN {0} <= 5 THEN 'medium' ELSE 'high' END"


@query("win_level_shift", f"""{DENS_SQL}, l AS (SELECT *, lag(n) OVER (PARTITION BY video_id ORDER BY sec) AS p FROM dens), c AS (SELECT video_id, sec, {_LEVEL_SQL.format("p")} AS from_level, {_LEVEL_SQL.format("n")} AS to_level, abs(n - p) / (greatest(n, p) + 0.001) AS m FROM l WHERE p IS NOT NULL)
SELECT * FROM (SELECT video_id, CAST(sec AS BIGINT) AS sec, from_level, to_level, CAST(m AS DECIMAL(18,6)) AS magnitude, row_number() OVER (PARTITION BY video_id ORDER BY m DESC, sec) AS rank FROM c WHERE from_level <> to_level AND m > 0.5) WHERE rank <= 10""")
def win_level_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = lambda c: F.when(c == 0, "none").when(c <= 2, "low").when(c <= 5, "medium").otherwise("high")
    l = density(spark, sf_dir).withColumn("p", F.lag("n").over(_sec())).where("p is not null")
    m = F.abs(F.col("n") - F.col("p")) / (F.greatest("n", "p") + 0.001)
    c = l.select("video_id", big("sec").alias("sec"), level(F.col("p")).alias("from_level"), level(F.col("n")).alias("to_level"), m.alias("m")).where("from_level <> to_level and m > 0.5")
    return top_k(c, 10, [F.desc("m"), "sec"]).select("video_id", "sec", "from_level", "to_level", dec("m").alias("magnitude"), "rank")


@query("win_thirds_compare", f"""{DENS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY sec) AS i, count(*) OVER (PARTITION BY video_id) AS c FROM dens)
SELECT video_id, CAST(avg(n) FILTER (i <= c // 3) AS DECIMAL(18,6)) AS first_third, CAST(avg(n) FILTER (i > c - (c + 2) // 3) AS DECIMAL(18,6)) AS last_third FROM r GROUP BY video_id""")
def win_thirds_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = density(spark, sf_dir).select("*", F.row_number().over(_sec()).alias("i"), F.count("*").over(Window.partitionBy("video_id")).alias("c"))
    part = lambda c: dec(F.avg(F.when(F.expr(c), F.col("n"))))
    return r.groupBy("video_id").agg(part("i <= c div 3").alias("first_third"), part("i > c - (c + 2) div 3").alias("last_third"))


@query("win_tail5", f"{DENS_SQL} SELECT video_id, CAST(avg(n) FILTER (sec >= {DURATION - 5}) AS DECIMAL(18,6)) AS tail, CAST(avg(n) AS DECIMAL(18,6)) AS mean FROM dens GROUP BY video_id")
def win_tail5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir).groupBy("video_id").agg(dec(F.avg(F.when(F.col("sec") >= DURATION - 5, F.col("n")))).alias("tail"), dec(F.avg("n")).alias("mean"))


_GAP_SQL = f"WITH {SEG_SQL}, gaps AS (SELECT * FROM (SELECT video_id, seq, start_s - lag(end_s) OVER (PARTITION BY video_id ORDER BY start_s, seq) AS gap_s FROM seg) WHERE gap_s > 1)"


def speech_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("video_id").orderBy("start_s", "seq")
    return segments(spark, sf_dir).select("video_id", "seq", (F.col("start_s") - F.lag("end_s").over(w)).alias("gap_s")).where("gap_s > 1")


@query("win_gaps_speech", f"{_GAP_SQL} SELECT video_id, seq, CAST(gap_s AS DECIMAL(18,4)) AS gap_s, CASE WHEN CAST(gap_s AS DECIMAL(18,4)) > 3 THEN 'awkward' WHEN CAST(gap_s AS DECIMAL(18,4)) > 2 THEN 'dramatic' ELSE 'strategic' END AS kind FROM gaps")
def win_gaps_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speech_gaps(spark, sf_dir).select("video_id", "seq", dec("gap_s", 4).alias("gap_s"), gap(dec("gap_s", 4)).alias("kind"))


@query("agg_pause_stats", f"""{_GAP_SQL}, k AS (SELECT video_id, CAST(gap_s AS DECIMAL(18,4)) AS g FROM gaps)
SELECT video_id, CAST(sum(g) AS DECIMAL(18,4)) AS total_s, count(*) AS pauses, max(g) AS longest_s, count(*) FILTER (g > 3) AS awkward, count(*) FILTER (g > 2 AND g <= 3) AS dramatic, count(*) FILTER (g <= 2) AS strategic FROM k GROUP BY video_id""")
def agg_pause_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = speech_gaps(spark, sf_dir).select("video_id", dec("gap_s", 4).alias("g"), gap(dec("gap_s", 4)).alias("kind"))
    n = lambda x: F.count_if(F.col("kind") == x).alias(x)
    return k.groupBy("video_id").agg(F.sum("g").cast("decimal(18,4)").alias("total_s"), F.count("*").alias("pauses"), F.max("g").alias("longest_s"), n("awkward"), n("dramatic"), n("strategic"))


@query("win_peak_rhythm", f"""{DENS_SQL}, p AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, sec) AS r FROM dens), q AS (SELECT * FROM p WHERE r <= 5), g AS (SELECT video_id, abs(sec - lag(sec) OVER (PARTITION BY video_id ORDER BY r)) AS s FROM q)
SELECT video_id, CAST(CASE WHEN avg(s) > 0 THEN 1 / (1 + coalesce(stddev_samp(s), 0) / avg(s)) ELSE 0 END AS DECIMAL(18,6)) AS rhythm FROM g WHERE s IS NOT NULL GROUP BY video_id""")
def win_peak_rhythm(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = top_k(density(spark, sf_dir), 5, [F.desc("n"), "sec"])
    g = q.select("video_id", F.abs(F.col("sec") - F.lag("sec").over(Window.partitionBy("video_id").orderBy("rank"))).alias("s")).where("s is not null")
    return g.groupBy("video_id").agg(dec(regularity(F.avg("s"), F.coalesce(F.stddev_samp("s"), F.lit(0.0)))).alias("rhythm"))


@query("win_first_last", f"WITH {SEG_SQL} SELECT video_id, CAST(min(start_s) AS DECIMAL(18,4)) AS first_s, CAST(max(end_s) AS DECIMAL(18,4)) AS last_s FROM seg WHERE words > 0 GROUP BY video_id")
def win_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).where("words > 0").groupBy("video_id").agg(dec(F.min("start_s"), 4).alias("first_s"), dec(F.max("end_s"), 4).alias("last_s"))


@query("win_longest_shortest", f"""{SHOT_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY d DESC, t, seq) AS rl, row_number() OVER (PARTITION BY video_id ORDER BY d, t, seq) AS rs FROM shot)
SELECT video_id, max(seq) FILTER (rl = 1) AS longest_seq, max(seq) FILTER (rs = 1) AS shortest_seq, max(CASE WHEN t < {DURATION} / 3.0 THEN 'intro' WHEN t < {DURATION} * 2 / 3.0 THEN 'middle' ELSE 'outro' END) FILTER (rl = 1) AS longest_place FROM r GROUP BY video_id""")
def win_longest_shortest(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.when(F.col("t") < DURATION / 3, "intro").when(F.col("t") < DURATION * 2 / 3, "middle").otherwise("outro")
    best = F.min(F.struct((-F.col("d")).alias("d"), "t", "seq", place.alias("place"))).alias("l")
    return shots(spark, sf_dir).groupBy("video_id").agg(best, F.min(F.struct("d", "t", "seq")).alias("s")).select("video_id", F.col("l.seq").alias("longest_seq"), F.col("s.seq").alias("shortest_seq"), F.col("l.place").alias("longest_place"))


@query("win_rank_top", f"{DENS_SQL} SELECT * FROM (SELECT video_id, CAST(sec AS BIGINT) AS sec, n, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, sec) AS rank FROM dens) WHERE rank <= 3")
def win_rank_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(density(spark, sf_dir).select("video_id", big("sec").alias("sec"), "n"), 3, [F.desc("n"), "sec"])


@query("win_first_in_group", f"WITH {TL_SQL} SELECT video_id, label AS first_label FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) AS r FROM tl WHERE entry_type = 'object' AND t < 3) WHERE r = 1")
def win_first_in_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.min(F.struct("t", "seq", "label"))["label"]
    return timeline(spark, sf_dir).where("entry_type = 'object' and t < 3").groupBy("video_id").agg(first.alias("first_label"))


@query("agg_shot_stats", f"{SHOT_SQL} SELECT video_id, count(*) AS shots, CAST(avg(d) AS DECIMAL(18,6)) AS mean_s, CAST(min(d) AS DECIMAL(18,6)) AS min_s, CAST(max(d) AS DECIMAL(18,6)) AS max_s, CAST(coalesce(var_samp(d), 0) AS DECIMAL(18,4)) AS variance, CAST(1 / (1 + coalesce(stddev_samp(d), 0)) AS DECIMAL(18,6)) AS rhythm FROM shot GROUP BY video_id")
def agg_shot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0.0)
    return shots(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("shots"), dec(F.avg("d")).alias("mean_s"), dec(F.min("d")).alias("min_s"), dec(F.max("d")).alias("max_s"), dec(F.coalesce(F.var_samp("d"), zero), 4).alias("variance"), dec(1 / (1 + F.coalesce(F.stddev_samp("d"), zero))).alias("rhythm"))


@query("agg_shot_buckets", f"{SHOT_SQL} SELECT video_id, count(*) FILTER (d < 2) AS short, count(*) FILTER (d >= 2 AND d < 5) AS medium, count(*) FILTER (d >= 5) AS long FROM shot GROUP BY video_id")
def agg_shot_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shots(spark, sf_dir).groupBy("video_id").agg(F.count_if(F.col("d") < 2).alias("short"), F.count_if((F.col("d") >= 2) & (F.col("d") < 5)).alias("medium"), F.count_if(F.col("d") >= 5).alias("long"))


@query("cls_object_density", f"{DENS_SQL} SELECT video_id, CAST(sec AS BIGINT) AS sec, CASE WHEN n < 2 THEN 'low' WHEN n < 5 THEN 'medium' ELSE 'high' END AS level FROM dens")
def cls_object_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir).select("video_id", big("sec").alias("sec"), density_level(F.col("n")).alias("level"))
