"""Time buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.operators.timeline import spine
from chronomark.plans._base import big, dec, query
from chronomark.plans.aggregates import DENS_SQL, density
from chronomark.plans.windows import SHOT_SQL, shots
from chronomark.sources.testdata import DURATION, TL_SQL, timeline


@query("bkt_1s", f"{DENS_SQL} SELECT video_id, CAST(sec AS BIGINT) AS sec, n FROM dens")
def bkt_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir).select("video_id", big("sec").alias("sec"), "n")


@query("bkt_5s_tumbling", f"WITH {TL_SQL} SELECT video_id, CAST(floor(t / 5) AS BIGINT) AS win, count(*) AS n, count(*) >= 3 AS burst FROM tl WHERE entry_type = 'text' GROUP BY ALL")
def bkt_5s_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("entry_type = 'text'").groupBy("video_id", F.floor(F.col("t") / 5).cast("long").alias("win")).agg(F.count("*").alias("n"), (F.count("*") >= 3).alias("burst"))


@query("bkt_5s_engagement", f"""WITH {TL_SQL}, v AS (SELECT DISTINCT video_id FROM tl), w AS (SELECT video_id, i * 5 AS a, least(i * 5 + 5, {DURATION}) AS b FROM v CROSS JOIN range({DURATION // 5}) r(i))
SELECT w.video_id, CAST(a AS BIGINT) AS start_s, CAST(least(coalesce(sum(CASE entry_type WHEN 'text' THEN 2 WHEN 'scene_change' THEN 1 WHEN 'gesture' THEN 1.5 ELSE 0.5 END), 0) / 10.0, 1) AS DECIMAL(18,6)) AS engagement
FROM w LEFT JOIN tl ON tl.video_id = w.video_id AND tl.t >= a AND tl.t <= b GROUP BY w.video_id, a""")
def bkt_5s_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows closed at both ends: an entry on a boundary counts in both, so entries are dealt to one or two windows."""
    kind = F.col("entry_type")
    weight = F.when(kind == "text", 2.0).when(kind == "scene_change", 1.0).when(kind == "gesture", 1.5).otherwise(0.5)
    own = F.floor(F.col("t") / 5)
    wins = F.explode(F.when((own * 5 == F.col("t")) & (own > 0), F.array(own - 1, own)).otherwise(F.array(own))).alias("win")
    tl = timeline(spark, sf_dir)
    sums = tl.select("video_id", weight.alias("w"), wins).groupBy("video_id", F.col("win").cast("int").alias("win")).agg(F.sum("w").alias("w"))
    all_ = spine(tl.select("video_id").distinct(), DURATION // 5, name="win").join(sums, ["video_id", "win"], "left")
    return all_.select("video_id", big(F.col("win") * 5).alias("start_s"), dec(F.least(F.coalesce("w", F.lit(0.0)) / 10, F.lit(1.0))).alias("engagement"))


@query("bkt_10s_cuts", f"{SHOT_SQL}, c AS (SELECT video_id, CAST(floor(t / 10) AS BIGINT) AS zone, count(*) AS n FROM shot GROUP BY ALL) SELECT video_id, zone, n, n >= 0.8 * max(n) OVER (PARTITION BY video_id) AS dense FROM c")
def bkt_10s_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = shots(spark, sf_dir).groupBy("video_id", F.floor(F.col("t") / 10).cast("long").alias("zone")).agg(F.count("*").alias("n"))
    return c.withColumn("dense", F.col("n") >= 0.8 * F.max("n").over(Window.partitionBy("video_id")))


@query("bkt_n_windows", f"{DENS_SQL} SELECT video_id, CAST(sec // {DURATION // 10} AS BIGINT) AS win, CAST(sum(n) AS BIGINT) AS n FROM dens GROUP BY ALL")
def bkt_n_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir).groupBy("video_id", F.expr(f"cast(sec div {DURATION // 10} as bigint)").alias("win")).agg(F.sum("n").alias("n"))


@query("bkt_interval_n", f"{DENS_SQL} SELECT video_id, CAST(sec AS BIGINT) AS sec, n FROM dens WHERE sec % 3 = 0")
def bkt_interval_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir).where("sec % 3 = 0").select("video_id", big("sec").alias("sec"), "n")


@query("bkt_opening", f"WITH {TL_SQL} SELECT video_id, entry_type, count(*) AS n FROM tl WHERE t <= 5 GROUP BY ALL")
def bkt_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("t <= 5").groupBy("video_id", "entry_type").agg(F.count("*").alias("n"))


@query("bkt_cta_window", f"WITH {TL_SQL} SELECT video_id, entry_type, count(*) AS n FROM tl WHERE t >= {DURATION * 0.85} GROUP BY ALL")
def bkt_cta_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where(f"t >= {DURATION * 0.85}").groupBy("video_id", "entry_type").agg(F.count("*").alias("n"))


@query("bkt_density_prog", f"WITH {TL_SQL} SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, CAST(least(sum(CASE entry_type WHEN 'text' THEN 3 WHEN 'speech' THEN 2 ELSE 1 END), 10) AS BIGINT) AS density FROM tl WHERE t < 5 GROUP BY ALL")
def bkt_density_prog(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = F.when(F.col("entry_type") == "text", 3).when(F.col("entry_type") == "speech", 2).otherwise(1)
    return timeline(spark, sf_dir).where("t < 5").groupBy("video_id", F.floor("t").cast("long").alias("sec")).agg(F.least(F.sum(weight), F.lit(10)).cast("long").alias("density"))


@query("bkt_energy_5s", f"{DENS_SQL} SELECT video_id, CAST(sec // 5 AS BIGINT) AS win, CAST(avg(n) AS DECIMAL(18,6)) AS energy FROM dens GROUP BY ALL")
def bkt_energy_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density(spark, sf_dir).groupBy("video_id", F.expr("cast(sec div 5 as bigint)").alias("win")).agg(dec(F.avg("n")).alias("energy"))


@query("agg_density_bucket", f"WITH {TL_SQL} SELECT video_id, CAST(floor(t / 2) AS BIGINT) AS bucket, count(*) AS n FROM tl GROUP BY ALL")
def agg_density_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).groupBy("video_id", F.floor(F.col("t") / 2).cast("long").alias("bucket")).agg(F.count("*").alias("n"))


@query("agg_hook_density", f"WITH {TL_SQL} SELECT video_id, CAST(floor(t / 10) * 10 AS BIGINT) AS start_s, count(*) AS hooks FROM tl WHERE entry_type = 'gesture' GROUP BY ALL")
def agg_hook_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline(spark, sf_dir).where("entry_type = 'gesture'").groupBy("video_id", (F.floor(F.col("t") / 10) * 10).cast("long").alias("start_s")).agg(F.count("*").alias("hooks"))


@query("agg_peak_zone_cuts", f"""{SHOT_SQL}, c AS (SELECT video_id, CAST(floor(t / 10) AS BIGINT) AS zone, count(*) AS n FROM shot GROUP BY ALL), d AS (SELECT *, n >= 0.8 * max(n) OVER (PARTITION BY video_id) AS dense FROM c)
SELECT video_id, zone, n, CAST(n / 10.0 * 2 AS DECIMAL(18,6)) AS intensity FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY zone) AS r FROM d WHERE dense) WHERE r <= 3""")
def agg_peak_zone_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = bkt_10s_cuts(spark, sf_dir).where("dense").withColumn("r", F.row_number().over(Window.partitionBy("video_id").orderBy("zone")))
    return d.where("r <= 3").select("video_id", "zone", "n", dec(F.col("n") / 10.0 * 2).alias("intensity"))
