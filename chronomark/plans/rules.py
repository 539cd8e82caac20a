"""Classes, tags and quality of density, pacing, emotion, framing and speech; landmark rules; scene thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.functions import text as tx
from chronomark.operators.timeline import band_exists
from chronomark.plans._base import big, dec, query
from chronomark.plans.aggregates import DENS_SQL, density
from chronomark.plans.features import _BOX_SQL, boxes
from chronomark.plans.joins import inside
from chronomark.plans.overlays import named, named_sql
from chronomark.plans.windows import SHOT_SQL, shots
from chronomark.sources.testdata import DURATION, SEG_SQL, TL_SQL, segments, table, timeline


def _steps(c: list[tuple[str, str]], otherwise: str) -> Column:
    out = None
    for cond, name in c:
        out = F.when(F.expr(cond), name) if out is None else out.when(F.expr(cond), name)
    return out.otherwise(otherwise)


def _steps_sql(c: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for cond, name in c) + f" ELSE '{otherwise}' END"


# --- density ------------------------------------------------------------------------------------------------------

_THIRD = DURATION // 3
DENSITY_FACTS_SQL = f"{DENS_SQL}, f AS (SELECT video_id, CAST(sum(n) AS BIGINT) AS total, avg(n) AS m, stddev_pop(n) AS s, CAST(max(n) AS BIGINT) AS most, CAST(min(n) AS BIGINT) AS least_, count(*) FILTER (n > 0) AS busy, avg(n) FILTER (sec < {_THIRD}) AS a, avg(n) FILTER (sec >= {DURATION - _THIRD}) AS z, avg(n) FILTER (sec >= {DURATION - 5}) AS e FROM dens GROUP BY video_id)"
ACCELERATION = [("a > z * 1.5", "front_loaded"), ("z > a * 1.5", "back_loaded"), ("s > m * 0.5", "oscillating")]
DENSITY_FLAGS = [("a > m * 1.2", "strongOpeningHook"), ("z > a", "crescendoPattern"), ("a > z * 1.5", "frontLoaded"), ("s < m * 0.3", "consistentPacing"), ("e > m", "finalCallToAction"), ("s < m * 0.2", "rhythmicPattern")]
DENSITY_CLASS = [("m < 1", "sparse"), ("m <= 5", "moderate")]
COGNITIVE_LOAD = [("m < 2", "minimal"), ("m <= 4", "optimal")]


def deviation(n: str) -> Column:
    """Population deviation of whole numbers from exact sums: at ties no order of rows decides."""
    x = F.col(n).cast("decimal(18,0)")
    count, total, squares = F.count(n).cast("decimal(18,0)"), F.sum(x), F.sum(x * x)
    return F.sqrt((count * squares.cast("decimal(18,0)") - total.cast("decimal(18,0)") * total.cast("decimal(18,0)")).cast("double")) / F.count(n)


def density_facts(d: DataFrame) -> DataFrame:
    """Of ``video_id, sec, n``: total, mean ``m``, deviation ``s``, extremes, busy seconds, means of the first and last third ``a, z`` and of the end ``e``."""
    part = lambda c: F.avg(F.when(F.expr(c), F.col("n")))
    return d.groupBy("video_id").agg(F.sum("n").alias("total"), F.avg("n").alias("m"), deviation("n").alias("s"), F.max("n").alias("most"), F.min("n").alias("least_"), F.count_if(F.col("n") > 0).alias("busy"), part(f"sec < {_THIRD}").alias("a"), part(f"sec >= {DURATION - _THIRD}").alias("z"), part(f"sec >= {DURATION - 5}").alias("e"))


@query("cls_density", f"{DENSITY_FACTS_SQL} SELECT video_id, {_steps_sql(ACCELERATION, 'even')} AS pacing_style, {_steps_sql(DENSITY_CLASS, 'dense')} AS class, {_steps_sql(COGNITIVE_LOAD, 'challenging')} AS cognitive_load, {named_sql(*DENSITY_FLAGS)} AS flags FROM f")
def cls_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = density_facts(density(spark, sf_dir))
    return f.select("video_id", _steps(ACCELERATION, "even").alias("pacing_style"), _steps(DENSITY_CLASS, "dense").alias("class"), _steps(COGNITIVE_LOAD, "challenging").alias("cognitive_load"), named(*[(F.expr(c), n) for c, n in DENSITY_FLAGS]).alias("flags"))


# --- pacing -------------------------------------------------------------------------------------------------------

_HALF = DURATION / 2
PACING_FACTS_SQL = f"""{SHOT_SQL}, p0 AS (SELECT video_id, count(*) AS cuts, avg(d) AS mean, min(d) AS shortest, max(d) AS longest, coalesce(stddev_samp(d), 0) AS dev, coalesce(var_samp(d), 0) AS variance, count(*) FILTER (t < {_HALF}) AS early, count(*) FILTER (t >= {_HALF}) AS late FROM shot GROUP BY video_id),
p AS (SELECT *, cuts * 60 / {DURATION}.0 AS cpm, CASE WHEN cuts > 1 THEN 1 / (1 + dev) ELSE 1.0 END AS rhythm, CASE WHEN early > 0 THEN (late - early) / early WHEN late = 0 THEN 0 ELSE 1 END AS accel FROM p0)"""
PACING_CLASS = [("cpm < 10", "slow"), ("cpm < 20", "moderate"), ("cpm < 40", "fast")]
RHYTHM_CLASS = [("rhythm > 0.7", "consistent"), ("rhythm > 0.4", "varied")]
TREND = [("accel > 0.3", "accelerating"), ("accel < -0.3", "decelerating")]
PACING_TAGS = [("cpm >= 20 or mean < 4", "quick_cuts"), ("accel > 0.3", "accelerating_pace"), ("accel < -0.3", "decelerating_pace"), ("rhythm > 0.7", "rhythmic_editing"), ("cuts > 0", "has_montage_sections"), ("mean < 1.5", "mtv_style"), ("variance > mean", "experimental_pacing")]
PACING_ML_TAGS = [*PACING_TAGS, ("cpm >= 20 and cpm < 40", "fast_paced"), ("rhythm > 0.4 and rhythm <= 0.7", "variable_rhythm"), ("accel > 0.3", "building_momentum")]
EDITING_STYLE = [("mean < 1.5", "mtv_style"), ("rhythm > 0.7 and mean > 3", "classic_narrative"), ("rhythm > 0.7", "rhythmic")]


def pacing_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cuts, mean, shortest, longest, dev, variance, early, late, cpm`` (cuts a minute)``, rhythm, accel`` of an item's shots."""
    zero = F.lit(0.0)
    early = F.count_if(F.col("t") < _HALF)
    p = shots(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("cuts"), F.avg("d").alias("mean"), F.min("d").alias("shortest"), F.max("d").alias("longest"), F.coalesce(F.stddev_samp("d"), zero).alias("dev"), F.coalesce(F.var_samp("d"), zero).alias("variance"), early.alias("early"), (F.count("*") - early).alias("late"))
    rhythm = F.when(F.col("cuts") > 1, 1 / (1 + F.col("dev"))).otherwise(1.0)
    accel = F.when(F.col("early") > 0, F.try_divide(F.col("late") - F.col("early"), "early")).when(F.col("late") == 0, 0.0).otherwise(1.0)
    return p.select("*", (F.col("cuts") * 60 / float(DURATION)).alias("cpm"), rhythm.alias("rhythm"), accel.alias("accel"))


@query("cls_pacing", f"{PACING_FACTS_SQL} SELECT video_id, {_steps_sql(PACING_CLASS, 'very_fast')} AS class, {_steps_sql(RHYTHM_CLASS, 'erratic')} AS rhythm, {_steps_sql(TREND, 'stable')} AS trend, {_steps_sql(EDITING_STYLE, 'experimental')} AS editing_style, {named_sql(*PACING_ML_TAGS)} AS tags FROM p")
def cls_pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pacing_facts(spark, sf_dir).select("video_id", _steps(PACING_CLASS, "very_fast").alias("class"), _steps(RHYTHM_CLASS, "erratic").alias("rhythm"), _steps(TREND, "stable").alias("trend"), _steps(EDITING_STYLE, "experimental").alias("editing_style"), named(*[(F.expr(c), n) for c, n in PACING_ML_TAGS]).alias("tags"))


@query("cls_camera_align", f"{SHOT_SQL}, c AS (SELECT video_id, count(*) AS cuts FROM shot GROUP BY video_id), o AS (SELECT video_id, label % 3 AS k, lag(label % 3) OVER (PARTITION BY video_id ORDER BY t, seq) AS p FROM tl WHERE entry_type = 'object'), m AS (SELECT video_id, count(*) FILTER (k <> p) AS moves FROM o GROUP BY video_id) SELECT c.video_id, CAST(coalesce(moves, 0) / (cuts + 1) AS DECIMAL(18,6)) AS changes_per_shot, CAST(least(1.0, coalesce(moves, 0) / (cuts + 1)) AS DECIMAL(18,6)) AS alignment FROM c LEFT JOIN m USING (video_id)")
def cls_camera_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the camera's distance (close, medium, far by class) for each shot, and at most one of them."""
    w = Window.partitionBy("video_id").orderBy("t", "seq")
    o = timeline(spark, sf_dir).where("entry_type = 'object'").select("video_id", (F.col("label") % 3).alias("k"), F.lag(F.col("label") % 3).over(w).alias("p"))
    m = o.groupBy("video_id").agg(F.count_if(F.coalesce(F.col("k") != F.col("p"), F.lit(False))).alias("moves"))
    x = shots(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("cuts")).join(m, "video_id", "left")
    per = F.coalesce("moves", F.lit(0)) / (F.col("cuts") + 1)
    return x.select("video_id", dec(per).alias("changes_per_shot"), dec(F.least(F.lit(1.0), per)).alias("alignment"))


#: Thresholds of the cut detector with the least strength of a cut at each, in the order in which they are tried.
THRESHOLDS = [(20, 0.6), (15, 0.4), (10, 0.0)]


@query("flt_scene_threshold", f"WITH {TL_SQL}, c AS (SELECT video_id, " + ", ".join(f"count(*) FILTER (conf >= {least}) AS n{k}" for k, least in THRESHOLDS) + f" FROM tl WHERE entry_type = 'scene_change' GROUP BY video_id), k AS (SELECT *, CASE " + " ".join(f"WHEN {DURATION} BETWEEN n{k} AND 5 * n{k} THEN {k}" for k, _ in THRESHOLDS) + " ELSE 10 END AS threshold FROM c) SELECT video_id, CAST(threshold AS INTEGER) AS threshold, CASE threshold WHEN 20 THEN n20 WHEN 15 THEN n15 ELSE n10 END AS scenes FROM k")
def flt_scene_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first threshold that gives scenes of one to five seconds on average; the most sensitive one if none does."""
    n = lambda least: F.count_if(F.col("conf") >= least)
    c = timeline(spark, sf_dir).where("entry_type = 'scene_change'").groupBy("video_id").agg(*[n(least).alias(f"n{k}") for k, least in THRESHOLDS])
    k = _steps([(f"{DURATION} between n{t} and 5 * n{t}", str(t)) for t, _ in THRESHOLDS], "10").cast("int")
    return c.select("video_id", k.alias("threshold"), F.when(k == 20, F.col("n20")).when(k == 15, F.col("n15")).otherwise(F.col("n10")).alias("scenes"))


# --- emotion ------------------------------------------------------------------------------------------------------

EMOTION_FACTS_SQL = f"""WITH {TL_SQL}, e AS (SELECT *, lag(label) OVER (PARTITION BY video_id ORDER BY t, seq) AS p, EXISTS (SELECT 1 FROM tl g WHERE g.video_id = x.video_id AND g.entry_type = 'gesture' AND abs(g.t - x.t) <= 1) AS g FROM tl x WHERE entry_type = 'emotion'),
a AS (SELECT video_id, count(*) AS n, count(DISTINCT label) AS kinds, count(*) FILTER (label <> p) AS changes, avg(conf) AS sure, bool_or(label = 4) AS surprised, count(*) FILTER (g) / count(*) AS aligned, count(*) FILTER (p = 6 AND label IN (0, 4)) AS reveals, any_value(label) AS x FROM e GROUP BY video_id),
k AS (SELECT v.video_id, coalesce(n, 0) AS n, coalesce(kinds, 1) AS kinds, coalesce(changes, 0) AS changes, coalesce(sure, 0.5) AS sure, coalesce(surprised, false) AS surprised, coalesce(aligned, 0) AS aligned, coalesce(reveals, 0) AS reveals FROM (SELECT DISTINCT video_id FROM tl) v LEFT JOIN a USING (video_id))"""
ARCHETYPE = [("changes = 0", "steady_state"), ("kinds > 3", "complex_journey"), ("surprised", "positive_journey")]
EMOTION_ARC = [("changes > n * 0.3", "dynamic"), ("changes > 0", "evolving")]
EMOTION_PACING = [("changes > n * 0.4", "dynamic_pacing"), ("changes > 0", "gradual_build")]
EMOTION_TECHNIQUES = [("true", "steady_state"), ("changes > 2", "emotional_variety"), ("aligned > 0.5", "gesture_reinforcement")]
_EXPECTED_EMOTIONS = max(1, DURATION // 10)


def emotion_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n, kinds, changes, sure`` (mean confidence)``, surprised, aligned`` (share with a gesture near)``, reveals`` of every item.

    Confidences are added up in order of time, so that the mean's last bits do not depend on how rows were dealt."""
    tl = timeline(spark, sf_dir)
    w = Window.partitionBy("video_id").orderBy("t", "seq")
    e = tl.where("entry_type = 'emotion'").select("video_id", "seq", "t", "label", "conf", F.lag("label").over(w).alias("p"), F.sum("conf").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"))
    near = band_exists(e, tl.where("entry_type = 'gesture'"), 1.0).groupBy("video_id").agg(F.count("*").alias("near"))
    is_ = lambda c: F.count_if(F.coalesce(F.expr(c), F.lit(False)))
    a = e.groupBy("video_id").agg(F.count("*").alias("n"), F.countDistinct("label").alias("kinds"), is_("label <> p").alias("changes"), (F.max_by("so_far", F.struct("t", "seq")) / F.count("*")).alias("sure"), F.bool_or(F.col("label") == 4).alias("surprised"), is_("p = 6 and label in (0, 4)").alias("reveals"))
    x = tl.select("video_id").distinct().join(a, "video_id", "left").join(near, "video_id", "left")
    x = x.withColumn("aligned", F.coalesce(F.try_divide("near", "n"), F.lit(0.0))).drop("near")
    return x.na.fill(0, ["n", "changes", "reveals"]).na.fill(1, ["kinds"]).na.fill(0.5, ["sure"]).na.fill(False, ["surprised"])


@query("cls_emotion", f"{EMOTION_FACTS_SQL} SELECT video_id, {_steps_sql(ARCHETYPE, 'discovery')} AS archetype, {_steps_sql(EMOTION_ARC, 'stable')} AS arc, {_steps_sql(EMOTION_PACING, 'steady_state')} AS pacing, {named_sql(*EMOTION_TECHNIQUES)} AS techniques FROM k")
def cls_emotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emotion_facts(spark, sf_dir).select("video_id", _steps(ARCHETYPE, "discovery").alias("archetype"), _steps(EMOTION_ARC, "stable").alias("arc"), _steps(EMOTION_PACING, "steady_state").alias("pacing"), named(*[(F.expr(c), n) for c, n in EMOTION_TECHNIQUES]).alias("techniques"))


_MISSING_EMOTIONS = [("n = 0", "no_emotions_detected"), ("n > 0 and kinds = 1", "limited_emotional_range")]


@query("agg_emotion_quality", f"{EMOTION_FACTS_SQL}, q AS (SELECT *, least(1.0, n / {_EXPECTED_EMOTIONS}.0) AS complete, n / {DURATION}.0 AS cover FROM k) SELECT video_id, CAST(sure AS DECIMAL(18,6)) AS detection, CAST(cover AS DECIMAL(18,6)) AS coverage, CAST(complete AS DECIMAL(18,6)) AS completeness, CASE WHEN n = 0 THEN 'low' ELSE 'high' END AS reliability, {named_sql(*_MISSING_EMOTIONS)} AS missing, CAST(least(0.95, (sure + complete + cover) / 3) AS DECIMAL(18,6)) AS confidence FROM q")
def agg_emotion_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete, cover, sure = F.least(F.lit(1.0), F.col("n") / float(_EXPECTED_EMOTIONS)), F.col("n") / float(DURATION), F.col("sure")
    return emotion_facts(spark, sf_dir).select("video_id", dec(sure).alias("detection"), dec(cover).alias("coverage"), dec(complete).alias("completeness"), F.when(F.col("n") == 0, "low").otherwise("high").alias("reliability"), named(*[(F.expr(c), m) for c, m in _MISSING_EMOTIONS]).alias("missing"), dec(F.least(F.lit(0.95), (sure + complete + cover) / 3)).alias("confidence"))


_FEAT_SQL = f"""{EMOTION_FACTS_SQL}, v AS (SELECT video_id, CASE WHEN label IN (0, 4) THEN 1 WHEN label = 6 THEN 0 ELSE -1 END AS v, t FROM e), ar AS (SELECT video_id, avg(v) FILTER (t < {DURATION / 3}) AS a, avg(v) FILTER (t >= {DURATION * 2 / 3}) AS z, coalesce(stddev_samp(v), 0) AS s FROM v GROUP BY video_id),
nb AS (SELECT video_id, label, conf, t, lag(conf) OVER (PARTITION BY video_id ORDER BY t, seq) AS b, lead(conf) OVER (PARTITION BY video_id ORDER BY t, seq) AS f FROM e), pk AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY conf DESC, t) AS r FROM nb WHERE conf > b AND conf > f AND conf > 0.7),
tp AS (SELECT video_id, bool_or(label = 0) AS joy, bool_or(label IN (1, 2)) AS low, bool_or(label = 4) AS wow FROM pk WHERE r <= 3 GROUP BY video_id), dm AS (SELECT video_id, label AS dominant FROM (SELECT video_id, label, row_number() OVER (PARTITION BY video_id ORDER BY count(*) DESC, label) AS r FROM e GROUP BY video_id, label) WHERE r = 1),
ft AS (SELECT k.*, dominant, joy, low, wow, (kinds - 1) / 6.0 AS diversity, CASE WHEN z - a > 0.3 THEN 'rising' WHEN z - a < -0.3 THEN 'falling' WHEN s > 0.5 THEN 'rollercoaster' ELSE 'stable' END AS arc FROM k LEFT JOIN ar USING (video_id) LEFT JOIN tp USING (video_id) LEFT JOIN dm USING (video_id))"""
FEAT_ARCHETYPE = [("wow is null", "steady_state"), ("arc = 'rising' and joy", "surprise_delight"), ("arc = 'falling' and low", "problem_solution"), ("arc = 'rollercoaster'", "transformation"), ("wow", "discovery")]
FEAT_TECHNIQUES = [("changes > 5", "rapid_shifts"), ("diversity > 0.7", "emotional_variety"), ("reveals > 0", "surprise_reveal"), ("dominant in (0, 4)", "positive_framing")]
# What a viewer goes through in a journey.
VIEWER = {"surprise_delight": "engaged_throughout", "problem_solution": "tension_release", "transformation": "emotional_investment", "discovery": "curiosity_driven", "narrative": "story_following", "steady_state": "passive_viewing"}


def feat_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``emotion_facts`` with ``dominant, diversity, arc`` and whether the three strongest peaks have joy, sadness or anger, surprise."""
    w = Window.partitionBy("video_id").orderBy("t", "seq")
    e = timeline(spark, sf_dir).where("entry_type = 'emotion'").withColumn("v", F.when(F.col("label").isin(0, 4), 1).when(F.col("label") == 6, 0).otherwise(-1))
    part = lambda c: F.avg(F.when(F.expr(c), F.col("v")))
    ar = e.groupBy("video_id").agg(part(f"t < {DURATION / 3}").alias("a"), part(f"t >= {DURATION * 2 / 3}").alias("z"), F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("s"))
    nb = e.select("video_id", "label", "conf", "t", F.lag("conf").over(w).alias("b"), F.lead("conf").over(w).alias("f")).where("conf > b and conf > f and conf > 0.7")
    pk = nb.withColumn("r", F.row_number().over(Window.partitionBy("video_id").orderBy(F.desc("conf"), "t"))).where("r <= 3")
    has = lambda c: F.bool_or(F.expr(c))
    tp = pk.groupBy("video_id").agg(has("label = 0").alias("joy"), has("label in (1, 2)").alias("low"), has("label = 4").alias("wow"))
    dm = e.groupBy("video_id", "label").agg(F.count("*").alias("c")).groupBy("video_id").agg(F.min(F.struct((-F.col("c")).alias("m"), "label"))["label"].alias("dominant"))
    x = emotion_facts(spark, sf_dir).join(ar, "video_id", "left").join(tp, "video_id", "left").join(dm, "video_id", "left")
    arc = F.when(F.expr("z - a > 0.3"), "rising").when(F.expr("z - a < -0.3"), "falling").when(F.expr("s > 0.5"), "rollercoaster").otherwise("stable")
    return x.select("*", ((F.col("kinds") - 1) / 6.0).alias("diversity"), arc.alias("arc"))


@query("cls_archetype_feat", f"{_FEAT_SQL} SELECT video_id, arc, {_steps_sql(FEAT_ARCHETYPE, 'narrative')} AS archetype FROM ft")
def cls_archetype_feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat_facts(spark, sf_dir).select("video_id", "arc", _steps(FEAT_ARCHETYPE, "narrative").alias("archetype"))


def viewer(archetype: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in VIEWER.items() for x in kv]), archetype), F.lit("variable_engagement"))


@query("cls_techniques_feat", f"{_FEAT_SQL}, c AS (SELECT *, {_steps_sql(FEAT_ARCHETYPE, 'narrative')} AS archetype FROM ft) SELECT video_id, {named_sql(*FEAT_TECHNIQUES)} AS techniques, CASE archetype " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in VIEWER.items()) + " ELSE 'variable_engagement' END AS viewer_journey FROM c")
def cls_techniques_feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feat_facts(spark, sf_dir).withColumn("archetype", _steps(FEAT_ARCHETYPE, "narrative"))
    return f.select("video_id", named(*[(F.expr(c), n) for c, n in FEAT_TECHNIQUES]).alias("techniques"), viewer(F.col("archetype")).alias("viewer_journey"))


# --- framing ------------------------------------------------------------------------------------------------------

FRAMING_FACTS_SQL = f"""WITH {_BOX_SQL}, o AS (SELECT *, lag(shot) OVER (PARTITION BY video_id ORDER BY seq, p, x) AS q, row_number() OVER (PARTITION BY video_id ORDER BY seq, p, x) AS i FROM b),
f AS (SELECT video_id, count(*) AS n, count(*) FILTER (shot IN ('close', 'medium')) / count(*) AS face, count(*) FILTER (shot <> 'none') / count(*) AS person, count(*) FILTER (shot <> q) / count(*) AS volatility, count(*) FILTER (shot <> q) AS moves, count(*) FILTER (shot = 'close') / count(*) AS close, count(*) FILTER (shot = 'wide') / count(*) AS far, any_value(shot) FILTER (i = 1) AS intro FROM o GROUP BY video_id)"""
FRAMING_ARCHETYPE = [("face > 0.7 and volatility < 0.3", "talking_head"), ("person < 0.3", "product_focused"), ("person between 0.3 and 0.7", "balanced_presence")]
INTENT = [("intro = 'close' and face > 0.5", "personal_message"), ("intro = 'wide' and person > 0.5", "performance"), ("face > 0.6 and close > 0.5", "personal_message"), ("face > 0.6", "educational"), ("person < 0.3", "product_showcase")]
RISK = {
    "personal_message": "case when volatility > 0.5 then 0.3 else 0 end + case when close < 0.5 then 0.3 else 0 end + case when volatility >= 0.2 then 0.2 else 0 end",
    "product_showcase": "case when face > 0.5 then 0.3 else 0 end + case when volatility < 0.3 then 0.2 else 0 end",
}
_RISK = "case intent " + " ".join(f"when '{k}' then {v}" for k, v in RISK.items()) + " else 0 end"


def framing_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n, face, person`` (shares of frames)``, volatility, moves, close, far, intro`` of an item's boxes; frames in order."""
    w = Window.partitionBy("video_id").orderBy("seq", "p", "x")
    o = boxes(spark, sf_dir).withColumn("q", F.lag("shot").over(w))
    share = lambda c: F.count_if(F.coalesce(F.expr(c), F.lit(False))) / F.count("*")
    return o.groupBy("video_id").agg(F.count("*").alias("n"), share("shot in ('close', 'medium')").alias("face"), share("shot <> 'none'").alias("person"), share("shot <> q").alias("volatility"), F.count_if(F.coalesce(F.expr("shot <> q"), F.lit(False))).alias("moves"), share("shot = 'close'").alias("close"), share("shot = 'wide'").alias("far"), F.min(F.struct("seq", "p", "x", "shot"))["shot"].alias("intro"))


@query("cls_archetype_framing", f"{FRAMING_FACTS_SQL} SELECT video_id, {_steps_sql(FRAMING_ARCHETYPE, 'unknown')} AS archetype, {_steps_sql(INTENT, 'general_content')} AS intent FROM f")
def cls_archetype_framing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archetype and intent by rules; items have no recognised actions."""
    return framing_facts(spark, sf_dir).select("video_id", _steps(FRAMING_ARCHETYPE, "unknown").alias("archetype"), _steps(INTENT, "general_content").alias("intent"))


@query("cls_intent_risk", f"{FRAMING_FACTS_SQL}, i AS (SELECT *, {_steps_sql(INTENT, 'general_content')} AS intent FROM f) SELECT video_id, intent, CAST(least(1.0, {_RISK}) AS DECIMAL(18,6)) AS risk FROM i")
def cls_intent_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = framing_facts(spark, sf_dir).withColumn("intent", _steps(INTENT, "general_content"))
    return f.select("video_id", "intent", dec(F.least(F.lit(1.0), F.expr(f"cast({_RISK} as double)"))).alias("risk"))


@query("agg_framing_confidence", f"{FRAMING_FACTS_SQL}, c AS (SELECT *, (face + person + 0.9) / 3 AS core, CASE WHEN moves > 0 THEN 0.85 ELSE 0.7 END AS dynamics, 1.5 / 3 AS interactions, 3 / 6.0 AS complete FROM f) SELECT video_id, CAST(core AS DECIMAL(18,6)) AS core, CAST(dynamics AS DECIMAL(18,6)) AS dynamics, CAST(interactions AS DECIMAL(18,6)) AS interactions, CAST(complete AS DECIMAL(18,6)) AS completeness, CAST((core + dynamics + interactions + complete) / 4 AS DECIMAL(18,6)) AS overall FROM c")
def agg_framing_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of detection rates and of what is there: faces, objects and distances are, gaze, actions and background are not."""
    core, dynamics = (F.col("face") + F.col("person") + 0.9) / 3, F.when(F.col("moves") > 0, 0.85).otherwise(0.7)
    return framing_facts(spark, sf_dir).select("video_id", dec(core).alias("core"), dec(dynamics).alias("dynamics"), dec(F.lit(0.5)).alias("interactions"), dec(F.lit(0.5)).alias("completeness"), dec((core + dynamics + 0.5 + 0.5) / 4).alias("overall"))


_DISTANCE_SQL = "CAST(CASE shot WHEN 'close' THEN 0.2 WHEN 'wide' THEN 0.8 ELSE 0.5 END AS DOUBLE)"


@query("win_distance_jump", f"WITH {_BOX_SQL}, l AS (SELECT video_id, seq, p, x, {_DISTANCE_SQL} AS d, lag({_DISTANCE_SQL}) OVER (PARTITION BY video_id ORDER BY seq, p, x) AS q FROM b) SELECT video_id, count(*) FILTER (abs(d - q) > 0.3) AS jumps FROM l GROUP BY video_id")
def win_distance_jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the camera's distance (close .2, medium .5, far .8) of more than .3 from one frame to the next."""
    d = F.when(F.col("shot") == "close", 0.2).when(F.col("shot") == "wide", 0.8).otherwise(0.5)
    l = boxes(spark, sf_dir).withColumn("d", d).withColumn("q", F.lag("d").over(Window.partitionBy("video_id").orderBy("seq", "p", "x")))
    return l.groupBy("video_id").agg(F.count_if(F.coalesce(F.abs(F.col("d") - F.col("q")) > 0.3, F.lit(False))).alias("jumps"))


# --- landmarks: the first coordinates of a vector are y, the next x -------------------------------------------------

_LM_SQL = "lm AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))


_GAZE = "((e[1] - (e[3] + e[5]) / 2) + (e[7] - (e[9] + e[11]) / 2)) / 2 / 5", "((e[2] - (e[4] + e[6]) / 2) + (e[8] - (e[10] + e[12]) / 2)) / 2 / 5"


def _spark_index(sql: str) -> str:
    """Positions from one, as SQL counts them, to positions from nought."""
    import re

    return re.sub(r"e\[(\d+)\]", lambda m: f"e[{int(m[1]) - 1}]", sql)


GAZE = [("m < 0.02", "camera"), ("abs(x) > abs(y) and x > 0", "right"), ("abs(x) > abs(y)", "left"), ("y > 0", "down")]


@query("mth_gaze", f"WITH {_LM_SQL}, o AS (SELECT vec_id, {_GAZE[0]} AS x, {_GAZE[1]} AS y FROM lm), g AS (SELECT *, sqrt(x * x + y * y) AS m FROM o) SELECT vec_id, CAST(x AS DECIMAL(18,6)) AS offset_x, CAST(y AS DECIMAL(18,6)) AS offset_y, CAST(m AS DECIMAL(18,6)) AS magnitude, {_steps_sql(GAZE, 'up')} AS direction, CAST(CASE WHEN m < 0.02 THEN greatest(0, 1 - m / 0.02) ELSE 0 END AS DECIMAL(18,4)) AS eye_contact FROM g")
def mth_gaze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of the irises from the middle of the eyes' corners, averaged over both eyes; a small one looks into the camera."""
    o = landmarks(spark, sf_dir).select("vec_id", F.expr(_spark_index(_GAZE[0])).alias("x"), F.expr(_spark_index(_GAZE[1])).alias("y"))
    g = o.withColumn("m", F.sqrt(F.expr("x * x + y * y")))
    score = F.when(F.col("m") < 0.02, F.greatest(F.lit(0.0), 1 - F.col("m") / 0.02)).otherwise(0.0)
    return g.select("vec_id", dec("x").alias("offset_x"), dec("y").alias("offset_y"), dec("m").alias("magnitude"), _steps(GAZE, "up").alias("direction"), dec(score, 4).alias("eye_contact"))


_ALT = "(case when abs(e[5] - e[3]) > 0 then (e[1] - e[3]) / abs(e[5] - e[3]) else 0.5 end + case when abs(e[11] - e[9]) > 0 then (e[7] - e[9]) / abs(e[11] - e[9]) else 0.5 end) / 2"


@query("mth_gaze_alt", f"WITH {_LM_SQL}, o AS (SELECT vec_id, {_ALT} AS p FROM lm) SELECT vec_id, CAST(p AS DECIMAL(18,4)) AS position, CASE WHEN p BETWEEN 0.35 AND 0.65 THEN 'camera' ELSE 'away' END AS direction FROM o")
def mth_gaze_alt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of the irises between the inner and the outer corners, averaged over both eyes."""
    o = landmarks(spark, sf_dir).select("vec_id", F.expr(_spark_index(_ALT)).alias("p"))
    return o.select("vec_id", dec("p", 4).alias("position"), F.when(F.col("p").between(0.35, 0.65), "camera").otherwise("away").alias("direction"))


def _y(i: int) -> str:
    return f"e[{i + 1}]"


def _x(i: int) -> str:
    return f"e[{i + 30}]"


_TIPS, _MCPS = [4, 8, 12, 16, 20], [2, 5, 9, 13, 17]
_up = " + ".join(f"case when {_y(t)} < {_y(m)} then 1 else 0 end" for t, m in zip(_TIPS, _MCPS, strict=True))
_down = " + ".join(f"case when {_y(t)} > {_y(m)} then 1 else 0 end" for t, m in zip(_TIPS[1:], _MCPS[1:], strict=True))
HAND = {
    "thumbs_up": f"{_y(4)} < {_y(8)} - 0.1 and {_y(4)} < {_y(12)} - 0.1 and {_y(8)} > {_y(5)}",
    "peace_sign": f"{_y(8)} < {_y(5)} and {_y(12)} < {_y(9)} and {_y(16)} > {_y(13)} and {_y(20)} > {_y(17)}",
    "pointing": f"{_y(8)} < {_y(5)} - 0.05 and {_y(12)} > {_y(9)}",
    "open_palm": f"{_up} >= 4",
    "fist": f"{_down} >= 4",
    "heart": f"sqrt(({_x(4)} - {_x(8)}) * ({_x(4)} - {_x(8)}) + ({_y(4)} - {_y(8)}) * ({_y(4)} - {_y(8)})) < 0.05",
}
POSE = [
    (f"{_y(23)} < {_y(25)} and {_y(25)} < {_y(27)}", "standing"),
    (f"abs({_y(23)} - {_y(25)}) < 0.1", "sitting"),
    (f"{_y(15)} < ({_y(11)} + {_y(12)}) / 2 or {_y(16)} < ({_y(11)} + {_y(12)}) / 2 or abs({_x(27)} - {_x(28)}) > 0.2", "dancing"),
    (f"{_y(15)} < {_y(11)} or {_y(16)} < {_y(12)}", "arms_up"),
    (f"{_x(15)} > 0.5 and {_x(16)} < 0.5", "arms_crossed"),
]


@query("mth_gesture_rules", f"WITH {_LM_SQL} SELECT vec_id, {', '.join(f'({c}) AS {n}' for n, c in HAND.items())} FROM lm")
def mth_gesture_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which hand shapes a set of landmarks fits."""
    return landmarks(spark, sf_dir).select("vec_id", *[F.expr(_spark_index(c)).alias(n) for n, c in HAND.items()])


@query("mth_pose_rules", f"WITH {_LM_SQL} SELECT vec_id, {_steps_sql(POSE, 'standing')} AS pose FROM lm")
def mth_pose_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first pose that a body's landmarks fit; standing if none."""
    return landmarks(spark, sf_dir).select("vec_id", _steps([(_spark_index(c), n) for c, n in POSE], "standing").alias("pose"))


# --- speech -------------------------------------------------------------------------------------------------------

#: The driver's invented prose has no phrases to find, so every turn says one of these at its end.
SAID = ["did you know", "follow me and order now", "link in bio", "", "this is a secret trick", "amazing", "share with a friend today"]
# Phrases of hooks and of calls to action, by kind.
HOOK_PATTERNS = {
    "question": ["did you know", "guess what", "wait for it", "watch this", "check this out"],
    "hyperbole": ["amazing", "incredible", "mind-blowing", "shocking", "unbelievable"],
    "promise": ["you won't believe", "you need to see", "this will change"],
    "greeting": ["hey", "hi", "hello", "what's up"],
    "value_prop": ["secret", "trick", "hack", "tip"],
}
CTA_PATTERNS = {
    "engagement": ["follow", "like", "subscribe", "comment", "share", "hit the"],
    "traffic": ["link in bio", "check out", "visit", "go to"],
    "conversion": ["buy", "purchase", "get yours", "order now"],
    "save": ["save this", "bookmark", "remember"],
    "viral": ["tag someone", "send this", "share with"],
}
_SAID_SQL = "(['" + "', '".join(SAID) + "'])[turn % 7 + 1]"
TRANSCRIPT_SQL = f"""{SEG_SQL}, tr AS (SELECT conv_id AS video_id, lower(string_agg(coalesce(text, '') || ' ' || {_SAID_SQL}, ' ' ORDER BY turn)) AS low FROM conversations GROUP BY conv_id), sp AS (SELECT video_id, sum(end_s - start_s) AS speech_s FROM seg GROUP BY video_id),
ts AS (SELECT video_id, low, len(regexp_extract_all(low, '[^ \\n\\t\\r]+')) AS words, speech_s FROM tr JOIN sp USING (video_id))"""


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, low, words, speech_s``: an item's whole transcript in lower case, its words and its time of speech."""
    said = F.element_at(F.array(*map(F.lit, SAID)), (F.col("seq") % 7 + 1).cast("int"))
    s = segments(spark, sf_dir).select("video_id", "seq", F.concat_ws(" ", F.coalesce("text", F.lit("")), said).alias("x"), (F.col("end_s") - F.col("start_s")).alias("d"))
    g = s.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("seq", "x"))).alias("xs"), F.sum("d").alias("speech_s"))
    low = F.lower(F.array_join(F.transform("xs", lambda v: v["x"]), " "))
    return g.select("video_id", low.alias("low"), F.size(tx.words(low)).alias("words"), "speech_s")


def _pattern(kind: str, phrases: list[str], java: bool) -> str:
    body = "|".join(phrases)
    if kind == "greeting":
        return f"^(?:{body})"
    return tx.bounded(body) if java else rf"\b(?:{body})\b"


def _found_sql(patterns: dict[str, list[str]]) -> str:
    """Matches of every kind with the words before each: the texts between matches tell where they are."""
    parts = []
    for kind, phrases in patterns.items():
        p = _pattern(kind, phrases, False).replace("'", "''")
        parts.append(f"SELECT video_id, '{kind}' AS kind, low, words, speech_s, regexp_extract_all(low, '{p}') AS m, string_split_regex(low, '{p}') AS s FROM ts")
    at = "list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
    return f"mm AS ({' UNION ALL '.join(parts)}), mi AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM mm), ma AS (SELECT video_id, kind, m[i] AS match, CAST({at} AS BIGINT) AS place, words, speech_s, len(regexp_extract_all(left(low, CAST({at} AS BIGINT)), '[^ \\n\\t\\r]+')) AS before FROM mi), found AS (SELECT video_id, kind, match, place, CASE WHEN words > 0 THEN before / words * speech_s ELSE 0 END AS at_s, speech_s FROM ma)"


def phrases(patterns: dict[str, list[str]]) -> Column:
    """Of a row of ``transcripts`` ``array<struct<kind, match, place, at_s>>``: what is found of all kinds, by kind and place.

    The texts between matches tell where they are; the time is the share of words before times the speech time.
    """
    def of(kind: str, pattern: str) -> Column:
        rows = F.transform(F.regexp_extract_all("low", F.lit(f"({pattern})"), F.lit(1)), lambda m, i: F.struct(F.lit(kind).alias("kind"), m.alias("match"), i.alias("i")))
        between = F.split("low", pattern, -1)
        upto = lambda a, n, length: F.aggregate(F.slice(a, F.lit(1), n), F.lit(0), lambda x, y: x + length(y))
        placed = F.transform(rows, lambda r: r.withField("place", upto(between, r["i"] + 1, F.char_length) + upto(rows, r["i"], lambda y: F.char_length(y["match"]))))
        return F.when(F.col("low").rlike(pattern), placed).otherwise(F.slice(placed, 1, 0))

    parts = [of(kind, _pattern(kind, words, True)) for kind, words in patterns.items()]
    whole = F.concat(*parts)
    before = lambda r: F.size(tx.words(F.left("low", r["place"])))
    return F.transform(whole, lambda r: F.struct(r["kind"].alias("kind"), r["match"].alias("match"), big(r["place"]).alias("place"), F.when(F.col("words") > 0, before(r) / F.col("words") * F.col("speech_s")).otherwise(0.0).alias("at_s")))


def found(spark: SparkSession, sf_dir: str, patterns: dict[str, list[str]]) -> DataFrame:
    """``video_id, kind, match, place, at_s, speech_s``: a row for every phrase in a transcript."""
    x = transcripts(spark, sf_dir).select("video_id", "speech_s", F.explode(phrases(patterns)).alias("x"))
    return x.select("video_id", "x.kind", "x.match", "x.place", "x.at_s", "speech_s")


@query("txt_hook_matches", f"WITH {TRANSCRIPT_SQL}, {_found_sql(HOOK_PATTERNS)} SELECT video_id, kind, match, place, CAST(at_s AS DECIMAL(18,4)) AS at_s FROM found")
def txt_hook_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir, HOOK_PATTERNS).select("video_id", "kind", "match", "place", dec("at_s", 4).alias("at_s"))


_URGENCY = [("contains(match, 'now') or contains(match, 'today') or contains(match, 'quick')", "high"), ("at_s > speech_s * 0.7", "medium")]


@query("txt_cta_matches", f"WITH {TRANSCRIPT_SQL}, {_found_sql(CTA_PATTERNS)} SELECT video_id, kind, match, place, CAST(at_s AS DECIMAL(18,4)) AS at_s, {_steps_sql(_URGENCY, 'low')} AS urgency FROM found")
def txt_cta_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(spark, sf_dir, CTA_PATTERNS).select("video_id", "kind", "match", "place", dec("at_s", 4).alias("at_s"), _steps(_URGENCY, "low").alias("urgency"))


_WPM_SQL = f"""{SEG_SQL}, du AS (SELECT video_id, max(end_s) AS dur, CAST(floor(max(end_s)) AS BIGINT) AS n FROM seg GROUP BY video_id),
x AS (SELECT video_id, words, start_s, end_s, unnest(range(CAST(floor(start_s) AS BIGINT), CAST(ceil(end_s) AS BIGINT))) AS sec FROM seg WHERE end_s > start_s),
w0 AS (SELECT video_id, sec, sum(floor(words * (least(end_s, sec + 1) - greatest(start_s, sec)) / (end_s - start_s) + 1e-9)) AS w, sum(least(end_s, sec + 1) - greatest(start_s, sec)) AS s FROM x GROUP BY ALL),
w1 AS (SELECT w0.video_id, w / s * 60 AS wpm FROM w0 JOIN du USING (video_id) WHERE sec < n),
h AS (SELECT seg.video_id, sum(words) FILTER (start_s < dur / 2) AS a, sum(words) FILTER (start_s >= dur / 2) AS b FROM seg JOIN du USING (video_id) GROUP BY ALL),
r AS (SELECT du.video_id, n, coalesce(sum(wpm), 0) / n AS m, CASE WHEN n > 1 THEN greatest(0, (coalesce(sum(wpm * wpm), 0) - coalesce(sum(wpm), 0) * coalesce(sum(wpm), 0) / n) / (n - 1)) ELSE 0 END AS v, coalesce(max(wpm), 0) AS most FROM du LEFT JOIN w1 USING (video_id) WHERE n > 0 GROUP BY du.video_id, n),
k AS (SELECT r.*, CASE WHEN coalesce(a, 0) > 0 THEN (coalesce(b, 0) - a) / a WHEN coalesce(b, 0) = 0 THEN 0 ELSE 1 END AS accel FROM r JOIN h USING (video_id))"""
SPEECH_RHYTHM = [("v < m * 0.2", "flowing"), ("accel > 0.3", "building"), ("most > m * 1.5", "staccato")]


def speech_rhythm_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n`` windows of a second, mean ``m``, variance ``v`` and maximum ``most`` of their words a minute, ``accel`` of the second half."""
    seg = segments(spark, sf_dir)
    du = seg.groupBy("video_id").agg(F.max("end_s").alias("dur"), F.floor(F.max("end_s")).alias("n"))
    s = seg.where("end_s > start_s")
    x = s.select("*", F.explode(F.sequence(F.floor("start_s"), F.ceil("end_s") - 1)).alias("sec"))
    here = F.least(F.col("end_s"), F.col("sec") + 1) - F.greatest(F.col("start_s"), F.col("sec"))
    w = x.groupBy("video_id", "sec").agg(F.sum(F.floor(F.col("words") * here / (F.col("end_s") - F.col("start_s")) + 1e-9)).alias("w"), F.sum(here).alias("s"))
    wpm = F.col("w") / F.col("s") * 60
    h = seg.join(du, "video_id").groupBy("video_id").agg(F.sum(F.when(F.expr("start_s < dur / 2"), F.col("words")).otherwise(0)).alias("a"), F.sum(F.when(F.expr("start_s >= dur / 2"), F.col("words")).otherwise(0)).alias("b"))
    sums = w.join(du, "video_id").where("sec < n").groupBy("video_id").agg(F.sum(wpm).alias("t"), F.sum(wpm * wpm).alias("q"), F.max(wpm).alias("most"))
    r = du.where("n > 0").join(sums, "video_id", "left").join(h, "video_id").na.fill(0, ["t", "q", "most"])
    v = F.when(F.col("n") > 1, F.greatest(F.lit(0.0), F.try_divide(F.col("q") - F.col("t") * F.col("t") / F.col("n"), F.col("n") - 1))).otherwise(0.0)
    accel = F.when(F.col("a") > 0, F.try_divide(F.col("b") - F.col("a"), "a")).when(F.col("b") == 0, 0.0).otherwise(1.0)
    return r.select("video_id", "n", (F.col("t") / F.col("n")).alias("m"), v.alias("v"), "most", accel.alias("accel"))


@query("cls_speech_rhythm", f"WITH {_WPM_SQL} SELECT video_id, {_steps_sql(SPEECH_RHYTHM, 'erratic')} AS rhythm, CAST(CASE WHEN m > 0 THEN 1 / (1 + v / m) ELSE 0 END AS DECIMAL(18,4)) AS consistency FROM k")
def cls_speech_rhythm(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = speech_rhythm_facts(spark, sf_dir)
    return k.select("video_id", _steps(SPEECH_RHYTHM, "erratic").alias("rhythm"), dec(F.when(F.col("m") > 0, 1 / (1 + F.try_divide("v", "m"))).otherwise(0.0), 4).alias("consistency"))


def _phrases_sql(name: str, patterns: dict[str, list[str]]) -> str:
    """``found`` of these patterns under another name."""
    return _found_sql(patterns).replace("mm AS", f"{name}m AS", 1).replace("FROM mm)", f"FROM {name}m)").replace("mi AS", f"{name}i AS", 1).replace("FROM mi)", f"FROM {name}i)").replace("ma AS", f"{name}a AS", 1).replace("FROM ma)", f"FROM {name}a)").replace("found AS", f"{name} AS", 1)


_FILLER = "|".join(sorted(tx.FILLERS, key=len, reverse=True))
_DIRECT = "|".join(sorted(tx.DIRECT, key=len, reverse=True)).replace("'", "''")
_QUESTION = r"\?|[.!][ \n\t\r]*(?:did|what|why|how|when|where|who|which)"
SPEECH_FACTS_SQL = f"""WITH {TL_SQL}, {TRANSCRIPT_SQL}, {_phrases_sql('hk', HOOK_PATTERNS)}, {_phrases_sql('ct', CTA_PATTERNS)},
hn AS (SELECT video_id, count(*) AS hooks, count(*) FILTER (at_s < 3) AS opening FROM hk GROUP BY video_id),
cs AS (SELECT *, CASE WHEN at_s - lag(at_s) OVER (PARTITION BY video_id ORDER BY at_s, place, kind) < 5 THEN 0 ELSE 1 END AS new FROM ct), cg AS (SELECT *, sum(new) OVER (PARTITION BY video_id ORDER BY at_s, place, kind ROWS UNBOUNDED PRECEDING) AS g FROM cs),
cn AS (SELECT video_id, CAST(sum(c) AS BIGINT) AS ctas, count(*) FILTER (c >= 2) AS clusters FROM (SELECT video_id, g, count(*) AS c FROM cg GROUP BY ALL) GROUP BY video_id),
gp AS (SELECT video_id, start_s - lag(end_s) OVER (PARTITION BY video_id ORDER BY start_s, seq) AS g FROM seg), gn AS (SELECT video_id, count(*) FILTER (g > 1) AS pauses, count(*) FILTER (g > 2 AND g <= 3) AS dramatic FROM gp GROUP BY video_id),
pt AS (SELECT video_id, floor(t) AS sec, entry_type FROM tl WHERE floor(t) <> 0), sg AS (SELECT s.video_id, s.seq, count(*) FILTER (entry_type = 'gesture') > 0 AS g, count(*) FILTER (entry_type = 'emotion') AS f FROM seg s LEFT JOIN pt p ON p.video_id = s.video_id AND p.sec BETWEEN s.start_s AND s.end_s GROUP BY ALL),
sn AS (SELECT video_id, count(*) FILTER (g) / count(*) AS gesture, sum(f) AS faces, count(*) AS n FROM sg GROUP BY video_id),
wl AS (SELECT video_id, regexp_extract_all(low, '[^ \\n\\t\\r]+') AS w FROM ts), ng AS (SELECT video_id, unnest(list_concat(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 1], ' ')) ELSE [] END, CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) ELSE [] END)) AS ph FROM wl),
nc AS (SELECT video_id, ph, count(*) AS c FROM ng WHERE NOT regexp_matches(ph, 'the|and|for') AND NOT (len(string_split(ph, ' ')) = 2 AND regexp_matches(ph, 'you|this')) GROUP BY ALL), nr AS (SELECT video_id, least(5, count(*)) AS repeated FROM nc WHERE c >= 2 GROUP BY video_id),
k AS (SELECT ts.video_id, words, speech_s, CASE WHEN speech_s > 0 THEN words * 60 / speech_s ELSE 0 END AS wpm, coalesce(hooks, 0) AS hooks, least(coalesce(opening, 0) / 2, 1) AS opening, coalesce(ctas, 0) AS ctas, coalesce(clusters, 0) AS clusters, pauses, dramatic, gesture,
  CASE WHEN speech_s > 0 THEN faces / speech_s ELSE 0 END AS face, coalesce(repeated, 0) AS repeated, len(regexp_extract_all(low, '\\b(?:{_DIRECT})\\b')) AS direct, len(regexp_extract_all(low, '{_QUESTION}')) AS questions, CASE WHEN words > 0 THEN len(regexp_extract_all(low, '\\b(?:{_FILLER})\\b')) / words ELSE 0 END AS filler
  FROM ts JOIN gn USING (video_id) JOIN sn USING (video_id) LEFT JOIN hn USING (video_id) LEFT JOIN cn USING (video_id) LEFT JOIN nr USING (video_id))"""
#: Segments have no confidence, which then is .5; items have no audio energy, so the burst pattern is "none".
SPEECH_TAGS = [("opening > 0.5", "strong_opening"), ("wpm > 150", "rapid_delivery"), ("pauses > 3 and dramatic > 0", "has_dramatic_pauses"), ("repeated > 0", "repetitive_emphasis"), ("direct > words * 0.05", "direct_address_heavy"), ("clusters > 0", "cta_clustered"), ("gesture > 0.6", "high_gesture_sync"), ("face > 0.8", "face_focused_delivery")]


def _truth(*rules: str) -> str:
    return " + ".join(f"case when {r} then 1 else 0 end" for r in rules)


_HOOK_SCORE = "least(hooks * 0.2 + opening, 1)"
SPEECH_SCORES = {
    "hook_effectiveness": _HOOK_SCORE,
    "cta_effectiveness": "least(ctas * 0.1 + clusters * 0.3, 1)",
    "delivery_confidence": "0.5",
    "authenticity": f"({_truth('filler < 0.05', 'filler > 0.01', 'repeated < 3', 'true')}) / 4.0",
    "verbal_engagement": f"({_truth(_HOOK_SCORE + ' > 0', 'direct > 0', 'questions > 0', 'gesture > 0.5', 'wpm > 120')}) / 6.0",
    "visual_verbal_harmony": "(gesture + face) / 2",
}


def speech_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``words, speech_s, wpm, hooks, opening, ctas, clusters, pauses, dramatic, gesture, face, repeated, direct, questions, filler`` of a transcript."""
    t = transcripts(spark, sf_dir).select("*", phrases(HOOK_PATTERNS).alias("hk"), F.array_sort(F.transform(phrases(CTA_PATTERNS), lambda c: c["at_s"])).alias("ct"))
    # a cluster counts when its second call comes, under five seconds after its first
    clusters = F.expr("aggregate(ct, named_struct('last', -1e9, 'n', 0, 'c', 0L), (a, x) -> named_struct('last', x, 'n', if(x - a.last < 5, a.n + 1, 1), 'c', a.c + if(x - a.last < 5 and a.n = 1, 1L, 0L)), a -> a.c)")
    t = t.select("video_id", "low", "words", "speech_s", big(F.size("hk")).alias("hooks"), big(F.size(F.filter("hk", lambda h: h["at_s"] < 3))).alias("opening"), big(F.size("ct")).alias("ctas"), clusters.alias("clusters"))
    seg = segments(spark, sf_dir)
    gp = seg.withColumn("g", F.col("start_s") - F.lag("end_s").over(Window.partitionBy("video_id").orderBy("start_s", "seq")))
    is_ = lambda c: F.count_if(F.coalesce(F.expr(c), F.lit(False)))
    gn = gp.groupBy("video_id").agg(is_("g > 1").alias("pauses"), is_("g > 2 and g <= 3").alias("dramatic"), F.count("*").alias("segments"))
    hits = inside(spark, sf_dir).where("entry_type in ('gesture', 'emotion')").groupBy("video_id", "seq").agg(F.bool_or(F.col("entry_type") == "gesture").alias("g"), F.count_if(F.col("entry_type") == "emotion").alias("f"))
    sn = hits.groupBy("video_id").agg(F.count_if("g").alias("with_gesture"), F.sum("f").alias("faces"))
    w = t.select("video_id", tx.words(F.col("low")).alias("w")).where(F.size("w") >= 3)
    ng = w.select("video_id", F.explode(F.concat(F.slice(tx.ngrams(F.col("w"), 2), F.lit(1), F.size("w") - 2), tx.ngrams(F.col("w"), 3))).alias("ph"))
    ng = ng.where(~F.col("ph").rlike("the|and|for") & ~((F.size(F.split("ph", " ")) == 2) & F.col("ph").rlike("you|this")))
    nr = ng.groupBy("video_id", "ph").agg(F.count("*").alias("c")).where("c >= 2").groupBy("video_id").agg(F.least(F.lit(5), F.count("*")).alias("repeated"))
    x = t.join(gn, "video_id").join(sn, "video_id", "left").join(nr, "video_id", "left").na.fill(0, ["with_gesture", "faces", "repeated"])
    per = lambda a, b: F.when(F.col(b) > 0, F.try_divide(a, F.col(b))).otherwise(0.0)
    return x.select("video_id", "words", "speech_s", "segments", per(F.col("words") * 60, "speech_s").alias("wpm"), "hooks", F.least(F.col("opening") / 2, F.lit(1.0)).alias("opening"), "ctas", "clusters", "pauses", "dramatic", (F.col("with_gesture") / F.col("segments")).alias("gesture"), per(F.col("faces"), "speech_s").alias("face"), "repeated",
                    tx.whole_words(F.col("low"), tx.DIRECT).alias("direct"), F.regexp_count("low", F.lit(_QUESTION)).alias("questions"), per(tx.whole_words(F.col("low"), tx.FILLERS), "words").alias("filler"))


@query("cls_speech_tags", f"{SPEECH_FACTS_SQL} SELECT video_id, {named_sql(*SPEECH_TAGS)} AS tags FROM k")
def cls_speech_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speech_facts(spark, sf_dir).select("video_id", named(*[(F.expr(c), n) for c, n in SPEECH_TAGS]).alias("tags"))


@query("cls_speech_scores", f"{SPEECH_FACTS_SQL} SELECT video_id, {', '.join(f'CAST({c} AS DECIMAL(18,4)) AS {n}' for n, c in SPEECH_SCORES.items())} FROM k")
def cls_speech_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speech_facts(spark, sf_dir).select("video_id", *[dec(F.expr(f"cast({c} as double)"), 4).alias(n) for n, c in SPEECH_SCORES.items()])

