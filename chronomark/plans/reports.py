"""Reports: six blocks of an item as JSON texts, assembled from one row of facts an item.

A report's block is a JSON object; numbers are exact decimals, so that two engines write the same text. Fields that no
producer fills carry their fixed default. ``*_report`` return the blocks as structs, the queries as JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.functions import text as tx
from chronomark.operators.timeline import band_exists, islands, spine
from chronomark.plans import buckets, rules  # noqa: F401  the markers are made of registered queries
from chronomark.plans._base import ORACLE_SQL, QUERIES, query
from chronomark.plans.features import boxes
from chronomark.plans.overlays import CLS_OVERLAY_SQL, TECHNIQUES, overlay_facts
from chronomark.plans.rules import (
    ACCELERATION,
    ARCHETYPE,
    COGNITIVE_LOAD,
    DENSITY_CLASS,
    DENSITY_FACTS_SQL,
    DENSITY_FLAGS,
    EDITING_STYLE,
    EMOTION_ARC,
    EMOTION_FACTS_SQL,
    EMOTION_PACING,
    EMOTION_TECHNIQUES,
    FEAT_ARCHETYPE,
    FEAT_TECHNIQUES,
    FRAMING_FACTS_SQL,
    PACING_FACTS_SQL,
    RHYTHM_CLASS,
    SPEECH_FACTS_SQL,
    _steps_sql,
)
from chronomark.sources.testdata import DURATION, EMOTIONS, TL_SQL, segments, timeline

BLOCKS = ["CoreMetrics", "Dynamics", "Interactions", "KeyEvents", "Patterns", "Quality"]
Fields = dict[str, tuple[str, str]]


def constant(x: float | str | bool | list) -> tuple[str, str]:
    """A fixed value in the SQL of Spark and of DuckDB."""
    if isinstance(x, bool):
        return str(x).lower(), str(x).lower()
    if isinstance(x, str):
        return f"'{x}'", f"'{x}'"
    if isinstance(x, list):
        body = ", ".join(f"'{v}'" for v in x)
        return (f"array({body})", f"[{body}]") if x else ("cast(array() as array<string>)", "CAST([] AS VARCHAR[])")
    return (str(x), str(x)) if isinstance(x, int) else (f"cast({x} as decimal(18,6))", f"CAST({x} AS DECIMAL(18,6))")


def number(sql: str) -> tuple[str, str]:
    """The same expression in both engines, as an exact decimal."""
    return (f"cast(cast({sql} as decimal(18,9)) as decimal(18,6))",) * 2  # noise of the last bits goes first


def same(sql: str) -> tuple[str, str]:
    return sql, sql


def steps(rule: list[tuple[str, str]], otherwise: str) -> tuple[str, str]:
    return (_steps_sql(rule, otherwise),) * 2


def names(rule) -> tuple[str, str]:
    """The names of the rules that hold, as a list."""
    cases = ", ".join(f"case when {c} then '{n}' end" for c, n in rule)
    return f"array_compact(array({cases}))", f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def six_blocks(flat: DataFrame, prefix: str, blocks: dict[str, Fields], key: str = "video_id") -> DataFrame:
    """Facts of an item as the structs ``<prefix>CoreMetrics`` and so on; a block without fields is left out."""
    return flat.select(key, *[F.struct(*[F.expr(spark).alias(n) for n, (spark, _) in blocks[b].items()]).alias(f"{prefix}{b}") for b in BLOCKS if b in blocks])


def as_json(report: DataFrame, key: str = "video_id") -> DataFrame:
    """Every struct of a report as JSON text, with the fields that are null."""
    return report.select(key, *[F.to_json(c, {"ignoreNullFields": "false"}).alias(c) for c in report.columns if c != key])


def blocks_sql(cte: str, source: str, prefix: str, blocks: dict[str, Fields], key: str = "video_id") -> str:
    made = ", ".join("CAST(to_json({" + ", ".join(f"'{n}': {duck}" for n, (_, duck) in blocks[b].items()) + f"}}) AS VARCHAR) AS {prefix}{b}" for b in BLOCKS if b in blocks)
    return f"{cte} SELECT {key}, {made} FROM {source}"


def ensure_blocks(flat: DataFrame, prefix: str, blocks: dict[str, Fields], key: str = "video_id") -> DataFrame:
    """``flat`` as it is if it has blocks already, else its six blocks."""
    return flat if any(c.endswith("CoreMetrics") for c in flat.columns) else six_blocks(flat, prefix, blocks, key)


# --- density: one aggregation to (item, second), one to the item; the rest are expressions over its seconds ---------

_KINDS = {"tx": "text", "ob": "object", "ge": "gesture", "ex": "emotion", "sc": "scene_change"}
_NAMES = {"tx": "text", "ob": "object", "ge": "gesture", "ex": "expression", "sc": "transition"}


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, c``: the seconds of an item with their entries by kind."""
    n = [F.count_if(F.col("entry_type") == v).alias(k) for k, v in _KINDS.items()]
    seconds = timeline(spark, sf_dir).groupBy("video_id", F.floor("t").cast("int").alias("sec")).agg(F.count("*").alias("n"), *n)
    grid = spine(seconds.select("video_id").distinct(), DURATION).join(seconds, ["video_id", "sec"], "left").na.fill(0)
    return grid.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("sec", "n", *_KINDS))).alias("c"), F.sum("n").alias("total"), F.avg("n").alias("m"), rules.deviation("n").alias("s"), F.max("n").alias("most"), F.min("n").alias("least_"), F.count_if(F.col("n") > 0).alias("busy"), *[F.sum(k).alias(f"all_{k}") for k in _KINDS], F.avg(F.when(F.col("sec") < DURATION // 3, F.col("n"))).alias("a"), F.avg(F.when(F.col("sec") >= DURATION - DURATION // 3, F.col("n"))).alias("z"), F.avg(F.when(F.col("sec") >= DURATION - 5, F.col("n"))).alias("e"))


_ACTIVE = "array_compact(array(" + ", ".join(f"if(x.{k} > 0, '{_NAMES[k]}', null)" for k in _KINDS) + "))"
_PRIMARY = "case when greatest(x.tx, x.ob, x.ge, x.sc) = 0 then 'none' when x.tx = greatest(x.tx, x.ob, x.ge, x.sc) then 'text' when x.ob = greatest(x.tx, x.ob, x.ge, x.sc) then 'object' when x.ge = greatest(x.tx, x.ob, x.ge, x.sc) then 'gesture' else 'scene_change' end"
_LEVEL = "case when {0} = 0 then 'none' when {0} <= 2 then 'low' when {0} <= 5 then 'medium' else 'high' end"
_PAIRS = [tuple(sorted((a, b))) for i, a in enumerate(_NAMES.values()) for b in list(_NAMES.values())[i + 1 :]]
_KEY_OF = {v: k for k, v in _NAMES.items()}
_TIME = "concat(cast(x.sec as string), '-', cast(x.sec + 1 as string), 's')"
_CUT_SQL = "CAST(sec AS VARCHAR) || '-' || CAST(sec + 1 AS VARCHAR) || 's'"

DENSITY_SQL = f"""{DENSITY_FACTS_SQL}, g AS (SELECT d.video_id, CAST(d.sec AS INTEGER) AS sec, any_value(d.n) AS n, {', '.join(f"count(*) FILTER (t.entry_type = '{v}') AS {k}" for k, v in _KINDS.items())} FROM dens d LEFT JOIN tl t ON t.video_id = d.video_id AND floor(t.t) = d.sec GROUP BY d.video_id, d.sec),
x AS (SELECT g.*, m, s, {_PRIMARY.replace('x.', '')} AS pe, list_filter([{', '.join(f"CASE WHEN {k} > 0 THEN '{v}' END" for k, v in _NAMES.items())}], lambda y: y IS NOT NULL) AS act, lag(n) OVER (PARTITION BY video_id ORDER BY sec) AS p FROM g JOIN f USING (video_id)),
sh AS (SELECT video_id, sec, {_LEVEL.format('p')} AS lo, {_LEVEL.format('n')} AS hi, CAST(abs(n - p) / (greatest(p, n) + 0.001) AS DECIMAL(18,6)) AS mag FROM x WHERE {_LEVEL.format('p')} <> {_LEVEL.format('n')} AND abs(n - p) / (greatest(p, n) + 0.001) > 0.5),
s10 AS (SELECT video_id, list({{'timestamp': sec, 'from': lo, 'to': hi, 'magnitude': mag}} ORDER BY mag DESC, sec)[1:10] AS shifts FROM sh GROUP BY video_id),
z0 AS (SELECT video_id, sec, sec - row_number() OVER (PARTITION BY video_id ORDER BY sec) AS r FROM g WHERE n = 0), z1 AS (SELECT video_id, min(sec) AS a, max(sec) + 1 AS b FROM z0 GROUP BY video_id, r HAVING count(*) >= 2), dz AS (SELECT video_id, list({{'start': a, 'end': b, 'duration': b - a}} ORDER BY a)[1:5] AS dead FROM z1 GROUP BY video_id),
c AS (SELECT video_id, list({{'second': sec, 'density': n, 'primaryElement': pe}} ORDER BY sec)[1:100] AS curve, list(sec ORDER BY sec) FILTER (n = 0) AS empties, count(*) FILTER (len(act) >= 3) AS npeaks,
  list({{'timestamp': {_CUT_SQL}, 'elements': act, 'syncType': CASE WHEN len(act) >= 4 THEN 'reinforcing' ELSE 'complementary' END}} ORDER BY sec) FILTER (len(act) >= 3) AS mm,
  list({{'timestamp': {_CUT_SQL}, 'totalElements': n, 'surpriseScore': CAST((n - m) / (s + 0.001) AS DECIMAL(18,6)), 'elementBreakdown': {{'text': tx, 'sticker': 0, 'transition': sc, 'scene_change': sc}}}} ORDER BY sec) FILTER (n > m + s) AS pk,
  {', '.join(f"CAST(sum({k}) AS BIGINT) AS all_{k}" for k in _KINDS)}, {', '.join(f"count(*) FILTER ({_KEY_OF[a]} > 0 AND {_KEY_OF[b]} > 0) AS {a}_{b}" for a, b in _PAIRS)} FROM x GROUP BY video_id),
rp AS (SELECT * FROM f JOIN c USING (video_id) LEFT JOIN s10 USING (video_id) LEFT JOIN dz USING (video_id))"""


def _pairs_spark() -> tuple[str, str]:
    count = lambda a, b: f"cast(size(filter(c, x -> x.{_KEY_OF[a]} > 0 and x.{_KEY_OF[b]} > 0)) as bigint)"
    fields = ", ".join(f"'{a}_{b}', {count(a, b)}" for a, b in sorted(_PAIRS))
    return f"named_struct({fields})", "{" + ", ".join(f"'{a}_{b}': {a}_{b}" for a, b in sorted(_PAIRS)) + "}"


def _dominant() -> tuple[str, str]:
    count = {f"{a}_{b}": f"size(filter(c, x -> x.{_KEY_OF[a]} > 0 and x.{_KEY_OF[b]} > 0))" for a, b in sorted(_PAIRS)}
    most = f"greatest({', '.join(count.values())})"
    spark = f"case when {most} = 0 then 'none' " + " ".join(f"when {v} = {most} then '{k}'" for k, v in count.items()) + " end"
    top = f"greatest({', '.join(count)})"
    return spark, f"CASE WHEN {top} = 0 THEN 'none' " + " ".join(f"WHEN {k} = {top} THEN '{k}'" for k in count) + " END"


_LEVEL_OF = lambda x: _LEVEL.format(x)
_SHIFT = "abs(c[i].n - c[i - 1].n) / (greatest(c[i - 1].n, c[i].n) + 0.001D)"
_SHIFTS = f"slice(transform(array_sort(transform(filter(sequence(1, size(c) - 1), i -> {_LEVEL_OF('c[i - 1].n')} <> {_LEVEL_OF('c[i].n')} and {_SHIFT} > 0.5D), i -> named_struct('o', -cast({_SHIFT} as decimal(18,6)), 'i', i))), v -> named_struct('timestamp', v.i, 'from', {_LEVEL_OF('c[v.i - 1].n')}, 'to', {_LEVEL_OF('c[v.i].n')}, 'magnitude', -v.o)), 1, 10)"
_DEAD = f"slice(filter(transform(filter(c, x -> x.n = 0 and (x.sec = 0 or c[x.sec - 1].n > 0)), x -> named_struct('start', x.sec, 'end', coalesce(get(filter(c, y -> y.sec > x.sec and y.n > 0), 0).sec, {DURATION}), 'duration', coalesce(get(filter(c, y -> y.sec > x.sec and y.n > 0), 0).sec, {DURATION}) - x.sec)), z -> z.duration >= 2), 1, 5)"


def _list_json(column: str, upto: int | None = None) -> str:
    """A list in DuckDB; none is an empty one."""
    return f"coalesce({column}{f'[1:{upto}]' if upto else ''}, [])"


DENSITY: dict[str, Fields] = {
    "CoreMetrics": {
        "avgDensity": number("m"), "maxDensity": same("most"), "minDensity": same("least_"), "stdDeviation": number("s"), "totalElements": same("total"), "elementsPerSecond": number("m"),
        "elementCounts": ("named_struct('text', all_tx, 'sticker', 0, 'transition', all_sc, 'object', all_ob, 'gesture', all_ge, 'expression', all_ex)", "{'text': all_tx, 'sticker': 0, 'transition': all_sc, 'object': all_ob, 'gesture': all_ge, 'expression': all_ex}"),
        "sceneChangeCount": same("all_sc"), "timelineCoverage": number(f"busy / {float(DURATION)}e0"), "confidence": constant(0.95),
    },
    "Dynamics": {
        "densityCurve": (f"slice(transform(c, x -> named_struct('second', x.sec, 'density', x.n, 'primaryElement', {_PRIMARY})), 1, 100)", "curve"), "volatility": number("s / (m + 1e-3)"),
        "accelerationPattern": steps(ACCELERATION, "even"), "densityProgression": constant("stable"), "emptySeconds": ("slice(transform(filter(c, x -> x.n = 0), x -> x.sec), 1, 50)", _list_json("empties", 50)), "confidence": constant(0.95),
    },
    "Interactions": {
        "multiModalPeaks": (f"slice(transform(filter(c, x -> size({_ACTIVE}) >= 3), x -> named_struct('timestamp', {_TIME}, 'elements', {_ACTIVE}, 'syncType', if(size({_ACTIVE}) >= 4, 'reinforcing', 'complementary'))), 1, 10)", _list_json("mm", 10)),
        "elementCooccurrence": _pairs_spark(), "dominantCombination": _dominant(), "coordinationScore": (f"cast(size(filter(c, x -> size({_ACTIVE}) >= 3)) / {float(DURATION)}D as decimal(18,6))", f"CAST(npeaks / {float(DURATION)} AS DECIMAL(18,6))"), "confidence": constant(0.9),
    },
    "KeyEvents": {
        "peakMoments": (f"slice(transform(filter(c, x -> x.n > m + s), x -> named_struct('timestamp', {_TIME}, 'totalElements', x.n, 'surpriseScore', cast((x.n - m) / (s + 0.001D) as decimal(18,6)), 'elementBreakdown', named_struct('text', x.tx, 'sticker', 0, 'transition', x.sc, 'scene_change', x.sc))), 1, 10)", _list_json("pk", 10)),
        "deadZones": (_DEAD, _list_json("dead")), "densityShifts": (_SHIFTS, _list_json("shifts")), "confidence": constant(0.95),
    },
    "Patterns": {
        "structuralFlags": ("named_struct(" + ", ".join(f"'{n}', {c}" for c, n in DENSITY_FLAGS) + ")", "{" + ", ".join(f"'{n}': {c}" for c, n in DENSITY_FLAGS) + "}"),
        "densityClassification": steps(DENSITY_CLASS, "dense"), "pacingStyle": steps(ACCELERATION, "even"), "cognitiveLoadCategory": steps(COGNITIVE_LOAD, "challenging"),
        "mlTags": ("array('density_computed', concat('avg_', cast(cast(m as decimal(18,1)) as string)))", "['density_computed', 'avg_' || CAST(CAST(m AS DECIMAL(18,1)) AS VARCHAR)]"), "confidence": constant(0.85),
    },
    "Quality": {
        "dataCompleteness": constant(0.95),
        "detectionReliability": tuple(f"{o}" + ", ".join(f"'{n}'{sep}cast({v} as decimal(4,2))" for n, v in (("textOverlay", 0.95), ("sticker", 0.92), ("transition", 0.85), ("sceneChange", 0.85), ("object", 0.88), ("gesture", 0.87))) + e for o, sep, e in (("named_struct(", ", ", ")"), ("{", ": ", "}"))),
        "overallConfidence": constant(0.9),
    },
}


def density_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six_blocks(_curve(spark, sf_dir), "density", DENSITY)


@query("rpt_density", blocks_sql(DENSITY_SQL, "rp", "density", DENSITY))
def rpt_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_json(density_report(spark, sf_dir))


# --- pacing and speech: flat metrics in six blocks, unfilled fields with their defaults -----------------------------

PACING: dict[str, Fields] = {
    "CoreMetrics": {"totalScenes": same("cuts + 1"), "averageSceneDuration": number("mean"), "scenesPerMinute": number("cpm"), "pacingScore": constant(0), "rhythmConsistency": steps(RHYTHM_CLASS, "erratic"), "transitionSmoothing": constant(0.8)},
    "Dynamics": {"pacingProgression": constant([]), "sceneRhythm": constant("regular"), "temporalFlow": constant("linear"), "accelerationPoints": constant([]), "decelerationPoints": constant([])},
    "Interactions": {"audioVisualSync": constant(0.8), "beatMatching": constant(0), "emotionalPacing": constant(0.7), "narrativeFlow": constant(0.75)},
    "KeyEvents": {"longestScene": ("named_struct('duration', 0, 'timestamp', '0-5s')", "{'duration': 0, 'timestamp': '0-5s'}"), "shortestScene": ("named_struct('duration', 0, 'timestamp', '0-1s')", "{'duration': 0, 'timestamp': '0-1s'}"), "pacingShifts": constant([]), "climaxTiming": constant(0.7)},
    "Patterns": {"editingStyle": steps(EDITING_STYLE, "experimental"), "transitionTypes": constant(["cut"]), "pacingPattern": constant("steady"), "rhythmStructure": constant("4/4")},
    "Quality": {"flowScore": constant(0.75), "engagementPacing": constant(0.7), "viewerRetention": constant(0.65), "editingQuality": constant(0.7), "overallScore": constant(0.71)},
}


@query("rpt_pacing", blocks_sql(PACING_FACTS_SQL, "p", "scenePacing", PACING))
def rpt_pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_json(six_blocks(rules.pacing_facts(spark, sf_dir), "scenePacing", PACING))


SPEECH_SQL = f"""{SPEECH_FACTS_SQL}, sd AS (SELECT video_id, avg(end_s - start_s) AS mean_d, max(end_s - start_s) AS longest, max(end_s) AS dur FROM seg GROUP BY video_id), un AS (SELECT video_id, len(list_distinct(regexp_extract_all(low, '[^ \\n\\t\\r]+'))) AS uniq FROM ts),
pw AS (SELECT du.video_id, du.sec, coalesce(sum(floor(words * (least(end_s, sec + 1) - greatest(start_s, sec)) / (end_s - start_s) + 1e-9)), 0) AS w, coalesce(sum(least(end_s, sec + 1) - greatest(start_s, sec)), 0) AS s FROM (SELECT video_id, unnest(range(least(10, CAST(floor(max(end_s)) AS BIGINT)))) AS sec FROM seg GROUP BY video_id) du LEFT JOIN seg ON seg.video_id = du.video_id AND end_s > start_s AND start_s < sec + 1 AND end_s > sec GROUP BY ALL),
pg AS (SELECT video_id, list(CAST(CASE WHEN s > 0 THEN w / s * 60 ELSE 0 END AS DECIMAL(18,1)) ORDER BY sec) AS wpms FROM pw GROUP BY video_id), rp AS (SELECT * FROM k JOIN sd USING (video_id) JOIN un USING (video_id) LEFT JOIN pg USING (video_id))"""
_COVER = "case when dur > 0 then speech_s / dur else 0 end"
SPEECH: dict[str, Fields] = {
    "CoreMetrics": {"totalWords": same("cast(words as bigint)"), "speechDensity": number("case when dur > 0 then words / dur else 0 end"), "wordsPerMinute": number("wpm"), "vocabularyDiversity": number("case when words > 0 then uniq / words else 0 end"), "silenceRatio": number(f"1 - {_COVER}"), "speechCoverage": number(_COVER), "avgSegmentDuration": number("mean_d"), "uniqueWords": same("cast(uniq as bigint)"), "confidence": constant(0.85)},
    "Dynamics": {"wpmProgression": ("coalesce(wpms, cast(array() as array<decimal(18,1)>))", _list_json("wpms")), "silencePeriods": constant([]), "speechBursts": constant([]), "burstPattern": constant("none"), "energyVariance": constant(0), "hasAudioEnergy": constant(False), "pacingVariation": constant(0), "temporalAlignment": number("gesture")},
    "Interactions": {"speechGestureSync": constant(0), "speechEmotionAlignment": constant(0), "speechTextOverlap": constant(0), "multiModalCoherence": constant(0)},
    "KeyEvents": {"longestSegment": ("named_struct('duration', cast(longest as decimal(18,6)), 'timestamp', '0-5s', 'words', 0)", "{'duration': CAST(longest AS DECIMAL(18,6)), 'timestamp': '0-5s', 'words': 0}"), "climaxMoment": ("named_struct('timestamp', 0, 'intensity', 0)", "{'timestamp': 0, 'intensity': 0}"), "silentMoments": constant([])},
    "Patterns": {"repetitionRate": constant(0), "emphasisTechniques": constant([]), "narrativeStyle": constant("conversational"), "verbalHooks": constant([])},
    "Quality": {"clarity": constant(0.8), "engagement": constant(0.7), "emotionalRange": constant(0.5), "deliveryStyle": constant("natural"), "overallScore": constant(0.75)},
}


@query("rpt_speech", blocks_sql(SPEECH_SQL, "rp", "speech", SPEECH))
def rpt_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = segments(spark, sf_dir)
    sd = s.groupBy("video_id").agg(F.avg(F.col("end_s") - F.col("start_s")).alias("mean_d"), F.max(F.col("end_s") - F.col("start_s")).alias("longest"), F.max("end_s").alias("dur"))
    un = rules.transcripts(spark, sf_dir).select("video_id", F.size(F.array_distinct(tx.words(F.col("low")))).alias("uniq"))
    x = s.where("end_s > start_s").select("*", F.explode(F.sequence(F.floor("start_s"), F.ceil("end_s") - 1)).alias("sec")).where("sec < 10")
    here = F.least(F.col("end_s"), F.col("sec") + 1) - F.greatest(F.col("start_s"), F.col("sec"))
    w = x.groupBy("video_id", "sec").agg(F.sum(F.floor(F.col("words") * here / (F.col("end_s") - F.col("start_s")) + 1e-9)).alias("w"), F.sum(here).alias("s"))
    first = sd.select("video_id", F.explode(F.expr("case when floor(dur) > 0 then sequence(0, least(10, cast(floor(dur) as int)) - 1) end")).alias("sec"))
    per = first.join(w, ["video_id", "sec"], "left").select("video_id", "sec", F.coalesce(F.try_divide("w", "s") * 60, F.lit(0.0)).cast("decimal(18,1)").alias("v"))
    pg = per.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("sec", "v"))).alias("x")).select("video_id", F.transform("x", lambda v: v["v"]).alias("wpms"))
    return as_json(six_blocks(rules.speech_facts(spark, sf_dir).join(sd, "video_id").join(un, "video_id").join(pg, "video_id", "left"), "speech", SPEECH))


# --- emotion ------------------------------------------------------------------------------------------------------

_STEP = max(1, DURATION // 10)
_NAME_SQL = "(['" + "', '".join(EMOTIONS) + "'])"
EMOTION_SQL = f"""{EMOTION_FACTS_SQL}, n1 AS (SELECT *, lead(label) OVER (PARTITION BY video_id ORDER BY t, seq) AS nx, lead(t) OVER (PARTITION BY video_id ORDER BY t, seq) AS nt, avg(conf) OVER (PARTITION BY video_id) AS mc FROM e),
l AS (SELECT video_id, list({{'timestamp': CAST(CAST(floor(t) AS INTEGER) AS VARCHAR) || 's', 'emotion': {_NAME_SQL}[label + 1], 'intensity': CAST(conf AS DECIMAL(18,6))}} ORDER BY t, seq) FILTER (conf > mc * 1.2) AS peaks,
  list({{'timestamp': CAST(CAST(floor(t) AS INTEGER) AS VARCHAR) || 's', 'fromEmotion': {_NAME_SQL}[label + 1], 'toEmotion': {_NAME_SQL}[nx + 1]}} ORDER BY t, seq) FILTER (label <> nx) AS moves,
  list({{'timestamp': CAST(CAST(floor(t) AS INTEGER) AS VARCHAR) || '-' || CAST(CAST(floor(nt) AS INTEGER) AS VARCHAR) || 's', 'fromEmotion': {_NAME_SQL}[label + 1], 'toEmotion': {_NAME_SQL}[nx + 1]}} ORDER BY t, seq) FILTER ((label IN (0, 4) AND nx IN (1, 2, 3, 5)) OR (label IN (1, 2, 3, 5) AND nx IN (0, 4))) AS contrasts,
  CAST(CAST(floor(arg_max(t, struct_pack(c := conf, a := -t, b := -seq))) AS INTEGER) AS VARCHAR) || 's' AS climax FROM n1 GROUP BY video_id),
wc AS (SELECT video_id, CAST(floor(t / {_STEP}) AS INTEGER) * {_STEP} AS i, label, count(*) AS c, sum(conf) AS sc FROM e GROUP BY ALL), wm AS (SELECT video_id, i, arg_max(label, struct_pack(c := c, l := -label)) AS top, sum(sc) / sum(c) AS inten FROM wc GROUP BY ALL),
wv AS (SELECT v.video_id, v.i, top, inten FROM (SELECT video_id, unnest(range(0, {DURATION}, {_STEP})) AS i FROM k) v LEFT JOIN wm ON wm.video_id = v.video_id AND wm.i = v.i),
wl AS (SELECT video_id, list({{'timestamp': CAST(i AS VARCHAR) || '-' || CAST(least(i + {_STEP}, {DURATION}) AS VARCHAR) || 's', 'emotion': coalesce({_NAME_SQL}[top + 1], 'neutral'), 'intensity': CAST(coalesce(inten, 0) AS DECIMAL(18,6))}} ORDER BY i) AS prog FROM wv GROUP BY video_id),
dm AS (SELECT video_id, arg_max(label, struct_pack(c := c, l := -label)) AS dominant FROM (SELECT video_id, label, count(*) AS c FROM e GROUP BY ALL) GROUP BY video_id),
rp AS (SELECT *, least(1.0, n / {max(1, DURATION // 10)}.0) AS complete, n / {float(DURATION)} AS cover FROM k LEFT JOIN l USING (video_id) LEFT JOIN wl USING (video_id) LEFT JOIN dm USING (video_id))"""
_NAMES_SPARK = "array(" + ", ".join(f"'{e}'" for e in EMOTIONS) + ")"
_STABLE = number("1 - changes / greatest(1, n)")
EMOTION: dict[str, Fields] = {
    "CoreMetrics": {"uniqueEmotions": same("kinds"), "emotionTransitions": same("changes"), "dominantEmotion": (f"coalesce(get({_NAMES_SPARK}, cast(dominant as int)), 'neutral')", f"coalesce({_NAME_SQL}[dominant + 1], 'neutral')"), "emotionalDiversity": number("case when kinds > 1 then (kinds - 1) / 6 else 0 end"), "gestureEmotionAlignment": number("aligned"), "audioEmotionAlignment": constant(0), "captionSentiment": constant("neutral"), "emotionalIntensity": number("case when n > 0 then sure else 0 end"), "confidence": constant(0.85)},
    "Dynamics": {"emotionProgression": ("prog", "prog"), "transitionSmoothness": _STABLE, "emotionalArc": steps(EMOTION_ARC, "stable"), "peakEmotionMoments": ("slice(peaks, 1, 3)", _list_json("peaks", 3)), "stabilityScore": _STABLE, "tempoEmotionSync": constant(0), "confidence": constant(0.8)},
    "Interactions": {"gestureReinforcement": number("aligned"), "multimodalCoherence": number("aligned"), "emotionalContrastMoments": ("slice(contrasts, 1, 2)", _list_json("contrasts", 2)), "confidence": constant(0.75)},
    "KeyEvents": {"emotionalPeaks": ("slice(peaks, 1, 2)", _list_json("peaks", 2)), "transitionPoints": ("slice(moves, 1, 3)", _list_json("moves", 3)), "climaxMoment": same("climax"), "resolutionMoment": constant(f"{DURATION - 5}s"), "confidence": constant(0.88)},
    "Patterns": {"journeyArchetype": steps(ARCHETYPE, "discovery"), "emotionalTechniques": names(EMOTION_TECHNIQUES), "pacingStrategy": steps(EMOTION_PACING, "steady_state"), "engagementHooks": ("slice(peaks, 1, 2)", _list_json("peaks", 2)), "viewerJourneyMap": steps(EMOTION_PACING, "steady_state"), "confidence": constant(0.82)},
    "Quality": {"detectionConfidence": number("sure"), "timelineCoverage": number("cover"), "emotionalDataCompleteness": number("complete"), "analysisReliability": same("case when n = 0 then 'low' else 'high' end"), "missingDataPoints": names([("n = 0", "no_emotions_detected"), ("n > 0 and kinds = 1", "limited_emotional_range")]), "overallConfidence": number("least(95e-2, (sure + complete + cover) / 3)")},
}


def _emotion_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item: peaks, moves, contrasts, climax, progression over ten windows, dominant emotion; one sorted list of its emotions."""
    e = timeline(spark, sf_dir).where("entry_type = 'emotion'").groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("t", "seq", "label", "conf"))).alias("e"), (F.avg("conf") * 1.2).alias("high"))
    at = lambda x: f"concat(cast(cast(floor({x}.t) as int) as string), 's')"
    name = lambda x: f"get({_NAMES_SPARK}, cast({x} as int))"
    pair = "named_struct('timestamp', {0}, 'fromEmotion', {1}, 'toEmotion', {2})"
    steps_ = "case when size(e) > 1 then sequence(0, size(e) - 2) else cast(array() as array<int>) end"
    down, up = "in (1, 2, 3, 5)", "in (0, 4)"
    inside = f"filter(e, x -> x.t >= i and x.t < least(i + {_STEP}, {DURATION}))"
    mode = "reverse(array_sort(transform(array_distinct(transform({0}, x -> x.label)), k -> named_struct('c', size(filter({0}, x -> x.label = k)), 'l', -k))))"
    return e.select(
        "video_id",
        F.expr(f"transform(filter(e, x -> x.conf > high), x -> named_struct('timestamp', {at('x')}, 'emotion', {name('x.label')}, 'intensity', cast(x.conf as decimal(18,6))))").alias("peaks"),
        F.expr(f"transform(filter({steps_}, i -> e[i].label <> e[i + 1].label), i -> {pair.format(at('e[i]'), name('e[i].label'), name('e[i + 1].label'))})").alias("moves"),
        F.expr(f"transform(filter({steps_}, i -> (e[i].label {up} and e[i + 1].label {down}) or (e[i].label {down} and e[i + 1].label {up})), i -> {pair.format('concat(cast(cast(floor(e[i].t) as int) as string), ' + chr(39) + '-' + chr(39) + ', ' + at('e[i + 1]') + ')', name('e[i].label'), name('e[i + 1].label'))})").alias("contrasts"),
        F.expr(f"transform(slice(array_sort(transform(e, x -> named_struct('c', -x.conf, 't', x.t, 's', x.seq))), 1, 1), x -> {at('x')})[0]").alias("climax"),
        F.expr(f"transform(sequence(0, {DURATION - 1}, {_STEP}), i -> named_struct('timestamp', concat(cast(i as string), '-', cast(least(i + {_STEP}, {DURATION}) as string), 's'), 'emotion', coalesce({name('-get(' + mode.format(inside) + ', 0).l')}, 'neutral'), 'intensity', cast(coalesce(aggregate({inside}, 0D, (s, x) -> s + x.conf) / nullif(size({inside}), 0), 0) as decimal(18,6))))").alias("prog"),
        F.expr(f"-get({mode.format('e')}, 0).l").alias("dominant"),
    )


@query("rpt_emotion", blocks_sql(EMOTION_SQL, "rp", "emotional", EMOTION))
def rpt_emotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = rules.emotion_facts(spark, sf_dir).select("*", F.least(F.lit(1.0), F.col("n") / float(max(1, DURATION // 10))).alias("complete"), (F.col("n") / float(DURATION)).alias("cover"))
    lists = _emotion_lists(spark, sf_dir)
    x = f.join(lists, "video_id", "left")
    types = dict(lists.dtypes)
    none = F.expr(f"transform(sequence(0, {DURATION - 1}, {_STEP}), i -> named_struct('timestamp', concat(cast(i as string), '-', cast(least(i + {_STEP}, {DURATION}) as string), 's'), 'emotion', 'neutral', 'intensity', cast(0 as decimal(18,6))))")
    x = x.withColumns({c: F.coalesce(F.col(c), F.array().cast(types[c])) for c in ("peaks", "moves", "contrasts")} | {"prog": F.coalesce("prog", none)})
    return as_json(six_blocks(x, "emotional", EMOTION))


_FEAT = rules._FEAT_SQL
FEAT: dict[str, Fields] = {
    "CoreMetrics": {"uniqueEmotions": same("kinds"), "emotionTransitions": same("changes"), "dominantEmotion": (f"coalesce(get({_NAMES_SPARK}, cast(dominant as int)), 'neutral')", f"coalesce({_NAME_SQL}[dominant + 1], 'neutral')"), "emotionalDiversity": number("diversity"), "avgConfidence": number("sure"), "detectionRate": number(f"least(1e0, n / {float(DURATION)}e0)")},
    "Dynamics": {"emotionalArc": same("arc"), "stabilityScore": number("case when n < 2 then 1e0 else 1e0 - changes / (n - 1) end")},
    "Patterns": {"journeyArchetype": steps(FEAT_ARCHETYPE, "narrative"), "emotionalTechniques": names(FEAT_TECHNIQUES), "viewerJourneyMap": ("case (" + _steps_sql(FEAT_ARCHETYPE, "narrative") + ") " + " ".join(f"when '{k}' then '{v}'" for k, v in rules.VIEWER.items()) + " else 'variable_engagement' end",) * 2},
}


@query("rpt_emotion_feat", blocks_sql(_FEAT, "ft", "emotional", FEAT))
def rpt_emotion_feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journey of the recogniser's own emotions: arc, stability, archetype, techniques."""
    return as_json(six_blocks(rules.feat_facts(spark, sf_dir), "emotional", FEAT))


# --- overlay, framing, metadata, markers ----------------------------------------------------------------------------

_PER = float(DURATION)
OVERLAY_SQL = f"""WITH {CLS_OVERLAY_SQL}, u AS (SELECT video_id, count(DISTINCT lower(trim(text))) AS unique_texts, avg(greatest(1.0, length(text) * 0.1)) AS mean_d, list(CAST(floor(t) AS INTEGER) ORDER BY t, seq) FILTER (regexp_matches(lower(text), 'buy|shop|click|link|follow|subscribe|comment|share|order|get')) AS moments, min(t) AS first_t FROM ov GROUP BY ALL),
ft AS (SELECT video_id, min(t) AS first_any FROM tl WHERE entry_type IN ('text', 'object') GROUP BY ALL), bu AS (SELECT video_id, count(*) FILTER (g < 2) AS bursts FROM iv GROUP BY ALL),
ga AS (SELECT o.video_id, count(*) AS near FROM ov o WHERE EXISTS (SELECT 1 FROM tl g WHERE g.video_id = o.video_id AND g.entry_type = 'gesture' AND abs(g.t - o.t) <= 1) GROUP BY ALL),
rp AS (SELECT k.*, n.stickers, coalesce(unique_texts, 0) AS unique_texts, coalesce(mean_d, 0) AS mean_d, moments, coalesce(first_any, {_PER}) AS first_s, coalesce(bursts, 0) AS bursts, coalesce(near, 0) AS near FROM k JOIN n USING (video_id) LEFT JOIN u USING (video_id) LEFT JOIN ft USING (video_id) LEFT JOIN bu USING (video_id) LEFT JOIN ga USING (video_id))"""
_COMPLETE = f"least(1e0, texts / {float(max(1, int(DURATION * 0.3)))}e0)"
_SURE = "(85e-2 + case when texts > 10 then 1e-1 else 0e0 end)"
OVERLAY: dict[str, Fields] = {
    "CoreMetrics": {"totalOverlays": same("texts + stickers"), "totalTextOverlays": same("texts"), "totalStickers": same("stickers"), "uniqueOverlayCount": same("unique_texts"), "overlayDensity": number("dens"), "uniqueOverlayRatio": number("case when texts + stickers > 0 then unique_texts / (texts + stickers) else 0 end"), "timeToFirstOverlay": number("first_s"), "avgOverlayDuration": number("mean_d"), "overlayFrequency": number("dens * 60"), "confidence": constant(0.92)},
    "Dynamics": {"rhythmConsistency": number("rhythm"), "overlayAcceleration": same("pace"), "temporalDistribution": same(f"case when first_s < {_PER * 0.3} then 'front_loaded' else 'balanced' end"), "burstPatterns": same("bursts"), "confidence": constant(0.88)},
    "Interactions": {"overlayGestureSync": number("case when texts > 0 then near / texts else 0 end"), "multimodalReinforcementCount": same("multi"), "confidence": constant(0.85)},
    "KeyEvents": {"ctaMoments": ("slice(moments, 1, 3)", _list_json("moments", 3)), "confidence": constant(0.9)},
    "Patterns": {"overlayStrategy": same("case when dens > 1.0 then 'heavy' when dens > 0.5 then 'moderate' else 'minimal' end"), "overlayTechniques": names(TECHNIQUES), "engagementArchetype": same("case when cta > 2 then 'conversion_focused' when dens > 0.8 then 'attention_grabbing' else 'informational' end"), "pacingPattern": same("pace"), "contentFocus": same("case when cta > 1 then 'product_focused' else 'informational' end"), "confidence": constant(0.87)},
    "Quality": {"detectionConfidence": number(_SURE), "dataCompleteness": number(_COMPLETE), "analysisReliability": same("case when texts = 0 then 'low' else 'high' end"), "missingDataPoints": names([("texts = 0", "no_overlays_detected"), ("texts > 0 and unique_texts < texts * 0.1", "low_text_variety")]), "timelineCoverage": number(f"texts / {_PER}e0"), "overallConfidence": number(f"least(95e-2, ({_SURE} + {_COMPLETE}) / 2)")},
}


@query("rpt_overlay", blocks_sql(OVERLAY_SQL, "rp", "visualOverlay", OVERLAY))
def rpt_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronomark.plans.overlays import CTA_MOMENT_WORDS, any_of, overlays

    tl, ov = timeline(spark, sf_dir), overlays(spark, sf_dir)
    gap = F.col("t") - F.lag("t").over(Window.partitionBy("video_id").orderBy("t", "seq"))
    cta = F.when(any_of(F.col("text"), CTA_MOMENT_WORDS), F.struct("t", "seq"))
    u = ov.withColumn("g", gap).groupBy("video_id").agg(F.avg(F.greatest(F.lit(1.0), F.char_length("text") * 0.1)).alias("mean_d"), F.count_if(F.coalesce(F.col("g") < 2, F.lit(False))).alias("bursts"), F.transform(F.array_sort(F.collect_list(cta)), lambda x: F.floor(x["t"]).cast("int")).alias("moments"))
    first = tl.where("entry_type in ('text', 'object')").groupBy("video_id").agg(F.min("t").alias("first_s"))
    near = band_exists(ov.select("video_id", "seq", "t"), tl.where("entry_type = 'gesture'"), 1.0).groupBy("video_id").agg(F.count("*").alias("near"))
    x = overlay_facts(spark, sf_dir).join(u, "video_id", "left").join(first, "video_id", "left").join(near, "video_id", "left").na.fill(0, ["mean_d", "bursts", "near"]).na.fill(_PER, ["first_s"])
    x = x.withColumn("moments", F.coalesce("moments", F.array().cast("array<int>")))
    return as_json(six_blocks(x, "visualOverlay", OVERLAY))


_SHOT_SHARES = "named_struct('close', cast(close as decimal(18,6)), 'wide', cast(far as decimal(18,6)))", "{'close': CAST(close AS DECIMAL(18,6)), 'wide': CAST(far AS DECIMAL(18,6))}"
FRAMING_SQL = f"""{FRAMING_FACTS_SQL}, sz AS (SELECT video_id, avg(a) AS area FROM b GROUP BY video_id), ct AS (SELECT video_id, arg_max(shot, struct_pack(c := c, s := -CASE shot WHEN 'close' THEN 0 WHEN 'medium' THEN 1 WHEN 'none' THEN 2 ELSE 3 END)) AS dominant FROM (SELECT video_id, shot, count(*) AS c FROM b GROUP BY ALL) GROUP BY video_id),
cl AS (SELECT video_id, list(seq ORDER BY seq, p, x) FILTER (shot = 'close' AND (q IS NULL OR q <> 'close')) AS closeups FROM o GROUP BY video_id), rp AS (SELECT * FROM f JOIN sz USING (video_id) JOIN ct USING (video_id) JOIN cl USING (video_id))"""
FRAMING: dict[str, Fields] = {
    "CoreMetrics": {"primarySubject": constant("single"), "averageFaceSize": number("area"), "faceVisibilityRate": number("face"), "framingConsistency": number("1 - volatility"), "subjectCount": constant(1), "dominantFraming": same("dominant"), "eyeContactRate": constant(0)},
    "Dynamics": {"gazeSteadiness": constant("unknown"), "distanceVariation": number("volatility"), "framingTransitions": same("moves"), "movementPattern": same("case when volatility > 0.5 then 'dynamic' when volatility > 0.2 then 'gradual' else 'static' end"), "stabilityScore": constant(0.8)},
    "Interactions": {"interactionZones": constant([]), "socialDistance": constant("personal")},
    "KeyEvents": {"closeUpMoments": ("slice(closeups, 1, 5)", _list_json("closeups", 5)), "groupShots": constant([]), "framingChanges": same("moves"), "keySubjectMoments": constant([])},
    "Patterns": {"framingDistribution": _SHOT_SHARES, "compositionRule": constant("center"), "cinematicStyle": constant("casual"), "framingTechnique": same("case when area > 30 then 'close_up' when area > 10 then 'medium_shot' else 'wide_shot' end")},
    "Quality": {"compositionScore": constant(0.7), "framingAppropriate": constant(0.8), "visualEngagement": constant(0.75), "professionalLevel": constant(0.6), "overallScore": constant(0.72)},
}


@query("rpt_framing", blocks_sql(FRAMING_SQL, "rp", "personFraming", FRAMING))
def rpt_framing(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = boxes(spark, sf_dir)
    runs = islands(b, F.col("shot"), ["seq", "p", "x"]).groupBy("video_id", "run").agg(F.min(F.struct("seq", "p", "x")).alias("first"), F.any_value("shot").alias("shot"))
    closeups = runs.groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("shot") == "close", F.col("first")))), lambda x: x["seq"]).alias("closeups"))
    c = b.groupBy("video_id", "shot").agg(F.count("*").alias("k"), F.sum("a").alias("s")).groupBy("video_id").agg((F.sum("s") / F.sum("k")).alias("area"), F.min(F.struct((-F.col("k")).alias("m"), "shot"))["shot"].alias("dominant"))
    return as_json(six_blocks(rules.framing_facts(spark, sf_dir).join(c, "video_id").join(closeups, "video_id"), "personFraming", FRAMING))


def _any(phrases: list[str]) -> str:
    return "cast(coalesce(" + " or ".join("contains(lower(text), '" + p.replace("'", "''") + "')" for p in phrases) + ", false) as int)"


_WORDS = ("size(filter(split(coalesce(text, ''), '[ \\\\n\\\\t\\\\r]+'), w -> w <> ''))", "len(regexp_extract_all(coalesce(text, ''), '[^ \\n\\t\\r]+'))")
_EMOJI = tx.EMOJI
_COUNT_EMOJI = (f"coalesce(regexp_count(text, '[{_EMOJI}]+'), 0)".replace("\\", "\\\\"), f"CAST(len(regexp_extract_all(coalesce(text, ''), '[{_EMOJI}]+')) AS INTEGER)")
_MENTIONS = ("regexp_extract_all(coalesce(text, ''), '@[\\\\p{L}\\\\p{N}_]+', 0)", "regexp_extract_all(coalesce(text, ''), '@[\\p{L}\\p{N}_]+')")


def _both(f: str, *parts: tuple[str, str]) -> tuple[str, str]:
    return f.format(*[p[0] for p in parts]), f.format(*[p[1] for p in parts])


_N_WORDS = _both("cast({0} as bigint)", _WORDS)
_N_MENTIONS = f"size({_MENTIONS[0]})", f"CAST(len({_MENTIONS[1]}) AS INTEGER)"
METADATA: dict[str, Fields] = {
    "CoreMetrics": {"captionLength": ("char_length(coalesce(text, ''))", "CAST(length(coalesce(text, '')) AS INTEGER)"), "wordCount": _N_WORDS, "hashtagCount": ("regexp_count(coalesce(text, ''), '#[\\\\p{L}\\\\p{N}_]+')", "CAST(len(regexp_extract_all(coalesce(text, ''), '#[\\p{L}\\p{N}_]+')) AS INTEGER)"), "emojiCount": _COUNT_EMOJI, "mentionCount": _N_MENTIONS},
    "Dynamics": {"emojiDensity": _both("cast(coalesce({0} / nullif({1}, 0), 0) as decimal(18,6))", _COUNT_EMOJI, _N_WORDS), "mentionDensity": _both("cast(coalesce({0} / nullif({1}, 0), 0) as decimal(18,6))", _N_MENTIONS, _N_WORDS)},
    "Interactions": {"questionCount": ("regexp_count(coalesce(text, ''), '[?]')", "CAST(len(regexp_extract_all(coalesce(text, ''), '[?]')) AS INTEGER)"), "exclamationCount": ("regexp_count(coalesce(text, ''), '!')", "CAST(len(regexp_extract_all(coalesce(text, ''), '!')) AS INTEGER)")},
    "KeyEvents": {"hasHook": (_any(tx.HOOKS),) * 2, "topMentions": (f"slice({_MENTIONS[0]}, 1, 3)", f"({_MENTIONS[1]})[1:3]")},
    "Patterns": {f"cta{k.capitalize()}": (_any(p),) * 2 for k, p in tx.CTA.items()},
    "Quality": {"hasCaption": _both("cast({0} > 0 as int)", _N_WORDS), "isEmpty": same("cast(coalesce(text, '') = '' as int)")},
}


@query("rpt_metadata", blocks_sql("WITH d AS (SELECT doc_id AS video_id, text FROM documents)", "d", "metadata", METADATA))
def rpt_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption features of documents: words, tags, emoji, mentions, hooks, calls to action; no shuffle."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("video_id"), "text")
    return as_json(six_blocks(d, "metadata", METADATA))


def _listed(rows: DataFrame, name: str, *fields: str) -> DataFrame:
    """Rows of an item as one array in field order. Items are small; a report lists what its operator has cut to."""
    return rows.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


_MARKERS = {"opening": ("bkt_density_prog", ("sec", "density")), "closing": ("bkt_cta_window", ("entry_type", "n")), "peaks": ("win_local_max", ("rank", "sec", "activity")), "curve": ("bkt_5s_engagement", ("start_s", "engagement"))}
_MARKERS_SQL = (
    "WITH " + ", ".join(f"{k} AS (SELECT video_id, to_json(list({{{', '.join(chr(39) + f + chr(39) + ': ' + f for f in fs)}}} ORDER BY {', '.join(fs)})) AS j FROM ({ORACLE_SQL[q]}) GROUP BY video_id)" for k, (q, fs) in _MARKERS.items())
    + f", {TL_SQL}, v AS (SELECT video_id, count(*) AS entries FROM tl GROUP BY video_id) SELECT v.video_id, CAST(to_json({{'density_progression': coalesce(opening.j, '[]'::JSON)}}) AS VARCHAR) AS first_5_seconds, CAST(to_json({{'entries': coalesce(closing.j, '[]'::JSON)}}) AS VARCHAR) AS cta_window, CAST(coalesce(peaks.j, '[]'::JSON) AS VARCHAR) AS peak_moments, CAST(coalesce(curve.j, '[]'::JSON) AS VARCHAR) AS engagement_curve, CAST(to_json({{'entries': entries, 'duration': {DURATION}}}) AS VARCHAR) AS metadata FROM v "
    + " ".join(f"LEFT JOIN {k} ON {k}.video_id = v.video_id" for k in _MARKERS)
)


@query("rpt_markers", _MARKERS_SQL)
def rpt_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening, closing, peaks and engagement curve; an item without any of them has empty lists."""
    x = timeline(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("entries"))
    for k, (q, fields) in _MARKERS.items():
        x = x.join(_listed(QUERIES[q](spark, sf_dir), k, *fields), "video_id", "left")
    types = dict(x.dtypes)
    listed = lambda c: F.coalesce(F.col(c), F.array().cast(types[c]))
    return x.select(
        "video_id", F.to_json(F.struct(listed("opening").alias("density_progression"))).alias("first_5_seconds"), F.to_json(F.struct(listed("closing").alias("entries"))).alias("cta_window"),
        F.to_json(listed("peaks")).alias("peak_moments"), F.to_json(listed("curve")).alias("engagement_curve"), F.to_json(F.struct("entries", F.lit(DURATION).alias("duration"))).alias("metadata"),
    )


@query("fmt_sixblock", blocks_sql(PACING_FACTS_SQL, "p", "scenePacing", {b: PACING[b] for b in ("CoreMetrics", "Patterns")}))
def fmt_sixblock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat metrics become blocks; what has blocks already is returned as it is."""
    made = ensure_blocks(rules.pacing_facts(spark, sf_dir), "scenePacing", {b: PACING[b] for b in ("CoreMetrics", "Patterns")})
    return as_json(ensure_blocks(made, "scenePacing", PACING))

