"""Rules on overlay texts and stickers: sizes, categories, calls to action, strategy, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.operators.timeline import band_exists
from chronomark.plans._base import big, dec, query
from chronomark.sources.testdata import DURATION, SEG_SQL, TL_SQL, segments, timeline

#: What the overlay of an event says, by its label.
OVERLAY_TEXTS = ["Follow for more", "50 percent off", "ok", "SHOP NOW", "#fyp", "What is this?", "Everyone loves the quality of this product line"]
#: Sticker types by label; the labels after these have none of their own and are static.
STICKER_TYPES = ["emoji", "animated", "static", "gif"]

# Words that decide calls to action and topics.
CTA_MOMENT_WORDS = ["buy", "shop", "click", "link", "follow", "subscribe", "comment", "share", "order", "get"]
CTA_WORDS = [*CTA_MOMENT_WORDS, "save", "discount", "sale", "limited"]
TOPICS = {
    "product_mentions": ["product", "item", "brand", "quality", "feature", "benefit"],
    "urgency_phrases": ["now", "today", "limited", "last", "hurry", "quick", "fast"],
    "social_proof": ["everyone", "viral", "trending", "popular", "love", "favorite"],
}

_LIST = "['" + "', '".join(OVERLAY_TEXTS) + "']"
OV_SQL = f"{TL_SQL}, ov AS (SELECT video_id, seq, t, conf, label, ({_LIST})[label + 1] AS text FROM tl WHERE entry_type = 'text')"


def overlays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, seq, t, conf, label, text``: overlay texts as they appear."""
    text = F.element_at(F.array(*map(F.lit, OVERLAY_TEXTS)), (F.col("label") + 1).cast("int"))
    return timeline(spark, sf_dir).where("entry_type = 'text'").select("video_id", "seq", "t", "conf", "label", text.alias("text"))


def any_of(text: Column, words: list[str]) -> Column:
    return F.lower(text).rlike("|".join(words))


def any_sql(words: list[str]) -> str:
    return f"regexp_matches(lower(text), '{'|'.join(words)}')"


def is_upper(text: Column) -> Column:
    """Some letter that has a case, and none in lower case."""
    return (F.upper(text) == text) & (F.lower(text) != text)


_UPPER_SQL = "upper(text) = text AND lower(text) <> text"


@query("flt_conf_text", f"WITH {OV_SQL} SELECT video_id, seq FROM ov WHERE conf > 0.5 AND length(trim(text)) > 2")
def flt_conf_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlays(spark, sf_dir).where((F.col("conf") > 0.5) & (F.char_length(F.trim("text")) > 2)).select("video_id", "seq")


@query("agg_unique_text", f"WITH {OV_SQL} SELECT video_id, count(DISTINCT lower(trim(text))) AS unique_texts, count(*) AS texts, CAST((count(*) - count(DISTINCT lower(trim(text)))) / count(*) AS DECIMAL(18,6)) AS repetition FROM ov GROUP BY video_id")
def agg_unique_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique, n = F.countDistinct(F.lower(F.trim("text"))), F.count("*")
    return overlays(spark, sf_dir).groupBy("video_id").agg(unique.alias("unique_texts"), n.alias("texts"), dec((n - unique) / n).alias("repetition"))


@query("agg_overlay_core", f"""WITH {OV_SQL}, a AS (SELECT tl.video_id, count(*) FILTER (entry_type = 'text') AS texts, count(*) FILTER (entry_type = 'object') AS stickers, min(tl.t) FILTER (entry_type IN ('text', 'object')) AS first_t FROM tl GROUP BY ALL),
u AS (SELECT video_id, count(DISTINCT lower(trim(text))) AS unique_texts, avg(greatest(1.0, length(text) * 0.1)) AS mean_s FROM ov GROUP BY ALL)
SELECT a.video_id, texts, stickers, coalesce(unique_texts, 0) AS unique_texts, CAST((texts + stickers) / {DURATION}.0 AS DECIMAL(18,6)) AS per_second, CAST((texts + stickers) * 60 / {DURATION}.0 AS DECIMAL(18,6)) AS per_minute,
CAST(coalesce(unique_texts / nullif(texts + stickers, 0), 0) AS DECIMAL(18,6)) AS unique_ratio, CAST(coalesce(first_t, {DURATION}) AS DECIMAL(18,6)) AS first_s, CAST(coalesce(mean_s, 0) AS DECIMAL(18,4)) AS mean_s FROM a LEFT JOIN u USING (video_id)""")
def agg_overlay_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and stickers of an item: numbers, rates, first appearance, mean time on screen (a tenth of a second a character, at least one)."""
    tl = timeline(spark, sf_dir)
    is_ = lambda k: F.col("entry_type") == k
    text = F.element_at(F.array(*map(F.lit, OVERLAY_TEXTS)), (F.col("label") + 1).cast("int"))
    own = F.when(is_("text"), text)
    a = tl.groupBy("video_id").agg(F.count_if(is_("text")).alias("texts"), F.count_if(is_("object")).alias("stickers"), F.countDistinct(F.lower(F.trim(own))).alias("unique_texts"), F.min(F.when(is_("text") | is_("object"), F.col("t"))).alias("first_t"), F.avg(F.greatest(F.when(is_("text"), F.lit(1.0)), F.char_length(own) * 0.1)).alias("mean_s"))
    both = F.col("texts") + F.col("stickers")
    return a.select("video_id", "texts", "stickers", "unique_texts", dec(both / float(DURATION)).alias("per_second"), dec(both * 60 / float(DURATION)).alias("per_minute"), dec(F.coalesce(F.try_divide("unique_texts", both), F.lit(0.0))).alias("unique_ratio"), dec(F.coalesce("first_t", F.lit(float(DURATION)))).alias("first_s"), dec(F.coalesce("mean_s", F.lit(0.0)), 4).alias("mean_s"))


# --- sizes and the fold over them ---------------------------------------------------------------------------------

_SIZES_SQL = f"{OV_SQL}, sz AS (SELECT video_id, list(length(text) * CASE WHEN {_UPPER_SQL} THEN 2 ELSE 1 END ORDER BY t, seq) AS s, list(seq ORDER BY t, seq) AS q FROM ov GROUP BY video_id), half AS (SELECT *, list_avg(s) * 0.5 AS h FROM sz)"


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, s, q, h``: text sizes in order (characters, twice for capitals), their rows, half of their mean."""
    size = F.char_length("text") * F.when(is_upper(F.col("text")), 2).otherwise(1)
    x = overlays(spark, sf_dir).groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("t", "seq", size.cast("long").alias("s")))).alias("x"), (F.avg(size) * 0.5).alias("h"))
    return x.select("video_id", F.transform("x", lambda v: v["s"]).alias("s"), F.transform("x", lambda v: v["seq"]).alias("q"), "h")


def dominant(s: str = "s", upto: str = "size(s)") -> Column:
    """The fold: the dominant size moves to a text's when the two differ by over half the mean; with the number of moves."""
    return F.expr(f"aggregate(slice({s}, 2, {upto} - 1), named_struct('size', {s}[0], 'moves', 0L), (a, x) -> if(abs(x - a.size) > h, named_struct('size', x, 'moves', a.moves + 1L), a))")


@query("fold_running", f"""WITH {_SIZES_SQL}, f AS (SELECT video_id, list_reduce(s, lambda a, x: CASE WHEN abs(x - a % 100000) > h THEN (a // 100000 + 1) * 100000 + x ELSE a END) AS a FROM half) SELECT video_id, CAST(a % 100000 AS BIGINT) AS last_size, CAST(a // 100000 AS BIGINT) AS moves FROM f""")
def fold_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sizes(spark, sf_dir).withColumn("f", dominant()).select("video_id", F.col("f.size").alias("last_size"), F.col("f.moves").alias("moves"))


@query("win_running_fold", f"""WITH {_SIZES_SQL}, i AS (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM half) SELECT video_id, q[i] AS seq, CAST(s[i] AS BIGINT) AS size, CAST(list_reduce(s[1:i], lambda a, x: CASE WHEN abs(x - a) > h THEN x ELSE a END) AS BIGINT) AS dominant_size FROM i""")
def win_running_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dominant size after every text."""
    trail = F.expr("aggregate(slice(s, 2, size(s) - 1), array(s[0]), (a, x) -> array_append(a, if(abs(x - element_at(a, -1)) > h, x, element_at(a, -1))))")
    x = sizes(spark, sf_dir).select("video_id", F.explode(F.arrays_zip(F.col("q").alias("seq"), F.col("s").alias("size"), trail.alias("top"))).alias("x"))
    return x.select("video_id", "x.seq", "x.size", F.col("x.top").alias("dominant_size"))


@query("agg_text_len_stats", f"""WITH {_SIZES_SQL}, d AS (SELECT video_id, h * 2 AS m, coalesce(list_stddev_samp(s), 0) AS dev, list_reduce(s, lambda a, x: CASE WHEN abs(x - a % 100000) > h THEN (a // 100000 + 1) * 100000 + x ELSE a END) // 100000 AS moves FROM half) SELECT video_id, CAST(m AS DECIMAL(18,4)) AS mean_size, CAST(dev AS DECIMAL(18,4)) AS deviation, CAST(moves AS BIGINT) AS dominance_changes FROM d""")
def agg_text_len_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = F.col("h") * 2
    square = F.aggregate("s", F.lit(0.0), lambda a, x: a + (x - F.col("h") * 2) * (x - F.col("h") * 2))
    return sizes(spark, sf_dir).select("video_id", dec(mean, 4).alias("mean_size"), dec(F.coalesce(F.sqrt(F.try_divide(square, F.size("s") - 1)), F.lit(0.0)), 4).alias("deviation"), dominant()["moves"].alias("dominance_changes"))


# --- classes of texts and stickers --------------------------------------------------------------------------------

_CATEGORY_SQL = f"CASE WHEN length(text) > 30 OR ({_UPPER_SQL}) THEN 'headline' WHEN {any_sql(CTA_WORDS)} THEN 'cta' WHEN starts_with(text, '#') THEN 'hashtag' WHEN regexp_matches(text, '[0-9]') THEN 'numbers' WHEN length(text) > 15 THEN 'subtitle' ELSE 'caption' END"
_CATEGORIES = ["headline", "subtitle", "cta", "caption", "numbers", "hashtag"]
_TOPIC_SQL = "CASE " + " ".join(f"WHEN {any_sql(w)} THEN '{k}'" for k, w in TOPICS.items()) + " WHEN contains(text, '?') THEN 'questions' ELSE 'other_text' END"
_TOPICS = [*TOPICS, "questions", "other_text"]


def category(text: Column) -> Column:
    return (
        F.when((F.char_length(text) > 30) | is_upper(text), "headline").when(any_of(text, CTA_WORDS), "cta").when(F.startswith(text, F.lit("#")), "hashtag")
        .when(text.rlike("[0-9]"), "numbers").when(F.char_length(text) > 15, "subtitle").otherwise("caption")
    )


def topic(text: Column) -> Column:
    out = None
    for k, w in TOPICS.items():
        out = F.when(any_of(text, w), k) if out is None else out.when(any_of(text, w), k)
    return out.when(F.contains(text, F.lit("?")), "questions").otherwise("other_text")


def _counts(of: str, kinds: list[str]) -> str:
    return ", ".join(f"count(*) FILTER ({of} = '{k}') AS {k}" for k in kinds)


@query("agg_text_categories", f"WITH {OV_SQL}, c AS (SELECT video_id, {_CATEGORY_SQL} AS c FROM ov UNION ALL SELECT conv_id, {_CATEGORY_SQL} FROM conversations WHERE text IS NOT NULL) SELECT video_id, {_counts('c', _CATEGORIES)} FROM c GROUP BY video_id")
def agg_text_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of overlay texts and spoken turns, the first that fits."""
    spoken = segments(spark, sf_dir).where("text is not null").select("video_id", "text")
    c = overlays(spark, sf_dir).select("video_id", "text").unionByName(spoken).select("video_id", category(F.col("text")).alias("c"))
    return c.groupBy("video_id").agg(*[F.count_if(F.col("c") == k).alias(k) for k in _CATEGORIES])


@query("agg_semantic_groups", f"WITH {OV_SQL}, c AS (SELECT video_id, {_TOPIC_SQL} AS c FROM ov), g AS (SELECT video_id, {_counts('c', _TOPICS)} FROM c GROUP BY video_id) SELECT *, CASE greatest({', '.join(_TOPICS)}) " + " ".join(f"WHEN {k} THEN '{k}'" for k in _TOPICS) + " END AS primary_group FROM g")
def agg_semantic_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics of overlay texts, and the most frequent one; of equal ones the first in order."""
    g = overlays(spark, sf_dir).groupBy("video_id").agg(*[F.count_if(topic(F.col("text")) == k).alias(k) for k in _TOPICS])
    most, first = F.greatest(*_TOPICS), None
    for k in _TOPICS:
        first = F.when(F.col(k) == most, k) if first is None else first.when(F.col(k) == most, k)
    return g.withColumn("primary_group", first)


@query("agg_sticker_types", f"WITH {TL_SQL}, s AS (SELECT video_id, coalesce((['" + "', '".join(STICKER_TYPES) + f"'])[label + 1], 'static') AS k FROM tl WHERE entry_type = 'object') SELECT video_id, {_counts('k', STICKER_TYPES[:3])} FROM s GROUP BY video_id")
def agg_sticker_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emoji, animated and static stickers; without a type a sticker is static, other types do not count."""
    k = F.coalesce(F.get(F.array(*map(F.lit, STICKER_TYPES)), F.col("label").cast("int")), F.lit("static"))
    return timeline(spark, sf_dir).where("entry_type = 'object'").groupBy("video_id").agg(*[F.count_if(k == t).alias(t) for t in STICKER_TYPES[:3]])


@query("agg_cta_matrix", f"""WITH {OV_SQL}, x AS (SELECT a.video_id, EXISTS (SELECT 1 FROM tl g WHERE g.video_id = a.video_id AND g.entry_type = 'gesture' AND abs(g.t - a.t) <= 1) AS g, EXISTS (SELECT 1 FROM tl s WHERE s.video_id = a.video_id AND s.entry_type = 'object' AND floor(s.t) = floor(a.t)) AS s FROM ov a WHERE {any_sql(CTA_WORDS)})
SELECT video_id, count(*) FILTER (NOT g AND NOT s) AS text_only, count(*) FILTER (g AND NOT s) AS text_gesture, count(*) FILTER (NOT g AND s) AS text_sticker, count(*) FILTER (g AND s) AS all_three FROM x GROUP BY video_id""")
def agg_cta_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls to action with a gesture at most a second away, with a sticker in their second, with both or neither."""
    tl = timeline(spark, sf_dir)
    cta = overlays(spark, sf_dir).where(any_of(F.col("text"), CTA_WORDS)).select("video_id", "seq", "t")
    near = band_exists(cta, tl.where("entry_type = 'gesture'"), 1.0).select("video_id", "seq", F.lit(True).alias("g"))
    sticker = tl.where("entry_type = 'object'").select("video_id", F.floor("t").alias("sec")).distinct().withColumn("s", F.lit(True))
    x = cta.withColumn("sec", F.floor("t")).join(near, ["video_id", "seq"], "left").join(sticker, ["video_id", "sec"], "left").na.fill(False, ["g", "s"])
    n = lambda c, name: F.count_if(F.expr(c)).alias(name)
    return x.groupBy("video_id").agg(n("not g and not s", "text_only"), n("g and not s", "text_gesture"), n("not g and s", "text_sticker"), n("g and s", "all_three"))


# --- strategy and quality -----------------------------------------------------------------------------------------

_EXPECTED = max(1, int(DURATION * 0.3))
_EXPECTED_TEXTS, _EXPECTED_STICKERS = int(DURATION * 0.5), int(DURATION * 0.1)
_N_SQL = f"{OV_SQL}, n AS (SELECT tl.video_id, count(*) FILTER (entry_type = 'text') AS texts, count(*) FILTER (entry_type = 'object') AS stickers FROM tl GROUP BY ALL)"


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_ = lambda k: F.count_if(F.col("entry_type") == k)
    text = F.element_at(F.array(*map(F.lit, OVERLAY_TEXTS)), (F.col("label") + 1).cast("int"))
    unique = F.countDistinct(F.when(F.col("entry_type") == "text", F.lower(F.trim(text))))
    return timeline(spark, sf_dir).groupBy("video_id").agg(is_("text").alias("texts"), is_("object").alias("stickers"), unique.alias("unique_texts"))


def named(*rules: tuple[Column, str]) -> Column:
    """The names of the rules that hold, joined."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in rules])), ",")


def named_sql(*rules: tuple[str, str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in rules) + "], lambda x: x IS NOT NULL), ',')"


@query("agg_overlay_quality", f"""WITH {_N_SQL}, u AS (SELECT video_id, count(DISTINCT lower(trim(text))) AS unique_texts FROM ov GROUP BY ALL), q AS (SELECT n.video_id, texts, coalesce(unique_texts, 0) AS unique_texts, least(1.0, texts / {_EXPECTED}.0) AS complete, 0.85 + CASE WHEN texts > 10 THEN 0.1 ELSE 0 END AS sure FROM n LEFT JOIN u USING (video_id))
SELECT video_id, CAST(sure AS DECIMAL(18,6)) AS detection, CAST(complete AS DECIMAL(18,6)) AS completeness, CASE WHEN texts = 0 THEN 'low' ELSE 'high' END AS reliability, {named_sql(('texts = 0', 'no_overlays_detected'), ('texts > 0 AND unique_texts < texts * 0.1', 'low_text_variety'))} AS missing, CAST(least(0.95, (sure + complete) / 2) AS DECIMAL(18,6)) AS confidence FROM q""")
def agg_overlay_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _numbers(spark, sf_dir)
    complete, sure = F.least(F.lit(1.0), F.col("texts") / float(_EXPECTED)), F.lit(0.85) + F.when(F.col("texts") > 10, 0.1).otherwise(0.0)
    missing = named((F.col("texts") == 0, "no_overlays_detected"), (F.expr("texts > 0 and unique_texts < texts * 0.1"), "low_text_variety"))
    return n.select("video_id", dec(sure).alias("detection"), dec(complete).alias("completeness"), F.when(F.col("texts") == 0, "low").otherwise("high").alias("reliability"), missing.alias("missing"), dec(F.least(F.lit(0.95), (sure + complete) / 2)).alias("confidence"))


@query("agg_overlay_completeness", f"""WITH {_N_SQL}, r AS (SELECT video_id, texts, least(texts / {_EXPECTED_TEXTS}.0, 1.0) AS a, least(stickers / {_EXPECTED_STICKERS}.0, 1.0) AS b FROM n)
SELECT video_id, CAST((a + b) / 2 AS DECIMAL(18,6)) AS completeness, CAST((a + b + CASE WHEN texts > 0 THEN 1 ELSE 0 END + 1.0) / 4 AS DECIMAL(18,6)) AS confidence FROM r""")
def agg_overlay_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.least(F.col("texts") / float(_EXPECTED_TEXTS), F.lit(1.0)), F.least(F.col("stickers") / float(_EXPECTED_STICKERS), F.lit(1.0))
    return _numbers(spark, sf_dir).select("video_id", dec((a + b) / 2).alias("completeness"), dec((a + b + F.when(F.col("texts") > 0, 1).otherwise(0) + 1.0) / 4).alias("confidence"))


_HALF_WINDOWS = (5, 6)  # of eleven windows of three seconds
CLS_OVERLAY_SQL = f"""{_N_SQL}, {SEG_SQL}, m AS (SELECT video_id, count(*) FILTER ({any_sql(CTA_MOMENT_WORDS)}) AS cta, count(*) FILTER (t < 15) / {_HALF_WINDOWS[0]}.0 AS a, count(*) FILTER (t >= 15) / {_HALF_WINDOWS[1]}.0 AS b,
  count(*) FILTER (EXISTS (SELECT 1 FROM tl g WHERE g.video_id = o.video_id AND g.entry_type = 'gesture' AND abs(g.t - o.t) <= 1) OR EXISTS (SELECT 1 FROM seg s WHERE s.video_id = o.video_id AND abs(s.start_s - o.t) <= 1)) AS multi FROM ov o GROUP BY ALL),
iv AS (SELECT video_id, t - lag(t) OVER (PARTITION BY video_id ORDER BY t, seq) AS g FROM ov), rh AS (SELECT video_id, CASE WHEN avg(g) > 0 THEN 1 - coalesce(stddev_samp(g), 0) / avg(g) ELSE 0 END AS rhythm FROM iv GROUP BY ALL),
k AS (SELECT n.video_id, (texts + stickers) / {DURATION}.0 AS dens, texts, coalesce(cta, 0) AS cta, coalesce(rhythm, 0) AS rhythm, coalesce(multi, 0) AS multi, CASE WHEN coalesce(b, 0) > coalesce(a, 0) * 1.3 THEN 'accelerating' WHEN coalesce(b, 0) < coalesce(a, 0) * 0.7 THEN 'decelerating' ELSE 'stable' END AS pace FROM n LEFT JOIN m USING (video_id) LEFT JOIN rh USING (video_id))"""


def overlay_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``video_id, texts, stickers, unique_texts, dens, cta, rhythm, multi, pace``: what the classes of an item's overlays go by."""
    tl = timeline(spark, sf_dir)
    ov = overlays(spark, sf_dir)
    times = tl.where("entry_type = 'gesture'").select("video_id", "t").unionByName(segments(spark, sf_dir).select("video_id", F.col("start_s").cast("double").alias("t")))
    multi = band_exists(ov.select("video_id", "seq", "t"), times, 1.0).groupBy("video_id").agg(F.count("*").alias("multi"))
    w = Window.partitionBy("video_id").orderBy("t", "seq")
    x = ov.withColumn("g", F.col("t") - F.lag("t").over(w))
    m = x.groupBy("video_id").agg(F.count_if(any_of(F.col("text"), CTA_MOMENT_WORDS)).alias("cta"), (F.count_if(F.col("t") < 15) / _HALF_WINDOWS[0]).alias("a"), (F.count_if(F.col("t") >= 15) / _HALF_WINDOWS[1]).alias("b"), F.when(F.avg("g") > 0, 1 - F.coalesce(F.stddev_samp("g"), F.lit(0.0)) / F.avg("g")).otherwise(0.0).alias("rhythm"))
    k = _numbers(spark, sf_dir).join(m, "video_id", "left").join(multi, "video_id", "left").na.fill(0, ["cta", "a", "b", "rhythm", "multi"])
    pace = F.when(F.expr("b > a * 1.3"), "accelerating").when(F.expr("b < a * 0.7"), "decelerating").otherwise("stable")
    return k.select("video_id", "texts", "stickers", "unique_texts", ((F.col("texts") + F.col("stickers")) / float(DURATION)).alias("dens"), "cta", "rhythm", "multi", pace.alias("pace"))


STRATEGY = ("dens > 1.0", "heavy"), ("dens > 0.5", "moderate")
TECHNIQUES = ("cta > 0", "direct_cta"), ("rhythm > 0.7", "rhythmic_timing"), ("pace <> 'stable'", "dynamic_pacing"), ("multi > texts * 0.3", "multimodal_reinforcement")


def overlay_classes() -> dict[str, Column]:
    """Strategy, techniques, archetype, pacing and focus from ``overlay_facts``."""
    return {
        "overlayStrategy": F.when(F.expr(STRATEGY[0][0]), "heavy").when(F.expr(STRATEGY[1][0]), "moderate").otherwise("minimal"),
        "overlayTechniques": F.array_compact(F.array(*[F.when(F.expr(c), F.lit(n)) for c, n in TECHNIQUES])),
        "engagementArchetype": F.when(F.expr("cta > 2"), "conversion_focused").when(F.expr("dens > 0.8"), "attention_grabbing").otherwise("informational"),
        "pacingPattern": F.col("pace"),
        "contentFocus": F.when(F.expr("cta > 1"), "product_focused").otherwise("informational"),
    }


@query("cls_overlay", f"WITH {CLS_OVERLAY_SQL} SELECT video_id, CASE WHEN dens > 1.0 THEN 'heavy' WHEN dens > 0.5 THEN 'moderate' ELSE 'minimal' END AS strategy, {named_sql(*TECHNIQUES)} AS techniques, CASE WHEN cta > 2 THEN 'conversion_focused' WHEN dens > 0.8 THEN 'attention_grabbing' ELSE 'informational' END AS archetype, pace, CASE WHEN cta > 1 THEN 'product_focused' ELSE 'informational' END AS focus FROM k")
def cls_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = overlay_classes()
    return overlay_facts(spark, sf_dir).select("video_id", c["overlayStrategy"].alias("strategy"), F.array_join(c["overlayTechniques"], ",").alias("techniques"), c["engagementArchetype"].alias("archetype"), "pace", c["contentFocus"].alias("focus"))


@query("cls_overlay_tags", f"WITH {_N_SQL}, c AS (SELECT video_id, count(*) FILTER ({any_sql(CTA_WORDS)}) AS cta FROM ov GROUP BY ALL) SELECT n.video_id, {named_sql(('texts / ' + str(float(DURATION)) + ' > 1.0', 'text_heavy'), ('texts > stickers * 2', 'text_led'), ('stickers > texts * 2', 'sticker_led'), ('coalesce(cta, 0) >= 3', 'multi_reinforced'))} AS tags FROM n LEFT JOIN c USING (video_id)")
def cls_overlay_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    cta = overlays(spark, sf_dir).groupBy("video_id").agg(big(F.count_if(any_of(F.col("text"), CTA_WORDS))).alias("cta"))
    n = _numbers(spark, sf_dir).join(cta, "video_id", "left").na.fill(0, ["cta"])
    return n.select("video_id", named((F.expr(f"texts / {float(DURATION)} > 1.0"), "text_heavy"), (F.expr("texts > stickers * 2"), "text_led"), (F.expr("stickers > texts * 2"), "sticker_led"), (F.col("cta") >= 3, "multi_reinforced")).alias("tags"))
