"""Whole-text features, exact rounding, JSON, payloads, sampling, validation and comparison of documents, run reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.functions import text as tx
from chronomark.functions.time import key_start
from chronomark.plans._base import QUERIES, big, dec, query
from chronomark.plans.overlays import is_upper, named, named_sql
from chronomark.plans.reports import BLOCKS, DENSITY, DENSITY_SQL, blocks_sql
from chronomark.sources.testdata import DURATION, EMOTIONS, TL_SQL, table, timeline


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# --- text ---------------------------------------------------------------------------------------------------------

_SPANISH = "el|la|los|las|un|una|que|es|en|de|por|para"
_EDGE = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def has_word(pattern: str) -> str:
    """Whether one of the words occurs, between what is no letter, digit or underscore of any script; the same in both engines."""
    return f"{_EDGE[0]}(?:{pattern}){_EDGE[1]}"


@query("txt_language", "SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'unknown' WHEN regexp_matches(text, '[\\x{4e00}-\\x{9fff}]') THEN 'zh' WHEN regexp_matches(text, '[\\x{3040}-\\x{30ff}]') THEN 'ja' WHEN regexp_matches(text, '[\\x{ac00}-\\x{d7af}]') THEN 'ko' WHEN regexp_matches(text, '[\\x{600}-\\x{6ff}]') THEN 'ar' WHEN regexp_matches(text, '[\\x{400}-\\x{4ff}]') THEN 'ru' WHEN regexp_matches(lower(text), '" + has_word(_SPANISH) + "') THEN 'es' ELSE 'en' END AS guess FROM documents")
def txt_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language by its script, Spanish by its small words, else English."""
    t = F.col("text")
    scripts = [(r"[\x{4e00}-\x{9fff}]", "zh"), (r"[\x{3040}-\x{30ff}]", "ja"), (r"[\x{ac00}-\x{d7af}]", "ko"), (r"[\x{600}-\x{6ff}]", "ar"), (r"[\x{400}-\x{4ff}]", "ru")]
    guess = F.when(F.coalesce(t, F.lit("")) == "", "unknown")
    for p, name in scripts:
        guess = guess.when(t.rlike(p), name)
    return docs(spark, sf_dir).select("doc_id", guess.when(F.lower(t).rlike(has_word(_SPANISH)), "es").otherwise("en").alias("guess"))


# Words and emoji that decide the sentiment.
POSITIVE = ["love", "amazing", "great", "awesome", "excellent", "best", "perfect", "beautiful", "fantastic", "wonderful", "happy", "good", "like", "enjoy"]
POSITIVE_EMOJI = ["😊", "😍", "❤️", "🔥", "💯", "👍", "✨", "🎉", "💖", "😄"]
NEGATIVE = ["hate", "terrible", "awful", "worst", "bad", "horrible", "disgusting", "ugly", "nasty", "poor", "wrong", "fail", "don't", "not"]
NEGATIVE_EMOJI = ["😞", "😢", "😡", "👎", "💔", "😠", "😤", "😭"]


def _hits(words: list[str], emoji: list[str]) -> Column:
    low = F.lower("text")
    return sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0)) + sum((F.contains("text", F.lit(e)).cast("int") for e in emoji), F.lit(0))


def _hits_sql(words: list[str], emoji: list[str]) -> str:
    return " + ".join([f"CAST(contains(lower(text), '{w.replace(chr(39), chr(39) * 2)}') AS INTEGER)" for w in words] + [f"CAST(contains(text, '{e}') AS INTEGER)" for e in emoji])


@query("txt_sentiment", f"WITH c AS (SELECT doc_id, {_hits_sql(POSITIVE, POSITIVE_EMOJI)} AS p, {_hits_sql(NEGATIVE, NEGATIVE_EMOJI)} AS n FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)) SELECT doc_id, p AS positive, n AS negative, CASE WHEN p > n * 1.5 THEN 'positive' WHEN n > p * 1.5 THEN 'negative' ELSE 'neutral' END AS sentiment FROM c")
def txt_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the words and emoji occur at all; one side needs half as many again as the other."""
    c = docs(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", _hits(POSITIVE, POSITIVE_EMOJI).alias("positive"), _hits(NEGATIVE, NEGATIVE_EMOJI).alias("negative"))
    return c.withColumn("sentiment", F.when(F.expr("positive > negative * 1.5"), "positive").when(F.expr("negative > positive * 1.5"), "negative").otherwise("neutral"))


_W = r"[\p{L}\p{N}_]"
ENTITIES = {
    "has_brand_mention": (rf"@{_W}+|#{_W}*(?:brand|official|store){_W}*", False),
    "has_price_mention": (r"[$][0-9]+|[0-9]+%|price|cost|free|sale|discount|deal", True),
    "has_cta": (has_word("link|bio|click|buy|shop|order|get|visit|check|follow|comment|share|like"), True),
    "has_url": (r"https?://|www[.]|[.]com|[.]net|[.]org", True),
    "has_question": (r"[?]|" + has_word("what|when|where|which|who|why|how|can|will|would|should"), True),
    "has_user_mention": (rf"@{_W}+", False),
}


@query("txt_entities", "SELECT doc_id, " + ", ".join(f"regexp_matches({'lower(text)' if low else 'text'}, '{p}') AS {n}" for n, (p, low) in ENTITIES.items()) + " FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)")
def txt_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = docs(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return t.select("doc_id", *[(F.lower("text") if low else F.col("text")).rlike(p).alias(n) for n, (p, low) in ENTITIES.items()])


# Words that are no terms.
STOPWORDS = ["the", "and", "for", "this", "that", "with", "from", "have", "has", "was", "were", "been", "being", "are", "our", "your", "their", "what", "when", "where", "which", "who", "why", "how", "can", "will"]
_STOP_SQL = ", ".join(f"'{w}'" for w in STOPWORDS)


@query("txt_top_terms", f"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{_W}{{3,}}') AS w FROM documents), t AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS i FROM w), c AS (SELECT doc_id, term, count(*) AS n, min(i) AS i FROM t WHERE term NOT IN ({_STOP_SQL}) AND NOT regexp_full_match(term, '[0-9]+') GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, i) AS r FROM c) SELECT doc_id, array_to_string(list(term ORDER BY r), ',') AS terms FROM r WHERE r <= 5 GROUP BY doc_id""")
def txt_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent words of three letters and more of a text; of equally frequent ones the first met."""
    w = docs(spark, sf_dir).select("doc_id", F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit(f"{_W}{{3,}}"), F.lit(0))).alias("i", "term"))
    kept = w.where(~F.col("term").isin(*STOPWORDS) & ~F.col("term").rlike("^[0-9]+$"))
    c = kept.groupBy("doc_id", "term").agg(F.count("*").alias("n"), F.min("i").alias("i"))
    r = c.withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("n"), "i"))).where("r <= 5")
    return r.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "term"))), lambda x: x["term"]), ",").alias("terms"))


@query("txt_lower_trim", "SELECT doc_id, trim(lower(text)) AS folded, upper(text) = text AND lower(text) <> text AS is_upper, starts_with(text, 'T') AS starts_t, regexp_matches(text, '[0-9]') AS has_digit FROM documents")
def txt_lower_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.trim(F.lower("text")).alias("folded"), is_upper(F.col("text")).alias("is_upper"), F.startswith("text", F.lit("T")).alias("starts_t"), F.col("text").rlike("[0-9]").alias("has_digit"))


_EMOJI_CHARS = rf"[{tx.EMOJI}\x{{2600}}-\x{{27BF}}]"
#: The driver's turns have no emoji; each says one of these at its end.
SMILES = ["🔥🔥", "😊", "", "✨ wow 🎉", "❤", "👍👍👍", "no"]
_SMILE_SQL = "coalesce(text, '') || (['" + "', '".join(SMILES) + "'])[turn % 7 + 1]"


@query("txt_emoji_chars", f"WITH e AS (SELECT conv_id, turn, regexp_extract_all({_SMILE_SQL}, '{_EMOJI_CHARS}') AS e FROM conversations) SELECT conv_id, turn, CAST(len(e) AS INTEGER) AS emoji_count, array_to_string(list_sort(list_distinct(e)), '') AS emoji_set FROM e")
def txt_emoji_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every emoji character by itself, and the different ones."""
    t = F.concat(F.coalesce("text", F.lit("")), F.element_at(F.array(*map(F.lit, SMILES)), (F.col("turn") % 7 + 1).cast("int")))
    e = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.regexp_extract_all(t, F.lit(_EMOJI_CHARS), F.lit(0)).alias("e"))
    return e.select("conv_id", "turn", F.size("e").alias("emoji_count"), F.array_join(F.array_sort(F.array_distinct("e")), "").alias("emoji_set"))


# --- math and JSON ------------------------------------------------------------------------------------------------


def round_half_even(x: Column, digits: int = 2) -> Column:
    """``x`` rounded as the exact value of its double is, ties to even; for 2^-8 <= |x| < 2^20 and 0.

    The double is taken apart into whole 2^-60ths, so a value that only looks like a tie (2.675 is a little less) is none.
    """
    a = F.abs(x)
    whole = F.floor(a * F.lit(float(1 << 26)))
    rest = F.floor((a * F.lit(float(1 << 26)) - whole) * F.lit(float(1 << 34)))
    num = lambda v: F.lit(v).cast("decimal(38,0)")
    units = (whole.cast("decimal(18,0)") * F.lit(1 << 34).cast("decimal(12,0)")).cast("decimal(30,0)") + rest.cast("decimal(18,0)")
    scaled = (units * F.lit(10**digits).cast("decimal(5,0)")).cast("decimal(38,0)")
    one = num(1 << 60)
    floor = F.floor(scaled / one).cast("decimal(38,0)")
    floor = F.when(floor * one > scaled, floor - 1).when((floor + 1) * one <= scaled, floor + 1).otherwise(floor).cast("decimal(28,0)")
    left = (scaled - floor.cast("decimal(18,0)") * F.lit(1 << 60).cast("decimal(20,0)")).cast("decimal(38,0)")
    half = num(1 << 59)
    up = (left > half) | ((left == half) & (floor % 2 == 1))
    sign = F.when(x < 0, F.lit(-1)).otherwise(F.lit(1))
    return ((floor + up.cast("int")) * sign / F.lit(10**digits).cast("decimal(5,0)")).cast(f"decimal(18,{digits})")


@query("mth_round", "SELECT l_orderkey, l_linenumber, CAST(printf('%.2f', x) AS DECIMAL(18,2)) AS rounded FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN (l_orderkey % 4000) / 1000.0 ELSE (l_orderkey % 4000) / 8.0 END::DOUBLE + 1 AS x FROM lineitem)")
def mth_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_orderkey") % 4000
    x = F.when(F.col("l_linenumber") % 2 == 0, k / F.lit(1000.0)).otherwise(k / F.lit(8.0)) + 1
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", round_half_even(x).alias("rounded"))


@query("jsn_dump", "SELECT event_id, CAST(to_json({'event_id': event_id, 'event_type': event_type, 'user': {'id': user_id}}) AS VARCHAR) AS document FROM events")
def jsn_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.to_json(F.struct("event_id", "event_type", F.struct(F.col("user_id").alias("id")).alias("user"))).alias("document"))


@query("jsn_load", "SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, len(json_keys(props)) AS keys FROM events")
def jsn_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), big(F.size(F.json_object_keys("props"))).alias("keys"))


# --- projections, sorting, sampling -------------------------------------------------------------------------------


def strip_prefix(name: Column, prefix: str) -> Column:
    """A block's name without its prefix, with a capital; other names stay."""
    rest = F.substring(name, len(prefix) + 1, 1 << 20)
    return F.when(F.startswith(name, F.lit(prefix)) & (F.char_length(name) > len(prefix)), F.concat(F.upper(F.left(rest, F.lit(1))), F.substring(rest, 2, 1 << 20))).otherwise(name)


@query("prj_prefix_strip", "WITH k AS (SELECT event_id, (['densityCoreMetrics', 'densityquality', 'density', 'metadata', 'CoreMetrics'])[event_id % 5 + 1] AS name FROM events) SELECT event_id, name, CASE WHEN starts_with(name, 'density') AND length(name) > 7 THEN upper(name[8:8]) || name[9:] ELSE name END AS stripped FROM k")
def prj_prefix_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, ["densityCoreMetrics", "densityquality", "density", "metadata", "CoreMetrics"]))
    k = table(spark, sf_dir, "events").select("event_id", F.element_at(names, (F.col("event_id") % 5 + 1).cast("int")).alias("name"))
    return k.withColumn("stripped", strip_prefix(F.col("name"), "density"))


_NAME_SQL = "(['" + "', '".join(EMOTIONS) + "'])"


@query("prj_clean_payload", f"WITH {TL_SQL} SELECT video_id, seq, CASE WHEN entry_type = 'emotion' THEN {_NAME_SQL}[label + 1] END AS expression, CASE WHEN entry_type = 'emotion' THEN CAST(CAST(conf AS DECIMAL(18,6)) AS DECIMAL(18,2)) END AS confidence, CASE WHEN entry_type = 'object' THEN (['close', 'medium', 'far'])[label % 3 + 1] END AS distance FROM tl WHERE entry_type <> 'scene_change'")
def prj_clean_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each kind the fields that are passed on, the confidence with two digits; descriptions go."""
    is_ = lambda k: F.col("entry_type") == k
    name = F.element_at(F.array(*map(F.lit, EMOTIONS)), (F.col("label") + 1).cast("int"))
    far = F.element_at(F.array(*map(F.lit, ["close", "medium", "far"])), (F.col("label") % 3 + 1).cast("int"))
    return timeline(spark, sf_dir).where("entry_type <> 'scene_change'").select("video_id", "seq", F.when(is_("emotion"), name).alias("expression"), F.when(is_("emotion"), dec("conf").cast("decimal(18,2)")).alias("confidence"), F.when(is_("object"), far).alias("distance"))


@query("sort_numeric_key", f"WITH {TL_SQL}, k AS (SELECT video_id, seq, CASE WHEN label = 6 THEN 'bad' ELSE CAST(CAST(floor(t) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(floor(t) AS BIGINT) + 1 AS VARCHAR) || 's' END AS key FROM tl) SELECT video_id, seq, key, row_number() OVER (PARTITION BY video_id ORDER BY CASE WHEN key = 'bad' THEN 0 ELSE CAST(split_part(key, '-', 1) AS INTEGER) END, seq) AS place FROM k")
def sort_numeric_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by the number that they begin with; those without one count as nought."""
    sec = F.floor("t")
    key = F.when(F.col("label") == 6, "bad").otherwise(F.concat(sec.cast("string"), F.lit("-"), (sec + 1).cast("string"), F.lit("s")))
    k = timeline(spark, sf_dir).select("video_id", "seq", key.alias("key"))
    w = Window.partitionBy("video_id").orderBy(key_start(F.col("key"), True), "seq")
    return k.withColumn("place", big(F.row_number().over(w)))


MOST_ENTRIES = 20


def _strided(order: str, n: str) -> str:
    """Of ``n`` rows numbered from nought: every (n / MOST_ENTRIES)th, the first and the last."""
    return f"{n} <= {MOST_ENTRIES} OR {order} % greatest(1, {n} // {MOST_ENTRIES}) = 0 OR {order} = {n} - 1"


@query("smp_stride_keepends", f"WITH {TL_SQL}, r AS (SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n FROM tl) SELECT video_id, seq FROM r WHERE {_strided('i', 'n')}")
def smp_stride_keepends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of an item at an even stride, its first and last among them."""
    return _sampled(timeline(spark, sf_dir))


def _sampled(entries: DataFrame) -> DataFrame:
    r = entries.select("video_id", "seq", (F.row_number().over(Window.partitionBy("video_id").orderBy("t", "seq")) - 1).alias("i"), F.count("*").over(Window.partitionBy("video_id")).alias("n"))
    return r.where(_strided("i", "n").replace("//", "div")).select("video_id", "seq")


@query("tl_compress", f"WITH {TL_SQL}, a AS (SELECT *, count(*) OVER (PARTITION BY video_id) AS whole FROM tl), k AS (SELECT * FROM a WHERE whole <= {MOST_ENTRIES} OR label <> 6), r AS (SELECT video_id, seq, row_number() OVER (PARTITION BY video_id ORDER BY t, seq) - 1 AS i, count(*) OVER (PARTITION BY video_id) AS n FROM k) SELECT video_id, seq FROM r WHERE {_strided('i', 'n')}")
def tl_compress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long timeline loses what is unknown, and then all but a stride of the rest."""
    a = timeline(spark, sf_dir).withColumn("whole", F.count("*").over(Window.partitionBy("video_id")))
    return _sampled(a.where(f"whole <= {MOST_ENTRIES} or label <> 6"))


@query("pick_prefer_success", f"WITH {TL_SQL} SELECT video_id, sec, seq, success FROM (SELECT video_id, CAST(floor(t) AS BIGINT) AS sec, seq, conf > 0.3 AS success, row_number() OVER (PARTITION BY video_id, floor(t) ORDER BY conf > 0.3 DESC, seq) AS r FROM tl) WHERE r = 1")
def pick_prefer_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the results of a second the first that succeeded; the first of all if none did."""
    best = F.min(F.struct((F.col("conf") <= 0.3).alias("failed"), "seq")).alias("x")
    return timeline(spark, sf_dir).groupBy("video_id", F.floor("t").cast("long").alias("sec")).agg(best).select("video_id", "sec", "x.seq", (~F.col("x.failed")).alias("success"))


def _top3_sql(kind: str) -> str:
    return f"(SELECT video_id, array_to_string(list(CAST(label AS VARCHAR) ORDER BY r), ',') AS top FROM (SELECT video_id, label, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, f) AS r FROM (SELECT video_id, label, count(*) AS n, min(t) AS f FROM tl WHERE entry_type = '{kind}' GROUP BY video_id, label)) WHERE r <= 3 GROUP BY video_id)"


@query("agg_human_insights", f"""WITH {TL_SQL}, s AS (SELECT video_id, floor(t) AS sec, count(*) FILTER (entry_type = 'object') AS faces, count(*) FILTER (entry_type = 'gesture') AS gestures FROM tl GROUP BY ALL), a AS (SELECT video_id, count(*) FILTER (faces > 0) / {DURATION}.0 AS presence, sum(faces) / {DURATION}.0 AS mean_faces, CAST(sum(gestures) AS BIGINT) AS gestures, count(*) FILTER (faces > 0 AND gestures > 0) / {DURATION}.0 AS engaged FROM s GROUP BY video_id),
v AS (SELECT video_id, count(DISTINCT label) AS variety FROM tl WHERE entry_type = 'emotion' GROUP BY video_id)
SELECT a.video_id, CAST(presence AS DECIMAL(18,6)) AS human_presence, CAST(mean_faces AS DECIMAL(18,6)) AS mean_faces, gestures, CAST(engaged AS DECIMAL(18,6)) AS engagement_rate, coalesce(variety, 0) AS expression_variety, e.top AS top_expressions, g.top AS top_gestures FROM a LEFT JOIN v USING (video_id) LEFT JOIN {_top3_sql('emotion')} e USING (video_id) LEFT JOIN {_top3_sql('gesture')} g USING (video_id)""")
def agg_human_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces and gestures over an item's seconds, and its three most frequent expressions and gestures (first met first)."""
    tl = timeline(spark, sf_dir)
    is_ = lambda k: F.count_if(F.col("entry_type") == k)
    s = tl.groupBy("video_id", F.floor("t").alias("sec")).agg(is_("object").alias("faces"), is_("gesture").alias("gestures"))
    per = lambda c: dec(c / float(DURATION))
    a = s.groupBy("video_id").agg(per(F.count_if(F.col("faces") > 0)).alias("human_presence"), per(F.sum("faces")).alias("mean_faces"), F.sum("gestures").alias("gestures"), per(F.count_if((F.col("faces") > 0) & (F.col("gestures") > 0))).alias("engagement_rate"))
    c = tl.where("entry_type in ('emotion', 'gesture')").groupBy("video_id", "entry_type", "label").agg(F.struct((-F.count("*")).alias("n"), F.min("t").alias("f"), F.col("label")).alias("x"))
    lists = lambda k: F.array_sort(F.collect_list(F.when(F.col("entry_type") == k, F.col("x"))))
    top = lambda k: F.when(F.size(lists(k)) > 0, F.array_join(F.transform(F.slice(lists(k), 1, 3), lambda x: x["label"].cast("string")), ","))
    t = c.groupBy("video_id").agg(F.count_if(F.col("entry_type") == "emotion").alias("expression_variety"), top("emotion").alias("top_expressions"), top("gesture").alias("top_gestures"))
    return a.join(t, "video_id", "left").na.fill(0, ["expression_variety"])


# --- validation and comparison ------------------------------------------------------------------------------------

#: The key that the document of each kind must have.
EXPECTED_KEYS = {"click": "k", "view": "k", "purchase": "amount", "error": "k", "signup": "k"}


@query("val_output", "SELECT event_id, CASE WHEN NOT list_contains(json_keys(props), key) THEN event_type || ' result misses required key ' || key END AS violation FROM (SELECT *, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXPECTED_KEYS.items()) + " END AS key FROM events)")
def val_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.element_at(F.create_map(*[F.lit(x) for kv in EXPECTED_KEYS.items() for x in kv]), F.col("event_type"))
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "props", key.alias("key"))
    return e.select("event_id", F.when(~F.array_contains(F.json_object_keys("props"), F.col("key")), F.concat("event_type", F.lit(" result misses required key "), "key")).alias("violation"))


_BLOCK_COLUMNS = [f"density{b}" for b in BLOCKS]
#: The block that the checked document of an item lacks, by its id; and the one that is empty in it.
_LACKS = " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(_BLOCK_COLUMNS))


def _check(missing: str, empty: str, size: str) -> list[tuple[str, str]]:
    return [(f"{missing} IS NOT NULL", "missing_block"), (f"{missing} IS NULL AND {empty}", "empty_block"), (f"{missing} IS NULL AND {size} < 500", "too_short")]


@query("val_sixblock", f"WITH r AS ({blocks_sql(DENSITY_SQL, 'rp', 'density', DENSITY)}), d AS (SELECT *, CASE video_id % 20 {_LACKS} END AS lacks, {' + '.join(f'length({c})' for c in _BLOCK_COLUMNS)} AS size FROM r) SELECT video_id, lacks AS missing, {named_sql(*_check('lacks', 'video_id % 20 = 7', 'size'))} AS errors, lacks IS NULL AND video_id % 20 <> 7 AND size >= 500 AS valid FROM d")
def val_sixblock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of six blocks: all there, none empty, 500 characters at least. Of twenty items one lacks each block, one has an empty one."""
    r = QUERIES["rpt_density"](spark, sf_dir)
    lacks = F.expr(f"CASE video_id % 20 {_LACKS} END")
    present = [F.when(lacks.eqNullSafe(F.lit(c)), None).when((F.col("video_id") % 20 == 7) & F.lit(c == _BLOCK_COLUMNS[0]), "{}").otherwise(F.col(c)) for c in _BLOCK_COLUMNS]
    d = r.select("video_id", *[x.alias(c) for x, c in zip(present, _BLOCK_COLUMNS, strict=True)])
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in _BLOCK_COLUMNS]))
    empty = sum((F.coalesce((F.col(c) == "{}").cast("int"), F.lit(0)) for c in _BLOCK_COLUMNS), F.lit(0)) > 0
    size = sum((F.char_length(F.col(c)) for c in _BLOCK_COLUMNS), F.lit(0))
    ok = F.size(missing) == 0
    errors = named((~ok, "missing_block"), (ok & empty, "empty_block"), (ok & (size < 500), "too_short"))
    return d.select("video_id", F.get(missing, F.lit(0)).alias("missing"), errors.alias("errors"), (ok & ~empty & (size >= 500)).alias("valid"))


def text_blocks(text: Column) -> Column:
    """``array<struct<block, content>>``: a text's lines from each line that is a block's name (a colon may follow) to the next."""
    header = "|".join(BLOCKS)
    lines = F.split(F.trim(text), "\n", -1)
    starts = F.filter(F.transform(lines, lambda line, i: F.when(F.regexp_replace(F.trim(line), ":+$", "").rlike(f"^(?:{header})$"), i)), lambda i: i.isNotNull())
    return F.transform(
        starts, lambda s, k: F.struct(
            F.regexp_replace(F.trim(F.get(lines, s)), ":+$", "").alias("block"),
            F.trim(F.array_join(F.slice(lines, s + 2, F.coalesce(F.get(starts, k + 1), F.size(lines)) - s - 1), "\n")).alias("content"),
        )
    )


_RESPONSE_SQL = "SELECT conv_id, string_agg(CASE WHEN turn < 6 THEN (['" + "', '".join(BLOCKS) + "'])[turn + 1] || CASE WHEN turn % 2 = 0 THEN ':' ELSE '' END || chr(10) ELSE '' END || replace(coalesce(text, ''), chr(10), ' '), chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id"


@query("val_text_blocks", f"""WITH r AS ({_RESPONSE_SQL}), l AS (SELECT conv_id, unnest(string_split(trim(t), chr(10))) AS line, generate_subscripts(string_split(trim(t), chr(10)), 1) AS i FROM r), h AS (SELECT *, CASE WHEN regexp_full_match(trim(line), '(?:{'|'.join(BLOCKS)}):*') THEN regexp_replace(trim(line), ':+$', '') END AS b FROM l),
g AS (SELECT *, count(b) OVER (PARTITION BY conv_id ORDER BY i) AS g FROM h), k AS (SELECT conv_id, g, any_value(b) AS b, length(trim(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (b IS NULL), ''))) AS n FROM g WHERE g > 0 GROUP BY ALL) SELECT conv_id, array_to_string(list(b ORDER BY g), ',') AS blocks, CAST(sum(n) AS BIGINT) AS content_chars, count(DISTINCT b) = {len(BLOCKS)} AS complete FROM k GROUP BY conv_id""")
def val_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks found in texts whose first turns each follow a block's name."""
    head = F.when(F.col("turn") < 6, F.concat(F.get(F.array(*map(F.lit, BLOCKS)), F.col("turn").cast("int")), F.when(F.col("turn") % 2 == 0, ":").otherwise(""), F.lit("\n"))).otherwise("")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(head, F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))).alias("x"))
    r = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "x"))).alias("xs")).select("conv_id", F.array_join(F.transform("xs", lambda v: v["x"]), "\n").alias("t"))
    b = r.select("conv_id", text_blocks(F.col("t")).alias("b")).where(F.size("b") > 0)
    chars = F.aggregate("b", F.lit(0), lambda s, x: s + F.char_length(x["content"]))
    return b.select("conv_id", F.array_join(F.transform("b", lambda x: x["block"]), ",").alias("blocks"), big(chars).alias("content_chars"), (F.size(F.array_distinct(F.transform("b", lambda x: x["block"]))) == len(BLOCKS)).alias("complete"))


def key_paths(document: str) -> str:
    """SQL for the paths of a JSON object's keys, two levels of objects; of a list of objects the first is looked into."""
    top = f"coalesce(json_object_keys({document}), cast(array() as array<string>))"
    return f"flatten(transform({top}, k -> concat(array(k), coalesce(transform(json_object_keys(get_json_object({document}, concat('$.', k))), x -> concat(k, '.', x)), transform(json_object_keys(get_json_object({document}, concat('$.', k, '[0]'))), x -> concat(k, '[0].', x)), cast(array() as array<string>)))))"


_LEFT_SQL = "'{\"k\":1,\"meta\":{\"x\":1,\"y\":2},\"rows\":[{\"a\":1},{\"b\":2}]}'"
_RIGHT = ['{"k":2,"meta":{"x":3},"rows":[{"a":1,"c":2}]}', '{"meta":{"x":1,"y":2},"extra":true,"rows":[]}', '{"k":1,"meta":5,"rows":[{"a":1}]}']
_PATHS_SQL = "flatten(list_transform(json_keys({0}), lambda k: list_concat([k], CASE json_type(json_extract({0}, '$.' || k)) WHEN 'OBJECT' THEN list_transform(json_keys(json_extract({0}, '$.' || k)), lambda x: k || '.' || x) WHEN 'ARRAY' THEN coalesce(list_transform(json_keys(json_extract({0}, '$.' || k || '[0]')), lambda x: k || '[0].' || x), []) ELSE [] END)))"


@query("cmp_structure", "WITH d AS (SELECT event_id, " + _LEFT_SQL + "::JSON AS a, (['" + "', '".join(_RIGHT) + "'])[event_id % 3 + 1]::JSON AS b FROM events), p AS (SELECT event_id, " + _PATHS_SQL.format("a") + " AS pa, " + _PATHS_SQL.format("b") + " AS pb FROM d) SELECT event_id, array_to_string(list_sort(list_filter(pa, lambda x: NOT list_contains(pb, x))), ',') AS left_only, array_to_string(list_sort(list_filter(pb, lambda x: NOT list_contains(pa, x))), ',') AS right_only, CAST(len(list_intersect(pa, pb)) AS INTEGER) AS common FROM p")
def cmp_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key paths that only one of two documents has, and how many both have."""
    right = F.element_at(F.array(*map(F.lit, _RIGHT)), (F.col("event_id") % 3 + 1).cast("int"))
    d = table(spark, sf_dir, "events").select("event_id", F.lit(_LEFT_SQL[1:-1]).alias("a"), right.alias("b"))
    p = d.select("event_id", F.expr(key_paths("a")).alias("pa"), F.expr(key_paths("b")).alias("pb"))
    only = lambda x, y: F.array_join(F.array_sort(F.array_except(x, y)), ",")
    return p.select("event_id", only("pa", "pb").alias("left_only"), only("pb", "pa").alias("right_only"), F.size(F.array_intersect("pa", "pb")).alias("common"))


#: Functions that a runner is expected to handle.
EXPECTED_FUNCTIONS = ["click", "view", "purchase", "signup", "scroll"]


@query("cmp_registry", "WITH a AS (SELECT DISTINCT event_type AS f FROM events), b AS (SELECT unnest(['" + "', '".join(EXPECTED_FUNCTIONS) + "']) AS f) SELECT coalesce(a.f, b.f) AS function, CASE WHEN b.f IS NULL THEN 'new' WHEN a.f IS NULL THEN 'removed' ELSE 'handled' END AS status FROM a FULL JOIN b ON a.f = b.f")
def cmp_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered functions that nobody expects, expected ones that are not registered, and the rest."""
    a = table(spark, sf_dir, "events").select(F.col("event_type").alias("function")).distinct().withColumn("a", F.lit(True))
    b = spark.range(1).select(F.explode(F.array(*map(F.lit, EXPECTED_FUNCTIONS))).alias("function")).withColumn("b", F.lit(True))
    return a.join(b, "function", "full").select("function", F.when(F.col("b").isNull(), "new").when(F.col("a").isNull(), "removed").otherwise("handled").alias("status"))


# --- run reports --------------------------------------------------------------------------------------------------


@query("rpt_run", "SELECT l_orderkey AS video_id, count(*) FILTER (l_returnflag <> 'R') AS prompts_successful, count(*) AS prompts_total, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_tax AS DECIMAL(18,4)) ELSE 0 END) AS DECIMAL(18,4)) AS total_cost, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS total_tokens, CAST(to_json(list({'step': l_linenumber, 'success': l_returnflag <> 'R'} ORDER BY l_linenumber, l_returnflag <> 'R')) AS VARCHAR) AS prompt_details FROM lineitem GROUP BY l_orderkey")
def rpt_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run came to: results, costs and tokens of those that succeeded, and each one's success."""
    ok = F.col("l_returnflag") != "R"
    details = F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("step"), ok.alias("success"))))
    x = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("video_id")).agg(F.count_if(ok).alias("prompts_successful"), F.count("*").alias("prompts_total"), F.sum(F.when(ok, F.col("l_tax").cast("decimal(18,4)")).otherwise(F.lit(0).cast("decimal(18,4)"))).cast("decimal(18,4)").alias("total_cost"), big(F.sum(F.when(ok, F.col("l_quantity")).otherwise(0))).alias("total_tokens"), details.alias("d"))
    return x.select("video_id", "prompts_successful", "prompts_total", "total_cost", "total_tokens", F.to_json("d").alias("prompt_details"))


@query("agg_memory_guard", "SELECT p_partkey AS process_id, CAST(p_retailprice AS DECIMAL(18,2)) AS rss, p_retailprice > 1400 OR p_size > 45 AS over, CASE WHEN p_retailprice > 1400 THEN 'process' WHEN p_size > 45 THEN 'system' ELSE 'none' END AS reason FROM part")
def agg_memory_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of a process over its own threshold, or over the system's."""
    own, system = F.col("p_retailprice") > 1400, F.col("p_size") > 45
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("process_id"), dec("p_retailprice", 2).alias("rss"), (own | system).alias("over"), F.when(own, "process").when(system, "system").otherwise("none").alias("reason"))


_CONTEXT_SQL = f"WITH {TL_SQL}, s AS (SELECT video_id, CAST(floor(t) AS INTEGER) AS sec, list_sort(list(DISTINCT entry_type)) AS kinds, count(*) AS n FROM tl GROUP BY ALL)"


@query("rpt_context", f"{_CONTEXT_SQL} SELECT video_id, CAST(to_json({{'duration': {DURATION}, 'entries': CAST(sum(n) AS BIGINT), 'seconds': list({{'sec': sec, 'kinds': kinds, 'n': n}} ORDER BY sec)}}) AS VARCHAR) AS context FROM s GROUP BY video_id")
def rpt_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an analysis is given of an item: its length, entries, and the kinds of every second that has any."""
    s = timeline(spark, sf_dir).groupBy("video_id", F.floor("t").cast("int").alias("sec")).agg(F.array_sort(F.collect_set("entry_type")).alias("kinds"), F.count("*").alias("n"))
    x = s.groupBy("video_id").agg(F.sum("n").alias("entries"), F.array_sort(F.collect_list(F.struct("sec", "kinds", "n"))).alias("seconds"))
    return x.select("video_id", F.to_json(F.struct(F.lit(DURATION).alias("duration"), "entries", "seconds")).alias("context"))


@query("txt_engagement_fallback", "SELECT o_orderkey AS video_id, CASE WHEN v = 0 THEN alt ELSE v END AS views, CAST(CASE WHEN CASE WHEN v = 0 THEN alt ELSE v END > 0 THEN likes * 100.0 / CASE WHEN v = 0 THEN alt ELSE v END ELSE 0 END AS DECIMAL(18,4)) AS like_rate FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 100 END AS v, o_orderkey % 50 AS alt, o_custkey % 10 AS likes FROM orders)")
def txt_engagement_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter that is nought gives way to its alternate field."""
    views = F.coalesce(F.nullif(F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_orderkey") % 100), F.lit(0)), F.col("o_orderkey") % 50)
    x = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("video_id"), views.alias("views"), (F.col("o_custkey") % 10).alias("likes"))
    return x.select("video_id", "views", dec(F.coalesce(F.try_divide(F.col("likes") * 100.0, "views"), F.lit(0.0)), 4).alias("like_rate"))

