"""Text queries over captions (documents) and speech (conversations)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomark.functions import text as tx
from chronomark.functions.stats import safe_div
from chronomark.operators.timeline import top_k
from chronomark.plans._base import big, dec, query
from chronomark.sources.testdata import table


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def said(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def _any_sql(column: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{p.replace(chr(39), chr(39) * 2)}')" for p in phrases) + ")"


def _count_sql(column: str, terms: list[str]) -> str:
    pattern = "\\b(?:" + "|".join(sorted(terms, key=len, reverse=True)).replace("'", "''") + ")\\b"
    return f"len(regexp_extract_all(lower({column}), '{pattern}'))"


_WORDS = "len(regexp_extract_all(coalesce(text, ''), '[^ \\n\\t\\r]+'))"


@query("txt_words", f"SELECT doc_id, {_WORDS} AS words FROM documents")
def txt_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", big(F.size(tx.words(F.col("text")))).alias("words"))


@query("txt_mentions", "SELECT doc_id, len(m) AS n, array_to_string(m[1:3], ' ') AS first_three FROM (SELECT doc_id, regexp_extract_all(text, '@[a-z0-9]+') AS m FROM documents)")
def txt_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.regexp_extract_all("text", F.lit("@[a-z0-9]+"), F.lit(0))
    return docs(spark, sf_dir).select("doc_id", m.alias("m")).select("doc_id", big(F.size("m")).alias("n"), F.array_join(F.slice("m", 1, 3), " ").alias("first_three"))


@query("txt_links", "SELECT page_id, regexp_matches(html, 'https?://[^ ]+') AS has_link FROM pages")
def txt_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.col("html").rlike("https?://[^ ]+").alias("has_link"))


@query("txt_emoji_runs", "SELECT doc_id, len(regexp_extract_all(text, '[\\x{1F600}-\\x{1F64F}\\x{1F300}-\\x{1F5FF}\\x{1F680}-\\x{1F6FF}\\x{2702}-\\x{27B0}]+')) AS runs FROM documents")
def txt_emoji_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", big(tx.emoji_runs(F.col("text"))).alias("runs"))


@query("txt_hook_flag", f"SELECT conv_id, turn, CAST({_any_sql('text', tx.HOOKS)} AS INTEGER) AS hook FROM conversations")
def txt_hook_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return said(spark, sf_dir).select("conv_id", "turn", tx.flag(tx.has_any(F.col("text"), tx.HOOKS)).alias("hook"))


@query("txt_cta_flags", "SELECT *, CAST(cta_follow + cta_like + cta_comment + cta_share + cta_urgency > 0 AS INTEGER) AS has_cta FROM (SELECT conv_id, turn, " + ", ".join(f"CAST({_any_sql('text', p)} AS INTEGER) AS cta_{k}" for k, p in tx.CTA.items()) + " FROM conversations)")
def txt_cta_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = said(spark, sf_dir).select("conv_id", "turn", *[tx.flag(tx.has_any(F.col("text"), p)).alias(f"cta_{k}") for k, p in tx.CTA.items()])
    return flags.withColumn("has_cta", F.greatest(*[f"cta_{k}" for k in tx.CTA]))


@query("txt_question", "SELECT conv_id, turn, contains(text, '?') AS question, contains(text, '!') AS exclaims FROM conversations")
def txt_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    return said(spark, sf_dir).select("conv_id", "turn", F.contains("text", F.lit("?")).alias("question"), F.contains("text", F.lit("!")).alias("exclaims"))


@query("txt_cta_keywords", "WITH k AS (SELECT unnest(['" + "', '".join(tx.CTA_KEYWORDS) + "']) AS keyword) SELECT conv_id, turn, keyword, lower(left(text, 100)) AS context FROM conversations CROSS JOIN k WHERE contains(lower(text), keyword)")
def txt_cta_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword by entry: the keywords are a literal array of the row, so nothing is joined."""
    low = F.lower("text")
    hits = F.filter(F.array(*map(F.lit, tx.CTA_KEYWORDS)), lambda k: F.contains(low, k))
    return said(spark, sf_dir).select("conv_id", "turn", F.explode(hits).alias("keyword"), F.lower(F.left("text", F.lit(100))).alias("context"))


@query("txt_cta_first_kw", "WITH k AS (SELECT unnest(['" + "', '".join(tx.CTA_KEYWORDS) + f"']) AS keyword, unnest(range({len(tx.CTA_KEYWORDS)})) AS i) SELECT conv_id, turn, arg_min(keyword, i) AS keyword FROM conversations CROSS JOIN k WHERE contains(lower(text), keyword) GROUP BY conv_id, turn")
def txt_cta_first_kw(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.lower("text")
    first = F.get(F.filter(F.array(*map(F.lit, tx.CTA_KEYWORDS)), lambda k: F.contains(low, k)), 0)
    return said(spark, sf_dir).select("conv_id", "turn", first.alias("keyword")).where("keyword is not null")


@query("txt_filler", f"SELECT conv_id, turn, {_count_sql('text', tx.FILLERS)} AS fillers, CAST(coalesce({_count_sql('text', tx.FILLERS)} / nullif({_WORDS}, 0), 0) AS DECIMAL(18,6)) AS ratio FROM conversations")
def txt_filler(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = tx.whole_words(F.col("text"), tx.FILLERS)
    return said(spark, sf_dir).select("conv_id", "turn", big(n).alias("fillers"), dec(safe_div(n, F.size(tx.words(F.col("text"))))).alias("ratio"))


@query("txt_direct_address", f"SELECT conv_id, turn, {_count_sql('text', tx.DIRECT)} AS direct, {_count_sql('text', tx.INCLUSIVE)} AS inclusive FROM conversations")
def txt_direct_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return said(spark, sf_dir).select("conv_id", "turn", big(tx.whole_words(F.col("text"), tx.DIRECT)).alias("direct"), big(tx.whole_words(F.col("text"), tx.INCLUSIVE)).alias("inclusive"))


@query("txt_questions_spoken", "SELECT conv_id, turn, len(regexp_extract_all(lower(text), '\\?|[.!][ \\n]*(?:did|what|why|how|when|where|who|which)')) AS questions FROM conversations")
def txt_questions_spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return said(spark, sf_dir).select("conv_id", "turn", big(F.regexp_count(F.lower("text"), F.lit(r"\?|[.!][ \n]*(?:did|what|why|how|when|where|who|which)"))).alias("questions"))


@query("txt_truncate", "SELECT doc_id, CASE WHEN length(text) > 50 THEN left(text, 50) || '...' ELSE text END AS short FROM documents")
def txt_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", tx.truncated(F.col("text"), 50).alias("short"))


@query("txt_emotion_kw", "SELECT conv_id, turn, CASE " + " ".join(f"WHEN {_any_sql('text', p)} THEN '{k}'" for k, p in tx.EMOTION_WORDS.items()) + " ELSE 'neutral' END AS emotion FROM conversations")
def txt_emotion_kw(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for k, p in tx.EMOTION_WORDS.items():
        out = F.when(tx.has_any(F.col("text"), p), k) if out is None else out.when(tx.has_any(F.col("text"), p), k)
    return said(spark, sf_dir).select("conv_id", "turn", out.otherwise("neutral").alias("emotion"))


_NGRAM_SQL = """WITH w AS (SELECT conv_id, turn, regexp_extract_all(lower(coalesce(text, '')), '[^ \\n\\t\\r]+') AS w FROM conversations),
g AS (SELECT conv_id, unnest(list_concat(
  CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 1], ' ')) ELSE [] END,
  CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) ELSE [] END)) AS phrase FROM w),
c AS (SELECT conv_id, phrase, count(*) AS n FROM g WHERE NOT regexp_matches(phrase, 'the|and|for') AND NOT (len(string_split(phrase, ' ')) = 2 AND regexp_matches(phrase, 'you|this')) GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, phrase) AS rank FROM c WHERE n >= 2) WHERE rank <= 5"""


@query("agg_ngram_repeat", _NGRAM_SQL)
def agg_ngram_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated phrases of two and three words, the five most frequent of a conversation."""
    w = said(spark, sf_dir).select("conv_id", tx.words(F.lower("text")).alias("w")).where(F.size("w") >= 3)
    pairs = F.slice(tx.ngrams(F.col("w"), 2), F.lit(1), F.size("w") - 2)
    g = w.select("conv_id", F.explode(F.concat(pairs, tx.ngrams(F.col("w"), 3))).alias("phrase"))
    kept = g.where(~F.col("phrase").rlike("the|and|for") & ~((F.size(F.split("phrase", " ")) == 2) & F.col("phrase").rlike("you|this")))
    counts = kept.groupBy("conv_id", "phrase").agg(F.count("*").alias("n")).where("n >= 2")
    return top_k(counts, 5, [F.desc("n"), "phrase"], ["conv_id"])


@query("txt_window_format", "SELECT l_orderkey, l_linenumber, CAST(l_linenumber * 5 AS VARCHAR) || '-' || CAST(l_linenumber * 5 + 5 AS VARCHAR) || 's' AS win FROM lineitem")
def txt_window_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber") * 5
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(n.cast("string"), F.lit("-"), (n + 5).cast("string"), F.lit("s")).alias("win"))


@query("txt_readability", f"""SELECT doc_id, CAST(least(greatest(100 - 10 * (length(replace(replace(text, ' ', ''), chr(10), '')) / {_WORDS}) - 2 * ({_WORDS} / greatest(len(regexp_extract_all(text, '[.!?]+')), 1)), 0), 100) AS DECIMAL(18,4)) AS readability FROM documents WHERE {_WORDS} > 0""")
def txt_readability(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size(tx.words(F.col("text")))
    letters = F.char_length(F.replace(F.replace("text", F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")))
    score = 100 - 10 * (letters / n) - 2 * (n / F.greatest(F.regexp_count("text", F.lit("[.!?]+")), F.lit(1)))
    return docs(spark, sf_dir).where(n > 0).select("doc_id", dec(F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0)), 4).alias("readability"))
