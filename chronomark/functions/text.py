"""Text features of captions and transcripts, in regular expressions of the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases and words that decide flags and counts.
HOOKS = ["wait for it", "watch till", "won't believe", "pov:", "story time", "here's how", "the secret"]
CTA = {
    "follow": ["follow me", "follow for", "hit follow"],
    "like": ["drop a like", "hit like", "double tap", "like if"],
    "comment": ["comment below", "let me know", "drop a comment", "tell me"],
    "share": ["share this", "tag someone", "send this to"],
    "urgency": ["limited time", "act now", "last chance", "today only", "ends soon"],
}
CTA_KEYWORDS = ["follow", "like", "subscribe", "comment", "share", "link", "bio", "check out", "click", "tap", "swipe", "buy", "shop", "order"]
FILLERS = ["um", "uh", "like", "you know", "basically", "literally", "actually"]
DIRECT = ["you", "your", "you're", "you'll", "you've"]
INCLUSIVE = ["we", "us", "our", "let's"]
EMOTION_WORDS = {"positive": ["amazing", "love", "great", "awesome"], "warning": ["warning", "careful", "don't", "avoid"], "urgent": ["urgent", "now", "quick", "fast"]}
#: Code points of emoji, in ranges.
EMOJI = r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}"


def words(text: Column) -> Column:
    """Runs without ASCII white space; of no text none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\n\\t\\r]+"), lambda w: w != "")


def bounded(pattern: str) -> str:
    """The pattern between ASCII word boundaries, whatever the JVM takes for one."""
    return rf"(?<![A-Za-z0-9_])(?:{pattern})(?![A-Za-z0-9_])"


def has_any(text: Column, phrases: list[str]) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(low, F.lit(p))
    return out


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def whole_words(text: Column, terms: list[str]) -> Column:
    """How often any of the words occurs as a whole word."""
    return F.regexp_count(F.lower(text), F.lit(bounded("|".join(sorted(terms, key=len, reverse=True)))))


def emoji_runs(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{EMOJI}]+"))


def mentions(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?U)@\w+"), F.lit(0))


def truncated(text: Column, n: int) -> Column:
    """The first ``n`` characters, with three dots if there are more."""
    return F.when(F.char_length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def ngrams(tokens: Column, n: int) -> Column:
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def script_language(text: Column) -> Column:
    return (
        F.when(text.rlike(r"[一-鿿]"), "zh").when(text.rlike(r"[぀-ヿ]"), "ja").when(text.rlike(r"[가-힯]"), "ko")
        .when(text.rlike(r"[؀-ۿ]"), "ar").when(text.rlike(r"[Ѐ-ӿ]"), "ru").when(F.lower(text).rlike(bounded("el|la|los|las|que|por|con")), "es").otherwise("en")
    )
