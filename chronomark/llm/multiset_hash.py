"""Operator 4, document fingerprints: a homomorphic multiset hash of paragraphs, in DataFrame functions only.

Every paragraph (line) is hashed to a wide vector and a document is the sum of its paragraphs' vectors modulo powers of
two, so the order of paragraphs does not matter, and paragraphs can be added to or taken from a fingerprint without
the text. The vector has two parts. Four lanes of 32 bits hold the hash of the whole paragraph: equal sums mean equal
multisets. The rest holds, for every clause of the paragraph (a run without punctuation), a vector of 128 signs: how
far two such sums are apart, against their own lengths, estimates how much the texts share.

128 sign lanes are packed as 64 longs of two lanes of 32 bits. A text has fewer than 2^31 characters, so it has fewer
clauses than a lane can count and no lane runs into the next. Clauses are added up 127 at a time in lanes of eight bits,
which are then widened; a document is one row's expression, so nothing is exploded, grouped or joined for it.

The next document needs no global order in one task: quantiles of doc_id (at most ``MAX_BUCKETS``, a bounded array) and,
beyond these, equal parts of the range between two of them cut the ids into buckets of about ``BUCKET_DOCS`` documents; texts
are shuffled once, by bucket; the first row of every bucket is also dealt to the bucket before it, where it is the next
of the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.llm._common import table

BUCKET_DOCS = 1_024
MAX_BUCKETS = 1 << 13
SEEDS = (0, 1)
#: So many buckets (24 bytes each) are sent to all executors; more are joined.
BROADCAST_BUCKETS = 1 << 20
#: Clauses that are added up in lanes of eight bits.
CHUNK = 127
_BYTES = 0x0101010101010101
_PAIR = 0x000000FF000000FF
_LOW = 0xFFFFFFFF
#: What ends a clause: everything that is no letter, digit, mark, space or apostrophe.
CLAUSE = r"[^\p{L}\p{N}\p{M} ']+"
STRONG, SIGNS = 4, 32 * len(SEEDS)
LANES = STRONG + 1 + SIGNS


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda p: F.trim(p) != "")


def clauses(text: Column) -> Column:
    """Line ends end clauses too, so the clauses of a text are those of its paragraphs."""
    return F.filter(F.transform(F.split(text, CLAUSE, -1), lambda c: F.lower(F.trim(c))), lambda c: c != "")


def _shift(x: Column, by: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, by)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _numbers(values) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _strong(paras: Column, lane: int) -> Column:
    """Lane ``lane`` (0 to 3): the sum of 32 bits of every paragraph's hash, modulo 2^32."""
    h = lambda p: F.xxhash64(F.lit(lane // 2), p)
    bits = (lambda p: h(p).bitwiseAND(F.lit(_LOW))) if lane % 2 == 0 else (lambda p: F.shiftrightunsigned(h(p), 32))
    return F.aggregate(paras, F.lit(0).cast("long"), lambda s, p: (s + bits(p)).bitwiseAND(F.lit(_LOW)))


def _signs(found: Column, seed: int) -> Column:
    """32 longs: lane pairs that count how many clauses have a bit set, for the 64 bits of a hash."""
    shifts = F.array(*[F.lit(j) for j in range(8)])
    h = F.transform(found, lambda c: F.xxhash64(F.lit(f"c{seed}"), c))

    def added(chunk: Column) -> Column:
        return F.aggregate(chunk, _numbers([0] * 8), lambda acc, x: F.zip_with(acc, shifts, lambda a, j: a + _shift(x, j).bitwiseAND(F.lit(_BYTES))))

    def widened(eight: Column) -> Column:
        return F.flatten(F.transform(eight, lambda v: F.array(*[F.shiftrightunsigned(v, 8 * k).bitwiseAND(F.lit(_PAIR)) for k in range(4)])))

    def summed(all_: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(CHUNK))
        return F.aggregate(starts, _numbers([0] * 32), lambda acc, at: F.zip_with(acc, widened(added(F.slice(all_, at, F.lit(CHUNK)))), lambda a, b: a + b))

    return _bound(h, summed)


def lanes(text: Column) -> Column:
    """``array<long>`` of a text: four strong lanes, the number of clauses, the sign lanes. Null and empty: zeros."""
    whole = F.coalesce(text, F.lit(""))
    strong = _bound(paragraphs(whole), lambda p: F.array(*[_strong(p, i) for i in range(STRONG)]))
    signs = _bound(clauses(whole), lambda c: F.concat(F.array(F.size(c).cast("long")), *[_signs(c, s) for s in SEEDS]))
    return F.concat(strong, signs)


def vectors(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``texts`` → the key and ``lanes array<long>`` of every row."""
    return texts.select(*key, lanes(F.col(text)).alias("lanes"))


def add(a: Column, b: Column, sign: int = 1) -> Column:
    """The lanes of two multisets together, or of ``a`` without ``b``."""
    return F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"] + F.lit(sign) * x["b"])


def fingerprint(of: Column) -> Column:
    """Lanes as hexadecimal text: equal for equal multisets of paragraphs."""
    return F.concat_ws("", F.transform(of, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))))


def lanes_of(fp: Column) -> Column:
    """The lanes back from a fingerprint."""
    return F.array(*[F.conv(F.substring(fp, 16 * i + 1, 16), 16, 10).cast("long") for i in range(LANES)])


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: 1 - |va - vb|^2 / (|va|^2 + |vb|^2) over the sign lanes of two lane arrays; two empty texts: 1."""
    na, nb = F.element_at(a, STRONG + 1), F.element_at(b, STRONG + 1)
    low, high = (lambda x: x.bitwiseAND(F.lit(_LOW))), (lambda x: F.shiftrightunsigned(x, 32))
    sign = lambda count, n: (count * F.lit(2) - n).cast("double")  # noqa: E731  ones less zeros
    square = lambda x: x * x
    signs = lambda x: F.slice(x, STRONG + 2, SIGNS)

    def total(of) -> Column:
        return F.aggregate(F.zip_with(signs(a), signs(b), lambda x, y: of(low(x), low(y)) + of(high(x), high(y))), F.lit(0.0), lambda s, x: s + x)

    apart = total(lambda x, y: square(sign(x, na) - sign(y, nb)))
    whole = total(lambda x, y: square(sign(x, na)) + square(sign(y, nb)))
    share = F.when(whole == 0, F.when(na == nb, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0) - apart / whole)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))


def with_next(docs: DataFrame, bucket_docs: int = BUCKET_DOCS, max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """``b, doc_id, text, next_text``: every row with the text of the row after it in descending doc_id.

    The row after the last is the first; a single row is its own next. Null ids come last; rows of one id follow each
    other in the order of their texts. Null text is the empty text.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    count = rows.count()
    n = max(1, min(max_buckets, -(-count // bucket_docs)))
    parts = max(1, -(-count // (bucket_docs * n)))  # of the range between two quantiles
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).head()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))  # max_buckets numbers at most
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    numbers = lambda v: F.split(F.lit(",".join(map(str, v))), ",").cast("array<long>")
    padded = numbers(cuts + [(1 << 63) - 1] * (2 * (steps or [1])[0] - len(cuts)))
    bisect = lambda lo, s: F.when(F.get(padded, lo + s - 1) <= F.col("doc_id"), lo + s).otherwise(lo)
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), bisect) if steps else F.lit(0)
    placed = rows.withColumn("q", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - below).cast("long"))
    if parts > 1:  # descending, as q is
        lo, hi = F.get(numbers([*cuts, *cuts[-1:]] or [0]), (F.lit(len(cuts)) - F.col("q") - 1).cast("int")), F.get(numbers(cuts or [0]), (F.lit(len(cuts)) - F.col("q")).cast("int"))
        inside = (F.col("q") > 0) & (F.col("q") < len(cuts))
        share = ((hi.cast("double") - F.col("doc_id")) / (hi.cast("double") - lo.cast("double")) * parts).cast("long")
        placed = placed.withColumn("b", F.col("q") * parts + F.when(inside, F.greatest(F.lit(0), F.least(F.lit(parts - 1), share))).otherwise(F.lit(0)))
    else:
        placed = placed.withColumn("b", F.col("q"))
    heads = placed.groupBy("q", "b").agg(F.max("doc_id").alias("head"))  # a row a bucket
    lasts = heads.groupBy("q").agg(F.max("b").alias("last"))  # a row a quantile, max_buckets + 1 at most
    every = Window.orderBy("q")
    lasts = lasts.select("q", F.coalesce(F.lag("last").over(every), F.max("last").over(every.rowsBetween(0, Window.unboundedFollowing))).alias("before"))
    heads = heads.join(F.broadcast(lasts), "q").select("b", "head", F.coalesce(F.lag("b").over(Window.partitionBy("q").orderBy("b")), "before").alias("to"))
    heads = heads.withColumnRenamed("b", "hb")  # a row a bucket at most: a known number
    first = placed.join(F.broadcast(heads) if n * parts <= BROADCAST_BUCKETS else heads, (F.col("b") == F.col("hb")) & F.col("doc_id").eqNullSafe(F.col("head")))
    guests = first.groupBy("b", "to", "doc_id").agg(F.min("text").alias("text")).select("doc_id", "text", F.col("to").alias("b"), F.lit(True).alias("guest"))
    both = placed.select("doc_id", "text", "b", F.lit(False).alias("guest")).unionByName(guests)
    w = Window.partitionBy("b").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    return both.select("*", F.lead("text").over(w).alias("next_text")).where("not guest").select("b", "doc_id", "text", "next_text")


def fingerprints_with_edits(docs: DataFrame, bucket_docs: int = BUCKET_DOCS, max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next text's are.

    Defined cases: null text is the empty text (zero lanes); two texts without clauses have likeness 1, one without and one
    with any 0; a null doc_id comes last; rows of one doc_id follow each other by text, equal rows in any order (they are
    alike); a single row is its own next; no rows: no rows. Other columns, whatever their names, are ignored. A very long
    text is one row: its clauses are counted exactly up to the length that a string can have.
    """
    placed = with_next(docs, bucket_docs, max_buckets).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    three = placed.select("doc_id", "n_chars", "text", edited.alias("edited"), "next_text")
    summed = three.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), lanes(F.col("text")).alias("own"), lanes(F.col("edited")).alias("other"), lanes(F.col("next_text")).alias("after"))
    return summed.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("after")).alias("near_next"))


def op4_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and the likeness to these and to the next; cases as in ``fingerprints_with_edits``."""
    return fingerprints_with_edits(table(spark, sf_dir, "documents"))
