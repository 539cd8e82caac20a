"""Operator 1, substring dedup: MinHash banding of paragraphs and of sliding paragraphs, verified and clustered.

Paragraphs are of two kinds. A line of ``LEAST_WORDS`` words or more is one, and so are shorter lines together until they have
that many. A passage that is pasted into another paragraph leaves the two dissimilar, so there are sliding paragraphs as
well: ``LEAST_WORDS`` words from every place where the hash of five words is the least of a run of ``RUN`` places. Every passage
of ``LEAST_WORDS + RUN - 1`` = 50 words has such a place, and its copies have the same one.

Both kinds take the same way. Minima over five-word shingles make band keys: five bands of two for the first kind, which
let a pair of similarity 0.8 through in 99.4 % of cases, one for the second, of which a passage has several. A key that only one document
has is dropped after an aggregation of narrow rows. Paragraphs with equal shingles are one node; nodes that share a key are
compared with the node of most occurrences, those unlike it again with the most frequent of them, and what no links
join after a few rounds in blocks, in memory, exactly (see ``_across``). Pairs are verified by the exact Jaccard similarity
of their shingles; links are clustered by components; in the first document of a component (least doc_id) it stays.

Only repetition across documents counts; a line that one document repeats does not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronomark.llm._common import as_bytes, materialize, partitions_for, shared_path, table
from chronomark.llm.components import connected_components
from chronomark.llm.quality import Model, _mix

LEAST_WORDS = 25
RUN = 26
SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 5, 2
#: Rounds in which the members of a key are compared with one of them.
STAR_ROUNDS = 3
#: Shingles of the two sides of a comparison in memory; keys with more blocks go by their rarest shingles instead.
BLOCK_SHINGLES, STRAY_SHINGLES, MOST_BLOCKS = 400_000, 100_000, 64
SLICE_BYTES = 4_000_000

_U = np.uint64
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_NULL_ID = (1 << 63) - 1
_MOST = ~_U(0)


def multipliers(name: bytes, n: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(name + bytes([i]), 1) | 1 for i in range(n)], dtype=np.uint64)


_MULTIPLIERS = multipliers(b"paragraph", BANDS * ROWS)


def _rehash(shingles: np.ndarray, multiplier: np.uint64) -> np.ndarray:
    values = shingles * multiplier
    values ^= values >> _U(32)
    values *= _U(0x9E3779B97F4A7C15)
    return values


def band_keys(shingles: np.ndarray, start: np.ndarray, stop: np.ndarray, by: np.ndarray) -> np.ndarray:
    """(bands, n) keys of the shingle ranges ``start..stop``, which are in order, not empty and do not overlap."""
    if not len(start):
        return np.zeros((len(by) // ROWS, 0), np.uint64)
    at = np.stack([start, stop], axis=1).reshape(-1)
    keys = []
    for band in range(len(by) // ROWS):
        key = np.full(len(start), band, np.uint64)
        for r in range(ROWS):
            key = _mix(key, np.minimum.reduceat(np.append(_rehash(shingles, by[band * ROWS + r]), _MOST), at)[::2])
        keys.append(key)
    return np.stack(keys)


def contents(shingles: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the shingles of each range, in order."""
    if not len(start):
        return np.zeros(0, np.uint64)
    at = np.stack([start, stop], axis=1).reshape(-1)
    place = np.arange(len(shingles) + 1, dtype=np.uint64) - np.repeat(np.append(_U(0), at.astype(np.uint64)), np.diff(np.concatenate(([0], at, [len(shingles) + 1]))))
    return _mix(np.add.reduceat(_mix(np.append(shingles, _U(0)), place), at)[::2], (stop - start).astype(np.uint64))


class Words:
    """Word hashes of the texts of a slice, with where documents and lines begin. Words: white-space tokens, A-Z lowered, outer ``strip`` off."""

    def __init__(self, texts: list[bytes], strip: bytes = _PUNCTUATION):
        known: dict[bytes, int] = {}
        get, ids, docs, lines = known.setdefault, [], [], []
        for t in texts:
            docs.append(len(ids))
            for line in t.lower().split(b"\n"):
                if words := line.split():
                    lines.append(len(ids))
                    ids.extend([get(w, len(known)) for w in words])
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(w.strip(strip) or w, 5) for w in known], dtype=np.uint64)
        self.hash = hashes[np.array(ids, dtype=np.int64)] if ids else np.zeros(0, np.uint64)
        self.doc = np.array([*docs, len(ids)], dtype=np.int64)
        self.line = np.array([*lines, len(ids)], dtype=np.int64)

    def grams(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words at every position at which that many are left."""
        h = self.hash
        if len(h) < n:
            return np.zeros(0, np.uint64)
        out = h[: len(h) - n + 1]
        for k in range(1, n):
            out = _mix(out, h[k : len(h) - n + 1 + k])
        return out

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last word (exclusive) of every paragraph: long lines, and shorter ones together until they are as long."""
        first, last = [], []
        ends = iter(self.doc[1:].tolist())
        end, at = -1, -1
        for a, b in zip(self.line[:-1].tolist(), self.line[1:].tolist(), strict=True):
            if a >= end:
                while a >= end:
                    end = next(ends)
                at = a
            if b - a >= LEAST_WORDS:
                at = a
            if b - at >= LEAST_WORDS:
                first.append(at)
                last.append(b)
                at = b
        return np.array(first, np.int64), np.array(last, np.int64)

    def sliding(self, five: np.ndarray) -> np.ndarray:
        """First words of the sliding paragraphs."""
        n = len(self.hash)
        runs = n - LEAST_WORDS - RUN + 2
        if runs <= 0:
            return np.zeros(0, np.int64)
        of = np.searchsorted(self.doc, np.arange(n), side="right") - 1
        left = self.doc[1:][of] - np.arange(n)  # words of the document from here on
        whole = left[:runs] >= LEAST_WORDS + RUN - 1
        least = np.where(whole, _sliding(np.minimum, five[: runs + RUN - 1], RUN), _U(0))
        chosen = five[: runs + RUN - 1] == _sliding(np.maximum, np.pad(least, RUN - 1), RUN)
        short = np.flatnonzero((np.diff(self.doc) >= LEAST_WORDS) & (np.diff(self.doc) < LEAST_WORDS + RUN - 1))  # documents without a whole run: their least place
        at = np.flatnonzero(chosen)
        own = [a + int(five[a : b - LEAST_WORDS + 1].argmin()) for a, b in zip(self.doc[:-1][short].tolist(), self.doc[1:][short].tolist(), strict=True)]
        return np.union1d(at, np.array(own, np.int64))

    def units(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(first word, words, hash, keys, keys of each)`` of all paragraphs of both kinds."""
        five = self.grams(SHINGLE)
        a, b = self.paragraphs()
        stop = b - SHINGLE + 1
        keys = band_keys(five, a, stop, _MULTIPLIERS)
        at = self.sliding(five)
        width = LEAST_WORDS - SHINGLE + 1
        low = [_sliding(np.minimum, _rehash(five, m), width)[at] if len(at) else np.zeros(0, np.uint64) for m in _MULTIPLIERS[:ROWS]]
        key = np.zeros(len(at), np.uint64)
        for x in low:
            key = _mix(key, x)
        h = np.full(len(at), LEAST_WORDS, np.uint64)
        for k in range(0, LEAST_WORDS, SHINGLE):
            h = _mix(h, five[at + k]) if len(at) else h
        return np.concatenate([a, at]), np.concatenate([b - a, np.full(len(at), LEAST_WORDS)]), np.concatenate([contents(five, a, stop), h]), np.concatenate([keys.T.reshape(-1), key]), np.concatenate([np.full(len(a), BANDS), np.ones(len(at), np.int64)])


def _sliding(best: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``best`` of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[: len(x) - width + size], x[width - size :]) if size < width else x


def _slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1).to_pylist()), strict=True):
            ids.append(_NULL_ID if i is None else i)
            texts.append(t)
            size += len(t)
            if size >= most:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


_UNIT_DDL = "doc_id long, at int, words int, hash long, keys array<long>"


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in _slices(batches):
        words = Words(texts)
        at, size, h, keys, count = words.units()
        if not len(at):
            continue
        d = np.searchsorted(words.doc, at, side="right") - 1
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), pa.array(keys.view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(np.array(ids, np.int64)[d]), pa.array((at - words.doc[d]).astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(h.view(np.int64)), lists], names=[c.split()[0] for c in _UNIT_DDL.split(", ")])


# --- shingle sets of some nodes -----------------------------------------------------------------------------------


def _keyed(rows: DataFrame, column: str, name: str) -> Model:
    """The distinct longs of a column as sorted shards of the shared folder, which a task looks its own up in."""
    spark = rows.sparkSession
    rows = rows.select(F.col(column).alias("key")).where("key is not null").distinct()
    bits = max(0, (partitions_for(spark, rows.count(), 1_000_000) - 1).bit_length())
    shard = F.shiftrightunsigned("key", 64 - bits).cast("int") if bits else F.lit(0)
    path = shared_path(spark, name)
    one = F.lit(1.0).cast("float")
    rows.select(shard.alias("shard"), "key", one.alias("a"), one.alias("b")).repartition(1 << bits, "shard").write.partitionBy("shard").parquet(path)
    return Model(path, bits)


def shingle_sets(docs: DataFrame, wanted: DataFrame, pieces: Callable[[list[bytes]], Iterator[tuple[int, np.ndarray]]]) -> DataFrame:
    """``(hash, shingles)`` of ``wanted(hash, doc_id)``: a document that has the node. Other documents are not looked into, and
    texts are not shuffled; documents without an id are all looked into."""
    wanted = materialize(wanted.select("hash", "doc_id"), "wanted")
    nodes = _keyed(wanted, "hash", "wanted-nodes")
    mixed = wanted.select(F.xxhash64(F.coalesce("doc_id", F.lit(_NULL_ID))).alias("id"))
    of = _keyed(mixed, "id", "wanted-docs")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            hit = np.flatnonzero(~np.isnan(of.look_up(batch.column(0).to_numpy().view(np.uint64))[0]))
            texts, at = as_bytes(batch.column(1).take(pa.array(hit)).to_pylist()), 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and size < SLICE_BYTES:
                    size += len(texts[upto])
                    upto += 1
                found = dict(pieces(texts[at:upto]))
                keys = np.fromiter(found, dtype=np.uint64, count=len(found))
                keys = keys[~np.isnan(nodes.look_up(keys)[0])]
                if len(keys):
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array([np.unique(found[int(h)]).tobytes() for h in keys], pa.binary())], names=["hash", "shingles"])
                at = upto

    return docs.select(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))).alias("id"), F.col("text").cast("binary")).mapInArrow(batches, "hash long, shingles binary").dropDuplicates(["hash"])


def _unit_sets(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    words = Words(texts)
    five = words.grams(SHINGLE)
    at, size, h, _, _ = words.units()
    return ((x, five[a : a + n - SHINGLE + 1]) for x, a, n in zip(h.tolist(), at.tolist(), size.tolist(), strict=True))


# --- links --------------------------------------------------------------------------------------------------------


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True)) if SIMILARITY * max(len(a), len(b)) <= min(len(a), len(b)) else 0
            keep.append(both >= SIMILARITY * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["u", "v"])


def similar_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links whose components are those of all similar pairs that share a key: ``members(key, hash, times)``, written, and
    ``sets(hash, shingles)``, written → ``(u, v)``. No pairs of a key are made but those with one of its members a round."""

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = sets.select(F.col("hash").alias("u"), F.col("shingles").alias("su")), sets.select(F.col("hash").alias("v"), F.col("shingles").alias("sv"))
        return pairs.distinct().join(a, "u").join(b, "v").select("u", "v", "su", "sv").mapInArrow(_similar, "u long, v long")

    out, active = None, members
    for n in range(STAR_ROUNDS):
        lead = F.min(F.struct((-F.col("times")).alias("t"), "hash")).alias("x")  # the text of most occurrences: others are edits of it
        leads = active.groupBy("key").agg(lead).select("key", F.col("x.hash").alias("lead"))
        star = materialize(active.join(leads, "key").where("hash <> lead"), f"stars-{n}")
        if n and not star.head(1):
            break
        found = materialize(verified(star.select(F.col("lead").alias("u"), F.col("hash").alias("v"))), f"links-{n}")
        out = found if out is None else out.unionAll(found)
        active = materialize(star.join(found.select(F.col("u").alias("lead"), F.col("v").alias("hash")), ["lead", "hash"], "left_anti").select("key", "hash", "times"), f"unlike-{n}")
    return out.unionAll(_across(members, sets, connected_components(out)))


_PART_DDL = "key long, i int, j int, hash long, root long, stray boolean, shingles binary"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_PART_DDL`` in the order of key, i, j → links from every stray to members of other roots that are similar, one a root."""
    held: list[tuple] = []
    name = None

    def links() -> pa.RecordBatch | None:
        rows = {h: (r, s, x) for h, r, s, x in sorted(held, key=lambda h: h[2])}  # a stray is a member too
        nodes, own = list(rows), list(rows.values())
        sets = [np.frombuffer(x, np.uint64) for _, _, x in own]
        sizes = np.array([len(s) for s in sets])
        roots = np.array([r for r, _, _ in own])
        of = np.repeat(np.arange(len(sets)), sizes)
        _, token, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        order = np.argsort(token, kind="stable")
        at, first = np.append(0, np.cumsum(often)), np.append(0, np.cumsum(sizes))
        posted = of[order]
        postings = lambda ts: np.concatenate([posted[at[t] : at[t + 1]] for t in ts]) if len(ts) else np.zeros(0, np.int64)
        u, v = [], []
        for i, (root, stray, _) in enumerate(own):
            if not stray:
                continue
            tokens = token[first[i] : first[i + 1]]
            tokens = tokens[np.argsort(often[tokens], kind="stable")]
            n = len(tokens)
            rare = tokens[: n - int(np.ceil(SIMILARITY * n - 1e-9)) + 1]
            found = np.unique(postings(rare[often[rare] > 1].tolist()))
            found = found[(roots[found] != root) & (SIMILARITY * np.maximum(sizes[found], n) <= np.minimum(sizes[found], n))]
            if not len(found):
                continue
            both = np.bincount(postings(tokens[often[tokens] > 1].tolist()), minlength=len(sets))[found]
            found = found[both >= SIMILARITY * (sizes[found] + n - both)]
            for j in np.unique(roots[found], return_index=True)[1].tolist():
                u.append(nodes[i])
                v.append(nodes[int(found[j])])
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]) if u else None

    for batch in batches:
        for key, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (key, i, j) != name:
                if held and (out := links()):
                    yield out
                held, name = [], (key, i, j)
            held.append(tuple(row))
    if held and (out := links()):
        yield out


def _parts(rooted: DataFrame, most_blocks: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of every key whose members have several roots: strays (not of the root of most members) with all members, each
    side in blocks of bounded size; and the members of keys that would have too many blocks."""
    by_root = rooted.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    main = F.max(F.struct("n", "root", "s")).alias("x")
    keys = by_root.groupBy("key").agg(main, F.count("*").alias("roots"), F.sum("s").alias("all")).where("roots > 1")
    ceil = lambda c, most: F.ceil(c / F.lit(most)).cast("int")
    keys = keys.select("key", F.col("x.root").alias("main"), ceil(F.col("all") - F.col("x.s"), STRAY_SHINGLES).alias("ni"), ceil(F.col("all"), BLOCK_SHINGLES).alias("nj"))
    several = materialize(rooted.join(keys, "key"), "members-open")
    few = several.where(F.col("ni").cast("long") * F.col("nj") <= most_blocks)
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    strays = few.where("root <> main").select("key", F.pmod(F.xxhash64(F.lit(1), "hash"), F.col("ni")).cast("int").alias("i"), upto("nj").alias("j"), "hash", "root", F.lit(True).alias("stray"))
    others = few.select("key", upto("ni").alias("i"), F.pmod(F.xxhash64(F.lit(2), "hash"), F.col("nj")).cast("int").alias("j"), "hash", "root", F.lit(False).alias("stray"))
    return strays.unionAll(others), several.where(F.col("ni").cast("long") * F.col("nj") > most_blocks)


def _across(members: DataFrame, sets: DataFrame, roots: DataFrame, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``(u, v)``: links between members of a key that the star rounds have left in different components.

    Members that are joined already are not compared with each other, so a large group of near copies costs what its few
    strays cost. A key with very many strays (a form letter, say) goes by the rarest shingles of its members instead
    (prefix filter): similar sets share one of the rarest fifth of either, and what has too many of its own is out of reach.
    """
    names = roots.withColumnRenamed("node", "hash")
    sized = sets.select("hash", (F.octet_length("shingles") / 8).cast("int").alias("size"))
    rooted = materialize(members.select("key", "hash").join(names, "hash", "left").withColumn("root", F.coalesce("root", "hash")).join(sized, "hash"), "members-rooted")

    def compared(parts: DataFrame) -> DataFrame:
        whole = parts.join(sets, "hash").select([c.split()[0] for c in _PART_DDL.split(", ")])
        return whole.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_compare, "u long, v long")

    parts, rest = _parts(rooted, most_blocks)
    out = materialize(compared(parts), "links-across")
    if rest.head(1):
        by_shingle = _prefixes(sets.join(rest.select("hash", "root").distinct(), "hash"))
        far, none = _parts(materialize(by_shingle, "prefixes"), 1 << 62)
        out = out.unionAll(compared(far))
    return out


def _prefixes(sets: DataFrame) -> DataFrame:
    """``sets(hash, shingles, root)`` → ``(key, hash, root, size)``: the rarest shingles of every set, so many that two similar
    sets share one. Sets with so many shingles of their own that no other set can be similar to them are left out."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, x, r in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                key = np.frombuffer(x, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), h)), pa.array(key), pa.array(np.full(len(key), len(key))), pa.array(np.full(len(key), r))], names=["hash", "key", "size", "root"])

    all_ = materialize(sets.select("hash", "shingles", "root").mapInArrow(tokens, "hash long, key long, size long, root long"), "set-shingles")
    often = all_.groupBy("key").agg(F.count("*").alias("often"))
    own = Window.partitionBy("hash")
    ranked = all_.join(often, "key").select("*", F.row_number().over(own.orderBy("often", "key")).alias("r"), F.count_if(F.col("often") > 1).over(own).alias("shared"))
    first = ranked.where((F.col("r") <= F.col("size") - F.ceil(F.col("size") * SIMILARITY - 1e-9) + 1) & (F.col("often") > 1))
    least = first.groupBy("key").agg(F.min("size").alias("least"))
    reach = F.col("shared") * (1 + SIMILARITY) >= SIMILARITY * (F.col("size") + F.greatest(F.col("least"), F.col("size") * SIMILARITY)) - 1e-9
    return first.join(least, "key").where(reach).select("key", "hash", "root", "size")


# --- the operator -------------------------------------------------------------------------------------------------


def repeated_units(docs: DataFrame) -> DataFrame:
    """Paragraphs that another document has too, alike or nearly: ``doc_id, start, stop, removed, first_doc``."""
    units = materialize(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(_unit_batches, _UNIT_DDL), "units")
    keyed = units.select(F.explode("keys").alias("key"), "doc_id", "at", "words", "hash")
    shared = materialize(keyed.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("key"), "keys-shared")  # written: a frequent key can then be split in the join
    hits = materialize(keyed.join(shared, "key"), "units-shared")
    places = materialize(hits.select("doc_id", "at", "words", "hash").distinct(), "places")
    nodes = materialize(places.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("times")), "nodes")
    unlike = materialize(hits.groupBy("key").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).where("a <> b").select("key"), "keys-unlike")
    members = materialize(hits.select("key", "hash").distinct().join(unlike, "key").join(nodes.select("hash", "times"), "hash"), "members")
    wanted = nodes.join(members.select("hash").distinct(), "hash", "left_semi").select("hash", F.col("first").alias("doc_id"))
    sets = materialize(shingle_sets(docs, wanted, _unit_sets), "shingle-sets")
    roots = connected_components(similar_links(members, sets)).withColumnRenamed("node", "hash")
    named = materialize(nodes.join(roots, "hash", "left").withColumn("root", F.coalesce("root", "hash")), "nodes-rooted")
    groups = named.groupBy("root").agg(F.min("first").alias("keep"), F.max("last").alias("last")).where("keep <> last")
    flagged = named.select("hash", "root").join(groups, "root").select("hash", "keep")
    return places.join(flagged, "hash").select("doc_id", F.col("at").cast("long").alias("start"), (F.col("at") + F.col("words")).cast("long").alias("stop"), (F.col("doc_id") != F.col("keep")).alias("removed"), F.col("keep").alias("first_doc"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """A row per document that has a passage of another: ``doc_id, n_repeated, n_removed`` (words), ``removed`` (word ranges), ``first_docs``.

    ``first_docs`` name the classes of its passages: the documents in which these stay; a document without a row is in no
    class. Defined cases: null text is empty; documents without a doc_id count as one document; repeated rows of one
    doc_id are one document's; texts of under ``LEAST_WORDS`` words have no passages; of equal passages (ties) that of the least
    doc_id stays; a very long text is one of the texts of a slice, which is as long as its longest text; an empty table
    gives no rows; columns other than doc_id and text, whatever their names, are ignored.
    """
    spans = repeated_units(docs)
    per = spans.groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("all"), F.collect_set(F.when(F.col("removed"), F.struct("start", "stop"))).alias("gone"), F.array_sort(F.collect_set("first_doc")).alias("first_docs"))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [[], []]
            for k in (1, 2):
                for spans_ in batch.column(k).to_pylist():
                    out: list[list[int]] = []
                    for s in sorted((x["start"], x["stop"]) for x in spans_):
                        if out and s[0] <= out[-1][1]:
                            out[-1][1] = max(out[-1][1], s[1])
                        else:
                            out.append(list(s))
                    cols[k - 1].append(out)
            count = lambda c: pa.array([sum(b - a for a, b in x) for x in c], pa.int64())
            ids = [None if i == _NULL_ID else i for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), count(cols[0]), count(cols[1]), pa.array(cols[1], pa.list_(pa.list_(pa.int64()))), batch.column(3)], names=["doc_id", "n_repeated", "n_removed", "removed", "first_docs"])

    return per.mapInArrow(merged, "doc_id long, n_repeated long, n_removed long, removed array<array<long>>, first_docs array<long>")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of all documents; cases as in ``repeated_passages``."""
    return repeated_passages(table(spark, sf_dir, "documents"))
