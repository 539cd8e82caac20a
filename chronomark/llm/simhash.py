"""Operator 7, SimHash near-dedup: binary trie self-join over distinct fingerprints.

Fingerprints are distinct before anything is compared, so a group of copies of any size is one leaf. Of ``budget`` + 1 blocks
of the 64 bits two similar fingerprints have one in common. So the tries that are joined with themselves are those of the
fingerprints that agree in some bits of a block, as many bits as leave about ``GROUP`` fingerprints to a trie: every fingerprint
goes to ``budget`` + 1 tries, at any size of the corpus. A trie is walked in node pairs from the top: both children of both
nodes, differing bits added up, a pair dropped once it is over the budget. Nodes are ranges of the sorted fingerprints, so
a level of the walk is a few numpy operations for many tries at once; a front of too many pairs is walked in parts, depth
first. A trie links its members by a spanning forest (never by all pairs). Tries of over ``split_above`` members are
dealt anew by pairs of 8-bit child nodes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomark.llm._common import as_bytes, keep_named_rows, materialize, partitions_for, table
from chronomark.llm.components import connected_components, local_roots

SEED = 42
SHINGLE = 3
BUDGET = 2
SPLIT_ABOVE = 200_000
CHUNK = 100_000
#: Fingerprints of a trie, as many as are walked at once, node pairs of a front.
GROUP, TOGETHER, FRONT = 4_096, 50_000, 500_000


def simhash(data: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of UTF-8 ``data`` as a signed 64-bit integer; no words: 0."""
    words = data.lower().split()  # bytes: A-Z only, and exactly \x20 \x09-\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter([digest(joined[s:e], SEED) for s, e in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)], dtype=np.uint64, count=len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


_FP = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = [simhash(b) for b in as_bytes(batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(fps, pa.int64())], schema=_FP)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, fp)`` per row; null text counts as empty. No shuffle."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("b")).mapInArrow(_fingerprint_batches, "doc_id long, text_hash long, fp long")


# --- the trie -----------------------------------------------------------------------------------------------------

def blocks(budget: int) -> list[tuple[int, int]]:
    """``budget`` + 1 runs of bits; at most ``budget`` differing bits leave one of them equal."""
    return [(64 * k // (budget + 1), 64 * (k + 1) // (budget + 1)) for k in range(budget + 1)]


def key_bits(count: int, budget: int) -> int:
    """Bits of a block that tell tries apart."""
    return min(64 // (budget + 1), max(0, (max(1, count // GROUP) - 1).bit_length()))


def node_keys(fp: np.ndarray, bits: int, budget: int = BUDGET) -> np.ndarray:
    """(budget + 1, n) names of tries; two fingerprints at most ``budget`` bits apart have one in common. Without bits there is one trie."""
    fp = fp.view(np.uint64) if fp.dtype == np.int64 else fp
    if not bits:
        return np.zeros((1, len(fp)), np.uint64)
    return np.stack([(((fp >> np.uint64(lo)) & np.uint64((1 << bits) - 1)) << np.uint64(6)) | np.uint64(k) for k, (lo, _) in enumerate(blocks(budget))])


def trie_pairs(fp: np.ndarray, lo: np.ndarray, hi: np.ndarray, budget: int = BUDGET, front: int = FRONT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``fp`` (uint64, sorted within each range lo..hi) at most ``budget`` bits apart, by ranges.

    Each range is a trie; the walk begins with its root against itself. A pair of single fingerprints is decided by the rest of their bits."""
    ones: dict[int, np.ndarray] = {}
    stack = [(63, lo, hi, lo, hi, np.zeros(len(lo), dtype=np.int8))]
    while stack:
        bit, a0, a1, b0, b1, diff = stack.pop()
        while len(a0):
            single = (a1 - a0 == 1) & (b1 - b0 == 1) if bit >= 0 else np.ones(len(a0), dtype=bool)
            if single.any():
                yield from _decided(fp, a0[single], a1[single], b0[single], b1[single], budget)
                a0, a1, b0, b1, diff = (x[~single] for x in (a0, a1, b0, b1, diff))
            if bit < 0 or not len(a0):
                break
            if len(a0) > front:
                half = len(a0) // 2
                stack.append((bit, *(x[half:] for x in (a0, a1, b0, b1, diff))))
                a0, a1, b0, b1, diff = (x[:half] for x in (a0, a1, b0, b1, diff))
            if bit not in ones:
                ones[bit] = np.concatenate(([0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)))
            count = ones[bit]
            am, bm = a1 - (count[a1] - count[a0]), b1 - (count[b1] - count[b0])  # where the children with a one begin
            cross = ~((a0 == b0) & (a1 == b1))
            parts = [(a0, am, b0, bm, diff), (am, a1, bm, b1, diff), (a0, am, bm, b1, diff + 1), (am[cross], a1[cross], b0[cross], bm[cross], diff[cross] + 1)]
            a0, a1, b0, b1, diff = (np.concatenate(x) for x in zip(*parts, strict=True))
            live = (diff <= budget) & (a1 > a0) & (b1 > b0) & ~((a0 == b0) & (a1 - a0 < 2) & (b1 == a1))
            a0, a1, b0, b1, diff = (x[live] for x in (a0, a1, b0, b1, diff))
            bit -= 1


def _decided(fp: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = (a1 - a0) * (b1 - b0)
    at = 0
    bounds = np.cumsum(sizes)
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(bounds, (bounds[at - 1] if at else 0) + 2_000_000, side="right")))
        n = sizes[at:upto]
        own = np.repeat(np.arange(at, upto), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = (b1 - b0)[own]
        i, j = a0[own] + k // width, b0[own] + k % width
        keep = (i < j) & (np.bitwise_count(fp[i] ^ fp[j]) <= budget)
        yield i[keep], j[keep]
        at = upto


def _group_forest(key: np.ndarray, fp: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) of a spanning forest over all groups of equal key."""
    order = np.lexsort((fp, key))
    key, fp = key[order], fp[order]
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    end = np.concatenate((cut[1:], [len(key)]))
    u, v, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
    while at < len(cut):
        upto = max(at + 1, int(np.searchsorted(end, cut[at] + TOGETHER, side="right")))
        part = fp[cut[at] : end[upto - 1]]
        lo, hi = cut[at:upto] - cut[at], end[at:upto] - cut[at]
        root, ia, ib, held = np.arange(len(part)), [], [], 0

        def folded(root: np.ndarray, ia: list, ib: list) -> np.ndarray:
            return local_roots(np.concatenate([*ia, np.arange(len(root))]), np.concatenate([*ib, root]), len(root))

        for i, j in trie_pairs(part, lo[hi - lo > 1], hi[hi - lo > 1], budget):
            ia.append(i)
            ib.append(j)
            held += len(i)
            if held > 2_000_000:  # what has been found goes into roots; links stay whole
                root, ia, ib, held = folded(root, ia, ib), [], [], 0
        root = folded(root, ia, ib)
        moved = np.flatnonzero(root != np.arange(len(part)))
        u.append(part[moved])
        v.append(part[root[moved]])
        at = upto
    return np.concatenate(u), np.concatenate(v)


_KEYED = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _key_batches(batches: Iterator[pa.RecordBatch], bits: int, budget: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
        for k in node_keys(fp, bits, budget):
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(fp.view(np.int64))], schema=_KEYED)


def _child_pair_batches(batches: Iterator[pa.RecordBatch], bits: int, budget: int) -> Iterator[pa.RecordBatch]:
    """For large tries: a fingerprint joins each pair of 8-bit child nodes that it can be in within the budget."""
    flips = np.array([f for f in range(256) if bin(f).count("1") <= budget], dtype=np.uint64)
    own = [set(range(lo, lo + bits)) for lo, _ in blocks(budget)]
    free_of = np.array([[b for b in range(63, -1, -1) if b not in o][:8] for o in own], dtype=np.uint64)
    for batch in batches:
        key = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
        fp = np.ascontiguousarray(batch.column(1).to_numpy(zero_copy_only=False)).view(np.uint64)
        free = free_of[(key & np.uint64(63)).astype(int)]
        node = np.zeros(len(fp), dtype=np.uint64)
        for i in range(8):
            node |= ((fp >> free[:, i]) & np.uint64(1)) << np.uint64(i)
        for f in flips:
            other = node ^ f
            pair = np.minimum(node, other) * np.uint64(256) + np.maximum(node, other)
            mixed = (key * np.uint64(0x9E3779B97F4A7C15)) ^ ((pair + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
            yield pa.RecordBatch.from_arrays([pa.array(mixed.view(np.int64)), pa.array(fp.view(np.int64))], schema=_KEYED)


def _forest_batches(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    whole = pa.Table.from_batches(tables)
    key, fp = (whole.column(i).to_numpy().view(np.uint64) for i in (0, 1))
    u, v = _group_forest(key, fp, budget)
    for at in range(0, len(u), CHUNK):
        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + CHUNK].view(np.int64)) for x in (u, v)], schema=_EDGE)


def fingerprint_links(distinct: DataFrame, count: int, budget: int = BUDGET, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """``distinct(fp)`` → ``(u, v)``: links of spanning forests of all pairs at most ``budget`` (0 to 15) bits apart."""
    if not 0 <= budget <= 15:
        raise ValueError("budgets of 0 to 15 bits")
    spark = distinct.sparkSession
    bits = key_bits(count, budget)
    keyed = distinct.select("fp").mapInArrow(lambda it: _key_batches(it, bits, budget), "key long, fp long")
    n = partitions_for(spark, (budget + 1) * count, CHUNK, 2)
    if count > split_above:
        keyed = materialize(keyed, "simhash-keys")
        hot = materialize(keyed.groupBy("key").count().where(F.col("count") > split_above).select("key", F.lit(True).alias("hot")), "simhash-hot")
        if hot.head(1):
            marked = keyed.join(hot, "key", "left")
            split = marked.where("hot").select("key", "fp").mapInArrow(lambda it: _child_pair_batches(it, bits, budget), "key long, fp long")
            keyed = marked.where("hot is null").select("key", "fp").unionAll(split)
    return keyed.repartition(n, "key").mapInArrow(lambda it: _forest_batches(it, budget), "u long, v long")


def simhash_classes(docs: DataFrame, budget: int = BUDGET, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, text_hash, fp, component_id, rep_id, rep_hash``.

    ``component_id`` is the least doc_id of those reachable over links, itself included; ``rep_id, rep_hash`` name the row
    that stays when a class is thinned to one (least doc_id, null last, then least text hash). Defined cases: null text
    is the empty text (fingerprint 0, linked like any other); a null doc_id takes part but is never a component_id while
    the class has another; repeated rows share a class; a very long text counts whole, in slices; an empty table gives no
    rows; other columns, whatever their names, are ignored.
    """
    fps = materialize(fingerprints(docs), "simhash-fp")
    rank = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), F.col("text_hash").alias("h"))
    distinct = materialize(fps.groupBy("fp").agg(F.min(rank).alias("rep")), "simhash-distinct")
    links = fingerprint_links(distinct, distinct.count(), budget, split_above)
    roots = connected_components(links).select(F.col("node").alias("fp"), "root")
    named = distinct.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("rep"))
    classes = named.drop("rep").join(least, "root").select("fp", F.col("rep.id").alias("component_id"), F.col("rep.h").alias("rep_hash"))
    return fps.join(classes, "fp").select("doc_id", "text_hash", "fp", "component_id", F.col("component_id").alias("rep_id"), "rep_hash")


def keep_one_per_class(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``docs`` without near copies: of each class the row named by ``rep_id, rep_hash`` stays, once, with all its columns."""
    return keep_named_rows(docs, simhash_classes(docs, budget))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document; cases as in ``simhash_classes``."""
    classes = simhash_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
