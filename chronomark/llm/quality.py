"""Operator 9, quality classifier: interpolated modified Kneser-Ney trigrams of trusted text, one model a language.

A language with fewer than ``LEAST_DOCS`` training documents has no model of its own: such languages share one, which is trained
on all trusted text and has a threshold from their own held-out documents.

Fitting: trusted rows are those that all labels call good and none toxic. A fifth of them (by hash of the id) is held
out for the thresholds; all others train, whole. Blocks of them send their distinct trigrams with counts to the shards of the
trigram's last two words. A shard adds the counts up, so that it has the words before each pair (the pair's count), and sends what
contexts (the counts of what follows) and words (the pairs that end in them) get to their shards. The model is counts,
not weights: discounts follow from counts of counts that are added up over all shards. A shard is added up slice by slice
(``SLICE`` n-grams, by ranges of the middle word or of the key, in which all rows are sorted), so that what a task holds
besides its packed rows does not grow with them.

Scoring: a block of documents sends its distinct words, pairs and trigrams to the shards, gets their counts back, and adds up
the logarithms of its own texts. So a shard is read by its own tasks only, and a task has a shard or a block, at any size. Keys are a shard
and 40 bits. Larger tables are scored in ``ROUNDS`` parts by hash of the id. Every row is scored, over its whole text.

Thresholds: the ``quantile`` of the perplexity of the held-out trusted documents in the language, over all of them.

Toxicity: a few insults hardly move the perplexity of a long text, so it has a measure and a threshold of its own. A word's
weight is the log10 ratio of the shares of toxic and of trusted training documents that have it; a text's toxicity is the
sum of the ``TOXIC_TOP`` heaviest of its distinct words, whatever its length, and its threshold the same quantile of the
same held-out documents.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomark.llm._common import _mix, discard, in_small_batches, materialize, open_filesystem, shared_path, table, without_shuffle_files, worker_cache
from chronomark.llm.lm_scoring import _KEY_BITS, _ROW_DDL, _deltas, _distinct, _in_groups, _pack, _row, _Rows, _shard_of, _unpack

LEAST_DOCS = 20
#: The name of the model that languages without one of their own share; no language has it.
POOLED = "\0pooled"
#: Ids of training documents that are sent to all executors at most (40 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 500_000
QUANTILE = 0.99
#: Training text of a shard; text of a block; parts of the documents that are scored one after the other, so that less of the exchange lies on disk.
SHARD_BYTES = 16_000_000
BLOCK_BYTES = 12_000_000
ROUNDS = 4
#: N-grams that a task works on at a time.
SLICE = 250_000
#: N-grams of shards that a worker keeps (``Model``).
CACHED_ENTRIES = 6_000_000
#: Words that count for the toxicity of a text; toxic training documents that have a word with a weight, and its least weight.
TOXIC_TOP = 3
TOXIC_WORD_DOCS = 3
TOXIC_WEIGHT = 0.5
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

_U = np.uint64


def _salt(lang: str | None) -> int:
    return xxhash.xxh64_intdigest((lang or "").encode(), 7)


def tokens_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _marks(salt: int) -> tuple[int, int]:
    """Hashes of the start and the end of a text; no word contains white space."""
    return xxhash.xxh64_intdigest(b" <s>", salt), xxhash.xxh64_intdigest(b" </s>", salt)


def _hashed(texts: list[str | None], salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
    """Word hashes of all texts in a row, each as start start words end; first positions; the words of each; the hash of every word."""
    start, end = _marks(salt)
    known: dict[str, int] = {}
    out: list[int] = []
    lengths = []
    digest = xxhash.xxh64_intdigest
    for t in texts:
        words = tokens_of(t)
        for w in words:
            if w not in known:
                known[w] = digest(w.encode("utf-8", "replace"), salt)
        out.append(start)
        out.append(start)
        out.extend(map(known.__getitem__, words))
        out.append(end)
        lengths.append(len(words) + 3)
    sizes = np.array(lengths, dtype=np.int64)
    return np.array(out, dtype=np.uint64), np.cumsum(sizes) - sizes, sizes - 3, known


def _discounts_of(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """Modified Kneser-Ney discounts of the counts 1, 2 and more from counts of counts, within their bounds."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    d1 = 1 - 2 * y * n2 / n1 if n1 else 0.5
    d2 = 2 - 3 * y * n3 / n2 if n2 else 1.0
    d3 = 3 - 4 * y * n4 / n3 if n3 else 1.5
    return np.array([0.0, min(max(d1, 0.1), 0.99), min(max(d2, 0.1), 1.98), min(max(d3, 0.1), 2.97)])


def _discounts(counts: np.ndarray) -> np.ndarray:
    return _discounts_of(*(float((counts == i).sum()) for i in (1, 2, 3, 4)))


def _vocabulary(texts: list[str | None], lang: str | None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of all distinct words, outer punctuation off, apart from the n-grams' ones; and which of them each text has."""
    salt, known, hashes, own = _salt(lang) ^ 0x70C1C, {}, {}, []
    for t in texts:
        ids = set()
        for w in set(tokens_of(t)):
            at = known.get(w)
            if at is None:
                bare = w.strip(_PUNCTUATION) or w
                at = known[w] = hashes.setdefault(xxhash.xxh64_intdigest(bare.encode("utf-8", "replace"), salt), len(hashes))
            ids.add(at)
        own.append(np.fromiter(ids, np.int64, len(ids)))
    return np.fromiter(hashes, np.uint64, len(hashes)), own


class Model:
    """A table of hashed keys with two weights in sorted shards of the shared folder, and where it is."""

    def __init__(self, path: str, bits: int):
        self.path, self.bits = path, bits

    def _parts(self, k: int) -> list[pa.Table]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, path = open_filesystem(f"{self.path}/shard={k}")
        found = [f.path for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
        return [pq.ParquetFile(store.open_input_file(f)).read() for f in sorted(found)]

    def _load(self, k: int) -> list[np.ndarray]:
        parts = self._parts(k)
        column = lambda c, kind: np.concatenate([p.column(c).to_numpy() for p in parts]) if parts else np.zeros(0, kind)
        return [column("key", np.int64).view(np.uint64), column("a", np.float32), column("b", np.float32)]

    def shard(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys and the two weights of shard ``k``; a worker keeps the last few."""
        kept = worker_cache("shards").setdefault("lru", OrderedDict())
        name = (self.path, k)
        if name not in kept:
            keys, a, b = self._load(k)
            order = np.argsort(keys)
            kept[name] = keys[order], a[order], b[order]
            while len(kept) > 1 and sum(len(x[0]) for x in kept.values()) > CACHED_ENTRIES:
                kept.popitem(last=False)
        kept.move_to_end(name)
        return kept[name]

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of ``keys``: NaN where there is no such n-gram."""
        a, b = np.full(len(keys), np.nan, np.float32), np.full(len(keys), np.nan, np.float32)
        if not len(keys):
            return a, b
        order = np.argsort(keys)
        ranked = keys[order]
        cuts = np.searchsorted(ranked >> _U(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64)) if self.bits else np.array([0, len(keys)])
        for k in range(len(cuts) - 1):
            if cuts[k] == cuts[k + 1]:
                continue
            have, wa, wb = self.shard(k)
            if not len(have):
                continue
            ask = ranked[cuts[k] : cuts[k + 1]]
            at = np.minimum(np.searchsorted(have, ask), len(have) - 1)
            hit = have[at] == ask
            rows = order[cuts[k] : cuts[k + 1]][hit]
            a[rows], b[rows] = wa[at[hit]], wb[at[hit]]
        return a, b


# --- what a block of documents sends ------------------------------------------------------------------------------

_LOW = _U((1 << _KEY_BITS) - 1)
#: Rows between blocks, shards and documents; ``check`` tells what a row holds.
_TRIGRAMS, _TOXIC, _DOCS = 0, 1, 2
_OWN, _OTHERS, _KEPT = 0, 3, 4
#: Columns of a model's statistics: counts of the counts 1 to 4 of trigrams, pairs, words; sum and number of words' counts; documents.
_SUM, _KINDS, _CLEAN, _BAD, _STATS = 12, 13, 14, 15, 16


def _place(gram: np.ndarray, by: np.ndarray, shards: int) -> np.ndarray:
    """The shard of ``by`` and 40 bits of ``gram``, in one key."""
    return (_shard_of(by, shards) << _U(_KEY_BITS)) | (gram & _LOW)


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    return np.searchsorted(keys >> _U(_KEY_BITS), np.arange(shards + 1, dtype=np.uint64))


def _narrow(a: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as they need."""
    most = int(a.max()) if len(a) else 0
    return a.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8")


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    distinct, _, at = _distinct(keys)
    return distinct, [_narrow(np.bincount(at, weights=v, minlength=len(distinct))) for v in values]


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The arrays of all parts one after the other, column by column; the parts are given up."""
    out = []
    for i in range(len(parts[0])):
        out.append(np.concatenate([p[i] for p in parts]))
        for p in parts:
            p[i] = None
    return out


def _ranges(sorted_: list[np.ndarray], size: int) -> list[np.ndarray]:
    """Where to cut each of some sorted arrays, so that equal values meet in one range and a range has about ``size`` of them over all."""
    step = max(1, size // 64)
    some = np.sort(np.concatenate([x[::step] for x in sorted_]))
    borders = np.unique(some[64::64])
    return [np.concatenate(([0], np.searchsorted(x, borders), [len(x)])) for x in sorted_]


def _context(counts: np.ndarray) -> list[np.ndarray]:
    """What a context needs of an n-gram after it: its count, and whether that is 1, 2 or more."""
    return [counts, counts == 1, counts == 2, counts > 2]


def _sorted_keys(deltas: np.ndarray) -> np.ndarray:
    return np.cumsum(deltas, dtype=np.uint64)


def _learned(texts: dict[tuple[int, bool], list[str | None]], names: list[str], shards: int, number: int) -> Iterator[pa.RecordBatch]:
    """Rows of a block of training texts by model and toxicity: trigrams by the shard of their last two words, words of documents."""
    hashed = [(m, *_hashed(t, _salt(names[m]))[:2]) for (m, toxic), t in texts.items() if not toxic]
    docs = np.zeros((len(names), 2), np.int64)
    words: list[tuple[np.ndarray, ...]] = []
    for (m, toxic), t in texts.items():
        docs[m, int(toxic)] += len(t)
        keys, own = _vocabulary(t, names[m])
        n = np.bincount(np.concatenate(own), minlength=len(keys)) if own else np.zeros(len(keys), np.int64)
        words.append((keys, np.full(len(keys), m), n * (not toxic), n * toxic))
    yield _row(number, 0, _DOCS, _pack([docs.ravel()]))
    if words:
        keys, m, clean, bad = (np.concatenate(x) for x in zip(*words, strict=True))
        order = np.argsort(keys)
        cut = np.searchsorted(_shard_of(keys[order], shards), np.arange(shards + 1, dtype=np.uint64))
        for s in range(shards):
            if cut[s] < cut[s + 1]:
                at = order[cut[s] : cut[s + 1]]
                yield _row(number, s, _TOXIC, _pack([_deltas(keys[at]), _narrow(m[at]), _narrow(clean[at]), _narrow(bad[at])]))
        del keys, m, clean, bad, order
    texts.clear()  # what follows takes several times the texts
    t = own = n = words = None
    if not hashed:
        return
    h = np.concatenate([x[1] for x in hashed])
    model = np.repeat(np.array([x[0] for x in hashed]), [len(x[1]) for x in hashed])
    inner = np.ones(len(h), dtype=bool)
    begin = 0
    for _, part, first in hashed:
        inner[begin + first] = inner[begin + first + 1] = False
        begin += len(part)
    at = np.flatnonzero(inner)
    vocabulary, place, index = _distinct(h)
    of = model[place]
    pair = _mix(h[:-1], h[1:])
    _, place, which = _distinct(_mix(pair[at - 2], h[at]))
    count, at = np.bincount(which), at[place]
    del h, model, inner, hashed, part, which, place
    shard = _shard_of(pair[at - 1], shards)
    order = np.lexsort((index[at - 1], shard))
    at, count = at[order], count[order]
    cut = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
    new = np.zeros(len(vocabulary), np.int64)
    for s in range(shards):
        if cut[s] < cut[s + 1]:
            own = at[cut[s] : cut[s + 1]]
            grams = [index[own - 2], index[own - 1], index[own]]
            used = np.zeros(len(vocabulary), dtype=bool)
            for g in grams:
                used[g] = True
            used = np.flatnonzero(used)
            new[used] = np.arange(len(used))
            yield _row(number, s, _TRIGRAMS, _pack([_deltas(vocabulary[used]), _narrow(of[used]), *(_narrow(new[g]) for g in grams), _narrow(count[cut[s] : cut[s + 1]])]))


def _count_of_counts(stats: np.ndarray, at: int, model: np.ndarray, counts: np.ndarray) -> None:
    for i in (1, 2, 3, 4):
        stats[:, at + i - 1] += np.bincount(model[counts == i], minlength=len(stats))


def _merged(rows: _Rows, shards: int, models: int) -> Iterator[pa.RecordBatch]:
    """A shard's trigrams of all blocks → its trigrams (for the model) and pairs with their counts, and what contexts and words get, by their shard."""
    me, stats = rows[0][1], np.zeros((models, _STATS), np.int64)
    grams: list[list[np.ndarray]] = []
    words: list[list[np.ndarray]] = []
    while rows:
        _, _, kind, data = rows.pop()
        a = _unpack(data)
        if kind == _DOCS:
            stats[:, [_CLEAN, _BAD]] += a[0].reshape(models, 2)
        elif kind == _TOXIC:
            words.append([_sorted_keys(a[0]), *a[1:]])
        else:
            grams.append([_sorted_keys(a[0]), *a[1:]])
    a = data = None
    if words:
        key, m, clean, bad = _joined(words)
        distinct, place, at = _distinct(key)
        bad = np.bincount(at, weights=bad, minlength=len(distinct))
        some = bad >= TOXIC_WORD_DOCS
        clean = np.bincount(at, weights=clean, minlength=len(distinct))[some]
        yield _row(me, me, _TOXIC, _pack([_deltas(distinct[some]), _narrow(m[place][some]), _narrow(clean), _narrow(bad[some])]))
        key = m = clean = bad = distinct = place = at = some = None
    if not grams:
        yield _row(me, me, _OWN, _pack([stats.ravel(), *[np.zeros(0, "<u8")] * 2]))
        return
    cuts = _ranges([g[0][g[3]] for g in grams], SLICE)
    trigrams, contexts, pairs, words = [], [], [], []
    for k in range(len(cuts[0]) - 1):
        parts = []
        for (vocabulary, of, *places, counts), cut in zip(grams, cuts, strict=True):
            some = slice(cut[k], cut[k + 1])
            parts.append([*(vocabulary[x[some]] for x in places), of[places[2][some]], counts[some]])
        u, v, w, m, c = _joined(parts)
        before = _mix(u, v)
        key, place, at = _distinct(_mix(before, w))
        c3 = np.bincount(at, weights=c).astype(np.int64)
        trigrams.append([(_U(me) << _U(_KEY_BITS)) | (key & _LOW), _narrow(c3)])
        before, v, w, m = _place(before, before, shards)[place], v[place], w[place], m[place]
        _count_of_counts(stats, 0, m, c3)
        key, values = _summed(before, *_context(c3))
        contexts.append([key, *values])
        after = _mix(v, w)
        key, place, at = _distinct(after)
        c2 = np.bincount(at)
        pairs.append([_place(key, key, shards), _narrow(c2)])
        v, w, m = v[place], w[place], m[place]
        _count_of_counts(stats, 4, m, c2)
        word, none = np.concatenate([_place(w, w, shards), _place(v, v, shards)]), np.zeros(len(w), np.int64)
        own, place, at = _distinct(word)
        values = [np.bincount(at, weights=np.concatenate(x)) for x in [(none + 1, none), *((none, x) for x in _context(c2))]]
        words.append([own, np.concatenate([m, m])[place], *map(_narrow, values)])
    grams.clear()
    u = v = w = m = c = c2 = c3 = before = after = word = none = own = key = place = at = values = parts = cuts = None
    for kind, parts in ((_KEPT, trigrams), (_OWN, pairs)):
        key, count = _joined(parts)
        order = np.argsort(key)
        yield _row(me, me, kind, _pack([*[stats.ravel()] * (kind == _OWN), _deltas(key[order]), count[order]]))
    contexts, words = _joined(contexts), _joined(words)
    for arrays in (contexts, words):
        order = np.argsort(arrays[0])
        arrays[:] = [x[order] for x in arrays]
    (own, of), values = words[:2], words[2:]
    own, place, at = _distinct(own)
    words = [own, of[place], *(np.bincount(at, weights=x) for x in values)]
    cut, cuts = _cuts(contexts[0], shards), _cuts(words[0], shards)
    for s in range(shards):
        if cut[s] < cut[s + 1] or cuts[s] < cuts[s + 1]:
            a, b = slice(cut[s], cut[s + 1]), slice(cuts[s], cuts[s + 1])
            yield _row(me, s, _OTHERS, _pack([_deltas(contexts[0][a]), *(_narrow(x[a]) for x in contexts[1:]), _deltas(words[0][b]), *(_narrow(x[b]) for x in words[1:])]))


def _united(parts: list[list[np.ndarray]], n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sums over rows of sorted keys and ``n`` values."""
    if not parts:
        return np.zeros(0, np.uint64), [np.zeros(0, np.int64)] * n
    cuts = _ranges([p[0] for p in parts], SLICE)
    out = []
    for k in range(len(cuts[0]) - 1):
        keys, *values = _joined([[x[c[k] : c[k + 1]] for x in p] for p, c in zip(parts, cuts, strict=True)])
        keys, values = _summed(keys, *values)
        out.append([keys, *values])
    parts.clear()
    keys, *values = _joined(out)
    return keys, values


def _complete(rows: _Rows, models: int) -> Iterator[pa.RecordBatch]:
    """All that came for a shard → its part of the model, of the statistics and of the toxic words."""
    me, stats = rows[0][1], np.zeros((models, _STATS), np.int64)
    pairs, words, owner = [], [], []
    while rows:
        _, _, kind, data = rows.pop()
        if kind == _TOXIC:
            yield _row(me, me, _TOXIC, data)
            continue
        a = _unpack(data)
        if kind == _OWN:
            stats += a[0].reshape(models, _STATS)
            pairs.append([_sorted_keys(a[1]), a[2], *[np.zeros(len(a[2]), "<u1")] * 4])
        else:
            pairs.append([_sorted_keys(a[0]), np.zeros(len(a[0]), "<u1"), *a[1:5]])
            words.append([_sorted_keys(a[5]), *a[7:]])
            owner.append([_sorted_keys(a[5]), a[6]])
    pair, of_pair = _united(pairs, 5)
    word, of_word = _united(words, 5)
    if len(word):
        m = np.zeros(len(word), np.int64)
        for keys, own in owner:
            m[np.searchsorted(word, keys)] = own
        c1 = of_word[0]
        _count_of_counts(stats, 8, m, c1)
        stats[:, _SUM] += np.bincount(m, weights=c1, minlength=models).astype(np.int64)
        stats[:, _KINDS] += np.bincount(m[c1 > 0], minlength=models)
    yield _row(me, me, _TRIGRAMS, _pack([_deltas(word), *map(_narrow, of_word), _deltas(pair), *map(_narrow, of_pair)]))
    yield _row(me, me, _DOCS, _pack([stats.ravel()]))


# --- the model ----------------------------------------------------------------------------------------------------


class NgramModel:
    """Where the counts are, and what the models need besides them. Small: it is sent with the tasks."""

    def __init__(self, path: str, trigrams: str, shards: int, names: list[str], stats: np.ndarray):
        self.path, self.trigrams, self.shards, self.stats = path, trigrams, shards, stats
        self.number = {x: i for i, x in enumerate(names) if stats[i, _CLEAN] > 0}
        self.toxic = frozenset(x for x in self.number if stats[self.number[x], _BAD] >= LEAST_DOCS)
        #: By order (words, pairs, trigrams), model and count.
        self.discounts = [np.array([_discounts_of(*map(float, r[k : k + 4])) for r in stats]).reshape(-1, 4) for k in (8, 4, 0)]
        d, n1, n2, kinds = self.discounts[0], stats[:, 8], stats[:, 9], stats[:, _KINDS]
        self.total = np.maximum(stats[:, _SUM], 1).astype(float)
        self.unseen = (d[:, 1] * n1 + d[:, 2] * n2 + d[:, 3] * (kinds - n1 - n2)) / self.total / (kinds + 1)

    def name(self, lang: str | None) -> str:
        """The language's own model, or the one that is shared."""
        return (lang or "") if (lang or "") in self.number else POOLED

    def _blobs(self, folder: str) -> list[bytes]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, path = open_filesystem(folder)
        found = [f.path for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
        return [b for f in sorted(found) for b in pq.ParquetFile(store.open_input_file(f)).read(["data"]).column("data").to_pylist()]

    def shard(self, k: int) -> list[tuple[np.ndarray, list[np.ndarray]]]:
        """Sorted keys and counts of the words, pairs and trigrams of a shard; a worker keeps the last one."""
        kept = worker_cache("kn")
        if kept.get("shard", (None,))[0] != (self.path, k):
            kept.pop("shard", None)
            a = [x for b in self._blobs(f"{self.path}/check={_TRIGRAMS}/shard={k}") for x in _unpack(b)] or [np.zeros(0, "<u8")] * 12
            a += [x for b in self._blobs(f"{self.trigrams}/check={_KEPT}/kept={k}") for x in _unpack(b)] or [np.zeros(0, "<u8")] * 2
            kept["shard"] = (self.path, k), [(_sorted_keys(a[i]), a[i + 1 : j]) for i, j in ((0, 6), (6, 12), (12, 14))]
        return kept["shard"][1]

    def lexicon(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes and weights of toxic words."""
        kept = worker_cache("kn")
        if kept.get("lexicon", (None,))[0] != self.path:
            parts = [_unpack(b) for k in range(self.shards) for b in self._blobs(f"{self.path}/check={_TOXIC}/shard={k}")]
            key = np.concatenate([_sorted_keys(p[0]) for p in parts]) if parts else np.zeros(0, np.uint64)
            m, clean, bad = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (1, 2, 3))
            m = m.astype(np.int64)
            weight = np.log10((bad + 0.5) / (self.stats[m, _BAD] + 1) / ((clean + 0.5) / (self.stats[m, _CLEAN] + 1)))
            some = (weight > TOXIC_WEIGHT) & (self.stats[m, _BAD] >= LEAST_DOCS)
            order = np.argsort(key[some])
            kept["lexicon"] = self.path, (key[some][order], weight[some][order])
        return kept["lexicon"][1]

    def answer(self, k: int, asked: list[np.ndarray]) -> list[np.ndarray]:
        """The counts of sorted keys of words, pairs and trigrams in shard ``k``: 0 where there is no such n-gram."""
        out = []
        for (have, counts), ask in zip(self.shard(k), asked, strict=True):
            if not len(have):
                out += [np.zeros(len(ask), "<u1")] * len(counts)
                continue
            at = np.minimum(np.searchsorted(have, ask), len(have) - 1)
            hit = have[at] == ask
            out += [_narrow(np.where(hit, c[at], 0)) for c in counts]
        return out

    def toxicity(self, known: dict[str, int], lang: str, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The weights of the ``TOXIC_TOP`` heaviest distinct words of each text, summed; ``known``: the hash of every word."""
        keys, weights = self.lexicon()
        out, salt = np.zeros(len(first)), _salt(lang) ^ 0x70C1C
        if not len(keys) or not known:
            return out
        bare = np.array([xxhash.xxh64_intdigest((w.strip(_PUNCTUATION) or w).encode("utf-8", "replace"), salt) for w in known], dtype=np.uint64)
        entry = np.minimum(np.searchsorted(keys, bare), len(keys) - 1)
        hit = keys[entry] == bare
        words, entry = np.fromiter(known.values(), np.uint64, len(known))[hit], entry[hit]
        if not len(words):
            return out
        order = np.argsort(words)
        words, entry = words[order], entry[order]
        at = np.minimum(np.searchsorted(words, h), len(words) - 1)
        where = np.flatnonzero(words[at] == h)
        found = np.unique(np.stack([np.searchsorted(first, where, "right") - 1, entry[at[where]]]), axis=1)
        heavy = np.lexsort((-weights[found[1]], found[0]))
        doc, weight = found[0][heavy], weights[found[1]][heavy]
        nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
        np.add.at(out, doc[nth < TOXIC_TOP], weight[nth < TOXIC_TOP])
        return out


class _Grams:
    """Distinct keys of the words, pairs and trigrams of texts in a row, and which of them every place has."""

    def __init__(self, h: np.ndarray, first: np.ndarray, shards: int):
        inner = np.ones(len(h), dtype=bool)
        inner[first] = inner[first + 1] = False
        self.at = np.flatnonzero(inner)
        pair = _mix(h[:-1], h[1:])
        within = np.ones(len(pair), dtype=bool)
        within[first[1:] - 1] = False
        pairs = np.flatnonzero(within)
        self.words, _, self.word = _distinct(_place(h, h, shards))
        self.pairs, _, which = _distinct(_place(pair, pair, shards)[pairs])
        self.pair = np.zeros(len(pair), np.int32)
        self.pair[pairs] = which
        self.trigrams, _, self.trigram = _distinct(_place(_mix(pair[self.at - 2], h[self.at]), pair[self.at - 1], shards))


def _logs(h: np.ndarray, first: np.ndarray, models: np.ndarray, counts: list[np.ndarray], model: NgramModel) -> np.ndarray:
    """log10 probability of each text, given the counts of its n-grams; ``models``: each text's."""
    grams = _Grams(h, first, model.shards)
    of = np.repeat(models.astype(np.int32), np.diff(np.append(first, len(h))))
    d1, d2, d3 = model.discounts

    def of_slice(at: np.ndarray, which: np.ndarray) -> np.ndarray:
        m = of[at]
        some = lambda c, i: c[i].astype(np.int64)
        less = lambda c, d: np.maximum(c - d[m, np.minimum(c, 3)], 0.0)

        def back(counts: list[np.ndarray], i: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            total, n1, n2, n3 = (some(c, i) for c in counts)
            return np.maximum(total, 1), np.where(total > 0, (d[m, 1] * n1 + d[m, 2] * n2 + d[m, 3] * n3) / np.maximum(total, 1), 1.0)

        p = less(some(counts[0], grams.word[at]), d1) / model.total[m] + model.unseen[m]
        total, gamma = back(counts[1:5], grams.word[at - 1], d2)
        p = less(some(counts[5], grams.pair[at - 1]), d2) / total + gamma * p
        total, gamma = back(counts[6:10], grams.pair[at - 2], d3)
        p = less(some(counts[10], which), d3) / total + gamma * p
        return np.log10(np.maximum(p, 1e-30))

    logs = np.zeros(len(h))
    for k in range(0, len(grams.at), SLICE):
        logs[grams.at[k : k + SLICE]] = of_slice(grams.at[k : k + SLICE], grams.trigram[k : k + SLICE])
    return np.add.reduceat(logs, first)


_SCORED = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("lang", pa.string()), ("n_tokens", pa.int64()), ("log10_prob", pa.float64()), ("toxicity", pa.float64())])
_SCORED_DDL = "part int, row long, doc_id long, lang string, n_tokens long, log10_prob double, toxicity double"


def _told(number: int, rows: list[tuple], model: NgramModel) -> Iterator[pa.RecordBatch]:
    """A block of ``(part, row, doc_id, lang, text)``: its n-grams to their shards, and itself with the number of the answers to expect."""
    by: dict[str, list[tuple]] = {}
    for r in rows:
        by.setdefault(model.name(r[3]), []).append(r)
    meta: list[tuple] = []
    parts, firsts, models, begin = [], [], [], 0
    for name, own in by.items():
        if name not in model.number:
            meta += [(*r[:4], len(tokens_of(r[4])) + 1, None, None) for r in own]
    unscored = len(meta)
    for name, own in by.items():
        if name in model.number:
            h, first, words, known = _hashed([r[4] for r in own], _salt(name))
            toxic = model.toxicity(known, name, h, first).tolist() if name in model.toxic else [None] * len(own)
            meta += [(*r[:4], n + 1, None, x) for r, n, x in zip(own, words.tolist(), toxic, strict=True)]
            parts.append(h)
            firsts.append(first + begin)
            models.append(np.full(len(own), model.number[name], np.int64))
            begin += len(h)
    head = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*meta, strict=True), _SCORED, strict=True)], schema=_SCORED).serialize().to_pybytes()
    asks, body = 0, b""
    rows.clear()  # what follows takes several times the texts
    own = by = meta = known = None
    if parts:
        h, first, models = (np.concatenate(x) for x in (parts, firsts, models))
        del parts
        grams = _Grams(h, first, model.shards)
        asked = [grams.words, grams.pairs, grams.trigrams]
        cuts = [_cuts(x, model.shards) for x in asked]
        for s in range(model.shards):
            keys = [x[c[s] : c[s + 1]] for x, c in zip(asked, cuts, strict=True)]
            if any(map(len, keys)):
                yield _row(number, s, 0, _pack([_deltas(x) for x in keys]))
                asks += 1
        del grams, asked
        vocabulary, _, index = _distinct(h)
        body = _pack([first, models, _deltas(vocabulary), _narrow(index)])
    yield _row(number, -1 - (number >> 28) * 64 - number % 64, asks, np.array([unscored, len(head)], "<i8").tobytes() + head + body)


def _scored(data: bytes, replies: list[tuple[int, bytes]], model: NgramModel) -> pa.RecordBatch:
    unscored, size = (int(x) for x in np.frombuffer(data, "<i8", 2))
    batch = pa.ipc.read_record_batch(pa.py_buffer(data[16 : 16 + size]), _SCORED)
    if not replies:
        return batch
    first, models, vocabulary, index = _unpack(data[16 + size :])
    replies.sort(key=lambda r: r[0])
    answers = []
    while replies:
        answers.append(_unpack(replies.pop(0)[1]))
    counts = _joined(answers)
    logs = _logs(_sorted_keys(vocabulary)[index], first, models, counts, model)
    n = batch.column(4).to_pylist()
    both = [None] * unscored + [x if k > 1 else None for x, k in zip(logs.tolist(), n[unscored:], strict=True)]
    return batch.set_column(5, _SCORED.field(5), pa.array(both, pa.float64()))


def _labelled(docs: DataFrame, labels: DataFrame, toxic: bool = False) -> DataFrame:
    """``(doc_id, lang, held_out)`` of trusted documents, or of those that a label calls toxic; narrow columns only."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"), F.count_if(F.col("quality").isNull()).alias("n"))
    good = good.where("t = 1" if toxic else "q = 1 and n = 0 and coalesce(t, 0) = 0").select("doc_id")
    ids = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang")).join(good, "doc_id")
    return ids.select("doc_id", "lang", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("held_out"))


def fit(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> NgramModel:
    """The models of all languages with ``LEAST_DOCS`` training documents at least, and the one of the others; from all training documents."""
    spark = docs.sparkSession
    pool = _labelled(docs, labels).where("not held_out").withColumn("toxic", F.lit(False)).unionAll(_labelled(docs, labels, toxic=True).where("not held_out").withColumn("toxic", F.lit(True)))
    pool = materialize(pool.select("doc_id", "lang", "toxic").distinct(), "kn-pool")
    sizes = [tuple(r) for r in pool.groupBy("lang").agg(F.count_if(~F.col("toxic"))).collect()]  # one short row a language
    names = sorted([lang for lang, good in sizes if good >= LEAST_DOCS] + [POOLED] * any(good < LEAST_DOCS for _, good in sizes))
    number = {x: i for i, x in enumerate(names)}
    models = [(lang, m) for lang, good in sizes for m in ([number[lang]] if good >= LEAST_DOCS else []) + ([number[POOLED]] if POOLED in number else [])]
    trained = pool.join(F.broadcast(spark.createDataFrame(models, "lang string, model int")), "lang")  # a row or two a language
    trained = F.broadcast(trained) if trained.count() <= BROADCAST_IDS else trained
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), "text").join(trained, ["doc_id", "lang"]).select("model", "toxic", "text")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).head()[0]
    shards = max(1, -(-size // shard_bytes))

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("kn")
        number, size, block = TaskContext.get().partitionId() << 28, 0, {}
        for batch in batches:
            for m, toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block.setdefault((m, toxic), []).append(text)
                size += len(text or "") + 1
                if size >= block_bytes:
                    yield from _learned(block, names, shards, number)
                    number, size, block = number + 1, 0, {}
        if block:
            yield from _learned(block, names, shards, number)

    merged = _in_groups(texts.mapInArrow(learned, _ROW_DDL), shards, ["shard"], lambda rows: _merged(rows, shards, len(names)))
    counted, path = shared_path(spark, "kn-trigrams"), shared_path(spark, "kn-model")
    with without_shuffle_files(spark), in_small_batches(spark):
        merged.withColumn("kept", F.when(F.col("check") == _KEPT, F.col("shard")).otherwise(-1)).write.partitionBy("check", "kept").parquet(counted)
        sent = spark.read.schema("block long, shard int, data binary, check long, kept int").parquet(counted).where(F.col("check") != _KEPT).select("block", "shard", "check", "data")
        _in_groups(sent, shards, ["shard"], lambda rows: _complete(rows, len(names))).write.partitionBy("check", "shard").parquet(path)
    for kind in (_OWN, _TOXIC, _OTHERS):  # they are in the model
        discard(f"{counted}/check={kind}")
    stats = np.zeros((len(names), _STATS), np.int64)
    for r in spark.read.schema("block long, data binary, check int, shard int").parquet(path).where(F.col("check") == _DOCS).select("data").toLocalIterator():  # a number or sixteen a model and shard
        stats += _unpack(bytes(r["data"]))[0].reshape(stats.shape)
    return NgramModel(path, counted, shards, names, stats)


def _scored_rows(docs: DataFrame, model: NgramModel, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(part, row, doc_id, lang, n_tokens, log10_prob, toxicity)`` of every row; ``part`` and ``row`` tell it from others."""
    spark = docs.sparkSession
    rows = docs.select(F.spark_partition_id().alias("part"), _row_hash(docs).alias("row"), docs["doc_id"].cast("long").alias("doc_id"), docs["lang"], docs["text"])
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).head()[0]
    rounds = ROUNDS if size >= ROUNDS * block_bytes else 1
    parts = max(1, -(-size // (rounds * block_bytes)))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("kn")
        number, size, block = TaskContext.get().partitionId() << 28, 0, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block.append(r)
                size += len(r[4] or "") + 1
                if size >= block_bytes:
                    yield from _told(number, block, model)
                    number, size, block = number + 1, 0, []
        if block:
            yield from _told(number, block, model)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("kn")
        for batch in batches:
            for i in range(batch.num_rows):
                block, shard, check, data = (c[i].as_py() for c in batch.columns)
                yield _row(block, shard, check, data if shard < 0 else _pack(model.answer(shard, [_sorted_keys(x) for x in _unpack(data)])))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("kn")
        current, whole, replies = None, None, []
        for batch in batches:
            for i in range(batch.num_rows):
                block, shard, check, data = (c[i].as_py() for c in batch.columns)
                if block != current:
                    if whole or replies:
                        raise RuntimeError("answers are missing")
                    current = block
                if shard < 0:
                    whole = check, data
                else:
                    replies.append((shard, data))
                if whole and len(replies) == whole[0]:
                    (_, data), whole = whole, None
                    yield _scored(data, replies, model)
                    replies = []
        if whole or replies:
            raise RuntimeError("answers are missing")

    out = []
    for k in range(rounds):
        some = rows.where(F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.lit(rounds)) == k) if rounds > 1 else rows
        asks = some.mapInArrow(told, _ROW_DDL).repartition(3 * max(model.shards, parts), "shard").sortWithinPartitions("shard")
        with without_shuffle_files(spark), in_small_batches(spark):
            out.append(materialize(asks.mapInArrow(answered, _ROW_DDL).repartition(parts, "block").sortWithinPartitions("block").mapInArrow(scored, _SCORED_DDL), "kn-scores"))
    return reduce(DataFrame.unionAll, out)


def _row_hash(docs: DataFrame):
    """What the verdict on a row goes by, and its id."""
    return F.xxhash64(docs["doc_id"].isNull(), docs["doc_id"], docs["lang"].isNull(), docs["lang"], docs["text"])


def scores(docs: DataFrame, model: NgramModel) -> DataFrame:
    """``(doc_id, lang, n_tokens, log10_prob, toxicity)`` of every row."""
    return _scored_rows(docs, model).drop("part", "row")


def _cross_entropy():
    """log10 of the perplexity; what thresholds compare, as it is the same double in every engine."""
    return -F.col("log10_prob") / F.col("n_tokens")


def _named(model: NgramModel):
    """The name of the model that judges a row."""
    return F.when(F.array_contains(F.array(*[F.lit(x) for x in sorted(model.number)]).cast("array<string>"), F.coalesce("lang", F.lit(""))), F.coalesce("lang", F.lit(""))).otherwise(F.lit(POOLED))


def thresholds(scored: DataFrame, docs: DataFrame, labels: DataFrame, model: NgramModel, quantile: float = QUANTILE) -> dict[str, tuple[float, float | None]]:
    """log10 of the greatest perplexity to keep and the greatest toxicity that is not toxic, by the name of the model."""
    held = _labelled(docs, labels).where("held_out").select("doc_id").distinct()
    found = scored.join(held, "doc_id", "left_semi").where("log10_prob is not null")
    most = lambda c, name: F.percentile_approx(c, quantile, 10_000).alias(name)
    rows = found.groupBy(_named(model).alias("name")).agg(most(_cross_entropy(), "t"), most(F.col("toxicity"), "x"))
    return {r["name"]: (r["t"], r["x"]) for r in rows.collect()}  # one short row a model


def _verdicts(scored: DataFrame, limit: dict[str, tuple[float, float | None]], model: NgramModel) -> DataFrame:
    """``scored`` with perplexity, threshold and verdicts."""
    limits = scored.sparkSession.createDataFrame([(name, *x) for name, x in limit.items()] or [("", None, None)], "__lang string, __limit double, __most double")
    joined = scored.join(F.broadcast(limits), _named(model) == F.col("__lang"), "left")  # one row a model
    keep = (F.col("n_tokens") > 1) & F.coalesce(_cross_entropy() <= F.col("__limit"), F.lit(True))
    power = lambda c: F.pow(F.lit(10.0), c)
    return joined.select("part", "row", "doc_id", "lang", "n_tokens", "log10_prob", power(_cross_entropy()).alias("perplexity"), power(F.col("__limit")).alias("threshold"), keep.alias("keep"), "toxicity", F.coalesce(F.col("toxicity") > F.col("__most"), F.lit(False)).alias("toxic"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``doc_id, lang, n_tokens, log10_prob, perplexity, threshold, keep, toxicity, toxic`` per row of ``docs``.

    ``keep`` is the verdict on quality alone and ``toxic`` the one on toxicity; ``filter_quality`` goes by both. With a model
    of fewer than ``LEAST_DOCS`` toxic training documents toxicity is null and nothing is toxic.
    Defined cases: a text without words (null, empty, white space) is rejected; where no model or no held-out trusted text
    is, rows are kept, with null score or threshold; null lang is the language "" ; repeated rows (ties) are
    scored alike; a very long text is scored whole, in a slice of its own; without labels everything with words is kept;
    an empty table gives no rows; other columns, whatever their names, are ignored.
    """
    model = fit(docs, labels)
    scored = _scored_rows(docs, model)
    return _verdicts(scored, thresholds(scored, docs, labels, model, quantile), model).drop("part", "row")


def filter_quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``docs`` without the rows that are rejected or toxic; all columns, cases as in ``classify``. Texts are not shuffled: a task
    reads the verdicts on its own part of the scan, which must meet the same rows again, as scans of files do."""
    spark = docs.sparkSession
    model = fit(docs, labels)
    scored = _scored_rows(docs, model)
    verdicts = _verdicts(scored, thresholds(scored, docs, labels, model, quantile), model).select("row", (F.col("keep") & ~F.col("toxic")).alias("keep"), "part")
    path = shared_path(spark, "kn-verdicts")
    verdicts.repartition("part").write.partitionBy("part").parquet(path)

    def verdicts_on(part: int) -> dict[int, bool]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, folder = open_filesystem(f"{path}/part={part}")
        found = [f.path for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".parquet")]
        return {r: k for f in found for t in [pq.ParquetFile(store.open_input_file(f)).read(["row", "keep"])] for r, k in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True)}

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdict: dict[int, dict[int, bool]] = {}
        for batch in it:
            part, rows = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
            for p in set(part) - set(verdict):
                verdict[p] = verdicts_on(p)
            try:
                keep = [verdict[p][r] for p, r in zip(part, rows, strict=True)]
            except KeyError:
                raise RuntimeError("the two scans of the documents met other rows; pass a written table") from None
            yield batch.select(range(batch.num_columns - 2)).filter(pa.array(keep, pa.bool_()))

    return docs.select(*[docs[f"`{c}`"] for c in docs.columns], F.spark_partition_id().alias("__part"), _row_hash(docs).alias("__row")).mapInArrow(batches, docs.schema)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all documents; cases as in ``classify``."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
