"""Operator 10, LM scoring: a weighted backoff automaton learned from the corpus itself.

The model grows with the corpus, so no task holds it. Documents are taken in blocks of about ``BLOCK_BYTES`` of text,
in the order in which the scan meets them. A block sends the distinct n-grams that it has, packed as sorted keys
with the counts in its training documents, to the shards of a key range. A shard adds the counts up over
all blocks and sends each block the corpus counts of just the n-grams that the block asked for. With these a block has
every state and arc of the automaton that its own documents can reach, and walks it.

The automaton: a state for every context of up to ``order`` - 1 words seen in training; from a state an arc for every
word seen after it, weighing log10((c(hw) + mu p(w | shorter h)) / (c(h) + mu)); a failure arc to the state of the
shorter context, weighing log10(mu / (c(h) + mu)); at the root an arc for every word, log10((c(w) + 1) / (N + V + 1)), unseen
words included. Probabilities of all words after a context sum to one (Dirichlet smoothing, one ``mu`` an order). A traversal
goes from left to right: it carries the state, follows failure arcs until there is an arc for the next word, and adds
up what the arcs weigh. All documents of a block are walked abreast, in lanes of ``LANE`` words: the lanes of a long document
begin ``order`` - 1 words early at the root, which brings them into the state that the whole document would carry.

The exchange: a block sends to at most ``FANOUT`` key ranges. Where there are more shards, the rows of as many blocks as there are
ranges are merged range by range, and the merged rows divided among as many finer ranges, level by level, until a range is a
shard; answers go the same way back. All levels divide by the same number, the least that does, so that a merge meets a block or
two of n-grams however many shards there are. A level has at most blocks times ``FANOUT`` rows, and their number grows with the
input, not with its square. What blocks send is made anew for the way back, not kept: it is twice the input.
Words are told apart by 64 bits; longer n-grams by their shard and 40 bits more, so that two of a shard are
confused with a probability of some 1 in 500,000 at any size of the corpus.

A frequent word or n-gram is one entry a block, however often it occurs, so there are no hot keys. Both passes over the
documents must meet the same rows in the same order, which scans of files do; a checksum of every block tells if not.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronomark.llm._common import _mix, as_bytes, materialize, table, without_shuffle_files, worker_cache

ORDER = 3
#: Smoothing of contexts of one word, of two and so on; the last one holds for longer ones too.
MU = (800.0, 5.0)
BLOCK_BYTES = 6_000_000
SHARD_BYTES = 16_000_000
FANOUT = 64
LANE = 256
HELD_OUT = 2
FOLDS = 7

_U = np.uint64
_START, _END = xxhash.xxh64_intdigest(b" <s>", 3), xxhash.xxh64_intdigest(b" </s>", 3)
_KEY_BITS = 40


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


# --- packing ------------------------------------------------------------------------------------------------------


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays as byte planes, compressed; sorted keys are passed as differences."""
    out = []
    for a in arrays:
        body = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() if len(a) else b""
        out.append(np.array([len(a), a.itemsize, ord(a.dtype.kind)], "<i8").tobytes() + body)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(raw):
        n, size, kind = (int(x) for x in np.frombuffer(raw, "<i8", 3, at))
        at += 24
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<{chr(kind)}{size}") if n else np.zeros(0, f"<{chr(kind)}{size}"))
        at += n * size
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and which one every place has."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(keys) else np.zeros(0, bool)
    inverse = np.empty(len(keys), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    return ranked[new], order[new], inverse


def _deltas(sorted_: np.ndarray) -> np.ndarray:
    return np.diff(sorted_, prepend=_U(0)) if len(sorted_) else sorted_


# --- blocks -------------------------------------------------------------------------------------------------------


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(shards)) >> _U(32)


class Block:
    """Documents as positions in a vocabulary that is sorted by hash; every document is start, words, end."""

    def __init__(self, ids: list[int | None], sizes: np.ndarray, words: np.ndarray, vocabulary: np.ndarray):
        self.ids, self.sizes, self.words, self.vocabulary = ids, sizes, words, vocabulary
        self.first = np.cumsum(sizes) - sizes
        self.check = zlib.crc32(vocabulary.tobytes(), zlib.crc32(sizes.tobytes()))

    @classmethod
    def of(cls, ids: list[int | None], texts: list[bytes]) -> Block:
        known: dict[bytes, int] = {}
        get, out, sizes = known.setdefault, [], []
        for t in texts:
            words = t.lower().split()
            out.append(0)
            out.extend([get(w, len(known) + 2) for w in words])
            out.append(1)
            sizes.append(len(words) + 2)
        digest = xxhash.xxh64_intdigest
        hashes = np.array([_START, _END, *[digest(w, 3) for w in known]], dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(len(order), dtype=np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        return cls(ids, np.array(sizes, dtype=np.int64), rank[np.array(out, dtype=np.int64)], hashes[order])

    def packed(self) -> bytes:
        return _pack([np.array([-1 if i is None else i for i in self.ids], "<i8"), np.array([i is None for i in self.ids], "<u1"), self.sizes.astype("<i4"), self.words.astype("<i4"), _deltas(self.vocabulary)])

    @classmethod
    def unpacked(cls, data: bytes) -> Block:
        ids, none, sizes, words, deltas = _unpack(data)
        return cls([None if z else i for i, z in zip(ids.tolist(), none.tolist(), strict=True)], sizes.astype(np.int64), words, np.cumsum(deltas, dtype=np.uint64))

    def _keys(self, order: int, shards: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For n of 2 and more: the positions that have an n-gram, and its key."""
        n = len(self.words)
        h = gram = self.vocabulary[self.words]
        has = np.ones(n, dtype=bool)
        for k in range(2, order + 1):
            gram = np.concatenate(([_U(0)], _mix(gram[:-1], h[1:])))
            at = self.first + (k - 2)
            has[at[(at < n) & (self.sizes > k - 2)]] = False
            own = np.flatnonzero(has)
            yield own, (_shard_of(gram[own], shards) << _U(_KEY_BITS)) | (gram[own] & _U((1 << _KEY_BITS) - 1))

    def counted(self, order: int, shards: int, learn: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each n: sorted distinct n-gram keys, and how often training documents have them (0 without ``learn``)."""
        train = self.training() & learn
        yield self.vocabulary, np.bincount(self.words[train], minlength=len(self.vocabulary)).astype("<u4")
        for own, keys in self._keys(order, shards):
            learned = np.sort(keys[train[own]])
            keys = np.sort(keys)
            keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
            yield keys, np.diff(np.searchsorted(learned, np.append(keys, ~_U(0)))).astype("<u4") if learn else np.zeros(len(keys), "<u4")

    def grams(self, order: int, shards: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each n: sorted distinct n-gram keys, a position of each, and the one at each position (-1: none)."""
        n = len(self.words)
        place = np.empty(len(self.vocabulary), np.int64)
        place[self.words] = np.arange(n)
        yield self.vocabulary, place, self.words
        for own, keys in self._keys(order, shards):
            distinct, place, inverse = _distinct(keys)
            where = np.full(n, -1, dtype=np.int32)
            where[own] = inverse
            yield distinct, own[place], where

    def training(self) -> np.ndarray:
        """Positions of training documents."""
        return np.repeat(np.array([not held_out(i) for i in self.ids], dtype=bool), self.sizes)


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[int, Block]]:
    """Blocks of a partition; their numbers follow from the place in the scan only."""
    ids: list[int | None] = []
    texts: list[bytes] = []
    size, number = 0, TaskContext.get().partitionId() << 28
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1).to_pylist()), strict=True):
            ids.append(i)
            texts.append(t)
            size += len(t) + 1
            if size >= block_bytes:
                yield number, Block.of(ids, texts)
                ids, texts, size, number = [], [], 0, number + 1
    if ids:
        yield number, Block.of(ids, texts)


# --- the exchange -------------------------------------------------------------------------------------------------

_ROW = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("check", pa.int64()), ("data", pa.binary())])
_ROW_DDL = "block long, shard int, check long, data binary"
_Rows = list[tuple[int, int, int, bytes]]
_OTHER_ROWS = "two scans of the documents met other rows; pass a written table"


def _row(block: int, shard: int, check: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([shard], pa.int32()), pa.array([check], pa.int64()), pa.array([data], pa.binary())], schema=_ROW)


def _in_groups(rows: DataFrame, parts: int, keys: list[str], of: Callable[[_Rows], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``of(rows)`` for the rows that agree in ``keys``."""
    at = [rows.columns.index(k) for k in keys]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("lm")
        held: _Rows = []
        for batch in it:
            for i in range(batch.num_rows):  # one by one: a batch can hold all rows of several groups
                row = tuple(c[i].as_py() for c in batch.columns)
                if held and [row[k] for k in at] != [held[0][k] for k in at]:
                    yield from of(held)
                    held = []
                held.append(row)
        if held:
            yield from of(held)

    return rows.repartition(3 * parts, *keys).sortWithinPartitions(*keys).mapInArrow(batches, _ROW_DDL)


def _written(rows: DataFrame, name: str) -> DataFrame:
    with without_shuffle_files(rows.sparkSession):
        return materialize(rows, name)


class Exchange:
    """How n-gram counts get from blocks to shards and back; small, it is sent with the tasks."""

    def __init__(self, order: int, shards: int, blocks: int, fanout: int):
        self.order, self.shards, self.fanout = order, shards, 1
        self.levels = 1
        while fanout**self.levels < shards:
            self.levels += 1
        while self.fanout**self.levels < shards:  # as even as it can be: few wide ranges would have many blocks whole
            self.fanout += 1
        self.groups = [max(1, -(-blocks // self.fanout**k)) for k in range(self.levels + 1)]

    def ranges(self, level: int) -> int:
        return -(-self.shards // self._width(level))

    def _width(self, level: int) -> int:
        """Shards of a range."""
        return self.fanout ** (self.levels - level)

    def _cuts(self, k: int, keys: np.ndarray, level: int, first: int, last: int) -> np.ndarray:
        shard = _shard_of(keys, self.shards) if k == 0 else keys >> _U(_KEY_BITS)
        return np.searchsorted(shard, np.arange(first, last + 1, dtype=np.uint64) * _U(self._width(level)))

    def divided(self, block: int, level: int, first: int, last: int, keys: Sequence[np.ndarray], counts: Sequence[np.ndarray], check: int) -> Iterator[pa.RecordBatch]:
        """A row for each of the ranges ``first..last`` of a level."""
        cuts = [self._cuts(k, x, level, first, last) for k, x in enumerate(keys)]
        for r in range(last - first):
            arrays = []
            for x, c, cut in zip(keys, counts, cuts, strict=True):
                arrays += [_deltas(x[cut[r] : cut[r + 1]]), c[cut[r] : cut[r + 1]]]
            yield _row(block, first + r, check, _pack(arrays))

    def _asked(self, rows: _Rows) -> list[list[np.ndarray]]:
        return [[np.cumsum(a, dtype=np.uint64) if i % 2 == 0 else a for i, a in enumerate(_unpack(r[3]))] for r in rows]

    def _merged(self, asked: list[list[np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, summed counts, and the key of every entry. The entries of ``k`` in ``asked`` are given up."""
        keys = self._taken(asked, 2 * k)
        distinct, _, inverse = _distinct(keys)
        del keys
        total = np.bincount(inverse, weights=self._taken(asked, 2 * k + 1), minlength=len(distinct)).astype("<u8")
        return distinct, total, inverse

    @staticmethod
    def _taken(asked: list[list[np.ndarray]], i: int) -> np.ndarray:
        whole = np.concatenate([a[i] for a in asked])
        for a in asked:
            a[i] = a[i][:0].copy()
        return whole

    def _sizes(self, asked: list[list[np.ndarray]]) -> list[np.ndarray]:
        """By order, where the entries of each row begin; taken before ``_merged``."""
        return [np.cumsum([0, *[len(a[2 * k]) for a in asked]]) for k in range(self.order)]

    def merge(self, rows: _Rows, level: int) -> Iterator[pa.RecordBatch]:
        """Rows of several blocks in one range → their sum, divided among the ranges of the next level."""
        asked = self._asked(rows)
        merged = [self._merged(asked, k)[:2] for k in range(self.order)]
        first = rows[0][1] * self.fanout
        yield from self.divided(rows[0][4], level + 1, first, min(first + self.fanout, self.ranges(level + 1)), [m[0] for m in merged], [m[1] for m in merged], self._together(rows))

    @staticmethod
    def _together(rows: _Rows) -> int:
        """A checksum of blocks, whatever their order."""
        return zlib.crc32(repr(sorted((r[0], r[2]) for r in rows)).encode())

    def _replies(self, rows: _Rows, sizes: list[np.ndarray], totals: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """``totals``: by order, the corpus counts and the key of every entry."""
        for i, (block, shard, check, *_) in enumerate(rows):
            yield _row(block, shard, check, _pack([total[inverse[s[i] : s[i + 1]]] for (total, inverse), s in zip(totals, sizes, strict=True)]))

    def answer(self, rows: _Rows) -> Iterator[pa.RecordBatch]:
        """Corpus counts for every row of a shard; and one row with the tokens and types here."""
        asked = self._asked(rows)
        sizes, totals, real = self._sizes(asked), [], np.zeros(0)
        for k in range(self.order):
            distinct, total, inverse = self._merged(asked, k)
            totals.append((total, inverse))
            real = total[distinct != _U(_START)] if k == 0 else real
            del distinct
        yield from self._replies(rows, sizes, totals)
        yield _row(-1, rows[0][1], int(real.sum()), np.array([(real > 0).sum()], "<i8").tobytes())

    def pass_on(self, rows: _Rows) -> Iterator[pa.RecordBatch]:
        """Rows that were merged, and the answers to the ranges that they were divided into (by place) → answers to each."""
        asking = sorted((r for r in rows if r[5] < 0), key=lambda r: r[0])
        answers = sorted((r for r in rows if r[5] >= 0), key=lambda r: r[5])
        if not answers or any(r[2] != self._together(asking) for r in answers):
            raise RuntimeError(_OTHER_ROWS)
        asked = self._asked(asking)
        sizes = self._sizes(asked)
        counts = [_unpack(r[3]) for r in answers]
        yield from self._replies(asking, sizes, [(np.concatenate([c[k] for c in counts]), _distinct(self._taken(asked, 2 * k))[2]) for k in range(self.order)])

    def corpus_counts(self, asks: DataFrame, again: DataFrame) -> DataFrame:
        """What blocks send (level 1) → a row with corpus counts for each, and one a shard with its tokens and types (block -1).

        With more than one level, ``again`` makes the same rows for the way back; its counts are not read."""
        parent = lambda level: F.pmod(F.xxhash64("block"), F.lit(self.groups[level]))
        levels = []
        for level in range(1, self.levels):
            asks = asks.withColumn("parent", parent(level))
            asks = asks if level == 1 else _written(asks, f"lm-asks-{level}")
            levels.append(again.withColumn("parent", parent(level)) if level == 1 else asks)
            asks = _in_groups(asks, max(1, self.groups[level] * self.ranges(level)), ["parent", "shard"], lambda rows, level=level: self.merge(rows, level))
        found = _written(_in_groups(asks, self.shards, ["shard"], self.answer), "lm-counts")
        totals = found.where("block = -1")
        for level in range(self.levels - 1, 0, -1):
            up = found.where("block >= 0").select("block", F.floor(F.col("shard") / self.fanout).cast("int").alias("shard"), "check", "data", F.col("block").alias("parent"), F.col("shard").alias("place"))
            both = levels[level - 1].withColumn("place", F.lit(-1)).unionByName(up)
            found = _written(_in_groups(both, max(1, self.groups[level] * self.ranges(level)), ["parent", "shard"], self.pass_on), f"lm-counts-{level}")
        return found if self.levels == 1 else found.unionAll(totals)


# --- the automaton ------------------------------------------------------------------------------------------------


class Automaton:
    """The states, arcs and failure arcs that the documents of one block can reach.

    State 0 is the root; then come the contexts of one word, of two and so on that training has. ``count`` is c(h) of a state,
    ``length`` its words, ``fail`` and ``fail_weight`` its failure arc. An arc has ``arc_from``, ``arc_word``, ``arc_weight``, ``arc_to``; ``root_weight``
    and ``root_to`` are the root's arcs, one for every word. ``arc_at`` names, by the length of the state, the arc that the word at
    a position of the block would take from there (-1: none), so that a walk need not search.
    """

    def __init__(self, block: Block, counts: list[np.ndarray], shards: int, tokens: int, types: int, mu: tuple[float, ...]):
        self.block, self.words, self.order = block, len(block.vocabulary), len(counts)
        smooth = lambda k: mu[min(k, len(mu)) - 1]  # noqa: E731  of contexts of k words
        self.known = counts[0] > 0
        counted, fails, weights, lengths = [np.zeros(1)], [np.zeros(1, np.int32)], [np.zeros(1)], [np.zeros(1, np.int8)]
        none = np.zeros(0, np.int32)
        source, label, weight, target = [none], [none], [np.zeros(0)], [none]
        self.arc_at: list[np.ndarray] = [none]
        states, arcs = 1, 0
        where_, p_, state_, c_ = none, none, none, none  # of the n-grams that are a word shorter
        for k, (distinct, place, where) in enumerate(block.grams(self.order, shards), start=1):
            c = counts[k - 1].astype(np.float64)
            seen = np.flatnonzero(c > 0)
            state = np.zeros(len(distinct), np.int32)  # of the n-gram as a context; 0: none
            if k < self.order:
                state[seen] = states + np.arange(len(seen))
                states += len(seen)
                counted.append(c[seen])
                weights.append(np.log10(smooth(k) / (c[seen] + smooth(k))))
                lengths.append(np.full(len(seen), k, np.int8))
            if k == 1:
                p = (c + 1.0) / (tokens + types + 1.0)
                self.root_weight, self.root_to = np.log10(p), state
                if k < self.order:
                    fails.append(np.zeros(len(seen), np.int32))
            else:
                at = place[seen]
                shorter, context = where_[at], where_[at - 1]
                p = np.zeros(len(distinct))
                p[seen] = (c[seen] + smooth(k - 1) * p_[shorter]) / (c_[context] + smooth(k - 1))
                source.append(state_[context])
                label.append(block.words[at])
                weight.append(np.log10(p[seen]))
                target.append(state[seen] if k < self.order else state_[shorter])
                if k < self.order:
                    fails.append(state_[shorter])
                arc = np.full(len(distinct) + 1, -1, np.int32)  # the last one is that of positions without an n-gram
                arc[seen] = arcs + np.arange(len(seen))
                arcs += len(seen)
                self.arc_at.append(arc[where])
            where_, p_, state_, c_ = where, p, state, c
        self.count, self.fail, self.fail_weight, self.length = (np.concatenate(x) for x in (counted, fails, weights, lengths))
        self.arc_from, self.arc_word, self.arc_weight, self.arc_to = (np.concatenate(x) for x in (source, label, weight, target))

    def step(self, state: int, word: int) -> tuple[int, float]:
        """The state after one more word, and the word's log10 probability: failure arcs until there is an arc."""
        if not hasattr(self, "arcs"):
            self.arcs = {(s, w): i for i, (s, w) in enumerate(zip(self.arc_from.tolist(), self.arc_word.tolist(), strict=True))}
        weight = 0.0
        while state:
            if (arc := self.arcs.get((state, word))) is not None:
                return int(self.arc_to[arc]), weight + float(self.arc_weight[arc])
            weight += float(self.fail_weight[state])
            state = int(self.fail[state])
        return int(self.root_to[word]), weight + float(self.root_weight[word])

    def _steps(self, state: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``step`` for many states, each with the word at its position."""
        weight, to, length = np.zeros(len(state)), np.empty(len(state), np.int32), self.length[state]
        left = np.arange(len(state))
        for k in range(self.order - 1, 0, -1):
            here = left[length == k]
            arc = self.arc_at[k][at[here]]
            hit = arc >= 0
            done, miss = here[hit], here[~hit]
            weight[done] += self.arc_weight[arc[hit]]
            to[done] = self.arc_to[arc[hit]]
            weight[miss] += self.fail_weight[state[miss]]
            state[miss] = self.fail[state[miss]]
            length[miss] = k - 1
            length[done] = -1
        root = left[length == 0]
        word = self.block.words[at[root]]
        weight[root] += self.root_weight[word]
        to[root] = self.root_to[word]
        return to, weight

    def walk(self, lane: int = LANE) -> np.ndarray:
        """log10 probability of the word at every position (0 at starts); all documents are walked abreast, long ones in lanes."""
        block, out = self.block, np.zeros(len(self.block.words))
        lanes = -(-block.sizes // lane)
        own = np.repeat(np.arange(len(lanes)), lanes)
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = block.first[own] + nth * lane
        stop = np.minimum(first + lane, (block.first + block.sizes)[own])
        at = np.maximum(first - (self.order - 1), block.first[own])
        state = np.zeros(len(at), np.int32)
        for _ in range(lane + self.order - 1):
            live = at < stop
            if not live.all():
                at, first, stop, state = at[live], first[live], stop[live], state[live]
            if not len(at):
                break
            state, weight = self._steps(state, at)
            counts = at >= first
            out[at[counts]] = weight[counts]
            at = at + 1
        out[block.first] = 0.0
        return out

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known tokens, base score and score of every document."""
        block = self.block
        skip = np.zeros(len(block.words), dtype=bool)
        skip[block.first] = True
        known = np.add.reduceat(np.where(skip, False, self.known[block.words]).astype(np.int64), block.first)
        base = np.add.reduceat(np.where(skip, 0.0, self.root_weight[block.words]), block.first)
        return known, base, np.add.reduceat(self.walk(), block.first)


_SCORE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
SCORE_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(data: bytes, check: int, replies: dict[int, tuple[int, bytes]], exchange: Exchange, tokens: int, types: int, mu: tuple[float, ...]) -> pa.RecordBatch:
    block = Block.unpacked(data)
    if len(replies) != exchange.ranges(1) or any(c != check for c, _ in replies.values()):
        raise RuntimeError(_OTHER_ROWS)
    answered = [_unpack(replies[s][1]) for s in sorted(replies)]
    counts = [np.concatenate([a[k] for a in answered]) for k in range(exchange.order)]
    known, base, score = Automaton(block, counts, exchange.shards, tokens, types, mu).scores()
    held = [held_out(i) for i in block.ids]
    return pa.RecordBatch.from_arrays([pa.array(block.ids, pa.int64()), pa.array(held), pa.array(block.sizes - 1), pa.array(known), pa.array(np.full(len(held), tokens)), pa.array(base), pa.array(score)], schema=_SCORE)


def lm_scores(docs: DataFrame, order: int = ORDER, mu: tuple[float, ...] | float = MU, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Defined cases: null text is the empty text, one token; a null doc_id trains; repeated rows count each (a tie has no
    meaning here); without training rows N = V = 0 and every token has probability one; a very long text is a block of its
    own, walked in lanes; an empty table gives no rows; other columns, whatever their names, are ignored.
    """
    mu = (float(mu),) if isinstance(mu, (int, float)) else tuple(mu)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).head()[0]
    parts = max(1, -(-size // block_bytes))
    exchange = Exchange(order, max(1, -(-size // shard_bytes)), parts, fanout)

    def ask(batches: Iterator[pa.RecordBatch], learn: bool = True) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches, block_bytes):
            keys, counts = zip(*block.counted(order, exchange.shards, learn), strict=True)
            yield from exchange.divided(number, 1, 0, exchange.ranges(1), keys, counts, block.check)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches, block_bytes):
            yield _row(number, -1, block.check, block.packed())

    answers = exchange.corpus_counts(rows.mapInArrow(ask, _ROW_DDL), rows.mapInArrow(lambda batches: ask(batches, learn=False), _ROW_DDL))
    tokens = types = 0
    for r in answers.where("block = -1").select("check", "data").toLocalIterator():  # one short row a shard
        tokens, types = tokens + r["check"], types + int(np.frombuffer(bytes(r["data"]), "<i8")[0])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, tuple[int, bytes]] = {}
        replies: dict[int, dict[int, tuple[int, bytes]]] = {}
        for batch in batches:
            for block, shard, check, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard < 0:
                    texts[block] = check, data
                else:
                    replies.setdefault(block, {})[shard] = check, data
                if block in texts and len(replies.get(block, ())) == exchange.ranges(1):
                    check, data = texts.pop(block)
                    yield _score(data, check, replies.pop(block), exchange, tokens, types, mu)
        for block, (check, data) in texts.items():
            yield _score(data, check, replies.get(block, {}), exchange, tokens, types, mu)

    told = rows.mapInArrow(tell, _ROW_DDL)
    return told.unionAll(answers.where("block >= 0")).repartition(parts, "block").mapInArrow(score, SCORE_DDL)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; cases as in ``lm_scores``."""
    return lm_scores(table(spark, sf_dir, "documents"))
