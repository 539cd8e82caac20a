"""Operator 8, benchmark decontamination: a generalised suffix automaton of the test items.

Words of all items go into one suffix automaton; each document is streamed through it once, word by word, with the
length of the longest match that ends at the word. A match of ``window`` words ends an occurrence of an item's window
(items with fewer words are one window). Documents never move: the benchmark does. It is broadcast while it has at
most ``SHARD_WORDS`` words; above that it is dealt into shards of about that many words in the shared folder and each
task takes its documents through one shard after the other, so the memory of a task is bounded in either case.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomark.llm._common import as_bytes, open_filesystem, shared_path, table, worker_cache

WINDOW = 10
SHARD_WORDS = 100_000
#: Bytes of documents that a task takes through the shards at a time, when there is more than one shard.
SHARD_BATCH_BYTES = 64_000_000

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TO = bytes(b if b in _KEPT else (b + 32 if 0x41 <= b <= 0x5A else 0x20) for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(data: bytes) -> list[bytes]:
    """Words of UTF-8 text: A-Z lower-cased, runs of digits, letters and everything outside ASCII."""
    return data.translate(_TO).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with the items of every window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.ids = [i for i, _ in items]
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.at_window = [0] * len(self.link)  # the state of the suffix of exactly ``window`` words
        for v in by_length:
            if self.length[v] >= window:
                self.at_window[v] = v if self.length[self.link[v]] < window else self.at_window[self.link[v]]
        self.windows: dict[int, set[int]] = {}  # state of a window of full length → items
        self.short: dict[int, list[tuple[int, int]]] = {}  # state → (length, item) of items that are one short window
        self.least = min([window, *(len(w) for _, w in items if w)], default=window)
        for n, (_, words) in enumerate(items):
            if words and len(words) < window:
                state = 0
                for w in words:
                    state = self.next[state][w]
                self.short.setdefault(state, []).append((len(words), n))
            elif words:
                state = depth = 0
                for w in words:
                    state, depth = self.step(state, depth, w)
                    if depth >= window:
                        self.windows.setdefault(self.at_window[state], set()).add(n)
        self.near_short = [0] * len(self.link)  # the state itself or its nearest suffix that is the end of a short item
        if self.short:
            for v in by_length:
                self.near_short[v] = v if v in self.short else self.near_short[self.link[v]]

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, q, w)
        cur = self._new(length[last] + 1, {}, 0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return cur

    def _new(self, length: int, arcs: dict[bytes, int], link: int) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _clone(self, p: int, q: int, w: bytes) -> int:
        copy = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def step(self, state: int, depth: int, w: bytes) -> tuple[int, int]:
        """The state after ``w`` and the length of the longest match that ends there."""
        to = self.next[state].get(w)
        if to is not None:
            return to, depth + 1
        while state:
            state = self.link[state]
            to = self.next[state].get(w)
            if to is not None:
                return to, self.length[state] + 1
        return 0, 0

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """``(hit spans as word ranges, items with occurring windows, longest match)`` of a document."""
        nxt, link, length, least, window = self.next, self.link, self.length, self.least, self.window
        root, near_short = nxt[0], self.near_short
        state = depth = longest = 0
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for i, w in enumerate(words):
            to = nxt[state].get(w)
            if to is not None:
                state, depth = to, depth + 1
            elif w in root:
                while True:
                    state = link[state]
                    to = nxt[state].get(w)
                    if to is not None:
                        state, depth = to, length[state] + 1
                        break
            else:
                state = depth = 0
                continue
            if depth > longest:
                longest = depth
            if depth < least:
                continue
            reach = 0
            if depth >= window:
                reach = window
                items |= self.windows[self.at_window[state]]
            short = near_short[state]
            while short:
                for k, n in self.short[short]:
                    if k <= depth:
                        items.add(n)
                        reach = max(reach, k)
                short = near_short[link[short]]
            if reach:
                start = i + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items, longest


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class _Scanner:
    """Takes documents through the broadcast automaton, or through the shards in turn."""

    def __init__(self, broadcast, shards: list[str], window: int):
        self.broadcast, self.shards, self.window, self.name = broadcast, shards, window, uuid.uuid4().hex

    def automata(self) -> Iterator[SuffixAutomaton]:
        if self.broadcast is not None:
            kept = worker_cache("automata")
            if self.name not in kept:  # once a worker, not once a task
                kept.clear()
                kept[self.name] = SuffixAutomaton(self.broadcast.value, self.window)
            yield kept[self.name]
        for uri in self.shards:
            import pyarrow.parquet as pq

            store, path = open_filesystem(uri)
            found = pq.read_table(path, filesystem=store).to_pydict()
            yield SuffixAutomaton([(i, words_of(t or b"")) for i, t in zip(found["item"], found["text"], strict=True)], self.window)

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str], int]]:
        """Per text: words, merged hit spans, item ids, longest match."""
        if self.broadcast is not None and not self.shards:
            (automaton,) = self.automata()
            ids, out = automaton.ids, []
            for t in texts:
                words = words_of(t)
                spans, items, longest = automaton.scan(words)
                out.append((len(words), spans, {ids[n] for n in items if ids[n] is not None}, longest))
            return out
        out = [[0, [], set(), 0] for _ in texts]
        for automaton in self.automata():
            for row, t in zip(out, texts, strict=True):
                words = words_of(t)
                spans, items, longest = automaton.scan(words)
                row[0] = len(words)
                row[1] += spans
                row[2] |= {automaton.ids[n] for n in items if automaton.ids[n] is not None}
                row[3] = max(row[3], longest)
        return [(n, _merge(s), i, m) for n, s, i, m in out]


def _scanner(benchmark: DataFrame, window: int, shard_words: int) -> _Scanner:
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    # words are at most half of the bytes and one: what is collected below is bounded by the parameter
    total = items.agg(F.coalesce(F.sum(F.length("text") / 2 + 1), F.lit(0))).head()[0]
    if total <= shard_words * 4:
        found = [(r["item"], words_of(bytes(r["text"] or b""))) for r in items.collect()]
        if sum(len(w) for _, w in found) <= shard_words:
            return _Scanner(spark.sparkContext.broadcast(found), [], window)
    path = shared_path(spark, "benchmark-shards")
    items.repartition(max(1, int(total // shard_words))).write.parquet(path)
    names = [r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()]  # one a shard
    return _Scanner(None, sorted(names), window)


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int, shard_words: int, make: Callable, schema) -> DataFrame:
    scanner = _scanner(benchmark, window, shard_words)
    with_bytes = docs.withColumn("__b", F.col("text").cast("binary"))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in it:
            held.append(batch)
            size += batch.nbytes
            if not scanner.shards or size >= SHARD_BATCH_BYTES:
                yield from _flush(held)
                held, size = [], 0
        yield from _flush(held)

    def _flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [as_bytes(b.column(b.schema.names.index("__b")).to_pylist()) for b in held]
        found = iter(scanner.scan([t for part in texts for t in part]))
        for batch, part in zip(held, texts, strict=True):
            yield make(batch, part, [next(found) for _ in part])

    return with_bytes.mapInArrow(batches, schema)


_HITS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("longest_match", pa.int64()), ("spans", pa.list_(pa.int64()))])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per row of ``docs``: word, hit and item counts, the digest of the item ids, longest match and flat hit spans.

    Defined cases: null and empty texts have no words; an item without words has no window; a null item_id marks words but
    is neither counted nor listed, a repeated item_id counts once; an empty benchmark hits nothing; repeated documents
    are reported each; a very long text is streamed word by word; columns other than doc_id and text, whatever their names,
    are ignored.
    """

    def make(batch: pa.RecordBatch, texts: list[bytes], found: list) -> pa.RecordBatch:
        hit = [sum(b - a for a, b in s) for _, s, _, _ in found]
        ids = batch.column(batch.schema.names.index("doc_id")).cast(pa.int64())
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([f[0] for f in found], pa.int64()), pa.array(hit, pa.int64()), pa.array([len(f[2]) for f in found], pa.int64()),
             pa.array([hashlib.sha256(",".join(sorted(f[2])).encode()).hexdigest() for f in found], pa.string()), pa.array([h > 0 for h in hit], pa.bool_()),
             pa.array([f[3] for f in found], pa.int64()), pa.array([[x for s in f[1] for x in s] for f in found], pa.list_(pa.int64()))],
            schema=_HITS,
        )

    return _scanned(docs.select("doc_id", "text"), benchmark, window, shard_words, make, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long, spans array<long>")


def remove_spans(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``data`` without the given word ranges, and without the space that a cut leaves double."""
    at = [m.span() for m in _WORD.finditer(data)]
    out, last = [], 0
    for a, b in spans:
        start, end = at[a][0], at[b - 1][1]
        if end < len(data) and data[end : end + 1] in (b" ", b"\n") and (start == 0 or data[start - 1 : start] in (b" ", b"\n")):
            end += 1
        out.append(data[last:start])
        last = end
    return b"".join([*out, data[last:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with every hit span cut out; a document with more than ``max_coverage`` of its words hit goes altogether.

    All columns stay; ``n_chars``, if there, follows a changed text. Rows without a hit are returned as they are, null and empty
    texts too; repeated rows are treated alike; an empty table gives no rows. Columns ``__b``, ``__new``, ``__changed`` are dropped.
    """
    docs = docs.drop("__b", "__new", "__changed")
    columns = docs.columns
    counted = "n_chars" in columns

    def make(batch: pa.RecordBatch, texts: list[bytes], found: list) -> pa.RecordBatch:
        keep, changed, out = [], [], []
        for t, (n, spans, _, _) in zip(texts, found, strict=True):
            hit = sum(b - a for a, b in spans)
            keep.append(hit <= max_coverage * n)
            changed.append(hit > 0)
            out.append(remove_spans(t, spans).decode("utf-8", "replace") if hit and keep[-1] else None)
        arrays = [pa.array(out, pa.string()), pa.array(changed, pa.bool_())]
        whole = pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], schema=pa.schema([*list(batch.schema)[:-1], ("__new", pa.string()), ("__changed", pa.bool_())]))
        return whole.filter(pa.array(keep, pa.bool_()))

    schema = T.StructType([*docs.schema.fields, T.StructField("__new", T.StringType()), T.StructField("__changed", T.BooleanType())])
    scanned = _scanned(docs, benchmark, window, shard_words, make, schema)
    text = F.when(F.col("__changed"), F.col("__new")).otherwise(F.col("text"))
    cols = {"text": text} | ({"n_chars": F.when(F.col("__changed"), F.char_length("__new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if counted else {})
    return scanned.select(*[cols[c].alias(c) if c in cols else F.col(f"`{c}`") for c in columns])


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all documents; cases as in ``contamination``."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("longest_match", "spans")


#: Windows of all items joined with windows of all documents, by their words.
OP8_SQL = r"""
WITH item AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
win AS (SELECT DISTINCT item_id, len(g) AS k, array_to_string(g, ' ') AS g FROM (
  SELECT item_id, CASE WHEN len(w) < 10 THEN w ELSE list_slice(w, s, s + 9) END AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT k FROM win),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM doc),
hit AS (
  SELECT d.doc_id, d.s, v.k, v.item_id
  FROM (SELECT doc_id, s, z.k, array_to_string(list_slice(w, s, s + z.k - 1), ' ') AS g FROM pos JOIN sizes z ON s + z.k - 1 <= len(w)) d JOIN win v ON v.k = d.k AND v.g = d.g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, s, k FROM hit)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
