"""Operator 2, best-fit packing: vector best-fit of tokenised pieces into sequences.

Tokenising is the scan; it needs no shuffle. Texts are cut at white space, over which the tokenizer's patterns never
reach, and a worker keeps the ids of the white-space chunks it has met. Pieces then go, dealt evenly whatever their
keys, to groups of ``group`` pieces; each group is packed on its own. A group holds thousands of sequences, so that
the last, partly filled ones of every group hardly count, and its size does not grow with the input.

Within a group pieces come in order of decreasing size. Each goes to the open sequence that can hold it under all
three capacities (tokens, documents, attention cost = sum of squared lengths) and scores best: by the least weighted
norm of what is left after it (``norm``), or by the greatest weighted dot product of piece and room (``dot``).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomark.llm._common import materialize, partitions_for, table, worker_cache

MAX_TOKENS = 2048
EOS = 0
GROUP = 20_000
#: Documents of a sequence, and what tokens, documents and attention cost that are left free weigh.
MAX_DOCS = 128
WEIGHTS = (1.0, 0.3, 0.1)
CACHE_ENTRIES = 700_000
CACHE_CHUNK = 64

#: What str.split() takes for white space and the tokenizer does not, or may not.
_ODD_SPACE = re.compile("[\x1c-\x1f\u180e]")
#: A run of these at the end of a word is one pre-token.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words that are encoded in one call; texts that are split at a time, in characters.
_CALL, _SLICE = 2_000, 2_000_000


class ChunkTokenizer:
    """A word-level BPE tokenizer file with a bounded cache of white-space chunks; ids as little-endian uint32 bytes.

    The tokenizer drops white space, lower-cases, and encodes runs of letters on their own. So a chunk that is a word, or a
    word and punctuation, is put together from the ids of both, and new words are encoded many in one call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, words: list[str]) -> None:
        """Ids of words that are letters only: one pre-token each, in the order in which they stand."""
        for at in range(0, len(words), _CALL):
            part = words[at : at + _CALL]
            (e,) = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(e.ids, dtype="<u4")
            bounds = ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
            if len(bounds) != len(part):  # a word of several pre-tokens
                self.cache.update(zip(part, self._ids(part), strict=True))
                continue
            raw = ids.tobytes()
            self.cache.update(zip(part, [raw[i:j] for i, j in zip([0, *bounds], bounds, strict=False)], strict=True))

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of new chunks; those too long for the cache are returned instead."""
        cache, forms, words, whole = self.cache, [], {}, []
        # most new chunks are words in lower case that stand for themselves: the tokenizer changes nothing in them
        plain = [c for c in chunks if c.islower() and c.isalpha() and len(c) <= CACHE_CHUNK and (c.isascii() or max(c) < "\u0250")]
        self._learn_words(plain)
        for c in set(chunks).difference(plain):
            body = c.rstrip(_MARKS)
            if len(c) <= CACHE_CHUNK and body.isalpha():
                tail = c[len(body) :]
                if body.isascii() or max(body) < "\u0250" and "\u0130" not in body:  # one to one and normal, before and after
                    body = body.lower()
                elif tail:  # lower-casing may add marks that join the punctuation
                    whole.append(c)
                    continue
                forms.append((c, body, tail))
                if body not in cache:
                    words[body] = None
            else:
                whole.append(c)
        self._learn_words(list(words))
        ids = dict(zip(whole, self._ids(whole), strict=True))
        cache.update((c, b) for c, b in ids.items() if len(c) <= CACHE_CHUNK)
        marks = list({tail for _, _, tail in forms if tail})
        ends = {"": b"", **dict(zip(marks, self._ids(marks), strict=True))}
        cache.update((c, cache[body] + ends[tail]) for c, body, tail in forms)
        return ids

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size < _SLICE):
                size += len(texts[upto])
                upto += 1
            if len(self.cache) > CACHE_ENTRIES:
                self.cache.clear()
            cache = self.cache
            split = [None if _ODD_SPACE.search(t) else t.split() for t in texts[at:upto]]
            new = set().union(*[s for s in split if s]).difference(cache)
            ids = self._learn(list(new))
            for t, s in zip(texts[at:upto], split, strict=True):
                if s is None:
                    yield self._ids([t])[0]
                else:
                    try:
                        yield b"".join(map(cache.__getitem__, s))
                    except KeyError:
                        yield b"".join([cache[c] if c in cache else ids[c] for c in s])
            at = upto

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))


def tokenizer(path: str) -> ChunkTokenizer:
    kept = worker_cache("tokenizers")
    if path not in kept:
        kept[path] = ChunkTokenizer(path)
    return kept[path]


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
PIECE_DDL = "doc_id long, piece int, start long, length long, ids binary"


def tokenize_pieces(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = MAX_TOKENS, eos: int = EOS) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: token ids (little-endian uint32) of every text and ``eos``, cut only if longer
    than ``max_tokens``. A null text is the empty text, one token; a very long one is encoded whole and cut afterwards; repeated
    rows give pieces each; columns other than doc_id and text, whatever their names, are ignored. No shuffle."""
    path = tokenizer_path or default_tokenizer_path()
    end = np.array([eos], dtype="<u4").tobytes()
    width = 4 * max_tokens

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode_all
        for batch in it:
            cols: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids += end
                for n, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    for c, v in zip(cols, (doc_id, n, at // 4, len(part) // 4, part), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECE, strict=True)], schema=_PIECE)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(batches, PIECE_DDL)


def best_fit(lengths: np.ndarray, max_tokens: int, max_docs: int, max_cost: int, weights: tuple[float, float, float], criterion: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of every length; no capacity of any bin is exceeded. Lengths over the capacities raise."""
    n = len(lengths)
    lengths = lengths.astype(np.int64)
    capacity = np.array([max_tokens, max_docs, max_cost], dtype=np.float64)
    if n and (lengths.max() > max_tokens or int(lengths.max()) ** 2 > max_cost or max_docs < 1):
        raise ValueError("a piece exceeds the capacities of an empty sequence")
    w = np.array(weights, dtype=np.float64)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min()) if n else 0
    room = np.zeros((3, 1024))  # residuals of the open bins, as shares of the capacities
    name = np.zeros(1024, dtype=np.int64)
    used = np.zeros(max(n, 1), dtype=np.int64)
    count = total = 0
    for i in order.tolist():
        size = int(lengths[i])
        need = np.array([size, 1, size * size]) / capacity
        at = -1
        if count:
            left = room[:, :count] - need[:, None]
            fits = left.min(axis=0) >= -1e-12
            if fits.any():
                score = (w[:, None] * left * left).sum(axis=0) if criterion == "norm" else -((w * need)[:, None] * room[:, :count]).sum(axis=0)
                score[~fits] = np.inf
                at = int(score.argmin())
        if at < 0:
            if count == room.shape[1]:
                room, name = np.concatenate([room, np.zeros_like(room)], axis=1), np.concatenate([name, np.zeros_like(name)])
            at, count = count, count + 1
            room[:, at], name[at] = 1.0, total
            total += 1
        bins[i], offsets[i] = name[at], used[name[at]]
        used[name[at]] += size
        room[:, at] -= need
        if room[0, at] * max_tokens < least - 1e-6 or room[1, at] * max_docs < 1 - 1e-6:  # nothing can follow: closed
            count -= 1
            room[:, at], name[at] = room[:, count], name[count]
    return bins, offsets


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, max_docs: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS, criterion: str = "norm", group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id long`` and ``offset long``; every other column is carried along (ids too, if given).

    ``pieces`` is read twice and must give the same rows each time: pass a written table. Without ``max_docs`` and
    ``max_cost`` these capacities are those that ``max_tokens`` implies. Equal rows (ties) are packed each, in any order; columns
    of the names ``sequence_id`` and ``offset`` are replaced; a piece that exceeds a capacity raises; no rows: no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    docs, cost = max_docs or max_tokens, max_cost or max_tokens**2
    n = partitions_for(pieces.sparkSession, pieces.count(), group, 1)

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker_cache("packing")
        frames = [f for f in it if len(f)]
        if not frames:
            return
        rows = pd.concat(frames, ignore_index=True)
        bins, offsets = best_fit(rows["length"].to_numpy(), max_tokens, docs, cost, weights, criterion)
        yield rows.assign(sequence_id=bins + (TaskContext.get().partitionId() << 32), offset=offsets)

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return pieces.repartition(n).mapInPandas(batches, schema)


def pack_digests(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = MAX_TOKENS, group: int = GROUP) -> DataFrame:
    """Placement of every piece, with the CRC of its ids in their place; ids leave the scan as four bytes a piece."""
    pieces = tokenize_pieces(docs, tokenizer_path, max_tokens)
    narrow = materialize(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(narrow, max_tokens, min(MAX_DOCS, max_tokens), group=group)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed; cases as in ``tokenize_pieces`` and ``pack``."""
    return pack_digests(table(spark, sf_dir, "documents"))
