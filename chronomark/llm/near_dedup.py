"""Near copies for the pipeline: documents that SimHash links, and those whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash is op 7's: its fingerprints, linked at its budget of differing bits by its trie walk. By calculation (not measured) two
fingerprints differ in some ten of 64 bits at a similarity of 0.8, three more or less being common, so this budget alone
loses most such pairs and a wider one would compare everything. So pairs that share one of nine bands of two minima, which
99.99 % of the pairs at 0.8 do, are verified by the exact similarity of their shingles and linked too; classes are the components of
both kinds of links. Equal shingle lists are one entry before anything is compared; large groups are linked as in op 1.

Words are those of op 7: white-space tokens, A-Z lowered. A text of fewer than five words is one shingle, no words too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronomark.llm._common import as_bytes, keep_named_rows, materialize, worker_cache
from chronomark.llm.components import connected_components
from chronomark.llm.quality import _mix
from chronomark.llm.simhash import fingerprint_links, simhash
from chronomark.llm.substring_dedup import ROWS, SHINGLE, SLICE_BYTES, Words, band_keys, contents, multipliers, shingle_sets, similar_links

BANDS = 9

_MULTIPLIERS = multipliers(b"document", BANDS * ROWS)


def _ranges(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(shingles, first and last of each text, order)``: the texts of five words or more, then the others, which have one shingle each."""
    words = Words(texts, strip=b"")
    a, b = words.doc[:-1], words.doc[1:]
    long = b - a >= SHINGLE
    shingles, ones = words.grams(SHINGLE), []
    for i in np.flatnonzero(~long).tolist():
        one = np.array([b[i] - a[i]], dtype=np.uint64)
        for k in range(a[i], b[i]):
            one = _mix(one, words.hash[k : k + 1])
        ones.append(one)
    at = len(shingles) + np.arange(len(ones))
    order = np.concatenate([np.flatnonzero(long), np.flatnonzero(~long)])
    return np.concatenate([shingles, *ones]), np.concatenate([a[long], at]), np.concatenate([b[long] - SHINGLE + 1, at + 1]), order


def _sets(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    shingles, a, b, _ = _ranges(texts)
    return ((h, shingles[i:j]) for h, i, j in zip(contents(shingles, a, b).tolist(), a.tolist(), b.tolist(), strict=True))


_DDL = "doc_id long, text_hash long, fp long, hash long, keys array<long>"


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_cache("near")
    for batch in batches:
        texts, at = as_bytes(batch.column(2).to_pylist()), 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and size < SLICE_BYTES:
                size += len(texts[upto])
                upto += 1
            shingles, a, b, order = _ranges(texts[at:upto])
            hashes, keys = np.empty(upto - at, np.uint64), np.empty((upto - at, BANDS), np.uint64)
            hashes[order], keys[order] = contents(shingles, a, b), band_keys(shingles, a, b, _MULTIPLIERS).T
            lists = pa.ListArray.from_arrays(pa.array(np.arange(upto - at + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, upto - at).cast(pa.int64()), batch.column(1).slice(at, upto - at), pa.array([simhash(t) for t in texts[at:upto]], pa.int64()), pa.array(hashes.view(np.int64)), lists], names=["doc_id", "text_hash", "fp", "hash", "keys"])
            at = upto


def simhash_links(distinct: DataFrame) -> DataFrame:
    """``distinct(hash, fp)`` → ``(u, v)``: entries of one class of fingerprints, each with the least of them."""
    fps = materialize(distinct.select("fp").distinct(), "near-fp")
    roots = connected_components(fingerprint_links(fps, fps.count())).select(F.col("node").alias("fp"), F.col("root").alias("fp_root"))
    rooted = materialize(distinct.select("hash", "fp").join(roots, "fp", "left").select("hash", F.coalesce("fp_root", "fp").alias("fp_root")), "near-fp-roots")
    least = rooted.groupBy("fp_root").agg(F.min("hash").alias("v"))
    return rooted.join(least, "fp_root").where("hash <> v").select(F.col("hash").alias("u"), "v")


def near_classes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, text_hash, rep_id, rep_hash``; ``rep_id, rep_hash`` name the row of the class that stays.

    Least doc_id, null last, then least text hash. Null text is the empty text; texts without words are one class. A very
    long text is compared whole. Repeated rows are of one class, an empty table gives no rows, other columns are ignored.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("b")).mapInArrow(_banded, _DDL)
    rows = materialize(rows, "near-bands")
    rank = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("id"), F.col("text_hash").alias("h"))
    distinct = materialize(rows.groupBy("hash").agg(F.min(rank).alias("rep"), F.count("*").alias("times"), F.any_value("keys").alias("keys"), F.any_value("fp").alias("fp")), "near-distinct")
    keyed = distinct.select(F.explode("keys").alias("key"), "hash", "times")
    shared = materialize(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "near-keys")
    members = materialize(keyed.join(shared, "key"), "near-members")
    wanted = distinct.join(members.select("hash").distinct(), "hash", "left_semi").select("hash", F.col("rep.id").alias("doc_id"))
    sets = materialize(shingle_sets(docs, wanted, _sets), "near-sets")
    roots = connected_components(similar_links(members, sets).unionByName(simhash_links(distinct))).withColumnRenamed("node", "hash")
    named = materialize(distinct.select("hash", "rep").join(roots, "hash", "left").withColumn("root", F.coalesce("root", "hash")), "near-roots")
    classes = named.drop("rep").join(named.groupBy("root").agg(F.min("rep").alias("rep")), "root")
    return rows.select("doc_id", "text_hash", "hash").join(classes, "hash").select("doc_id", "text_hash", F.col("rep.id").alias("rep_id"), F.col("rep.h").alias("rep_hash"))


def keep_one_near_copy(docs: DataFrame) -> DataFrame:
    """``docs`` without near copies: of each class the row named by ``rep_id, rep_hash`` stays, once, with all its columns."""
    return keep_named_rows(docs, near_classes(docs))
