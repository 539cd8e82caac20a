import random

import numpy as np

import corpus_pipeline as cp
from chronomark.llm import simhash
from tests.llm import _docs
from tests.llm.test_op1_op7 import _components


def _shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def _edited(seed):
    rng = random.Random(seed)
    rows = _docs.rows()
    for i, (_, t, *_) in enumerate(rows[:30]):
        w = t.split()
        for k in range(4):
            v = list(w)
            for _ in range(max(1, len(v) // 60) if k < 2 else len(v) // 20):
                v[rng.randrange(len(v))] = f"x{i}y{k}"
            rows.append((1000 + 10 * i + k, " ".join(v), "en", "s", 0, 1, "k", 2))
    return rows


def test_stage_against_brute_force(spark):
    rows = _edited(5)
    sets = [_shingles(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    fps = [simhash.simhash((r[1] or "").encode()) & (1 << 64) - 1 for r in rows]
    assert np.median([bin(fps[i] ^ fps[j]).count("1") for i, j in links if sets[i] != sets[j]]) > 2
    least = {}
    for r, root in zip(rows, _components(len(rows), links), strict=True):
        if r[0] is not None:
            least[root] = min(r[0], least.get(root, r[0]))
    docs = spark.createDataFrame(rows, _docs.SCHEMA)
    kept = cp.simhash_near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())
    assert cp.simhash_near_dedup(spark, _docs.empty(spark), "").count() == 0


def test_stage_links_fingerprints(spark):
    """Texts whose fingerprints are two bits apart or fewer and whose shingles are unlike: one of them stays, and what is like either goes too."""
    line = "the same few words of one line over and over again "
    a, b = line * 30 + "alpha beta gamma delta", line * 12 + "one two three four five six seven"
    other = " ".join(f"w{i}" for i in range(60))
    rows = [(7, a, "en", "s", 0, 1, "k", 2), (8, b, "en", "s", 0, 1, "k", 2), (9, other, "en", "s", 0, 1, "k", 2), (10, a + " epsilon", "en", "s", 0, 1, "k", 2)]
    assert bin((simhash.simhash(a.encode()) ^ simhash.simhash(b.encode())) & (1 << 64) - 1).count("1") <= 2
    assert len(_shingles(a) & _shingles(b)) < 0.8 * len(_shingles(a) | _shingles(b))
    kept = cp.simhash_near_dedup(spark, spark.createDataFrame(rows, _docs.SCHEMA), "").collect()
    assert sorted(r["doc_id"] for r in kept) == [7, 9]


def test_stage_keeps_no_two_of_a_simhash_class(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = [r["doc_id"] for r in cp.simhash_near_dedup(spark, docs, "").select("doc_id").collect()]
    classes = {r["doc_id"]: r["component_id"] for r in simhash.simhash_classes(docs).select("doc_id", "component_id").collect()}
    assert len({classes[i] for i in kept}) == len(kept)
