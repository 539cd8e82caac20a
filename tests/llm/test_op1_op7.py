import collections
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronomark.llm import simhash as sh
from chronomark.llm import substring_dedup as sd
from chronomark.llm.components import connected_components
from tests.llm import _docs


def _components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(b)] = find(a)
    return [find(i) for i in range(n)]


def _simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_classes_against_brute_force(spark):
    rows = _docs.rows()
    got = sh.simhash_classes(_docs.frame(spark)).collect()
    fps = [_simhash(r[1]) for r in rows]
    roots = _components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2])
    least = {}
    for r, root in zip(rows, roots, strict=True):
        if r[0] is not None:
            least[root] = min(r[0], least.get(root, r[0]))
    want = sorted((str(r[0]), fp, least[root]) for r, fp, root in zip(rows, fps, roots, strict=True))
    assert sorted((str(r["doc_id"]), r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got) == want


def test_spark_hash_is_the_same(spark):
    row = spark.createDataFrame([("an été ok",)], "s string").select(F.xxhash64("s").alias("h")).first()
    assert row["h"] & (1 << 64) - 1 == xxhash.xxh64_intdigest("an été ok".encode(), 42)


def _near(n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(n // 6)]
    out = set(base)
    while len(out) < n:
        x = rng.choice(base)
        for _ in range(rng.randint(0, 3)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return np.array(sorted(out), dtype=np.uint64)


def test_trie_links_find_every_pair(spark, monkeypatch):
    for n, seed, split, group in ((400, 1, 200_000, 4096), (400, 2, 20, 4096), (400, 3, 200_000, 8), (400, 4, 20, 64)):
        monkeypatch.setattr(sh, "GROUP", group)
        fp = _near(n, seed)
        df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
        links = sh.fingerprint_links(df, n, split_above=split).collect()
        at = {int(x): i for i, x in enumerate(fp.view(np.int64))}
        assert all(bin((r["u"] ^ r["v"]) & (1 << 64) - 1).count("1") >= 1 for r in links)
        want = _components(n, [(i, j) for i in range(n) for j in np.flatnonzero(np.bitwise_count(fp[:i] ^ fp[i]) <= 2)])
        got = _components(n, [(at[r["u"]], at[r["v"]]) for r in links])
        assert len(set(zip(want, got, strict=True))) == len(set(want)) == len(set(got))


@pytest.mark.parametrize("budget", [0, 1, 2, 5])
def test_near_fingerprints_share_a_trie(budget):
    rng = random.Random(3)
    a = np.array([rng.getrandbits(64) for _ in range(500)], dtype=np.uint64)
    b = a.copy()
    for _ in range(budget):
        b ^= np.array([1 << rng.randrange(64) for _ in a], dtype=np.uint64)
    for bits in (0, 4, 64 // (budget + 1)):
        assert (sh.node_keys(a, bits, budget) == sh.node_keys(b, bits, budget)).any(axis=0).all()


@pytest.mark.parametrize("budget", [0, 2, 7])
def test_walk_against_all_pairs(budget):
    fp = np.sort(np.concatenate([_near(300, 5), _near(200, 6)]))
    fp = np.unique(fp)
    want = {(i, int(j)) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= budget) if i < j}
    for front in (500_000, 50):
        got = [(int(x), int(y)) for i, j in sh.trie_pairs(fp, np.array([0]), np.array([len(fp)]), budget, front) for x, y in zip(np.minimum(i, j), np.maximum(i, j), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_keep_one_per_class(spark):
    docs = _docs.frame(spark)
    kept = sh.keep_one_per_class(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) == sh.simhash_classes(docs).select("component_id").distinct().count()
    assert sh.keep_one_per_class(_docs.empty(spark)).count() == sh.simhash_classes(_docs.empty(spark)).count() == 0


def test_components_of_chains_stars_and_noise(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5), (7, None), (2000, 2001), (2001, 2000)]
    df = spark.createDataFrame(edges, "u long, v long")
    for finish in (0, 200_000):
        groups = collections.defaultdict(set)
        for r in connected_components(df, finish_edges=finish).collect():
            groups[r["root"]].add(r["node"])
        assert sorted(map(len, groups.values())) == [2, 200, 301]


def _passages(n_docs, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvwz") for _ in range(rng.randint(3, 8)))
    line = lambda k: " ".join(word() for _ in range(k))
    docs = [[line(rng.randint(20, 80)) for _ in range(3)] for _ in range(n_docs)]
    shared, near = line(60), line(70)
    changed = near.split()
    changed[30] = "zzz"
    docs[2][1] = docs[2][1] + " " + shared + " " + line(30)  # inside paragraphs
    docs[7][0] = line(40) + " " + shared
    docs[9].append(near)
    docs[11].insert(0, " ".join(changed))
    docs[15] = docs[15] + docs[15]  # repeats itself only
    return [(i, "\n".join(d)) for i, d in enumerate(docs)]


def test_repeated_passages(spark):
    rows = [*_passages(40, 4), (40, None), (41, ""), (None, "a b c"), (42, "x " * 30_000)]
    got = {r["doc_id"]: r for r in sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {2, 7, 9, 11}
    assert got[2]["n_removed"] == got[9]["n_removed"] == 0 < got[2]["n_repeated"]
    assert 25 <= got[7]["n_removed"] <= 60 and got[7]["first_docs"] == [2]
    assert got[11]["n_removed"] == 70 and got[11]["first_docs"] == [9]


def test_large_bucket_of_near_copies(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefghik") for _ in range(6)) for _ in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(120)] = f"w{i}"
        rows.append((i, " ".join(w)))
    got = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == set(range(60))
    assert sum(r["n_removed"] > 0 for r in got) == 59


def test_unlike_tails_stay_linked(spark):
    """A text of many copies leads; what is like a member of its group, but not like it, is in the component too."""
    base = [f"base{i}" for i in range(94)]
    rows = [(i, " ".join([*base, *[f"lead{k}" for k in range(10)]])) for i in range(60)]
    rows += [(60, " ".join(base))] + [(100 + i, " ".join([*base, *[f"u{i}x{k}" for k in range(20)]])) for i in range(50)]
    got = sd.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == {r[0] for r in rows} and {r["first_doc"] for r in got} == {0}


def test_every_passage_of_fifty_words_has_a_window(spark):
    """Of words that start no window by their own hash, in the middle of lines."""
    words = [w for i in range(4_000) if xxhash.xxh64_intdigest((w := f"q{i}").encode(), 5) & 3]
    rng = random.Random(6)
    rows = []
    for i in range(20):
        shared = rng.sample(words, 50)
        rows += [(2 * i + k, " ".join([*rng.sample(words, 40), *shared, *rng.sample(words, 40)])) for k in range(2)]
    got = {r["doc_id"]: r for r in sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {r[0] for r in rows} and all(got[2 * i + 1]["first_docs"] == [2 * i] for i in range(20))
    x = np.array([rng.getrandbits(64) for _ in range(90)], dtype=np.uint64)
    assert all((sd._sliding(np.minimum, x, w) == [x[i : i + w].min() for i in range(91 - w)]).all() for w in (1, 2, 5, 26))


def _set(words):
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def _similar(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def _variants(rng, n_words, n, edits, prefix):
    base = [f"{prefix}{k}" for k in range(n_words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(n_words)] = f"{prefix}e{i}{rng.randrange(1000)}"
        out.append(w)
    return out


@pytest.mark.parametrize("small", [False, True])
def test_links_against_brute_force(spark, monkeypatch, small):
    """Components of paragraphs by the operator and by all pairs: variants, form letters, chains, singles; blocks of a few sets too."""
    if small:
        monkeypatch.setattr(sd, "BLOCK_SHINGLES", 900)
        monkeypatch.setattr(sd, "STRAY_SHINGLES", 300)
        monkeypatch.setattr(sd, "MOST_BLOCKS", 4)
        monkeypatch.setattr(sd, "STAR_ROUNDS", 1)
    rng = random.Random(12)
    texts = _variants(rng, 120, 70, 4, "a") + _variants(rng, 90, 60, 2, "b")
    head = [f"h{k}" for k in range(50)]
    texts += [head + [f"f{i}x{k}" for k in range(rng.randint(5, 40))] for i in range(50)]
    texts += [[f"c{k}" for k in range(i * 6, i * 6 + 100)] for i in range(12)]  # a chain: only neighbours are similar
    texts += [[f"s{i}x{k}" for k in range(40)] for i in range(20)]
    sets = sorted({_set(t) for t in texts}, key=sorted)
    hashes = {}
    for t in texts:
        (h, x), *_ = sd._unit_sets([" ".join(t).encode()])
        hashes[_set(t)] = h - (1 << 64) if h >> 63 else h
    five = {h: np.unique(x) for t in texts for h, x in [next(iter(sd._unit_sets([" ".join(t).encode()])))]}
    keys = {}
    for t in texts:
        w = sd.Words([" ".join(t).encode()])
        keys[hashes[_set(t)]] = w.units()[3][: sd.BANDS].view(np.int64).tolist()
    rows = [(k, h, 1 + h % 3) for h, ks in keys.items() for k in ks]
    members = spark.createDataFrame(rows, "key long, hash long, times long")
    shared = members.groupBy("key").count().where("count > 1").select("key")
    found = spark.createDataFrame([(h - (1 << 64) if h >> 63 else h, x.tobytes()) for h, x in five.items()], "hash long, shingles binary")
    links = sd.similar_links(members.join(shared, "key"), found).collect()
    at = {hashes[s]: i for i, s in enumerate(sets)}
    band = {i: set(keys[hashes[s]]) for i, s in enumerate(sets)}
    true = [(i, j) for i in range(len(sets)) for j in range(i) if _similar(sets[i], sets[j])]
    collide = [(i, j) for i, j in true if band[i] & band[j]]
    assert len(collide) >= 0.97 * len(true) > 200
    assert all(_similar(sets[at[r["u"]]], sets[at[r["v"]]]) for r in links)
    got, want = _components(len(sets), [(at[r["u"]], at[r["v"]]) for r in links]), _components(len(sets), collide)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))
    assert len(links) < 6 * len(sets)


def test_recall_of_passages_by_length(spark):
    """Passages between other words: all of 50 words and more; shorter ones as the README says."""
    rng = random.Random(3)
    rows, spans = [], {}
    for n, length in enumerate([*[25] * 40, *[32] * 40, *[40] * 40, *[50] * 40, *[70] * 40]):
        shared = [f"p{n}w{rng.randrange(10**6)}" for _ in range(length)]
        for k in range(2):
            around = [[f"r{rng.randrange(10**9)}" for _ in range(rng.randint(30, 60))] for _ in range(2)]
            rows.append((2 * n + k, " ".join([*around[0], *shared, *around[1]])))
            spans[2 * n + k] = length
    got = {r["doc_id"] for r in sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    share = {x: sum(d in got for d, y in spans.items() if x == y) / 80 for x in (25, 32, 40, 50, 70)}
    print("recall by words of a passage:", share)
    assert share[50] == share[70] == 1 and share[40] > 0.5 and share[32] > 0.2


def test_paragraphs_and_contents():
    text = b"\n".join([b"a " * 10, b"b " * 10, b"c " * 9, b"", b"d " * 30, b"e " * 24])
    w = sd.Words([text, b"", b"z " * 24, b"y " * 25])
    a, b = w.paragraphs()
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == [(0, 29), (29, 59), (107, 132)]
    x = np.arange(10, dtype=np.uint64) * np.uint64(7919)
    h = sd.contents(np.concatenate([x, x[::-1], x]), np.array([0, 10, 20]), np.array([10, 20, 30]))
    assert h[0] == h[2] != h[1]
    y = np.concatenate([x, [np.uint64(5)], x])
    assert (sd.contents(y, np.array([0, 11]), np.array([10, 21])) == sd.contents(x, np.array([0]), np.array([10]))).all()
    k = sd.band_keys(y, np.array([0, 11]), np.array([10, 21]), sd._MULTIPLIERS)
    assert (k[:, 0] == k[:, 1]).all() and len(set(k[:, 0].tolist())) == sd.BANDS


def test_no_documents(spark):
    assert sd.repeated_passages(_docs.empty(spark)).count() == 0
    got = {r["doc_id"]: r for r in sd.repeated_passages(_docs.frame(spark)).collect()}
    assert {4, 62, 63, 3, None} <= set(got) and not {60, 61, 64, 65, 0} & set(got)  # equal texts, upper case; null, empty, blank and one's own repeats
    assert got[62]["first_docs"] == got[63]["first_docs"] == got[4]["first_docs"] and got[4]["n_removed"] == 0
