import hashlib
import math
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from chronomark.llm import chat_format, decontaminate, lm_scoring, multiset_hash, warc
from chronomark.llm._common import open_filesystem, shared_path
from tests.llm import _docs


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_chat_windows_read_back(spark):
    rng = random.Random(5)
    pool = ["<|t|>", "<|x|>", "<|e|>", "\\", "<", "[", "|", "s>", "</s>", "[INST]", "<\\|", "<<SYS>>", "a", "é", "\n", "😀", "<end_of_turn>", " word"]
    rows = []
    for c in range(40):
        for k in range(rng.choice([1, 2, 5, 40])):
            text = rng.choice([None, ""]) if rng.random() < 0.1 else "".join(rng.choice(pool) for _ in range(rng.choice([3, 20, 300])))
            rows.append((c, k, "system" if k == 0 and c % 2 else rng.choice(["user", "assistant", "tool<|x|>", None]), text, "x"))
    rows += [(None, 0, "user", "lost", "x"), (50, 1, "user", "tie", "x"), (50, 1, "user", "tie", "x"), (50, None, "assistant", "first", "x"), (51, 0, "system", "only", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    windows = chat_format.format_windows(df, 200, 40)
    want, by = {}, {}
    for c, t, r, x, _ in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    for c, ts in by.items():
        ts.sort()
        loss = "".join(x for *_, r, x in ts if r == "assistant")
        want[c] = (len(ts), sha("".join(f"{r}\n{x}\n" for *_, r, x in ts)), len(loss), sha(loss))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_format.conversation_digests(windows).collect()}
    assert got == want
    for w in windows.collect():
        assert w["cost"] <= 200 or w["formatted"].removeprefix("<|t|>system").count("<|t|>") == 1
        assert w["window"] == 0 or w["conv_id"] not in {c for c, ts in by.items() if ts[0][2] == "system"} or w["formatted"].startswith("<|r|>system<|x|>")
    assert chat_format.format_windows(df.limit(0)).count() == 0


def test_fingerprints_of_edits(spark):
    rows = [(r[0], r[1]) for r in _docs.rows() if r[0] is not None]
    rows = list(dict(rows).items())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, key=lambda r: -r[0])
    want = {}
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        want[d] = (len(t), sha(t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]))
    for size, most in ((1024, 1 << 13), (5, 1 << 13), (3, 4)):
        got = multiset_hash.fingerprints_with_edits(docs, size, most).collect()
        assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want
        fp = {r["doc_id"]: r for r in got}
        assert all(fp[a]["near_next"] == 1 for a, b in zip([o[0] for o in order], [o[0] for o in order][1:], strict=False) if dict(rows)[a] == dict(rows)[b])
        assert sum(r["near_edited"] for r in got) > 3 * sum(r["near_next"] for r in got)


def test_fingerprints_are_homomorphic(spark):
    texts = spark.createDataFrame([(0, "a b. c\nd e"), (1, "d e\na b. c"), (2, "a b. c"), (3, "d e"), (4, "a b. c\nd e\nd e"), (5, None), (6, "")], "doc_id long, text string")
    lanes = {r["doc_id"]: r["lanes"] for r in multiset_hash.vectors(texts, ["doc_id"]).collect()}
    assert lanes[0] == lanes[1] != lanes[4] and lanes[5] == lanes[6] == [0] * multiset_hash.LANES
    both = spark.createDataFrame([(lanes[2], lanes[3], lanes[4])], "a array<long>, b array<long>, c array<long>")
    r = both.select(multiset_hash.add(F.col("a"), F.col("b")).alias("s"), multiset_hash.add(F.col("c"), F.col("b"), -1).alias("d"), multiset_hash.lanes_of(multiset_hash.fingerprint(F.col("c"))).alias("back")).first()
    mod = lambda v: [x % (1 << 32) if i < 4 else x for i, x in enumerate(v)]
    assert mod(r["s"]) == lanes[0] == mod(r["d"]) and r["back"] == lanes[4]


def _lanes(text):
    """Strong lanes, clauses and sign counts, one by one."""
    def h(seed, s):
        x = xxhash.xxh64_intdigest(seed if isinstance(seed, bytes) else seed.to_bytes(4, "little"), 42)
        return xxhash.xxh64_intdigest(s.encode(), x)

    strong, signs, n = [0] * 4, [[0] * 64, [0] * 64], 0
    for p in (text or "").split("\n"):
        if p.strip(" "):
            for lane in range(4):
                strong[lane] = (strong[lane] + (h(lane // 2, p) >> 32 * (lane % 2) & 0xFFFFFFFF)) % (1 << 32)
        for c in regex.split(r"[^\p{L}\p{N}\p{M} ']+", p):
            if c := c.strip(" ").lower():
                n += 1
                for s in (0, 1):
                    x = h(b"c%d" % s, c)
                    for b in range(64):
                        signs[s][b] += x >> b & 1
    return strong, n, signs


def test_lanes_and_likeness_against_brute_force(spark):
    rng = random.Random(8)
    line = lambda: ", ".join(" ".join(rng.choice(["a", "be", "it's", "Été", "9"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 5)))
    texts = ["\n".join(line() for _ in range(k)) for k in (1, 2, 3, 200)] + [None, "", " \n.", "a. " * 70_000]
    pairs = [(i, j, texts[i], texts[j]) for i in range(len(texts)) for j in (0, 3, 5, 7)]
    a, b = multiset_hash.lanes(F.col("x")), multiset_hash.lanes(F.col("y"))
    df = spark.createDataFrame(pairs, "i int, j int, x string, y string").select("i", "j", a.alias("a"), b.alias("b")).select("*", multiset_hash.likeness(F.col("a"), F.col("b")).alias("like"))
    want = [_lanes(t) for t in texts]
    for r in df.collect():
        strong, n, signs = want[r["i"]]
        assert r["a"][:4] == strong and r["a"][4] == n
        for s in (0, 1):
            got = r["a"][5 + 32 * s : 37 + 32 * s]
            assert sorted([x & 0xFFFFFFFF for x in got] + [x >> 32 for x in got]) == sorted(signs[s])
        va, vb = ([2 * c - m for part in sg for c in part] for _, m, sg in (want[r["i"]], want[r["j"]]))
        whole = sum(x * x for x in va) + sum(x * x for x in vb)
        like = max(0.0, 1 - sum((x - y) ** 2 for x, y in zip(va, vb, strict=True)) / whole) if whole else 1.0
        assert abs(r["like"] - like) < 1e-9


def test_fingerprint_corner_cases(spark):
    for rows in ([], [(1, "a")], [(None, "x"), (3, "y"), (3, "y"), (3, None)]):
        assert multiset_hash.fingerprints_with_edits(spark.createDataFrame(rows, "doc_id long, text string"), 2).count() == len(rows)
    assert multiset_hash.fingerprints_with_edits(_docs.frame(spark), 7).count() == len(_docs.rows())


PAGES = [(1, "u", "x" * 200), (2, "v", "x" * 200), (3, None, None), (4, "w\r\nX: 1", "short"), (5, "w", "short"), (None, "n", "x" * 200), (2, "v", "x" * 200), (6, "é", "é" * 100), (7, "z", "\r\n\r\n" * 80)]


@pytest.mark.parametrize("zip64", [False, True])
def test_archives_round_trip(spark, zip64):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("path", F.lit("clash"))
    packages = warc.write_archives(warc.record_types(df), shared_path(spark, "w"), package_bytes=400, zip64=zip64)
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"], r["payload"] and bytes(r["payload"]).decode()) for r in warc.read_archives(packages, 2).collect())
    want = []
    for p, _, h in PAGES:
        b, revisit = len((h or "").encode()), h == "x" * 200 and p != 1
        want.append((str(p), "revisit" if revisit else "response", 1 if revisit else None, b, None if revisit else (h or "")))
    assert [tuple(x or "" if i == 4 else x for i, x in enumerate(r)) for r in got] == [tuple(x or "" if i == 4 else x for i, x in enumerate(r)) for r in sorted(want, key=lambda r: (r[0], r[1]))]
    for r in packages.collect():
        _, path = open_filesystem(r["path"])
        z = zipfile.ZipFile(path)
        assert z.testzip() is None and set(z.namelist()) == {warc.WARC_MEMBER, warc.INDEX_MEMBER}
    assert warc.read_archives(warc.write_archives(warc.record_types(df.limit(0)), shared_path(spark, "w"))).count() == 0


def test_zip_reader_on_foreign_files(tmp_path):
    path = tmp_path / "z.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"PK\x05\x06 in a comment"
        z.writestr("a/é.txt", b"hello")
        z.writestr(zipfile.ZipInfo("deflated"), b"x" * 99, zipfile.ZIP_DEFLATED)
        with z.open("big", "w", force_zip64=True) as f:
            f.write(b"zip64")
    with pa.OSFile(str(path)) as f:
        members = warc.zip_members(f, f.size())
        assert set(members) == {"a/é.txt", "big"} and f.read_at(members["big"][1], members["big"][0]) == b"zip64"
    for bad in (b"", b"PK", path.read_bytes()[:-30]):
        with pytest.raises(ValueError):
            warc.zip_members(pa.BufferReader(bad), len(bad))


def _contamination(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)):
            if w:
                windows.setdefault(tuple(w[k : k + window]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    ids |= windows[g] - {None}
        out.append((str(d), len(w), len(hit), len(ids), sha(",".join(sorted(map(str, ids)))), bool(hit)))
    return sorted(out)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = ["a", "b", "cc", "dé", "e1"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.choice([3, 8, 12, 25]))) for i in range(12)] + [(90, None), (91, "!!"), (None, some(14)), (3, some(11))]
    docs = [(i, some(60) + ". " + (rng.choice(items)[1] or "") + "\n" + some(20)) for i in range(30)] + [(50, None), (51, ""), (None, items[3][1]), (50, items[2][1])]
    d = spark.createDataFrame([(i, t, "en", "s", 0, 0, "", 0) for i, t in docs], _docs.SCHEMA)
    b = spark.createDataFrame(items, "item_id long, text string")
    for shard in (100_000, 30):
        got = decontaminate.contamination(d, b, shard_words=shard).collect()
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got) == _contamination(docs, items)
    assert decontaminate.contamination(d, b.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(d.limit(0), b).count() == 0


def test_automaton_of_repeated_words_is_linear():
    import time

    def took(n):
        t = time.perf_counter()
        one = decontaminate.SuffixAutomaton([("a", [b"x"] * n), ("b", [b"x"] * 3), ("c", [b"x"] * 2)])
        spans, items, longest = one.scan([b"x"] * n)
        assert spans == [(0, n)] and items == {0, 1, 2} and longest == n
        return time.perf_counter() - t

    took(1_000)
    assert took(32_000) < 12 * took(8_000)


def test_decontaminate_cuts_and_keeps(spark):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"One two three. {item.upper()}! " + "four " * 20 + "end"), (2, item), (3, "clean text stays, as it is"), (4, None)]
    d = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0, "", 0) for i, t in rows], _docs.SCHEMA)
    out = {r["doc_id"]: r for r in decontaminate.decontaminate(d, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert set(out) == {1, 3, 4} and out[3]["text"] == rows[2][1] and out[4]["text"] is None
    assert "W5" not in out[1]["text"] and out[1]["text"].startswith("One two three. ") and out[1]["n_chars"] == len(out[1]["text"])


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_against_brute_force(spark, order):
    rows = _docs.rows()
    d = _docs.frame(spark)
    texts = [(r[0], [w for w in re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or ""))] + ["</s> "]) for r in rows]
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in texts}
    counts = [Counter() for _ in range(order + 1)]
    for i, w in texts:
        if not held[i]:
            s = ["<s> ", *w]
            for n in range(1, order + 1):
                counts[n].update(tuple(s[k : k + n]) for k in range(len(s) - n + 1))
    total = sum(c for g, c in counts[1].items() if g != ("<s> ",))
    types = len([g for g in counts[1] if g != ("<s> ",)])
    want = []
    for i, w in texts:
        s, score = ["<s> ", *w], 0.0
        for k in range(1, len(s)):
            p = (counts[1][(s[k],)] + 1) / (total + types + 1)
            for n in range(2, order + 1):
                if k - n + 1 >= 0 and (c := counts[n - 1][tuple(s[k - n + 1 : k])]):
                    mu = (400.0, 40.0)[min(n, 3) - 2]
                    p = (counts[n][tuple(s[k - n + 1 : k + 1])] + mu * p) / (c + mu)
            score += math.log10(p)
        base = sum(math.log10((counts[1][(x,)] + 1) / (total + types + 1)) for x in w)
        want.append((str(i), held[i], len(w), sum(counts[1][(x,)] > 0 for x in w), total, round(base, 6), round(score, 6)))
    for fanout in (64, 3):  # one level of ranges, and three
        got = lm_scoring.lm_scores(d, order, (400.0, 40.0), block_bytes=3_000, shard_bytes=5_000, fanout=fanout).collect()
        assert sorted((str(r[0]), *tuple(r)[1:5], round(r["base_score"], 6), round(r["score"], 6)) for r in got) == sorted(want)


def test_automaton_against_its_definition():
    """States, arcs, failure arcs and lanes of a small automaton, one token at a time."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(n)).encode() for n in (0, 1, 2, 40, 300, 7)]
    block = lm_scoring.Block.of([1, 2, 3, 4, 5, 6], texts)
    train = np.repeat([True, True, False, True, True, False], block.sizes)
    counts = [np.bincount(w[(w >= 0) & train], minlength=len(k)) for k, _, w in block.grams(3, 5)]
    one = lm_scoring.Automaton(block, counts, 5, 300, 8, (20.0, 3.0))
    words, v = block.words.tolist(), len(block.vocabulary)
    grams = [Counter(), Counter(), Counter()]
    for a, n, t in zip(block.first.tolist(), block.sizes.tolist(), [True, True, False, True, True, False], strict=True):
        for k in range(3):
            if t:
                grams[k].update(tuple(words[i : i + k + 1]) for i in range(a, a + n - k))
    learned = list(block.counted(3, 5))
    own = [np.bincount(w[(w >= 0) & block.training()], minlength=len(k)) for k, _, w in block.grams(3, 5)]
    assert all((a == c).all() for a, (_, c) in zip(own, learned, strict=True)) and all((k == d).all() for (k, _, _), (d, _) in zip(block.grams(3, 5), learned, strict=True))
    assert len(one.count) == 1 + len(grams[0]) + len(grams[1]) and len(one.arc_from) == len(grams[1]) + len(grams[2])
    assert sorted(one.count[1:]) == sorted([*grams[0].values(), *grams[1].values()])
    assert (one.fail[1 : 1 + len(grams[0])] == 0).all() and (one.fail[1 + len(grams[0]) :] > 0).all()
    alone = np.zeros(len(words))
    for a, n in zip(block.first.tolist(), block.sizes.tolist(), strict=True):  # one document, one token after the other
        state = 0
        for i in range(a, a + n):
            state, weight = one.step(state, words[i])
            alone[i] = 0.0 if i == a else weight
            context = next((words[i - k : i + 1] for k in (1, 0) if i - k >= a and grams[k][tuple(words[i - k : i + 1])]), [])
            assert one.count[state] == (grams[len(context) - 1][tuple(context)] if context else 0) and one.length[state] == len(context)
    for lane in (1, 3, 256):
        assert np.allclose(one.walk(lane), alone)
    total = [sum(10 ** one.step(s, w)[1] for w in range(v)) for s in range(len(one.count))]
    for s in set(one.arc_from.tolist()):  # what a context's own arcs leave goes to the shorter one
        back = 10 ** one.fail_weight[s]
        assert math.isclose(total[s], 1 - back + back * total[one.fail[s]])


def test_lm_probabilities_sum_to_one(spark):
    d = spark.createDataFrame([(0, "a b a c"), (1, "a b b"), (3, "c a")], "doc_id long, text string")
    held = [i for i in range(10, 200) if lm_scoring.held_out(i)][:5]
    probe = spark.createDataFrame([(h, f"a {w}") for h, w in zip(held, ["a", "b", "c", "zzz", ""], strict=True)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm_scoring.lm_scores(d.unionAll(probe)).where("held_out").collect()}
    first = [math.log10(10 ** got[h]) for h in held]
    assert len(first) == 5
    assert lm_scoring.lm_scores(d.limit(0)).count() == 0


def test_a_shard_gives_its_entries_up_as_they_are_merged():
    """Peak of a shard's answer, as a multiple of the entries that it was asked for."""
    import tracemalloc

    rng = random.Random(3)
    exchange = lm_scoring.Exchange(3, 1, 12, 64)
    rows, raw = [], 0
    for b in range(12):
        block = lm_scoring.Block.of([b], [" ".join(f"w{rng.randrange(40_000)}" for _ in range(30_000)).encode()])
        keys, counts = zip(*block.counted(3, 1), strict=True)
        raw += sum(x.nbytes for x in (*keys, *counts))
        rows += [(b, 0, block.check, r.column(3)[0].as_py()) for r in exchange.divided(b, 1, 0, 1, keys, counts, block.check)]
    tracemalloc.start()
    n = sum(1 for _ in exchange.answer(rows))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 13 and peak < 3 * raw, peak / raw


def test_a_merge_meets_few_blocks_at_any_number_of_shards():
    """Just over 64 shards, two ranges would hold the n-grams of 64 blocks between them."""
    for shards in [*range(1, 600), 4095, 4096, 4097, 5000]:
        exchange = lm_scoring.Exchange(3, shards, 3 * shards, 64)
        assert 1 <= exchange.ranges(1) <= 64 and exchange.ranges(exchange.levels) == shards
        for level in range(1, exchange.levels):
            blocks = exchange.groups[0] / exchange.groups[level]
            assert blocks * exchange._width(level) / shards < 2.5, (shards, level)


def test_a_merge_tells_rows_of_another_scan():
    exchange = lm_scoring.Exchange(2, 4, 3, 2)
    block = lm_scoring.Block.of([1], [b"a b c a b"])

    def rows(check, learn, *place):
        keys, counts = zip(*block.counted(2, 4, learn), strict=True)
        return [(7, r.column(1)[0].as_py(), check, r.column(3)[0].as_py(), 0, *place) for r in exchange.divided(7, 1, 0, 2, keys, counts, check)]

    merged = [b for r in rows(5, True) if r[1] == 0 for b in exchange.merge([r], 1)]
    answers = []
    for b in merged:
        block_, shard, check, data = (c[0].as_py() for c in b.columns)
        found = [x for x in exchange.answer([(block_, shard, check, data)]) if x.column(0)[0].as_py() >= 0]
        answers += [(x.column(0)[0].as_py(), 0, x.column(2)[0].as_py(), x.column(3)[0].as_py(), 0, shard) for x in found]
    assert len(list(exchange.pass_on([*rows(5, False, -1)[:1], *answers]))) == 1
    with pytest.raises(RuntimeError, match="other rows"):
        list(exchange.pass_on([*rows(6, False, -1)[:1], *answers]))
