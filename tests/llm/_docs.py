"""Small documents with every awkward case: nulls, empty and long texts, ties, repeated rows, extra columns with clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, key string, b int"


def rows(n=60, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghiklmnoprstuvwz") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    out = []
    for i in range(n):
        text = "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) + "." for _ in range(rng.randint(1, 4)))
        out.append((i, text))
    out += [(n, None), (n + 1, ""), (None, out[3][1]), (n + 2, out[4][1]), (n + 3, out[4][1].upper()), (n + 4, " \n\t "), (n + 5, "word " * 20_000), (5, out[5][1])]
    return [(i, t, "en" if (i or 0) % 3 else None, "s", len(t or ""), 1, "k", 2) for i, t in out]


def frame(spark, **kw):
    return spark.createDataFrame(rows(**kw), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
