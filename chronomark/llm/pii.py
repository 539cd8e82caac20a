"""Operator 6, PII: keyed surrogates that keep type, format, script, gender, distinctness and coreference.

Detection is one pass of patterns with bounded repetition and of a scan over the capitalised words, so a text of any length
takes linear time. A surrogate is a keyed permutation of the entity's own alphabet and length (digits stay digits, letters
stay letters of their script, a card number keeps its Luhn state, an e-mail its domain structure), so different entities get
different surrogates by construction and one entity gets the same one in every document and in every notation. Names are
replaced word by word, so "Mr John Smith" and "Mr Smith" stay one person: a word is permuted as a number over its letters,
which is written in syllables, more of them for longer words, so that names cannot run out. What a name word is, given name of
a gender or surname, is decided once for the whole corpus, from the words before it in all documents; its ending tells.

Collision checks run over the distinct entities of the whole corpus: a surrogate must not be a real entity, nor the
surrogate of another. Losers get the next attempt, round by round, until there are none; the space of names grows with the attempt, as does
that of short local parts and telephone numbers after some attempts. Only entities whose attempt is
not 0, or whose gender the word alone does not tell, are kept, by 64-bit hash, in shards of the shared folder; a task looks the
hashes of its entities up there. Texts are not shuffled and no table of entities is sent to the driver.
"""

from __future__ import annotations

import hashlib
import ipaddress
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronomark.llm._common import materialize, partitions_for, shared_path, table, worker_cache
from chronomark.llm.quality import Model

KEY = b"chronomark surrogate key"
#: From this attempt on local parts and telephone numbers get longer: corpora can use up the short ones.
LONGER_FROM = 8

_TITLES = {
    "m": ["Mr", "Mr.", "Sir", "Lord", "Herr", "Monsieur", "M.", "Señor", "Sr.", "Don", "господин"],
    "f": ["Mrs", "Mrs.", "Ms", "Ms.", "Miss", "Lady", "Frau", "Madame", "Mme", "Mme.", "Mlle", "Señora", "Sra.", "Doña", "госпожа"],
    "n": ["Dr", "Dr.", "Prof", "Prof."],
}
_GENDER = {t: g for g, ts in _TITLES.items() for t in ts}
#: Given names whose gender is known without a title, and which begin a name without one.
_GIVEN = {
    "m": ["James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Paul", "Mark", "George", "Andrew", "Peter", "Henry", "Hans", "Klaus", "Jürgen", "Wolfgang", "Stefan", "Jean", "Pierre", "Michel", "Jacques", "Philippe", "Luis", "Carlos", "Juan", "Pablo", "José", "Miguel", "Jorge", "Marco", "Antonio", "Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай"],
    "f": ["Mary", "Anna", "Linda", "Elizabeth", "Susan", "Sarah", "Jennifer", "Patricia", "Barbara", "Karen", "Nancy", "Margaret", "Emma", "Emily", "Julia", "Laura", "Petra", "Sabine", "Monika", "Ursula", "Heike", "Marie", "Claire", "Sophie", "Nathalie", "Isabelle", "Sofia", "Carmen", "Lucia", "Elena", "Maria", "María", "Ana", "Rosa", "Isabel", "Мария", "Ольга", "Анна", "Елена", "Наталья", "Татьяна"],
}
_KNOWN = {n: g for g, ns in _GIVEN.items() for n in ns}
_NAME_WORD = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё'’-]{1,30}"
_TITLE = "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))

PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,6}[A-Za-z]{2,24}(?![\w-]))"
    r"|(?P<token>(?<![\w-])(?:(?:sk|pk|ghp|gho|xox[abp]|glpat|hf)[-_][A-Za-z0-9_-]{16,100}|AKIA[A-Z0-9]{16}|[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\w-]))"
    r"|(?P<mac>(?<![\w:])(?:[0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}(?![\w:]))"
    r"|(?P<ipv6>(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:]))"
    r"|(?P<ipv6c>(?<![\w:])(?=[A-Fa-f:]{0,30}[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){1,6}:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?|::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})(?![\w:]))"
    r"|(?P<ipv4>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w+.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d))"
)
#: Patterns that begin with a set of characters, for which the search skips quickly.
_SECRET = re.compile(r"[:=][ \t]{0,3}[\"'](?P<secret>[A-Za-z0-9+/_=-]{16,200})[\"']")
_NEXT_WORD = rf" (?!(?:{_TITLE})[ \u00a0]){_NAME_WORD}"
_NAMED = re.compile(rf"(?:{_TITLE})[ \u00a0](?:{_NAME_WORD})(?:{_NEXT_WORD}){{0,2}}")
_UNTITLED = re.compile(rf"(?:{'|'.join(sorted(_KNOWN, key=len, reverse=True))})(?:{_NEXT_WORD}){{1,2}}(?!\w)")
_CAPITAL = re.compile(rf"(?<!\w){_NAME_WORD}(?!\w)")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Every other entity has one of these within ``_REACH`` characters of its start and of its end: a digit or an at sign, or
#: without these the prefix of a token, hex groups between colons or a long run of hex letters.
_SIGN = re.compile(r"[0-9@](?:.{0,64}[0-9@])*", re.DOTALL)
_BARE = re.compile(r"(?:sk|pk|ghp|gho|xox[abp]|glpat|hf)[-_]|AKIA|:[A-Fa-f]{1,4}:|[a-f]{32}|[A-F]{32}")
_REACH = 210


# --- the keyed permutation ----------------------------------------------------------------------------------------


def permute(value: int, domain: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(domain): eight Feistel rounds over bits, walked until the value is inside."""
    if domain < 2:
        return value
    half = (max(2, (domain - 1).bit_length()) + 1) // 2
    mask = (1 << half) - 1
    size = (half + 7) // 8 + 8
    while True:
        left, right = value >> half, value & mask
        for r in range(8):
            data = b"%d|%s|" % (r, tweak.encode("utf-8", "replace")) + right.to_bytes(size, "big")
            mixed, block = b"", 0
            while len(mixed) < size:
                mixed += hashlib.blake2b(data + bytes([block]), key=key[:64], digest_size=64).digest()
                block += 1
            left, right = right, left ^ (int.from_bytes(mixed[:size], "big") & mask)
        value = left << half | right
        if value < domain:
            return value


_ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"]


def _alphabet(c: str) -> str:
    if c.isdigit() and c.isascii():
        return "0123456789"
    if not c.isalpha():
        return ""
    low = c.lower()
    return _ALPHABETS[1] if "а" <= low <= "ё" else _ALPHABETS[2] if "α" <= low <= "ω" else _ALPHABETS[0] if ord(c) < 0x250 else ""


def permute_text(text: str, key: bytes, tweak: str) -> str:
    """Letters and digits permuted as one number in mixed radix; case, script and everything else stay."""
    sets = [_alphabet(c) for c in text]
    value, domain = 0, 1
    for c, a in zip(text, sets, strict=True):
        if a:
            at = a.find(c.lower())
            value, domain = value * len(a) + (at if at >= 0 else ord(c) % len(a)), domain * len(a)
    value = permute(value, domain, key, f"{tweak}|{len(text)}")
    out = []
    for c, a in zip(reversed(text), reversed(sets), strict=True):
        if a:
            value, at = divmod(value, len(a))
            out.append(a[at].upper() if c.isupper() else a[at])
        else:
            out.append(c)
    return "".join(reversed(out))


def permute_over(text: str, alphabet: str, key: bytes, tweak: str) -> str:
    value = 0
    for c in text:
        value = value * len(alphabet) + alphabet.index(c)
    value = permute(value, len(alphabet) ** len(text), key, f"{tweak}|{len(text)}")
    out = []
    for _ in text:
        value, at = divmod(value, len(alphabet))
        out.append(alphabet[at])
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


_VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу"}
_CONSONANTS = {"latin": "bcdfghjklmnprstvwxyz", "cyrillic": "бвгджзйклмнпрстфхцчш"}
_SYLLABLES = {script: [c + v for c in _CONSONANTS[script] for v in _VOWELS[script]] for script in _VOWELS}
_ENDINGS = {"latin": {"m": "nor", "f": "lia", "n": "rin", "s": "sen"}, "cyrillic": {"m": "ний", "f": "лия", "n": "рен", "s": "сов"}}
_GENDERS = "smfn"
#: All letters that a name word can have.
_NAME_LETTERS = _ALPHABETS[0] + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7) + _ALPHABETS[1] + "'’-"


def _name(norm: str, key: bytes, attempt: int, gender: str) -> str:
    """The word as a number over its letters, permuted among all numbers of so many syllables."""
    low = norm.lower()
    script = "cyrillic" if _alphabet(low[0]) == _ALPHABETS[1] else "latin"
    letters = next(a for a in (_ALPHABETS[0], _ALPHABETS[1], _NAME_LETTERS) if set(low) <= set(a))
    value = 0
    for c in low:
        value = value * len(letters) + letters.index(c)
    parts, n = _SYLLABLES[script], 2
    while len(parts) ** n < len(letters) ** len(low):
        n += 1
    value = permute(value, len(parts) ** (n + attempt), key, f"name|{attempt}|{len(letters)}|{len(low)}")
    out = []
    for _ in range(n + attempt):
        value, at = divmod(value, len(parts))
        out.append(parts[at])
    return "".join(out).capitalize() + _ENDINGS[script][gender]


def surrogate(kind: str, norm: str, attempt: int, key: bytes = KEY, gender: str = "s") -> str:
    """The surrogate of a normalised entity, itself in normal form; ``gender`` (m, f, n, or s of surnames) counts for names."""
    tweak = f"{kind}|{attempt}"
    longer = max(0, attempt - LONGER_FROM + 1)
    if kind == "email":
        local, _, host = norm.rpartition("@")
        labels = host.split(".")
        new = ".".join([*[permute_text(x, key, f"host|{attempt}|{'.'.join(labels[i + 1 :])}") for i, x in enumerate(labels[:-1])], labels[-1]])
        return f"{permute_text(local + 'a' * longer, key, f'{tweak}|{host}')}@{new}"
    if kind in ("phone", "ssn"):
        head, _, digits = norm.rpartition(" ")
        digits += "0" * (longer if kind == "phone" else 0)
        return f"{head} {permute_over(digits, '0123456789', key, tweak)}".lstrip() if head else permute_over(digits, "0123456789", key, tweak)
    if kind == "card":
        body = permute_over(norm[:-1], "0123456789", key, tweak)
        return body + str((luhn(body) + int(norm[-1]) - luhn(norm[:-1])) % 10)
    if kind == "ipv4":
        value = int.from_bytes(bytes(map(int, norm.split("."))), "big")
        return ".".join(map(str, permute(value, 1 << 32, key, tweak).to_bytes(4, "big")))
    if kind in ("mac", "ipv6"):
        return permute_over(norm, "0123456789abcdef", key, tweak)
    if kind == "iban":
        return norm[:2] + permute_text(norm[2:], key, tweak + norm[:2])
    if kind == "name":
        return _name(norm, key, attempt, gender)
    if re.fullmatch("[0-9a-f]+", norm):
        return permute_over(norm, "0123456789abcdef", key, tweak)
    return permute_text(norm, key, tweak)


# --- detection ----------------------------------------------------------------------------------------------------


def _poured(digits: str, shape: str) -> str:
    """The digits or letters of ``digits`` in the places of those of ``shape``, with its punctuation and case; more of them follow."""
    it = iter(digits)
    return "".join((next(it).upper() if c.isupper() else next(it)) if c.isalnum() else c for c in shape) + "".join(it)


def _signs(text: str) -> list[tuple[int, int]]:
    """Places of signs, in order; near ones are one."""
    found = [m.span() for m in _SIGN.finditer(text)]
    bare = [m.span() for m in _BARE.finditer(text)]
    if not bare:
        return found
    out: list[tuple[int, int]] = []
    for a, b in sorted(found + bare):
        if out and a <= out[-1][1] + 64:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _candidates(text: str) -> list[re.Match]:
    """Matches of all patterns, in order and without overlap; the earlier one counts, then the one with signs in it."""
    out, last = [], 0
    for first, stop in _signs(text):
        start, end = max(last, first - _REACH), min(len(text), stop + _REACH)
        while start > last and not text[start - 1].isspace() and first - start < 2 * _REACH:
            start -= 1
        for m in PATTERN.finditer(text, start, end):
            out.append(m)
            last = m.end()
    out += _SECRET.finditer(text)
    for pattern in (_NAMED, _UNTITLED):
        out += [m for m in pattern.finditer(text) if not m.start() or not (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_")]
    if len(out) < 2:
        return out
    kept, last = [], 0
    for m in sorted(out, key=lambda m: m.start("secret") if m.re is _SECRET else m.start()):
        start = m.start("secret") if m.re is _SECRET else m.start()
        if start >= last:
            kept.append(m)
            last = m.end()
    return kept


def entities(text: str) -> Iterator[tuple[int, int, str, str, str]]:
    """``(start, end, kind, normal form, shape)`` of every entity, in order; the shape of a name word is what its place tells of
    its gender: m, f or n of a given name, s of the last word of a name, nothing of a mention without a title."""
    names: set[str] = set()
    found = []
    for m in _candidates(text):
        kind, value, (a, b) = m.lastgroup or "name", m.group(), m.span()
        if kind == "email":
            found.append((a, b, kind, value.lower(), value))
        elif kind == "secret":
            found.append((*m.span("secret"), "token", m["secret"], m["secret"]))
        elif kind == "token":
            found.append((a, b, kind, value, value))
        elif kind == "phone":
            country = re.match(r"\+\d{1,3}(?=[ .(-])", value)
            head = country.group() if country else ""
            digits = re.sub(r"\D", "", value[len(head) :])
            found.append((a, b, kind, f"{head} {digits}".lstrip(), value))
        elif kind in ("card", "ssn"):
            found.append((a, b, kind, re.sub(r"\D", "", value), value))
        elif kind in ("mac", "iban"):
            found.append((a, b, kind, re.sub("[: ]", "", value.lower() if kind == "mac" else value), value))
        elif kind == "ipv6":
            found.append((a, b, kind, "".join(x.zfill(4) for x in value.lower().split(":")), value))
        elif kind == "ipv6c":
            try:
                found.append((a, b, "ipv6", ipaddress.IPv6Address(value).exploded.replace(":", ""), value))
            except ValueError:  # too many groups
                continue
        elif kind == "ipv4":
            found.append((a, b, kind, ".".join(str(int(x)) for x in value.split(".")), value))
        else:
            title = re.match(_TITLE, value).group() if m.re is _NAMED else ""
            words = list(re.finditer(_NAME_WORD, value[len(title) :]))
            at = a + len(title)
            for i, w in enumerate(words):
                last = i == len(words) - 1
                names.add(w.group())
                found.append((at + w.start(), at + w.end(), "name", w.group(), "s" if last or not title else _GENDER[title]))
    if names:  # later and earlier mentions without a title
        taken, k = sorted((a, b) for a, b, *_ in found), 0
        for m in _CAPITAL.finditer(text):
            word = m.group()
            if word not in names and (bare := _LETTERS.match(word).group()) in names:
                word = bare
            if word in names:
                a, b = m.start(), m.start() + len(word)
                while k < len(taken) and taken[k][1] <= a:
                    k += 1
                if k == len(taken) or taken[k][0] >= b:
                    found.append((a, b, "name", word, ""))
        found.sort()
    yield from found


def gender_of(norm: str, votes: dict[str, int] | None = None) -> str:
    """m, f or n of a given name, s of any other: by the list of names, else by what its places in the corpus say most often."""
    m, f, n = ((votes or {}).get(g, 0) for g in "mfn")
    return _KNOWN.get(norm) or ("m" if m > f else "f" if f > m else "n" if m or n else "s")


def rendered(kind: str, new: str, shape: str) -> str:
    """A surrogate in the notation of the entity that it replaces."""
    if kind == "email":
        return "".join(c.upper() if s.isupper() else c for c, s in zip(new, shape, strict=True)) if len(new) == len(shape) else new
    if kind == "phone":
        country = re.match(r"\+\d{1,3}(?=[ .(-])", shape)
        head = country.group() if country else ""
        return head + _poured(new.rpartition(" ")[2], shape[len(head) :])
    if kind in ("card", "ssn", "mac", "iban"):
        return _poured(new, shape)
    if kind == "ipv6":
        return ":".join(new[i : i + 4] for i in range(0, 32, 4))
    return new


def entity_hash(kind: str, norm: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}\0{norm}".encode("utf-8", "replace"), 6)


# --- the corpus ---------------------------------------------------------------------------------------------------

_ENTITY = pa.schema([("kind", pa.string()), ("norm", pa.string()), ("m", pa.int64()), ("f", pa.int64()), ("n", pa.int64())])


def _entity_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    worker_cache("entities")
    for batch in batches:
        found: dict[tuple[str, str], Counter] = {}
        for t in batch.column(0).to_pylist():
            for _, _, kind, norm, shape in entities(t) if t else ():
                votes = found.setdefault((kind, norm), Counter())
                if kind == "name":
                    votes[shape] += 1
        if found:
            kinds, norms = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(norms), *[pa.array([v[g] for v in found.values()], pa.int64()) for g in "mfn"]], schema=_ENTITY)


def _assign(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        gendered = [(k, n, gender_of(n, {"m": m, "f": f, "n": x}) if k == "name" else "s", a) for k, n, m, f, x, a in rows]
        new = [surrogate(k, n, a, key, g) for k, n, g, a in gendered]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([g for _, _, g, _ in gendered], pa.string()), pa.array(new, pa.string())], names=[*batch.schema.names, "gender", "new"])


def attempts(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``(kind, norm, m, f, n, attempt, gender, new)`` of every distinct entity: no surrogate is an entity of the corpus or is used twice."""
    found = docs.select("text").mapInArrow(_entity_batches, "kind string, norm string, m long, f long, n long").groupBy("kind", "norm").agg(*[F.sum(g).alias(g) for g in "mfn"])
    real = materialize(found, "pii-entities")
    current = real.withColumn("attempt", F.lit(0))
    for n in itertools.count():
        given = materialize(current.mapInArrow(lambda it: _assign(it, key), "kind string, norm string, m long, f long, n long, attempt int, gender string, new string"), f"pii-round-{n}")
        taken = given.join(real.select("kind", F.col("norm").alias("new")), ["kind", "new"], "left_semi").select("kind", "norm")
        firsts = given.groupBy("kind", "new").agg(F.min("norm").alias("first"), F.count("*").alias("same")).where("same > 1").drop("same")
        twice = given.join(firsts, ["kind", "new"]).where("norm <> first").select("kind", "norm")
        losers = materialize(taken.union(twice).distinct(), f"pii-losers-{n}")
        if not losers.head(1):
            return given
        marked = losers.withColumn("lost", F.lit(1))
        current = given.join(marked, ["kind", "norm"], "left").select("kind", "norm", "m", "f", "n", (F.col("attempt") + F.coalesce("lost", F.lit(0))).cast("int").alias("attempt"))


_KEYED = pa.schema([("shard", pa.int32()), ("key", pa.int64()), ("a", pa.float32()), ("b", pa.float32())])


def _exceptions(given: DataFrame) -> Model | None:
    """Attempts other than 0 and genders that the word does not tell, in shards, by the hash of the entity; None if there are none."""
    told = F.array(*[F.lit(x) for x in sorted(_KNOWN)])
    other = given.where((F.col("attempt") > 0) | ((F.col("gender") != "s") & ~F.array_contains(told, F.col("norm")))).select("kind", "norm", "attempt", F.expr(f"locate(gender, '{_GENDERS}')").cast("float").alias("g"))
    count = other.count()
    if not count:
        return None
    spark = given.sparkSession
    bits = max(0, (partitions_for(spark, count, 1_000_000) - 1).bit_length())

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array([entity_hash(k, n) for k, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], dtype=np.uint64)
            shard = (keys >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(keys), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(keys.view(np.int64)), batch.column(2).cast(pa.float32()), batch.column(3)], schema=_KEYED)

    path = shared_path(spark, "pii-attempts")
    other.mapInArrow(keyed, "shard int, key long, a float, b float").repartition(1 << bits, "shard").write.partitionBy("shard").parquet(path)
    return Model(path, bits)


def replace(texts: list[str | None], exceptions: Model | None, key: bytes = KEY) -> list[tuple[str | None, list[str]]]:
    """Each text with its entities replaced, and the kinds replaced."""
    found = [list(entities(t)) if t else [] for t in texts]
    distinct = list({(kind, norm) for f in found for _, _, kind, norm, _ in f})
    tries, genders = [0] * len(distinct), [gender_of(norm) for _, norm in distinct]
    if exceptions and distinct:
        a, b = exceptions.look_up(np.array([entity_hash(*e) for e in distinct], dtype=np.uint64))
        tries = np.nan_to_num(a).astype(int).tolist()
        genders = [_GENDERS[int(x) - 1] if x > 0 else g for x, g in zip(np.nan_to_num(b).tolist(), genders, strict=True)]
    new = {e: surrogate(*e, n, key, g) for e, n, g in zip(distinct, tries, genders, strict=True)}
    out = []
    for t, f in zip(texts, found, strict=True):
        parts, last = [], 0
        for a, b, kind, norm, shape in f:
            parts += [t[last:a], rendered(kind, new[kind, norm], shape)]
            last = b
        out.append(("".join([*parts, t[last:]]) if f else t, [kind for _, _, kind, _, _ in f]))
    return out


def pseudonymize(docs: DataFrame, key: bytes = KEY, report: bool = False) -> DataFrame:
    """``docs`` with surrogates in ``text``; all columns. ``report`` adds ``n_entities long`` and ``kinds array<string>``.

    ``n_chars``, if there, follows a changed text. Defined cases: null and empty texts stay; rows without entities are
    returned as they are; repeated rows and ties get the same surrogates; an empty table gives no rows; a very long text takes
    time in proportion to its length. Columns named ``__new`` or ``__kinds``, and with ``report`` ``n_entities`` or ``kinds``, are replaced.
    """
    docs = docs.drop("__new", "__kinds", *(["n_entities", "kinds"] if report else []))
    exceptions = _exceptions(attempts(docs, key))
    counted = "n_chars" in docs.columns

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            done = replace(batch.column(batch.schema.names.index("text")).to_pylist(), exceptions, key)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t for t, _ in done], pa.string()), pa.array([k for _, k in done], pa.list_(pa.string()))], names=[*batch.schema.names, "__new", "__kinds"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__new", T.StringType()), T.StructField("__kinds", T.ArrayType(T.StringType()))])
    done = docs.mapInArrow(batches, schema)
    changed = F.size("__kinds") > 0
    cols = {"text": F.col("__new")} | ({"n_chars": F.when(changed, F.char_length("__new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if counted else {})
    extra = [F.size("__kinds").cast("long").alias("n_entities"), F.array_sort(F.array_distinct("__kinds")).alias("kinds")] if report else []
    return done.select(*[cols[c].alias(c) if c in cols else F.col(f"`{c}`") for c in docs.columns], *extra)


def op6_surrogate_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates; cases as in ``pseudonymize``."""
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), report=True)
