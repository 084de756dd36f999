"""Collocations, spelling variants and secrets: against brute force, on awkward rows and empty tables."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_rows import ROWS
from sievemill.llm import collocations, secret_scan, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_collocations(rows, least, longest, most):
    """rows: (lang, text)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    candidates = [k for k, a in counts.items() if len(k) > 2 and a >= least]
    inside = Counter()
    for lang, *words in candidates:
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    inside[(lang, *words[i:j])] = max(inside[(lang, *words[i:j])], counts[(lang, *words)])
    out = {}
    for key in candidates:
        (lang, *words), a = key, counts[key]
        if inside[key] < a:
            cuts = [(1000 * a * totals[lang] // (counts[(lang, *words[:k])] * counts[(lang, *words[k:])]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[(lang, *words[:k])], counts[(lang, *words[k:])]))
    return {
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1)
    }


def prose(seed, n_rows=60):
    rng = random.Random(seed)
    words = ["of", "the", "The", "river", "Élan", "stone", "a-b", "\x85", "light", "rare"] + [f"w{i}" for i in range(40)]
    weights = [40, 40, 10, 8, 6, 6, 4, 4, 4, 1] + [1] * 40
    marks = [" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", " of the "]
    rows = []
    for i in range(n_rows):
        text = "".join(w + rng.choice(marks) for w in rng.choices(words, weights, k=rng.randrange(200)))
        rows.append((rng.choice(["en", "fr", None, "und", ""]), text))
    return rows + [("en", None), ("fr", ""), (None, " \n.,"), ("en", "of the river " * 300), ("en", "of the river " * 300), ("xx", "lone words")]


@pytest.mark.parametrize("spread", [None, 64, 3])
def test_collocations_by_brute_force(spark, spread):
    rows = prose(1)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = collocations.collocations(docs, least=4, most=50, spread=spread).collect()
    assert {tuple(r) for r in got} == brute_collocations(rows, 4, 5, 50)
    got = collocations.collocations(docs, least=3, longest=3, most=5, spread=spread).collect()
    assert {tuple(r) for r in got} == brute_collocations(rows, 3, 3, 5)


def test_collocations_of_awkward_rows(spark, edges, nothing):
    got = collocations.collocations(edges, lang_col="source", least=3).collect()
    assert {tuple(r) for r in got} == brute_collocations([(r[2], r[1]) for r in ROWS], 3, 5, 2000)
    empty = collocations.collocations(nothing, lang_col="source")
    assert empty.count() == 0 and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("hot, least", [(0, 1), (0, 5), (3, 5), (30, 5), (3, 1)])
def test_quicksort_counts_prefixes(hot, least):
    rng = np.random.default_rng(hot + least)
    tokens = np.where(rng.random(3000) < 0.1, 0, rng.geometric(0.25, 3000)).astype(np.int32)
    columns = collocations.suffix_columns(tokens, 5)
    weights = rng.integers(1, 4, len(columns[0]))
    want = Counter()
    for *words, weight in zip(*columns, weights):
        for size in range(2, 6):
            if words[size - 1]:
                want[tuple(map(int, words[:size]))] += int(weight)
    found = list(collocations.frequent_prefixes(columns, weights, hot, least))
    got = {tuple(int(c[at]) for c in columns[:size]): n for at, size, n in found}
    assert len(got) == len(found)
    assert got == {k: n for k, n in want.items() if n >= least or all(w <= hot for w in k)}


class Known:
    """In the place of a broadcast."""

    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("n_common", [0, 7, 10**6])
def test_bucket_in_slices_equals_bucket_at_once(monkeypatch, n_common):
    """Slices of a bucket give all counts in parts, whether words travel by rank or by hash."""
    chunk = collocations.Chunk()
    rows = prose(2)
    for lang, text in rows:
        chunk.add(lang, text)
    hashes = chunk.hashes(0)[1:][:n_common]
    by_hash = np.argsort(hashes)
    known = Known((np.full(1 << 17, 255, np.uint8), (hashes[by_hash], by_hash.astype(np.int32))))
    none = np.empty(0, np.uint64)
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i::7]]), pa.array([r[1] for r in rows[i::7]])], names=["lang", "text"]) for i in range(7)]

    def sums():
        out = Counter()
        routed = [r for b in batches for r in collocations.routed_suffixes(known, none, 1, 5, 0)(iter([b]))]
        for b in collocations.bucket_counts(known, none, 20, 5)(iter(routed)):
            for key, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out[key] += n
        return {k: n for k, n in out.items() if n >= 20}

    whole = sums()
    monkeypatch.setattr(collocations, "SLICE", 300)
    assert whole and sums() == whole


def brute_variants(rows, least_length=7, least_count=2, times=10):
    """rows: (id, text)."""
    counts = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            at = h % len(run)
            word = run[:at] + run[at + 1 :] if h % 31 == 0 else run
            if len(word) >= least_length:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= least_count}

    def near(u, v):
        if len(u) == len(v):
            return sum(a != b for a, b in zip(u, v)) == 1
        short, long = sorted((u, v), key=len)
        return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    close = {w: [v for v in counts if near(w, v)] for w in counts}
    forms = {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, counts[w], len(close[w]), counts[forms[w]] if forms[w] else None))
    return out


def spellings(seed):
    rng = random.Random(seed)
    letters, words = "abcdehiqyÉéÿ×", []
    for _ in range(12):
        word = "".join(rng.choices(letters, k=rng.randrange(7, 12)))
        words.append((word, 3000))
        for _ in range(12):
            at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
            words.append((word[:at] + rng.choice(letters) * (kind > 0) + word[at + (kind < 2) :], rng.choice([2, 20, 250])))
    pool = [w for w, n in words for _ in range(n // 2)]
    rng.shuffle(pool)
    return [(i, rng.choice([" ", "-", "1", "Ā"]).join(pool[i * 100 : i * 100 + 100])) for i in range(len(pool) // 100 + 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_by_brute_force(spark, seed):
    rows = spellings(seed) + [(None, "Misspelt wordlike WORDLIKE wordlikes"), (5, None), (6, ""), (7, "wordlike wordlikes")]
    want = brute_variants(rows)
    assert any(form and root != form for _, form, root, *_ in want)  # a chain of forms
    got = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert {tuple(r) for r in got.collect()} == want


def test_variants_of_awkward_rows(spark, edges, nothing):
    long = "q" * 30_000
    extra = spark.createDataFrame([(90, f"{long} {long}x"), (91, f"{long} {long}x {long[1:]}"), (92, long[1:])], "doc_id long, text string")
    docs = edges.unionByName(extra, allowMissingColumns=True)
    rows = [(r[0], r[1]) for r in ROWS] + [(r.doc_id, r.text) for r in extra.collect()]
    got = spelling.spelling_variants(docs)
    assert {tuple(r) for r in got.collect()} == brute_variants(rows)
    empty = spelling.spelling_variants(nothing)
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_neighbourhoods_are_full():
    """All reduced words within one edit, and no other; in blocks or at once."""

    def hashed(symbols):
        return sum(s * pow(spelling.BASE, i, 2**64) for i, s in enumerate(symbols)) % 2**64

    word = [1, 8, 3, 3, 2]
    every = range(1, spelling.SYMBOLS + 1)
    want = {hashed(word)} | {hashed(word[:i] + word[i + 1 :]) for i in range(5)}
    want |= {hashed(word[:i] + [s] + word[i + 1 :]) for i in range(5) for s in every}
    want |= {hashed(word[:i] + [s] + word[i:]) for i in range(6) for s in every}
    for block in (1 << 20, 1, 40):
        spelling.BLOCK, kept = block, spelling.BLOCK
        try:
            got = {int(k) for _, keys in spelling.neighbourhoods(np.array([word, word], np.uint64)) for k in keys.ravel()}
        finally:
            spelling.BLOCK = kept
        assert got == want


ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute_secrets(text):
    text = text or ""
    base = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    added = []
    for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text):
        token = m[0]
        if any(re.search(p, token) for p in secret_scan.ALLOWED):
            continue
        kind, bits = ("entropy_hex", 3.0) if re.fullmatch("[0-9A-Fa-f]+", token) else ("entropy_base64", 3.8)
        covered = set()
        for i in range(len(token) - 19):
            entropy = -sum(n / 20 * math.log2(n / 20) for n in Counter(token[i : i + 20]).values())
            if entropy >= bits - 1e-6:
                covered |= set(range(m.start() + i, m.start() + i + 20))
        for at in sorted(covered):
            if added and added[-1][1] == at and added[-1][2] == kind:
                added[-1][1] = at + 1
            else:
                added.append([at, at + 1, kind])
    added = [tuple(a) for a in added if not any(b[0] < a[1] and a[0] < b[2] for b in base)]
    return [(s, e, k) for s, _, e, k in sorted(base)], added


SECRETS = [
    "password=abcdef", "PassWD : 'hunter2hunter2", "token=abc", "password:token : longvalue", "api_key = \"x.y=z+/_-\"", "apikey: 12345", "ſecret=abcdef",
    "secret\n=abcdef", "token=secret=abcdef", "AKIA" + "A1" * 8, "AKIAAKIA" + "Z" * 12, "AKIA" + "B" * 15, "xAKIA" + "9" * 40, "deadbeef" * 3,
    "deadbeef" * 2 + "dead", "DEADbeef01234567c9d2", "é" * 5 + "0123456789abcdef01234567", "🙂🙂 token=" + "f3" * 20,
    "kJ8s7Df0aQ2mZx9LpW4tRb6YhUv1", "internationalisation_of_very_long_names", "550e8400-e29b-41d4-a716-446655440000", "2024-01-01-2024-02-02-2024",
    "aaaaaaaaaaaaaaaaaaaa1aaaaaaaaaaaaaaa" + "kJ8s7Df0aQ2mZx9LpW4t" + "b" * 45 + "Q9x7Rk2Lm4Zp8Ws1Vt6Y", "sha256-kJ8s7Df0aQ2mZx9LpW4tRb6YhUv1", "0123456789kJ8s7Df0aQ2mZx9",
    "exampleKJ8s7Df0aQ2mZx9LpW4t", "a1" * 10, "7f3A9c01E5b2D8464aF1", "", " ", "no secret here", None, "password=" * 50 + "abcdefg",
]


def found_in(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    found = docs.select("doc_id", secret_scan.secrets(F.col("text")).alias("f")).orderBy("doc_id").collect()
    return [([tuple(s) for s in r.f.base], [tuple(s) for s in r.f.added]) for r in found]


def test_secrets_by_brute_force(spark):
    rng = random.Random(3)
    mixed = [" ".join(rng.choices([s for s in SECRETS if s], k=12)) for _ in range(60)]
    joined = ["".join(rng.choices("ab0f9AKI=:+/_- é", k=400)) for _ in range(60)]
    keys = ["".join(rng.choices("kJ8s7Df0aQ2mZx9LpW4taaaabbb", k=rng.randrange(20, 120))) for _ in range(60)]
    rows = SECRETS + mixed + joined + keys
    want = [brute_secrets(t) for t in rows]
    assert sum(len(added) for _, added in want) > 60
    assert found_in(spark, rows) == want


def test_secrets_of_awkward_rows(spark, edges, nothing):
    got = edges.select("text", secret_scan.secrets(F.col("text")).alias("f")).collect()
    assert len(got) == len(ROWS)
    for r in got:
        base, added = brute_secrets(r.text)
        assert [tuple(s) for s in r.f.base] == base and [tuple(s) for s in r.f.added] == added
    assert nothing.select(secret_scan.secrets(F.col("text")).alias("f")).count() == 0


def test_allow_list_suppresses(spark):
    token = "kJ8s7Df0aQ2mZx9LpW4tRb6YhUv1"
    docs = spark.createDataFrame([(token,)], "text string")
    assert docs.select(F.size(secret_scan.secrets(F.col("text"))["added"])).first()[0] == 1
    assert docs.select(F.size(secret_scan.secrets(F.col("text"), allowed=["^kJ8s"])["added"])).first()[0] == 0


def test_secrets_in_long_texts(spark):
    """A megabyte each of letters, figures, one key and many matches."""
    rng = random.Random(4)
    rows = ["z" * 1_000_000, "1" * 1_000_000, "password " * 110_000, "token=abcdefg " * 30_000, "".join(rng.choices("kJ8s7Df0aQ2mZx9", k=50_000))]
    started = time.perf_counter()
    got = found_in(spark, rows)
    assert time.perf_counter() - started < 120
    assert got[0] == got[2] == ([], [])
    assert len(got[3][0]) == 30_000 and got[3][0][-1] == (29_999 * 14, 29_999 * 14 + 13, "assign")
    assert got == [brute_secrets(t) for t in rows]
