"""Mixing against an exhaustive solver, BPE against the tokenizers library."""

import itertools
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_rows import ROWS
from sievemill.llm import bpe, mixing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_targets_by_weight_with_a_ceiling():
    assert mixing.targets({"a": 600, "b": 600, "c": 600}) == {"a": 300.0, "b": 600.0, "c": 900.0}
    # c may have 30 at most; what it cannot take goes to a and b by 1 to 2.
    assert mixing.targets({"a": 1000, "b": 1000, "c": 10}) == pytest.approx({"a": 660.0, "b": 1320.0, "c": 30.0})
    # The order is that of code points and null is last, so the weights 1, 2, 3, 1 go to B, a, é, null.
    found = mixing.targets({None: 700, "a": 700, "é": 700, "B": 700})
    assert found == pytest.approx({"B": 400.0, "a": 800.0, "é": 1200.0, None: 400.0})
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def cost(given, capacity):
    total = 0
    for p, n in given.items():
        for use, price in enumerate(mixing.COSTS):
            total += price * min(max(n - use * capacity[p], 0), capacity[p])
    return total


def test_flow_is_the_cheapest():
    """Small networks against every way to route them: as much as can be, at the least cost."""
    rng = np.random.default_rng(1)
    for _ in range(25):
        capacity = {p: int(rng.integers(1, 3)) for p in range(3)}
        members = {p: sorted({int(x) for x in rng.integers(0, 2, 2)}) for p in range(3)}
        quota = {s: int(rng.integers(0, 6)) for s in range(2)}
        arcs = [(p, s) for p in capacity for s in members[p]]
        best = None
        for routed in itertools.product(*[range(min(quota[s], 3 * capacity[p]) + 1) for p, s in arcs]):
            given, got = dict.fromkeys(capacity, 0), dict.fromkeys(quota, 0)
            for (p, s), n in zip(arcs, routed):
                given[p] += n
                got[s] += n
            if all(given[p] <= 3 * capacity[p] for p in capacity) and all(got[s] <= quota[s] for s in quota):
                key = (-sum(got.values()), cost(given, capacity))
                best = key if best is None or key < best else best
        given = mixing.cheapest_flow(capacity, members, quota)
        assert (-sum(given.values()), cost(given, capacity)) == best


@pytest.fixture(scope="module")
def sources(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))), [None, "big", "small", "mid"][0 if i % 40 == 0 else 1 + (i % 7 > 3) + (i % 7 > 5)]) for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_sources_come_near_their_targets(sources):
    mixed, plan = mixing.mix(sources, F.array("source"))
    taken, copies = defaultdict(int), Counter()
    for r in mixed.collect():
        taken[r.source] += r._mix.size * r._mix.copies
        copies[r.doc_id] = r._mix.copies
    assert sum(n for _, n, _ in plan.sources) == sum(r.n for r in sources.select(mixing.words_in(F.col("text")).alias("n")).collect())
    assert all(abs(taken[s] - target) <= max(2, 0.002 * target) for s, _, target in plan.sources)
    assert max(copies.values()) <= 3
    again = mixing.mix(sources.repartition(7), F.array("source"))[0]
    assert {r.doc_id: r._mix.copies for r in again.collect()} == dict(copies)
    assert mixing.repeated(mixed).count() == sum(copies.values()) and mixing.repeated(mixed).columns == sources.columns


def test_documents_of_several_sources(spark):
    """What only a small source wants comes from documents that it shares with a large one before anything is repeated."""
    rows = [(i, "w " * 10, ["large"] if i < 80 else ["large", "small"] if i < 98 else ["small"]) for i in range(100)]
    docs = spark.createDataFrame([*rows, (200, "w " * 10, [])], "doc_id long, text string, member array<string>")
    mixed, plan = mixing.mix(docs, F.col("member"))
    copies = {r.doc_id: r._mix.copies for r in mixed.collect()}
    assert copies[200] == 0 and max(copies.values()) <= 3
    wanted = sum(round(t) for _, _, t in plan.sources)
    assert abs(10 * sum(copies.values()) - min(wanted, 3000)) <= 20


def test_many_sources_have_the_targets_of_few(spark):
    """More sources than weights, sizes from nothing to many words, ceilings reached, a null one: as the plain function has it."""
    rng = np.random.default_rng(5)
    size = {None if s == 7 else f"s{s:04}é": int(rng.integers(0, 5)) if s % 3 else int(rng.integers(50, 400)) for s in range(2000)}
    docs = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(size.items())], "doc_id long, text string, source string")
    plan = mixing.mix(docs, F.array("source"))[1]
    want = mixing.targets(size)
    assert {s: (n, t) for s, n, t in plan.sources} == {s: (n, pytest.approx(want[s])) for s, n in size.items()}
    given = {r.pattern: (r.whole, r.part) for r in plan.patterns.collect()}
    assert len(given) == 2000
    for s, _, alone in [(r.source, r.size, r.pattern) for r in plan.source_table.collect()]:
        assert sum(given[alone]) == 0 if not size[s] else given[alone][0] * size[s] + given[alone][1] == min(round(want[s]), 3 * size[s])


def test_large_tables_of_patterns_give_the_same_mix(spark, monkeypatch):
    """Beyond FEW patterns only the hot ones are broadcast; a source that holds a third of all, sources in common, rows in none."""
    rng = np.random.default_rng(6)
    member = [["hot"] if i % 3 == 0 else [] if i % 50 == 1 else sorted({f"s{x}" for x in rng.integers(0, 40, int(rng.integers(1, 3)))}) for i in range(1500)]
    rows = [(i, "w " * int(rng.integers(0, 30)), m) for i, m in enumerate(member)] + [(5000, "w w", None), (5001, "w w w", [None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, member array<string>")

    def taken():
        mixed, plan = mixing.mix(docs, F.col("member"))
        assert mixed.columns == [*docs.columns, "_mix"]
        return {r.doc_id: (r._mix.size, r._mix.copies) for r in mixed.collect()}, plan

    small, plan = taken()
    assert plan.lookup.few and len(small) == len(rows) and small[5000] == (2, 0)
    monkeypatch.setattr(mixing, "FEW", 3)
    monkeypatch.setattr(mixing, "HOT", 20)
    large, plan = taken()
    assert not plan.lookup.few and plan.lookup.hot == ['["hot"]'] and large == small
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 5)
    with pytest.raises(ValueError, match="several sources"):
        taken()


def test_mix_of_awkward_rows(edges, nothing):
    mixed, plan = mixing.mix(edges, F.array("source"))
    rows = mixed.collect()
    assert mixed.columns == [*edges.columns, "_mix"] and len(rows) == len(ROWS)
    assert [s for s, _, _ in plan.sources] == ["a", "b", "c", None]
    want = Counter((d, len((t or "").split())) for d, t, _ in ROWS)
    assert Counter((r.doc_id, r._mix.size) for r in rows) == want and all(0 <= r._mix.copies <= 3 for r in rows)
    empty, plan = mixing.mix(nothing, F.array("source"))
    assert empty.count() == 0 and plan.sources == []


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


AWKWARD = [
    "", " \n ", "<|startoftext|>x<|endoftext|> y", "<|", "it's I'LL we'd", "ΑΣ ΑΣ. Σ", "İstanbul ẞ ß ﬀ ǅ", "é é 한", "a\xa0b c\x1cd\x85e​f",
    "日本語 中文 한국어", "😀👩‍👩‍👧 🇩🇪", "१२३ ½ Ⅷ ²", "!!!...###$$$%%%", "a" * 700, "abab" * 300, "Ᲊ Ɤ \U00010d50 \U000187f8 \U0001d6a6 \U000323b0", "x\U000f0000y",
]


def test_ids_are_those_of_the_library(library):
    rng = np.random.default_rng(8)
    ranges = [(0x20, 0x7F), (0xA0, 0x250), (0x370, 0x530), (0x4E00, 0x4F00), (0xAC00, 0xAD00), (0x1F300, 0x1F600)]
    texts = [*AWKWARD, *(t or "" for _, t, _ in ROWS)]
    for _ in range(1500):
        pick = [ranges[int(k)] for k in rng.choice(len(ranges), int(rng.integers(1, 40)), p=[0.5, 0.2, 0.1, 0.08, 0.06, 0.06])]
        texts.append("".join(chr(int(rng.integers(*r))) for r in pick))
    known = bpe.Vocabulary(PATH)
    got = [ids.tolist() for at in range(0, len(texts), 100) for ids in known.encode(texts[at : at + 100])]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []
    assert [known.decode(i) for i in want] == [library.decode(i, skip_special_tokens=False) for i in want]


def test_words_met_before_are_forgotten_in_time(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    known = bpe.Vocabulary(PATH)
    texts = [f"alpha{i} beta{i}" for i in range(50)]
    one_by_one = [known.encode([t])[0].tolist() for t in texts]
    assert len(known.known) <= 30 and one_by_one == [x.tolist() for x in bpe.Vocabulary(PATH).encode(texts)]


def test_columns(edges, nothing, library):
    both = edges.select("doc_id", "text", bpe.encode(F.col("text"), PATH).alias("ids"), bpe.round_trip(F.col("text"), PATH).alias("both"))
    rows = both.select("*", bpe.decode(F.col("ids"), PATH).alias("decoded")).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids == r.both.ids and r.decoded == r.both.decoded == library.decode(ids, skip_special_tokens=False)
    assert nothing.select(bpe.round_trip(F.col("text"), PATH)).count() == 0
