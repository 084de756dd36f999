"""Deduplication operators against brute force, on awkward rows and on an empty table."""

from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_rows import ROWS
from sievemill.llm import exact_dedup, line_dedup, simhash, substring_dedup

SPACES = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact_expected(rows):
    groups = defaultdict(list)
    for i, (doc_id, text, _) in enumerate(rows):
        groups[(text or "").translate(UPPER)].append((doc_id, i))
    out = Counter()
    for found in groups.values():
        best = max((d for d, _ in found if d is not None), default=None)
        kept = False
        for d, _ in found:
            stays = d == best and not kept
            kept = kept or stays
            out[d, best, len(found), stays] += 1
    return out


def rows_of(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())


def test_exact_groups(edges):
    assert rows_of(exact_dedup.exact_groups(edges)) == exact_expected(ROWS)


def test_exact_groups_compares_bytes_where_digests_collide(edges):
    weak = lambda text: F.encode(F.substring(F.sha2(text, 256), 1, 1), "UTF-8")  # noqa: E731  16 digests for all texts
    assert rows_of(exact_dedup.exact_groups(edges, digest=weak)) == exact_expected(ROWS)


def test_exact_state_lasts(spark, tmp_path):
    """A table that has grown: with the state of the first run, only new files enter the stream, and all rows are judged."""
    state, path = str(tmp_path / "state"), str(tmp_path / "documents")
    rows = []
    for n in (1, 2):
        new = [(n, "Same"), (10 * n, f"own {n}")]
        rows += [(*r, None) for r in new]
        spark.createDataFrame(new, "doc_id long, text string").write.mode("append").parquet(path)
        assert rows_of(exact_dedup.exact_groups(spark.read.parquet(path), state=state)) == exact_expected(rows)
    assert spark.read.parquet(f"{state}/entries").count() == 4


def lines_expected(rows):
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(UPPER)
    for doc_id, text, _ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(float("inf") if doc_id is None else doc_id)
    out = Counter()
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        me = float("inf") if doc_id is None else doc_id
        kept = [x for x in lines if len(key(x)) < 10 or me == min(holders[key(x)])]
        out[doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_lines(edges):
    found = line_dedup.drop_repeated_lines(edges)
    assert found.columns == [*edges.columns, "_lines"]
    got = Counter((r.doc_id, r._lines.n_lines, r._lines.n_dropped, r.text or "") for r in found.collect())
    assert got == lines_expected(ROWS)


def test_lines_of_a_hot_key(spark):
    """A line in every document, and long documents whose bitmap has many words."""
    rows = [(i, "\n".join(["Common line here"] * (1 + i % 3) + [f"only in {i} {k}" for k in range(200 if i % 50 == 0 else 2)]), "") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter((r.doc_id, r._lines.n_lines, r._lines.n_dropped, r.text) for r in line_dedup.drop_repeated_lines(docs).collect())
    assert got == lines_expected(rows)


def passages_expected(rows, window):
    texts = [(t or "").encode().split() for _, t, _ in rows]
    count = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = Counter()
    for (doc_id, _, _), words in zip(rows, texts):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if count[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out[doc_id, len(words), sum(gone), kept] += 1
    return out


@pytest.mark.parametrize("window", [35, 4])
def test_passages(edges, window, monkeypatch):
    found = substring_dedup.remove_repeats(edges, window=window)
    got = Counter((r.doc_id, r._kept.n_words, r._kept.n_removed, r._kept.text) for r in found.collect())
    assert got == passages_expected(ROWS, window)


def test_window_hashes():
    tokens = np.arange(90, dtype=np.uint64) * np.uint64(7919)
    for window in (1, 2, 3, 5, 35, 64):
        base = substring_dedup.BASES[0]
        want = [sum(int(tokens[i + j]) * pow(base, window - 1 - j, 2**64) for j in range(window)) % 2**64 for i in range(91 - window)]
        assert substring_dedup.window_hashes(tokens, window, base).tolist() == want


def test_hashes_that_agree_in_part_are_told_apart():
    first, second = np.array([5, 5, 5, 9], np.uint64), np.array([1, 2, 1, 1], np.uint16)
    order, same = substring_dedup.equal_runs(first, second)
    assert [(int(first[i]), int(second[i])) for i in order] == [(5, 1), (5, 1), (5, 2), (9, 1)] and same.tolist() == [True, False, False]


def print_expected(text, shingle=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_expected(rows):
    prints = [print_expected(t) for _, t, _ in rows]
    part = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3:
                    part[i] = part[j] = min(part[i], part[j])
    least = {p: min((d for (d, _, _), q in zip(rows, part) if q == p and d is not None), default=None) for p in part}
    return Counter((d, f, least[p]) for (d, _, _), f, p in zip(rows, prints, part))


def test_components(edges):
    got = Counter((r.doc_id, r.print & 2**64 - 1, r.component_id) for r in simhash.near_duplicates(edges).collect())
    assert got == components_expected(ROWS)


def test_chains_of_near_texts(spark):
    """Prints a few bits apart, made to order: chains, stars and lone ones."""
    rng = np.random.default_rng(5)
    prints = [int(x) for x in rng.integers(0, 2**63, 40, dtype=np.uint64)]
    for start in prints[:20]:
        at = start
        for _ in range(int(rng.integers(1, 12))):
            for b in rng.integers(0, 64, int(rng.integers(1, 4))):
                at ^= 1 << int(b)
            prints.append(at)
    prints = sorted({p - 2**64 if p >= 2**63 else p for p in prints})
    only = spark.createDataFrame([(p,) for p in prints], "print long").repartition(3)
    bitmap = simhash.home_bitmap(only)
    rows = only.mapInArrow(simhash.replicas(bitmap, 16), "bucket int, kind tinyint, anchors binary, prints binary")
    pairs = rows.repartition(4, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(simhash.links, "a long, b long").distinct()
    assert all(0 < ((r.a ^ r.b) & 2**64 - 1).bit_count() <= 3 for r in pairs.collect())
    got = {r.node: r.part for r in simhash.contracted(pairs).collect()}
    part = {p: p for p in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if ((a ^ b) & 2**64 - 1).bit_count() <= 3:
                    part[a] = part[b] = min(part[a], part[b])
    assert {p: got.get(p, p) for p in prints} == part


def test_code_covers():
    """Every error pattern of 23 bits is within the radius of one code word, and reach finds each home three bits away."""
    leader, by_excess = simhash.golay_tables()
    assert len(np.unique(leader)) == 2**11 and max(int(x).bit_count() for x in leader) == 3
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 500, dtype=np.uint64)
    moved = prints.copy()
    for _ in range(3):
        moved ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
    assert all(h in at for h, at in zip(simhash.homes(moved), simhash.reached(prints)))


def test_one_of_each_group(edges):
    left = simhash.one_of_each_group(edges)
    assert left.columns == edges.columns
    want = {c for _, _, c in components_expected(ROWS)}
    assert Counter(r.doc_id for r in left.select("doc_id").collect()) == Counter(want)


@pytest.mark.parametrize("doc_id", [7, None])
def test_one_row_stays_of_a_repeated_id(spark, doc_id):
    """Near texts of one id, or of none, with fingerprints that differ; and a group of its own with the same id."""
    words = [f"w{i}" for i in range(400)]
    near = {}
    for i in range(400):
        text = " ".join([*words[:i], "other", *words[i + 1 :]])
        near.setdefault(print_expected(text), text)
    near, first = list(near.items()), next(iter(near))
    texts = [t for p, t in near if 0 <= (p ^ first).bit_count() <= 3]
    assert len(texts) > 1
    far = " ".join(f"far{i}" for i in range(400))
    docs = spark.createDataFrame([(doc_id, t) for t in [*texts, far]], "doc_id long, text string")
    left = [r.text for r in simhash.one_of_each_group(docs).collect()]
    assert len(left) == 2 and far in left
    assert left[left[0] == far] == min(texts, key=lambda t: (p := print_expected(t)) - 2**64 * (p >= 2**63))


def test_whole_rows_are_not_shuffled_to_keep_one_of_each_group(spark):
    """The rows that stay are told by so small a table that it is broadcast, also where a list of them would be too large."""
    rows = [(i % 19_000, " ".join(f"{i % 19_000}w{k}" for k in range(4))) for i in range(20_000)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")
    try:
        left = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in left.collect()) == sorted({d for d, _ in rows})
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_empty_tables(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_of_each_group(nothing).count() == 0


@pytest.mark.parametrize("operator", [exact_dedup.exact_groups, line_dedup.drop_repeated_lines, lambda d: line_dedup.keep_bitmaps(d)])
def test_native_plans_hold_no_python(edges, operator):
    plan = operator(edges)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
