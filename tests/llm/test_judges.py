"""Toxicity, quality, quality rules and personal data: on made-up corpora, awkward rows and empty tables."""

import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import ROWS
from sievemill.llm import personal_data, quality_classifier, quality_rules, toxicity, training

GOOD = "the of and river stone walks under quiet light morning green hills carry water song every field".split()
BAD = "click### now%%% buy&&& free*** win$$$ offer### the%%% of&&& and***".split()


@pytest.fixture(scope="module")
def corpus(spark):
    """(documents, labels): one in five toxic, one in four of poor quality; a label of null and one of an unknown document."""
    rng, rows, labels = np.random.default_rng(7), [], []
    for i in range(1500):
        toxic, poor = i % 5 == 0, i % 4 == 1
        words = [str(rng.choice(BAD if poor else GOOD)) for _ in range(int(rng.integers(30, 80)))]
        if toxic:
            for at in rng.integers(0, len(words), 3):
                words[at] = str(rng.choice(["idiot", "you moron", "stupid,", "Loser!", "zorgblat"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(not poor), int(toxic)))
    labels += [(3, None, None), (10**9, 1, 1), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(docs, labels, score, label, least):
    rows = docs.select("doc_id", score.alias("s"), training.held_out(F.col("doc_id")).alias("out")).join(labels.where(f"{label} is not null"), "doc_id")
    found = rows.where("out").select("s", label).collect()
    assert len(found) > 200 and all(0 <= r.s <= 1 for r in found)
    return np.mean([(r.s >= least) == bool(r[label]) for r in found])


def test_toxicity_of_texts_kept_out(corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    assert accuracy(docs, labels, toxicity.score(F.col("text"), model), "toxic", 0.5) > 0.97
    assert "zorgblat" in model.learned  # not in the list; found in the labels
    again = toxicity.fit(docs.repartition(7), labels)
    texts = ["you moron", "", None, "quiet river", "id1ot you"]
    assert model.scores(texts).tolist() == again.scores(texts).tolist()


def test_quality_of_texts_kept_out(corpus):
    docs, labels = corpus
    model = quality_classifier.fit(docs, labels)
    assert accuracy(docs, labels, quality_classifier.score(F.col("text"), model), "quality", 0.3) > 0.97
    again = quality_classifier.fit(docs.repartition(7), labels)
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias


def test_labels_kept_out_are_not_learned(corpus):
    """Turning the labels of held-out rows round changes nothing."""
    docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(training.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    texts = ["you moron, you", "quiet river", "stupid"]
    assert toxicity.fit(docs, labels).scores(texts).tolist() == toxicity.fit(docs, turned).scores(texts).tolist()


def test_scores_of_awkward_rows(edges, nothing, corpus):
    docs, labels = corpus
    for module in (toxicity, quality_classifier):
        model = module.fit(docs, labels)
        scored = edges.select("doc_id", "text", module.score(F.col("text"), model).alias("score_"))
        rows = scored.collect()
        assert len(rows) == len(ROWS) and all(0 <= r.score_ <= 1 for r in rows)
        assert len({r.score_ for r in rows if not (r.text or "").strip()}) == 1  # null as empty
        assert nothing.select(module.score(F.col("text"), model)).count() == 0


def test_models_without_labels(nothing, edges, corpus):
    for module, column in ((toxicity, "toxic"), (quality_classifier, "quality")):
        for docs, labels in ((nothing, corpus[1]), (edges, corpus[1].limit(0))):
            model = module.fit(docs, labels, column)
            assert all(0 <= r[0] <= 1 for r in edges.select(module.score(F.col("text"), model)).collect())


def test_trees_fit_a_step():
    rng = np.random.default_rng(0)
    x = rng.random((800, 3))
    label = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    margin = toxicity.boost(x, label).margin(x)
    assert np.mean((margin > 0) == label) > 0.97


def test_isotonic_pools_what_falls():
    x, y = toxicity.isotonic(np.array([1.0, 2.0, 3.0, 4.0]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert np.all(np.diff(y) >= 0) and np.interp(2.5, x, y) == pytest.approx(0.5)


def test_follow_the_regularised_leader_by_hand():
    """One place and one text: the weight after a step is that of the closed form."""
    model = quality_classifier.train([np.array([7], np.int32)], np.array([1.0]), epochs=1)
    g = 0.5 - 1.0
    want = (abs(g) - quality_classifier.L1) / ((quality_classifier.BETA + abs(g)) / quality_classifier.ALPHA + quality_classifier.L2)
    assert model.weights[7] == pytest.approx(want) and np.count_nonzero(model.weights) == 1


def rules_expected(rows, limit, left):
    """The rules in plain Python."""
    def norm(line):
        line = re.sub("[0-9]+", "0", re.sub("[A-Z]", lambda m: m[0].lower(), line))
        return re.sub("[ \t\n\x0b\x0c\r]+", " ", line).strip(" ")

    held = {}
    for _, text, host in rows:
        for line in {norm(x) for x in (text or "").split("\n")} - {""}:
            held.setdefault((host, line), set()).add(text)
    out = Counter()
    for doc_id, text, host in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        rep = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        lost = sum(len(norm(x).split(" ")) for x in lines if len(held[host, norm(x)]) > limit)
        failed = len(words) < 50 or 100 * len(rep) > 50 * len(words)
        depleted = len(words) - lost < left * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text)
        out[doc_id, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(rep), lost, failed, depleted, not failed and not depleted] += 1
    return out


def judged(df, **kw):
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words n_lost_words base_failed depleted kept".split()
    return Counter(tuple(r[n] for n in names) for r in quality_rules.judged(df, **kw).collect())


def test_rules(edges, nothing):
    assert judged(edges, limit=1) == rules_expected(ROWS, 1, quality_rules.LEFT)
    assert judged(nothing) == Counter()


def test_boilerplate_rejects_and_copies_do_not(spark):
    body = " ".join(f"w{i}" for i in range(20))
    menu = "\n".join(f"{body} item {k}" for k in range(10))
    rows = [(i, f"{menu}\nown {i} words {i * 7}", "host") for i in range(40)]  # little but boilerplate
    rows += [(100 + i, " ".join(f"good{k}" for k in range(80)), "other") for i in range(40)]  # exact copies of a good text
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert judged(docs) == rules_expected(rows, quality_rules.LIMIT, quality_rules.LEFT)
    kept = {r.doc_id for r in quality_rules.judged(docs).where("kept").collect()}
    assert kept == {100 + i for i in range(40)}
    # Told apart by id, copies make each other's lines boilerplate.
    assert quality_rules.judged(docs, by="row").where("kept").count() == 0
    with pytest.raises(ValueError, match="by is"):
        quality_rules.judged(docs, by="id")


def test_documents_of_null_ids_are_told_apart_by_text(spark):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(None, f"{line}\nrest {i} {'x' * i}", "host") for i in range(4)] + [(1, f"{line}\nown", "host")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = quality_rules.frequent_lines(quality_rules.line_table(docs, "source", "doc_id", "text"), 1, by="row").collect()
    assert [r.n_documents for r in found] == [5]  # four texts without an id and one id


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def base_expected(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text):
            figures = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(figures))]
            checks = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(figures) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 9 <= len(figures) <= 15,
            }
            if checks[kind]:
                out.append((k, *m.span()))
    return sorted(out)


def test_patterns_match_plain_expressions():
    rng = np.random.default_rng(3)
    alphabet = list("0123456789" * 3 + " .-()+@@ab.é\n%٣")
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 60)))) for _ in range(5000)]
    texts += ["4111111111111111", "+1 (136) 555-7479", "a.b@c.d.e", "@a.b", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1", "x@y.z@w.v"]
    assert [t for t in texts if personal_data.base_spans(t) != base_expected(t)] == []


def figures(rng, n):
    return "".join(map(str, rng.integers(0, 10, n)))


@pytest.fixture(scope="module")
def weights(spark):
    """Learned from a corpus with personal data of the plain forms."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(200):
        span = [f"u{i}.x@mail{i % 9}.example.com", ".".join(map(str, rng.integers(0, 256, 4))), figures(rng, 16), f"+1 ({figures(rng, 3)}) 555-{figures(rng, 4)}"][i % 4]
        rows.append((i, f"some words before {span} and after"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = personal_data.fit(docs)
    assert np.array_equal(found, personal_data.fit(docs.repartition(5)))
    return found


def test_field_adds_what_patterns_miss(weights):
    found = lambda t: [(personal_data.KINDS[k], t[a:b]) for k, a, b in personal_data.find(t, weights)[1]]
    assert found("call (017) 555-7713 now") == [("phone", "(017) 555-7713")]
    assert found("to joe.doe [at] example [dot] com please") == [("email", "joe.doe [at] example [dot] com")]
    assert found("on 2023-04-17 10:22:31, version 10.4.22631.388, id 98432423423423423423423432") == []
    assert found("in 1999 or 2001 there were 12 of 345") == []


def test_disguised_addresses_in_any_case(weights):
    found = lambda t: [(personal_data.KINDS[k], t[a:b]) for k, a, b in personal_data.find(t, weights)[1]]
    for address in ("joe.doe [AT] example [DOT] com", "joe.doe (At) example.org", "JOE.DOE { AT } EXAMPLE { DOT } COM", "joe.doe[aT]example[Dot]com"):
        assert found(f"to {address} please") == [("email", address)]


def test_rare_kinds_are_learned(spark):
    """One stretch of a kind among thousands without an entity; the sample holds it, and all of a corpus that fits."""
    rng = np.random.default_rng(6)
    rare = ["mail to joe.doe@mail.example.com now", "from 10.20.30.40 today", "card 4111 1111 1111 1111 paid", "call +1 (136) 555-7479 now"]
    texts = [f"entry {figures(rng, 9)}.{figures(rng, 2)} of log {i % 7}" for i in range(4000)] + rare + ["no 4111 1111 1111 1112 card"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = personal_data.sample(docs, most=60)
    assert len(found) == 60 and {s[0] for t in found for s in personal_data.base_spans(t)} == {0, 1, 2, 3}
    assert sorted(found) == sorted(personal_data.sample(docs.repartition(7), most=60))
    assert len(personal_data.sample(docs, most=5000)) == 4004  # the failed one teaches nothing
    weights = personal_data.fit(docs, most=60)
    assert not any((w == -1.0).all() for w in weights)


def test_base_spans_stay(weights):
    text = "a@b.example.org at 10.0.0.1 by 4111111111111111 or +1 (136) 555-7479"
    base, added = personal_data.find(text, weights)
    assert base == base_expected(text) and added == []


def test_best_segments_are_the_best(weights):
    """Dynamic programming against all segmentations of short stretches, and the sum over them against the same."""
    rng = np.random.default_rng(4)
    for text in ("(017) 555-7713", "a@b.co c@d.org", "1234567 7654321"):
        lat = personal_data.lattice(text, 0, len(text))
        w = weights + rng.normal(0, 0.3, weights.shape)
        scores = w[:, lat.table].sum(2)

        def all_from(i):
            if i == len(lat.ends):
                return [0.0]
            out = [*all_from(i + 1)]
            for c, (a, b) in enumerate(lat.candidates):
                if a == i:
                    out += [scores[k, c] + r for k in range(len(scores)) for r in all_from(b)]
            return out

        every = all_from(0)
        at = {c: n for n, c in enumerate(lat.candidates)}
        assert sum(scores[k, at[i, j]] for k, i, j in personal_data.best_segments(lat, w)) == pytest.approx(max(every))
        assert personal_data.expected(lat, scores)[0] == pytest.approx(np.logaddexp.reduce(every))


def test_personal_data_of_awkward_rows(edges, nothing, weights):
    rows = edges.select("doc_id", personal_data.personal_data(F.col("text"), weights).alias("found")).collect()
    assert len(rows) == len(ROWS) and all(r.found.base == [] == r.found.added for r in rows)
    assert nothing.select(personal_data.personal_data(F.col("text"), weights)).count() == 0
    assert not personal_data.find("word " * 3, personal_data.fit(nothing))[1]


@pytest.mark.parametrize("text", ["1" * 100_000, "a" * 100_000 + "@", "1.1." * 30_000, "@" * 30_000, "+" * 50_000 + "1"])
def test_very_long_texts_are_read_whole(text, weights):
    assert personal_data.find(text, weights)[0] == ([] if "1.1" not in text else personal_data.find(text, weights)[0])


def plain_features(span, before, after):
    """What the features of a candidate say, spelt out for one span."""
    groups, n = re.findall("[0-9]+", span), len(re.sub("[^0-9]", "", span))
    letters = sum(c.isalpha() for c in span)
    return [
        min(n, 21), tuple(map(len, groups)) if len(groups) <= 8 else "many", min(len(groups), 9), "".join(sorted(set(re.sub(r"[\w\s]", "", span)))),
        span[0] == "+", "(" in span, (min(letters, 3), n > 8), min(span.count(" "), 5), (13 <= n <= 19, 13 <= n <= 19 and personal_data.luhn(re.sub("[^0-9]", "", span))),
        (len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups), min(span.count("."), 9)), (min(span.count("@"), 9), bool(personal_data.AT.search(span))),
        bool(re.search(r"\.[A-Za-z]{2,}$|(?i:dot) ?[\])}] ?[A-Za-z]{2,}$", span)), *map(personal_data.surrounding, (span[0], span[-1], before, after)),
    ]


def test_features_say_what_the_span_says():
    """Candidates of one stretch have the same place for a feature if, and but for chance only if, the plain feature is the same."""
    rng, unlike = np.random.default_rng(5), 0
    parts = ["[at]", "(at) ", "{ AT }", " [dot] ", "(DOT)", ".", "com", "é", "_", "x", "@", "+", "(", ")", "-", "  ", " ", "7", "12", "255", "256", "4111111111111111", "٣"]
    for _ in range(150):
        text = "".join(rng.choice(parts, 14))
        lat, seen = personal_data.lattice(text, 1, len(text) - 1), {}
        ends = [1, *lat.ends]
        for (i, j), row in zip(lat.candidates, lat.table):
            a, b = ends[i], ends[j]
            assert personal_data.MOST_FIGURES >= sum(c in "0123456789" for c in text[a:b]) or "@" in text[a:b] or "at" in text[a:b].lower()
            for k, value in enumerate(plain_features(text[a:b], text[a - 1 : a], text[b : b + 1])):
                assert seen.setdefault((k, value), row[k]) == row[k], (text, text[a:b], k)
        unlike += sum(len({v for (f, _), v in seen.items() if f == k}) < sum(f == k for f, _ in seen) for k in range(16))
    assert unlike < 25  # chance: one in 4,096 for each pair of values


def test_a_long_stretch_is_one_whatever_the_piece(weights, monkeypatch):
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(list("0123456789 .-()+"), 20_000)) + " joe.doe [at] example [dot] com " + "12.5 " * 3_000
    whole = personal_data.find(text, weights)
    monkeypatch.setattr(personal_data, "PIECE", 37)
    assert personal_data.find(text, weights) == whole and whole[1]


@pytest.mark.parametrize("unit", ["a", "1", "a-", "1.", "12.345 ", "2023-04-17 10:22:31, ", "idiot ", "+49 (30) 1234567 "])
def test_texts_of_a_megabyte_take_seconds(unit, weights):
    text = (unit * 1_000_000)[:1_000_000]
    start = time.perf_counter()
    personal_data.find(text, weights)
    assert len(toxicity.features(text, frozenset())) == len(toxicity.NAMES)
    assert time.perf_counter() - start < 40  # some seconds where nothing else runs; quadratic patterns took hours


def test_disguised_words_are_those_of_the_plain_pattern():
    plain = re.compile(r"[^\W\d_]+[0-9@$!|*.\-_]+[^\W\d_][\w@$!|*.\-]*|[@$0-9]+[^\W\d_][\w@$!|*]*")
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list("ab1@$!|*.-_ é٣²#"), int(rng.integers(0, 16)))) for _ in range(20_000)]
    assert [t for t in texts if plain.findall(t) != toxicity.DISGUISED.findall(t)] == []
