"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

The features of a text are rates: words of a lexicon of insults, those near a second person, disguised spellings of them, capitals and
punctuation. The lexicon is a short list of plain insults and what the labelled sample adds to it. Some of the sample's folds serve
for the lexicon, the others for the trees. The calibration goes by margins that each part of these gets from trees grown without it, so
nothing is judged on what it was made from.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sievemill.llm.training import labelled_sample

#: Plain insults, and words of address in the corpus's languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown clowns dumb fool fools jerk garbage "
    "imbecile pig coward freak vermin filth".split()
)
SECOND_PERSON = frozenset("you your yours yourself youre ya du dich dir dein deine ihr euch tu te ti toi ton ta vous votre usted ustedes tus vos".split())
EDGES = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "¿¡«»„“”‘’…"
DISGUISE = str.maketrans("013457@$!|*", "oieastasil*")
#: Runs are taken whole and only from their first character, so a long run of letters or figures is walked once.
DISGUISED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$!|*.\-_]++[^\W\d_][\w@$!|*.\-]*|(?<![@$0-9])[@$0-9]++[^\W\d_][\w@$!|*]*")
REPEATED = re.compile(r"(\w)\1{2,}")
NEAR = 5
LEXICON_FOLDS = range(25)
PARTS = 4
LEXICON_SIZE, LEXICON_LEAST = 300, 8
NAMES = (
    "words insults insult_rate learned learned_rate both near_you disguised disguised_rate stretched capitals capital_words exclaim question "
    "marks repeated_marks digits"
).split()


def plain(word: str) -> str:
    return word.strip(EDGES)


def features(text: str, learned: frozenset[str]) -> list[float]:
    words = [w.strip(EDGES) for w in text.lower().split()]
    n, chars = max(1, len(words)), max(1, len(text))
    hits = [i for i, w in enumerate(words) if w in INSULTS]
    found = [i for i, w in enumerate(words) if w in learned]
    both = sorted({*hits, *found})
    near = 0
    if both:
        you = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
        if len(you):
            at = np.searchsorted(you, both)
            gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - both), np.abs(you[np.maximum(at - 1, 0)] - both))
            near = int((gap <= NEAR).sum())
    known = INSULTS | learned
    disguised = sum(1 for w in DISGUISED.findall(text.lower()) if bare(w) in known and plain(w) not in known)
    stretched = sum(1 for m in REPEATED.finditer(text))
    upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    capital_words = len(re.findall(r"\b[A-Z]{2,}\b", text))
    exclaim, question = text.count("!"), text.count("?")
    marks = sum(map(text.count, ".,;:!?#*$%&|<>"))
    repeated_marks = text.count("!!") + text.count("??") + text.count("##") + text.count("**")
    digits = sum(map(text.count, "0123456789"))
    return [
        math.log1p(n), math.log1p(len(hits)), 100 * len(hits) / n, math.log1p(len(found)), 100 * len(found) / n, math.log1p(len(both)), near,
        disguised, 100 * disguised / n, 100 * stretched / n, upper / chars, capital_words / n, 100 * exclaim / chars, 100 * question / chars,
        marks / chars, 100 * repeated_marks / chars, digits / chars,
    ]


def bare(word: str) -> str:
    """A disguised word without its disguise: digits and signs as the letters they look like, signs between letters left out."""
    return re.sub(r"[^\w]|_", "", plain(word).translate(DISGUISE))


def feature_table(texts: list[str | None], learned: frozenset[str]) -> np.ndarray:
    return np.array([features(t or "", learned) for t in texts], np.float64).reshape(len(texts), len(NAMES))


# --- trees ------------------------------------------------------------------------------------------------------------


@dataclass
class Trees:
    """Complete binary trees: node k of a tree has the children 2k + 1 and 2k + 2; the last level are the leaves."""

    depth: int
    base: float
    split_on: list[np.ndarray] = field(default_factory=list)
    above: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def margin(self, table: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(table)), np.full(len(table), self.base)
        for on, above, leaves in zip(self.split_on, self.above, self.leaves):
            node = np.zeros(len(table), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (table[rows, on[node]] > above[node])
            out += leaves[node - (2**self.depth - 1)]
        return out


def boost(table: np.ndarray, label: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Trees on the gradients of the logistic loss, split where second-order gain over binned features is largest."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(1) for c in table.T]
    binned = np.stack([np.searchsorted(cut, c, "left") for cut, c in zip(cuts, table.T)], 1)
    share = (label.sum() + 1) / (len(label) + 2)
    model = Trees(depth, math.log(share / (1 - share)))
    margin = np.full(len(label), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - label, p * (1 - p)
        on, above = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        node = np.zeros(len(label), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(count)
            for f, cut in enumerate(cuts):
                size = len(cut) + 1
                at = local * size + binned[:, f]
                g = np.bincount(at, slope, count * size).reshape(count, size).cumsum(1)
                h = np.bincount(at, bend, count * size).reshape(count, size).cumsum(1)
                left = g[:, :-1] ** 2 / (h[:, :-1] + ridge) + (g[:, -1:] - g[:, :-1]) ** 2 / (h[:, -1:] - h[:, :-1] + ridge)
                gain = left - g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                k = gain.argmax(1)
                better = gain[np.arange(count), k] > best + 1e-9
                best = np.where(better, gain[np.arange(count), k], best)
                on[first : first + count] = np.where(better, f, on[first : first + count])
                above[first : first + count] = np.where(better, cut[k], above[first : first + count])
            node = 2 * node + 1 + (table[np.arange(len(label)), on[node]] > above[node])
        leaf = node - (2**depth - 1)
        value = -rate * np.bincount(leaf, slope, 2**depth) / (np.bincount(leaf, bend, 2**depth) + ridge)
        model.split_on.append(on)
        model.above.append(above)
        model.leaves.append(value)
        margin += value[leaf]
    return model


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising function of the score that is nearest to the labels, by pooling neighbours that fall; as points to draw it through.

    One made-up row of each label at the two ends keeps it inside 0 and 1 where a few rows say little."""
    order = np.argsort(score, kind="stable")
    x = np.r_[score.min() - 1, score[order], score.max() + 1] if len(score) else np.array([-1.0, 1.0])
    y = np.r_[0.0, label[order], 1.0]
    pools: list[list[float]] = []  # sum, count, first x, last x
    for a, b in zip(x, y):
        pools.append([b, 1, a, a])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2], last]
    return np.array([v for p in pools for v in (p[2], p[3])]), np.repeat([p[0] / p[1] for p in pools], 2)


# --- fitting and scoring ----------------------------------------------------------------------------------------------


@dataclass
class Model:
    learned: frozenset[str]
    trees: Trees
    points: tuple[np.ndarray, np.ndarray]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return np.interp(self.trees.margin(feature_table(texts, self.learned)), *self.points)


def learned_lexicon(sample: DataFrame, size: int = LEXICON_SIZE, least: int = LEXICON_LEAST) -> frozenset[str]:
    """Words that stand in far more toxic texts than others, of the lexicon's folds; ``size`` at most come to the driver."""
    part = sample.where(F.col("fold").isin(*LEXICON_FOLDS))
    totals = part.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    toxic, other = totals.toxic or 0, (totals.n or 0) - (totals.toxic or 0)
    if not toxic or not other:
        return frozenset()
    words = part.select("label", F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("word"))
    words = words.select("label", F.btrim("word", F.lit(EDGES)).alias("word")).where("word != ''")
    count = words.groupBy("word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o"))
    odds = (F.col("t") + 0.5) / (toxic + 1) / ((F.col("o") + 0.5) / (other + 1))
    found = count.where((F.col("t") >= least) & (odds > 8)).orderBy(odds.desc(), "word").limit(size)
    return frozenset(r.word for r in found.select("word").collect())


def table_of(sample: DataFrame, learned: frozenset[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and folds of the sample, in the order of the texts' digests so that reruns agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = feature_table(batch.column("text").to_pylist(), learned)
            columns = [pa.array(list(table), pa.list_(pa.float64())), batch.column("label"), batch.column("fold"), batch.column("digest")]
            yield pa.RecordBatch.from_arrays(columns, ["x", "label", "fold", "digest"])

    rows = sample.mapInArrow(run, "x array<double>, label int, fold int, digest string").collect()
    rows = [r for r in sorted(rows, key=lambda r: r.digest) if r.fold not in LEXICON_FOLDS]
    x = np.array([r.x for r in rows], np.float64).reshape(len(rows), len(NAMES))
    return x, np.array([r.label for r in rows], np.float64), np.array([r.fold for r in rows], np.int64)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of a bounded labelled sample. Without any label nothing is known to be toxic, and every text scores 0."""
    sample = labelled_sample(docs, labels, label_col, id_col, text_col)
    learned = learned_lexicon(sample)
    x, label, fold = table_of(sample, learned)
    margin = np.zeros(len(label))
    for part in range(PARTS):
        out = fold % PARTS == part
        margin[out] = boost(x[~out], label[~out]).margin(x[out])
    points = isotonic(margin, label) if len(label) else (np.zeros(1), np.zeros(1))
    return Model(learned, boost(x, label), points)


def score(text: Column, model: Model) -> Column:
    """The calibrated probability that each text is toxic; null is scored as an empty text. Texts are read whole."""

    def run(texts: pa.Array) -> pa.Array:
        parts = [model.scores(texts[at : at + 256].to_pylist()) for at in range(0, len(texts), 256)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0))

    return arrow_udf(run, T.DoubleType())(text)
