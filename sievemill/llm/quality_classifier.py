"""Quality by logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

A text's features are its distinct words and pairs of words, hashed to 2**18 places, all of one value so that their squares sum to one.
Training visits the sample's texts one by one, in an order that reruns repeat; weights come from the sums of gradients and of their
squares by the closed form of the method, most of them zero. A score is a sparse dot product.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sievemill.llm.common import word_list
from sievemill.llm.training import labelled_sample

PLACES = 1 << 18
EPOCHS = 8
#: Step size, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 20.0, 1.0, 0.01, 0.001


def places(text: str | None) -> np.ndarray:
    """Where the distinct words and pairs of a text fall, sorted."""
    words = word_list(text)
    one = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ one[1:]) * np.uint64(0xD6E8FEB86659FD93)
        one = one * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(np.concatenate([one, two]) >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, at: np.ndarray) -> float:
        margin = self.bias + (self.weights[at].sum() / np.sqrt(len(at)) if len(at) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Weights after each text is seen ``epochs`` times. The last place is the bias, which bears no penalty of the first kind."""
    z, n = np.zeros(PLACES + 1), np.zeros(PLACES + 1)
    penalty = np.r_[np.full(PLACES, L1), 0.0]

    def weights(at) -> np.ndarray:
        over = np.maximum(np.abs(z[at]) - penalty[at], 0)
        return -np.sign(z[at]) * over / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            at = np.r_[texts[i], PLACES]
            value = np.r_[np.full(len(texts[i]), 1 / np.sqrt(max(1, len(texts[i])))), 1.0]
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
            g = (p - labels[i]) * value
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(np.arange(PLACES + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of a bounded labelled sample; only hashed places come to the driver. Without labels every text scores 0.5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [places(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("label"), batch.column("digest")], ["at", "label", "digest"])

    sample = labelled_sample(docs, labels, label_col, id_col, text_col)
    rows = sample.mapInArrow(run, "at binary, label int, digest string").orderBy("digest").toLocalIterator()
    texts, known = [], []
    for row in rows:
        texts.append(np.frombuffer(row["at"], np.int32))
        known.append(row["label"])
    return train(texts, np.array(known, np.float64))


def score(text: Column, model: Model) -> Column:
    """The probability that each text is of good quality; null, empty and blank texts have the bias alone. Texts are read whole."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(places(t.as_py())) for t in texts], pa.float64())

    return arrow_udf(run, T.DoubleType())(text)
