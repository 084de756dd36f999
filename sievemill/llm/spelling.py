"""Spelling variant grouping: words one edit apart, and the form that a rare one of them stands for.

Candidates come from a reduced alphabet. Letters are hashed to SYMBOLS symbols; words one edit apart have reduced words that are equal or
one edit apart. So all reduced words within one edit of a word's own are generated, joined with the reduced vocabulary, and what
meets is verified on the words as they are.

A reduced word is a polynomial of its symbols modulo 2**64, and all its neighbours follow from sums over its beginnings and ends. Most
neighbours are no word's; a bitmap of the vocabulary, of bounded size, leaves them out before the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.llm.common import ascii_lower, written

#: What words are made of, and which occurrences are misspelt on purpose.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
SLIP = 31
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10

SYMBOLS = 8
BASE = 0xD6E8FEB86659FD93
#: Bits of the bitmap of reduced words: 64 for each, and so many at most (16 MB).
BITMAP_BITS = 27
#: Neighbours that are worked out at once.
BLOCK = 1 << 20
REDUCED = pa.schema([("word", pa.string()), ("n", pa.int64()), ("reduced", pa.int64())])


def misspelt(run: Column, id_: Column) -> Column:
    """``run`` in lower case; where SLIP divides the CRC of ``id:run``, without the code point that the CRC falls on."""
    h = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def spelled_words(docs: DataFrame, id_col: str, text_col: str, least_length: int, least_count: int) -> DataFrame:
    """(word, n) of all words of at least these lengths and counts."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{least_length},}}+"), F.lit(0))
    exploded = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run"))
    words = exploded.select(misspelt(ascii_lower(F.col("run")), F.col("id")).alias("word"))
    counted = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of the words of one length, their symbols from 1, a row for each)."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        points = np.frombuffer("".join(words[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), length)
        yield at, (points % SYMBOLS + 1).astype(np.uint64)


def ends(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Polynomials of the first i symbols, of those from i on as if they came first, and the powers."""
    n, length = symbols.shape
    power = powers(length + 2)
    first = np.zeros((n, length + 1), np.uint64)
    np.cumsum(symbols * power[:length], axis=1, dtype=np.uint64, out=first[:, 1:])
    # BASE is odd, so its powers can be divided by.
    inverse = np.full(length + 1, pow(BASE, -1, 2**64), np.uint64)
    inverse[:1] = 1
    last = (first[:, -1:] - first) * np.multiply.accumulate(inverse)
    return first, last, power


def reduced_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        out = np.zeros(len(words), np.uint64)
        for at, symbols in by_length(words):
            out[at] = ends(symbols)[0][:, -1]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.view(np.int64))], schema=REDUCED)


def neighbourhoods(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (places of the words, their reduced neighbours, a row for each): equal ones and those one edit away, some repeatedly."""
    length = symbols.shape[1]
    rows = max(1, BLOCK // ((length + 1) * (2 * SYMBOLS + 1)))
    for low in range(0, len(symbols), rows):
        some = symbols[low : low + rows]
        first, last, power = ends(some)
        at = np.arange(low, low + len(some))
        columns = max(1, BLOCK // (len(some) * (2 * SYMBOLS + 1)))
        for a in range(0, length + 1, columns):
            b = min(a + columns, length + 1)
            front, c = first[:, a:b], min(b, length)
            yield at, first[:, a:c] + power[a:c] * last[:, a + 1 : c + 1]  # without symbol i
            yield at, first[:, -1:]  # as it is
            for symbol in range(1, SYMBOLS + 1):
                own = power[a:b] * np.uint64(symbol)
                yield at, front + own + power[a + 1 : b + 1] * last[:, a:b]  # one more before symbol i, or at the end
                yield at, first[:, a:c] + own[: c - a] + power[a + 1 : c + 1] * last[:, a + 1 : c + 1]  # another for symbol i, or the same


def neighbours(bitmap):
    """``bitmap``: a broadcast of the bits of reduced words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        shift = np.uint64(64 - (8 * len(bits)).bit_length() + 1)
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for places, symbols in by_length(words):
                found_at, found = [], []
                for at, keys in neighbourhoods(symbols):
                    bit = keys >> shift
                    hit = np.nonzero(bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                    found_at.append(at[hit[0]])
                    found.append(keys[hit])
                pair = np.unique(np.rec.fromarrays([np.concatenate(found_at), np.concatenate(found)]))
                of = places[pair.f0]
                for low in range(0, len(of), 100_000):
                    part = of[low : low + 100_000]
                    columns = [pa.array([words[i] for i in part], pa.string()), pa.array(counts[part]), pa.array(pair.f1[low : low + 100_000].view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, schema=REDUCED)

    return run


def reduced_bitmap(vocabulary: DataFrame, n_words: int) -> np.ndarray:
    """Bits by the upper bits of reduced words; put together in Spark, in pieces of 4 KB."""
    bits = min(BITMAP_BITS, max(20, (64 * n_words).bit_length()))
    at = F.shiftrightunsigned("reduced", 64 - bits) + 1
    pieces = vocabulary.select(F.bitmap_bucket_number(at).alias("piece"), F.bitmap_bit_position(at).alias("bit"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in pieces.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        piece = np.frombuffer(row.bits, np.uint8)
        bitmap[(row.piece - 1) * 4096 :][: len(piece)] = piece
    return bitmap


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all pairs of words of ``vocabulary`` (word, n, reduced) one edit apart, in both directions."""
    spark = vocabulary.sparkSession
    bitmap = spark.sparkContext.broadcast(reduced_bitmap(vocabulary, vocabulary.count()))
    # The vocabulary is a small table beside the neighbours made of it, so its tasks are as many as those of a shuffle.
    spread = vocabulary.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    made = spread.mapInArrow(neighbours(bitmap), "word string, n long, reduced long")
    own = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "reduced")
    met = made.join(own, "reduced").where(F.levenshtein("word", "near", 1) == 1)
    return met.select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form), following forms to the last. Each round doubles the steps that a row has gone."""
    links = written(forms.select("word", F.col("form").alias("root")))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = written(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = gone.select("word", "root")
        if gone.where("moved").isEmpty():
            return links


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
    times: int = TIMES,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of ``least_length`` code points and ``least_count`` occurrences.

    Words are runs of LETTERS with A-Z lower-cased, some misspelt by the CRC of ``id:run``. Near words differ by exactly one inserted,
    deleted or replaced code point; ``n_near`` is their number. A word's form is the near word of most occurrences, the smallest of
    several, if it has ``times`` those of the word; the root follows forms to the last and is the word itself where there is none.

    Null and empty texts have no words; a null id counts as an empty one; rows all alike count each; an empty table gives no rows. Other
    columns of ``docs`` are not looked at.
    """
    words = written(spelled_words(docs, id_col, text_col, least_length, least_count))
    vocabulary = written(words.mapInArrow(reduced_words, "word string, n long, reduced long"))
    near = near_words(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.max("n").alias("own_n"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    close = written(
        near.select("word", "n_near", F.when(-F.col("best.less") >= times * F.col("own_n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("of"))
    )
    root = roots(close.where(F.col("of").isNotNull()).select("word", "of.form"))
    joined = vocabulary.select("word", "n").join(close, "word", "left").join(root, "word", "left")
    return joined.select(
        "word", "of.form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "of.form_n"
    )
