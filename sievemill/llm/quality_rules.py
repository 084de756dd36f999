"""Quality rules: lines that many documents of a host share are boilerplate; documents that are little else are rejected.

Lines are normalised and hashed; Spark counts, for each host and hash, the distinct documents that hold the line. Lines above the limit
count as removed, and a document is depleted if too few of its words are left. Documents are told apart by text, so exact copies count
as one: they are for deduplication to judge, and must not make every line of a good text look like boilerplate. ``by="row"`` tells them
apart by id instead (rows of a null id by text), as suits a corpus without copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sievemill.llm import line_dedup
from sievemill.llm.common import SPACES, ascii_lower, written

#: A line in more than so many distinct documents of a host is boilerplate.
LIMIT = 30
#: A document with less than this share of its words left is depleted.
LEFT = 0.3
#: Fixed values of the base rules.
MIN_WORDS, WINDOW, SYMBOLS = 50, 3, "#*$%&|<>"

IS_SPACE, IS_SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
IS_SPACE[list(SPACES.encode())] = True
IS_SYMBOL[list(SYMBOLS.encode())] = True


def repeated_words(words: list[bytes]) -> int:
    """How many words are in windows of three that the text holds twice or more."""
    if len(words) <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    code = ids[: len(ids) - WINDOW + 1]
    for k in range(1, WINDOW):
        code = code * len(number) + ids[k : len(ids) - WINDOW + 1 + k]
        _, code = np.unique(code, return_inverse=True)
    twice = np.flatnonzero(np.bincount(code)[code] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(WINDOW):
        covered[twice + k] = True
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data, words = np.frombuffer(raw, np.uint8), raw.split()
    starts_char = data & 0xC0 != 0x80
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), int((starts_char & ~IS_SPACE[data]).sum()), int(IS_SYMBOL[data].sum()), len(lines) - len(set(lines)), repeated_words(words)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in NAMES])


@arrow_udf(COUNTS)
def counts(texts: pa.Array) -> pa.Array:
    found = np.array([base_counts(t.as_py()) for t in texts], np.int64).reshape(-1, len(NAMES))
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(found[:, k])) for k in range(len(NAMES))], NAMES)


def normalised(line: Column) -> Column:
    """Lines that differ in case, numbers or white space alone are the same line."""
    return F.btrim(F.regexp_replace(F.regexp_replace(ascii_lower(line), "[0-9]+", "0"), f"[{SPACES}]+", " "), F.lit(" "))


def line_table(docs: DataFrame, host_col: str, id_col: str, text_col: str) -> DataFrame:
    """(host, h, doc_id, tid, line_no, words) of every line that has a word."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(host_col).alias("host"), F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tid"), text.alias("text"))
    lines = keyed.select("host", "doc_id", "tid", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select("host", "doc_id", "tid", "line_no", normalised(F.col("line")).alias("line")).where("line != ''")
    words = (F.char_length("line") - F.char_length(F.replace("line", F.lit(" "), F.lit(""))) + 1).alias("words")
    return lines.select("host", F.unhex(F.substring(F.sha2("line", 256), 1, 32)).alias("h"), "doc_id", "tid", "line_no", words)


def frequent_lines(lines: DataFrame, limit: int = LIMIT, by: str = "text") -> DataFrame:
    """(host, h, n_documents) of lines in more than ``limit`` distinct documents of a host. Both sums combine within tasks first."""
    if by not in ("text", "row"):
        raise ValueError(f"by is 'text' or 'row', not {by!r}")
    document = F.col("tid") if by == "text" else F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("tid")))
    held = lines.select("host", "h", document.alias("document")).distinct()
    return held.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_documents")).where(F.col("n_documents") > limit)


def boilerplate(lines: DataFrame, limit: int = LIMIT, by: str = "text") -> DataFrame:
    """The rows of ``lines`` above the limit."""
    found = frequent_lines(lines, limit, by).select(F.col("host").alias("_host"), F.col("h").alias("_h"))
    return lines.join(found, (F.col("h") == F.col("_h")) & F.col("host").eqNullSafe(F.col("_host"))).drop("_host", "_h")


def without_boilerplate(
    docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, by: str = "text"
) -> DataFrame:
    """(doc_id, tid, n_dropped, keep) of documents that lose lines, as bitmaps that line_dedup.kept_text applies to a text."""
    return line_dedup.bitmaps(boilerplate(written(line_table(docs, host_col, id_col, text_col)), limit, by))


def judged(
    docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, left: float = LEFT,
    by: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the base counts, n_lost_words, base_failed, depleted, kept.

    A null text is empty: no words, so it fails the base rules. Rows without a host form a host of their own; rows of a null id are told
    apart by their text. Rows all alike get the same verdict. An empty table gives no rows. Lengths have no limit.
    """
    lost = boilerplate(written(line_table(docs, host_col, id_col, text_col)), limit, by)
    lost = lost.groupBy("doc_id", "tid", "line_no").agg(F.max("words").alias("words"))  # rows all alike lose a line once
    lost = lost.groupBy(F.col("doc_id").alias("_id"), F.col("tid").alias("_tid")).agg(F.sum("words").alias("n_lost_words"))
    tid = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    base = docs.select(F.col(id_col).alias("doc_id"), tid.alias("tid"), counts(F.col(text_col)).alias("c")).select("doc_id", "tid", "c.*")
    joined = base.join(lost, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tid") == F.col("_tid")), "left").drop("_id", "_tid", "tid")
    joined = joined.withColumn("n_lost_words", F.coalesce("n_lost_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    joined = joined.withColumn("base_failed", failed)
    joined = joined.withColumn("depleted", F.col("n_words") - F.col("n_lost_words") < F.lit(left) * F.col("n_words"))
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
