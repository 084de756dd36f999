"""Line dedup: lines that several documents share stay in the first document only.

Only DataFrame functions: hashes of the lines are range-partitioned and sorted by document and position, first occurrences are
told while the sorted rows stream by, and what comes back to a document is a bitmap of the lines it keeps, not text.

The range is over (hash, slice of documents), so a line that a third of all documents hold is spread over ``SLICES`` pieces.
In a piece, every row of another document than the piece's first is a repetition for certain. What is left, one document for each
line and piece, is settled by a second, small window over the hash alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemill.llm.common import SPACES, ascii_lower, columns_but, free_names, keyed, written

MIN_CHARS = 10
#: Pieces that one line's documents are dealt to.
SLICES = 64
BITS = 64


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h, doc_id, tid, line_no) of every line whose key is long enough; h is half of a SHA-256, 128 bits."""
    lines = docs.select("doc_id", "tid", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select("doc_id", "tid", "line_no", line_key(F.col("line")).alias("key"))
    return lines.where(F.char_length("key") >= min_chars).select(
        F.unhex(F.substring(F.sha2("key", 256), 1, 32)).alias("h"), "doc_id", "tid", "line_no"
    )


def repetitions(rows: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose line a document of smaller id holds too. A null id comes after all others."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("tid"), F.col("line_no")]
    ranged = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))).repartitionByRange("h", "slice")
    first = ranged.withColumn("first_id", F.first("doc_id").over(Window.partitionBy("h", "slice").orderBy(*order)))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id"))
    settled = first.where(~is_first)
    open_ = first.where(is_first).withColumn("first_id", F.first("doc_id").over(Window.partitionBy("h").orderBy(*order)))
    return settled.union(open_.where(~is_first)).select("doc_id", "tid", "line_no")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, tid, n_dropped, keep) of every document that loses lines.

    ``keep`` is compressed: pairs of a word number and 64 bits, bit i of word w being set if line 64 * w + i stays; words without a
    loss are left out. An empty table, texts without lines that are long enough, and rows all alike give no row.
    """
    rows = written(line_rows(keyed(docs, id_col, text_col), min_chars))
    return bitmaps(repetitions(rows))


def bitmaps(lost: DataFrame) -> DataFrame:
    """(doc_id, tid, n_dropped, keep) from the lines that go, (doc_id, tid, line_no); a line named twice goes once."""
    words = lost.groupBy("doc_id", "tid", F.floor(F.col("line_no") / BITS).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, line_no % {BITS})")).alias("bits")
    )
    return words.groupBy("doc_id", "tid").agg(
        F.sum(F.bit_count("bits")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"),
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` that the bitmap keeps. The bitmap is laid out densely first, so each line looks up its word in one step."""
    lines = F.split(text, "\n")
    by_word = F.map_from_entries(keep)
    dense = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / BITS).cast("int")),
        lambda w: F.coalesce(F.try_element_at(by_word, w), F.lit(-1).cast("long")),
    )
    # The dense bitmap is bound to a lambda's variable; written out in place it would be built anew for each line.
    return F.array_join(
        F.flatten(
            F.transform(
                F.array(dense),
                lambda d: F.filter(
                    lines, lambda _, i: F.getbit(F.get(d, F.floor(i / BITS).cast("int")), (i % BITS).cast("int")) == 1
                ),
            )
        ),
        "\n",
    )


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, out_col: str = "_lines"
) -> DataFrame:
    """``docs`` with repeated lines gone from the text, all columns and rows kept; ``out_col`` holds (n_lines, n_dropped).

    The key of a line is the line stripped of white space at both ends, A-Z lower-cased; keys of fewer than ``min_chars`` code points
    stay. Rows of one id count as one document. A null text comes back null, or empty text; a null id is larger than any other.
    A column that is called ``out_col`` already gives way to it; other columns may have any name. An empty table gives no rows.
    """
    key, found = free_names(docs, "_bitmap_of", "_bitmap")
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_chars).select(
        F.struct(F.col("doc_id").alias("id"), "tid").alias(key), F.struct("n_dropped", "keep").alias(found)
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    of = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("tid"))
    joined = docs.join(bitmaps, (of["id"].eqNullSafe(F.col(f"{key}.id"))) & (of["tid"] == F.col(f"{key}.tid")), "left")
    kept = F.when(F.col(found).isNull(), F.col(text_col)).otherwise(kept_text(text, F.col(f"{found}.keep")))
    counts = F.struct(
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"), F.coalesce(F.col(f"{found}.n_dropped"), F.lit(0)).cast("long").alias("n_dropped")
    )
    return joined.select(*[kept.alias(text_col) if c == f"`{text_col}`" else F.col(c) for c in columns_but(docs, out_col)], counts.alias(out_col))
