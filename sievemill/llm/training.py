"""The labelled rows that models are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.llm.common import written

#: A model is fitted on so many labelled documents at most; the bound of what comes to one place.
SAMPLE = 12_000
FOLDS = 5


def held_out(id_: Column) -> Column:
    """One document in FOLDS, by the CRC of its id; a null id is held out."""
    return F.coalesce(F.crc32(id_.cast("string")) % FOLDS == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE) -> DataFrame:
    """(text, label, fold) of at most ``most`` labelled documents that are not held out, those whose ids have the smallest hashes.

    Of several labels of a document the largest counts; null labels do not. Copies of one text are one row, as they would count a text
    more than once. ``fold`` is from 0 to 99, by the text. The sample is a written table: everything after reads it, not the corpus.
    """
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(most)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(known), "_id")  # ``most`` rows at most
    sample = sample.groupBy(F.xxhash64("text").alias("of"), F.sha2("text", 256).alias("digest")).agg(
        F.max("label").alias("label"), F.min("text").alias("text")
    )
    return written(sample.select("text", "label", F.pmod("of", F.lit(100)).cast("int").alias("fold"), "digest"))
