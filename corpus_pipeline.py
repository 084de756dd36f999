"""The corpus pipeline: documents go through the stages one after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.llm import bpe, line_dedup, mixing, simhash, toxicity
from sievemill.llm.common import free_names, table, written

#: The vocabulary file of the last stage; every executor has it at this path.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TOXIC = 0.5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below TOXIC.

    A null text is scored as an empty one; rows all alike have the same score and stay or go together. Without labels all score 0
    and stay. An empty table stays empty; columns may have any name.
    """
    (score,) = free_names(docs, "_toxicity")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.withColumn(score, toxicity.score(F.col("text"), model)).where(F.col(score) < TOXIC).drop(score)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the first of them; n_chars follows.

    No row goes: a document that loses all its lines has an empty text. Null texts stay null, with n_chars null; rows of one id count as one
    document, a null id is larger than any other. Columns may have any name.
    """
    (lines,) = free_names(docs, "_lines")
    kept = line_dedup.drop_repeated_lines(docs, out_col=lines).drop(lines)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id; one of a null id only where the group has no other.

    Null, empty and blank texts are one group; rows all alike are one row. Columns may have any name.
    """
    return simhash.one_of_each_group(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them, none to three times.

    A null source is a source of its own. Documents without words have size 0 and come along like others; rows all alike are taken or left
    together. Columns may have any name.
    """
    (mix,) = free_names(docs, "_mix")
    return mixing.repeated(mixing.mix(docs, F.array("source"), out_col=mix)[0], mix)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they are decoded to: none and an empty text where the text is null, empty or blank.

    One row for each row, also for rows all alike and null ids. Rows go to Python by the thousand: ids and decoded text come back with them.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    both = docs.select("doc_id", "lang", "source", bpe.round_trip(F.col("text"), VOCABULARY).alias("_both"))
    return both.select("doc_id", "lang", "source", F.size("_both.ids").cast("long").alias("n_tokens"), "_both.ids", "_both.decoded")


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_shared_lines),
    ("SimHash near-dedup", without_near_duplicates),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]

#: A trained model and a tokenizer decide here, which SQL cannot express; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = written(docs)
    return docs
