"""Queries of the operators that mix, encode and judge documents."""

from __future__ import annotations

from pyspark.sql import functions as F

import public_tokenizers
from sievemill.llm import bpe, mixing, personal_data, quality_classifier, quality_rules, toxicity, training
from sievemill.llm.common import table


def scored(docs, score, least):
    rows = docs.select("doc_id", training.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))


def toxic(spark, sf):
    """Every document with its toxicity."""
    docs = table(spark, sf, "documents")
    return scored(docs, toxicity.score(F.col("text"), toxicity.fit(docs, table(spark, sf, "labels"))), 0.5)


def quality(spark, sf):
    """Every document with its quality."""
    docs = table(spark, sf, "documents")
    return scored(docs, quality_classifier.score(F.col("text"), quality_classifier.fit(docs, table(spark, sf, "labels"))), 0.3)


def rules(spark, sf):
    """Every document judged by base rules and by the lines it shares with others of its source."""
    return quality_rules.judged(table(spark, sf, "documents"))


# Base counts and line frequencies as the operator has them; the pattern of words is the contract's.
RULES_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) > 3),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) > 1),
rep AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM twice) GROUP BY doc_id),
raw AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
full_lines AS (SELECT * FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
norm AS (
  SELECT doc_id, source, text, trim(regexp_replace(regexp_replace(
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
  FROM full_lines
),
often AS (SELECT source, line FROM norm GROUP BY source, line HAVING count(DISTINCT text) > 30),
lost AS (
  SELECT n.doc_id, sum(len(string_split(n.line, ' ')))::BIGINT AS n FROM norm n JOIN often o
  ON n.line = o.line AND n.source IS NOT DISTINCT FROM o.source GROUP BY n.doc_id
),
c AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in ws]), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_lost_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)
),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_words - n_lost_words < 0.3 * n_words AS depleted FROM c)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM v
"""


def personal(spark, sf):
    """Every document with the places of personal data in it."""
    docs = table(spark, sf, "documents")
    found = docs.select("doc_id", personal_data.personal_data(F.col("text"), personal_data.fit(docs)).alias("found"))

    def count(kind):
        return F.size(F.filter("found.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    # email, ip, card, phone is not the order of letters, so the place of the kind goes first.
    order = F.array(*[F.lit(k) for k in personal_data.KINDS])
    ranked = F.transform(
        F.concat("found.base", "found.added"),
        lambda s: F.struct(F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return found.select(
        "doc_id", *map(count, personal_data.KINDS), F.sha2(joined(F.col("found.base")), 256).alias("base_sha256"),
        joined(F.sort_array(ranked)).alias("spans"), F.size("found.added").cast("long").alias("n_added"),
    )


def mix(spark, sf):
    """Every document with what the mix takes of it."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    mixed, plan = mixing.mix(docs, F.array("source"))
    joined = plan.with_targets(mixed, F.col("source"))
    return joined.select("doc_id", "_mix.size", "source_size", "target", (F.col("_mix.size") * F.col("_mix.copies")).alias("taken"))


def encode(spark, sf):
    """Every document as token ids and back."""
    path = public_tokenizers.path("word_bpe_49k.json")
    both = table(spark, sf, "documents").select("doc_id", bpe.round_trip(F.col("text"), path).alias("both"))
    return both.select("doc_id", "both.*").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op3_personal_data": (personal, None),  # tests compare the patterns with plain regular expressions, the rest with planted spans
    # Trained models are not to be had in SQL; tests hold them against labels kept out of training.
    "op1_toxicity": (toxic, None),
    "op7_quality_classifier": (quality, None),
    "op2_quality_rules": (rules, RULES_SQL),
    "op8_bpe": (encode, None),  # tests compare with the tokenizers library
    "op9_mix_sources": (mix, None),  # a flow is not to be had in SQL; tests compare with brute force
}
