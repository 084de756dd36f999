"""Queries of the deduplication operators, with their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.llm import exact_dedup, line_dedup, simhash, substring_dedup
from sievemill.llm.common import table


def exact(spark, sf):
    """Every document with its group of equal texts."""
    return exact_dedup.exact_groups(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


EXACT_SQL = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""


def lines(spark, sf):
    """Every document without the lines that a document of smaller id holds."""
    docs = line_dedup.drop_repeated_lines(table(spark, sf, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return docs.select("doc_id", "_lines.n_lines", "_lines.n_dropped", kept.alias("kept_sha256"))


LINES_SQL = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM split),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
first AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.doc_id, k.i, k.line, coalesce(k.doc_id <> first_id, false) AS dropped FROM k LEFT JOIN first USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


def passages(spark, sf):
    """Every document without the passages that also stand elsewhere."""
    docs = substring_dedup.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "_kept.n_words", "_kept.n_removed", F.sha2("_kept.text", 256).alias("kept_sha256"))


PASSAGES_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
k AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS h FROM p),
r AS (SELECT doc_id, i FROM k QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS pos FROM r),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n_kept
  FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def near(spark, sf):
    """Every document with its fingerprint and the component it belongs to."""
    return simhash.near_duplicates(table(spark, sf, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES = {
    "op4_substring_dedup": (passages, PASSAGES_SQL),
    "op5_exact_dedup": (exact, EXACT_SQL),
    "op6_simhash_near_dedup": (near, None),  # SQL has neither the hash nor components; tests compare with brute force
    "op10_line_dedup": (lines, LINES_SQL),
}
