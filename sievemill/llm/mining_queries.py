"""Queries of the operators that mine words and phrases and look for secrets."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievemill.llm import collocations, secret_scan, spelling
from sievemill.llm.common import table


def phrases(spark, sf):
    """The best collocations of every language."""
    return collocations.collocations(table(spark, sf, "documents"))


PHRASES_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3), (4), (5)) sizes(m)
),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
spans AS (SELECT lang, f, m, ws, unnest(range(1, m + 1)) AS i FROM c),
ends AS (SELECT *, unnest(range(i + 1, m + 1)) AS j FROM spans),
inner_phrases AS (SELECT lang, array_to_string(ws[i:j], ' ') AS phrase, max(f) AS f FROM ends WHERE j - i + 1 < m GROUP BY ALL),
own AS (
  SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM inner_phrases x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.f >= 100 * c.f)
),
cuts AS (SELECT lang, phrase, f AS a, ws, m, unnest(range(1, m)) AS k FROM own),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, n.n, ((1000::HUGEINT * a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1:k], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[k + 1:cuts.m], ' ') JOIN n ON n.lang = cuts.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""



def variants(spark, sf):
    """Every word with its near words, its form and its root."""
    return spelling.spelling_variants(table(spark, sf, "documents"))


# SQL has no CRC-32, so it is worked out byte by byte. Near words: equal without the same place, or one without a place being the other.
VARIANTS_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
),
r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
d AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM r WHERE length(run) >= 7 GROUP BY ALL),
h AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(bytes), 2), lambda i: ('0x' || substr(bytes, i, 2))::BIGINT)),
    lambda c, b: xor(c // 256, steps[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM d, crc
),
spelt AS (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gap AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (
  SELECT a.word, b.word AS near FROM gap a JOIN gap b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM gap a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM gap a JOIN v b ON a.rest = b.word
),
near AS (
  SELECT pairs.word, count(*) AS n_near, min((-m.n, m.word)) AS best FROM pairs JOIN v m ON m.word = pairs.near GROUP BY pairs.word
),
t AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 10 * v.n THEN best[2] END AS form,
         CASE WHEN -best[1] >= 10 * v.n THEN -best[1] END AS form_n
  FROM v LEFT JOIN near USING (word)
),
walk AS (
  SELECT word, word AS at FROM t UNION ALL SELECT walk.word, t.form FROM walk JOIN t ON t.word = walk.at WHERE t.form IS NOT NULL
),
root AS (SELECT walk.word, walk.at AS root FROM walk JOIN t ON t.word = walk.at WHERE t.form IS NULL)
SELECT t.word, form, root, n, n_near, form_n FROM t JOIN root USING (word)
"""



def secrets(spark, sf):
    """Every document with the places of secrets in it."""
    found = table(spark, sf, "documents").select("doc_id", secret_scan.secrets(F.col("text")).alias("found"))

    def count(kind):
        return F.size(F.filter("found.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    # Kinds as listed, those of the method after them.
    order = F.array(*[F.lit(k) for k in (*secret_scan.KINDS, *(name for name, _, _ in secret_scan.CLASSES))])
    ranked = F.transform(
        F.concat("found.base", "found.added"),
        lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    return found.select(
        "doc_id", *map(count, secret_scan.KINDS), F.sha2(joined(F.col("found.base")), 256).alias("base_sha256"),
        joined(F.sort_array(ranked)).alias("spans"), F.size("found.added").cast("long").alias("n_added"),
    )


def _quoted(pattern):
    return "'" + pattern.replace("'", "''") + "'"


SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT doc_id, 'assign' AS kind, string_split_regex(text, {_quoted(secret_scan.ASSIGN)}) AS gaps, regexp_extract_all(text, {_quoted(secret_scan.ASSIGN)}) AS tokens FROM d
  UNION ALL SELECT doc_id, 'access', string_split_regex(text, '{secret_scan.ACCESS}'), regexp_extract_all(text, '{secret_scan.ACCESS}') FROM d
  UNION ALL SELECT doc_id, 'hex', string_split_regex(text, '{secret_scan.HEX}'), regexp_extract_all(text, '{secret_scan.HEX}') FROM d
  UNION ALL SELECT doc_id, 'candidate', string_split_regex(text, '{secret_scan.CANDIDATE}'), regexp_extract_all(text, '{secret_scan.CANDIDATE}') FROM d
),
sized AS (SELECT *, list_transform(gaps, lambda g: length(g)) AS gap_sizes, list_transform(tokens, lambda t: length(t)) AS token_sizes FROM cut WHERE len(tokens) > 0),
each AS (SELECT doc_id, kind, unnest(tokens) AS token, unnest(gap_sizes[:len(tokens)]) AS gap, unnest(token_sizes) AS size, unnest(range(1, len(tokens) + 1)) AS i FROM sized),
placed AS (SELECT *, (sum(gap + size) OVER (PARTITION BY doc_id, kind ORDER BY i) - size)::BIGINT AS start FROM each),
base AS (
  SELECT doc_id, kind, start, start + size AS stop, list_position(['assign', 'access', 'hex'], kind) AS rank FROM placed
  WHERE (kind = 'access' AND size >= 20) OR (kind = 'hex' AND size >= 24)
     OR (kind = 'assign' AND length(regexp_extract(token, {_quoted(secret_scan.ASSIGN)}, 2)) >= 6)
),
candidates AS (
  SELECT doc_id, start, token, CASE WHEN regexp_matches(token, '{secret_scan.CLASSES[0][1]}') THEN 1 ELSE 2 END AS class FROM placed
  WHERE kind = 'candidate' AND {" AND ".join(f"NOT regexp_matches(token, '{a}')" for a in secret_scan.ALLOWED)}
),
windows AS (SELECT *, unnest(range(1, length(token) - {secret_scan.WINDOW - 2})) AS i FROM candidates),
letters AS (SELECT doc_id, start, class, i, unnest(string_split(token[i:i + {secret_scan.WINDOW - 1}], '')) AS c FROM windows),
counted AS (SELECT doc_id, start, class, i, c, count(*) AS n FROM letters GROUP BY ALL),
dense AS (
  SELECT doc_id, start, class, i FROM counted GROUP BY ALL
  HAVING sum({[secret_scan.weighted(c) for c in range(secret_scan.WINDOW + 1)]}[n + 1]) <= CASE class WHEN 1 THEN {secret_scan.most_weight(secret_scan.CLASSES[0][2])} ELSE {secret_scan.most_weight(secret_scan.CLASSES[1][2])} END
),
opened AS (SELECT *, coalesce(i > lag(i) OVER (PARTITION BY doc_id, start ORDER BY i) + {secret_scan.WINDOW}, true) AS opens FROM dense),
grouped AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY doc_id, start ORDER BY i) AS stretch FROM opened),
stretches AS (
  SELECT doc_id, CASE class WHEN 1 THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind, start + min(i) - 1 AS start, start + max(i) + {secret_scan.WINDOW - 1} AS stop, class + 3 AS rank
  FROM grouped GROUP BY doc_id, start, class, stretch
),
added AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = s.doc_id AND b.start < s.stop AND s.start < b.stop)
),
spans AS (SELECT doc_id, kind, start, stop, rank, true AS is_base FROM base UNION ALL SELECT doc_id, kind, start, stop, rank, false FROM added),
texts AS (SELECT *, kind || ':' || start || ':' || stop AS span FROM spans),
rolled AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY start, rank) FILTER (is_base) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans, count(*) FILTER (NOT is_base) AS n_added
  FROM texts GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_added, 0) AS n_added
FROM d LEFT JOIN rolled USING (doc_id)
"""

QUERIES = {
    "op13_secret_scan": (secrets, SECRETS_SQL),
    "op12_spelling_variants": (variants, VARIANTS_SQL),
    "op11_collocations": (phrases, PHRASES_SQL),
}
