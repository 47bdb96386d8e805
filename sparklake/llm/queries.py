"""The registered queries of this folder, each beside the SQL that must agree where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sparklake.llm import bpe, decontaminate, lengths, lines, ngram_join, passages, phrases, quality, secrets, slots, toxicity, turns, urls

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


QUERIES = {
    "op1_byte_bpe": lambda s, d: bpe.op1(_documents(s, d), RANKS, PATTERN),
    "op2_ngram_join": lambda s, d: ngram_join.op2(_documents(s, d)),
    "op3_quality_rules": lambda s, d: quality.op3(_documents(s, d)),
    "op4_secret_scan": lambda s, d: secrets.op4(_documents(s, d)),
    "op5_substring_dedup": lambda s, d: passages.op5(_documents(s, d)),
    "op6_token_counts": lambda s, d: lengths.op6(_documents(s, d), RANKS, PATTERN),
    "op7_line_dedup": lambda s, d: lines.op7(_documents(s, d)),
    "op8_decontamination": lambda s, d: decontaminate.op8(_documents(s, d), _table(s, d, "benchmark")),
    "op9_url_filter": lambda s, d: urls.op9(_table(s, d, "pages")),
    "op10_toxicity": lambda s, d: toxicity.op10(_documents(s, d), _table(s, d, "labels")),
    "op11_phrases": lambda s, d: phrases.op11(_documents(s, d)),
    "op12_virtual_slots": lambda s, d: slots.op12(_documents(s, d)),
    "op13_conversation_repair": lambda s, d: turns.op13(_table(s, d, "conversations")),
    "pipeline": corpus_pipeline.run,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_ngram_join": rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS i, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT i, doc_id, g FROM (
    SELECT i, doc_id, array_to_string(w[j:j + 2], ' ') AS g
    FROM (SELECT i, doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS j FROM w WHERE len(w) > 0))),
n AS (SELECT i, count(*) AS n FROM g GROUP BY i),
p AS (
  SELECT x.i AS a, y.i AS b, count(*) AS o
  FROM g AS x JOIN g AS y ON x.g = y.g AND x.i <> y.i AND x.doc_id IS NOT NULL AND y.doc_id IS NOT NULL GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n AS x ON x.i = a JOIN n AS y ON y.i = b
  WHERE 100 * o >= 90 * (x.n + y.n - o)),
r AS (SELECT i AS a, i AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(doc_id) AS c FROM r JOIN w ON w.i = b GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CASE WHEN w.doc_id IS NOT NULL THEN coalesce(c, w.doc_id) END AS component_id
FROM w LEFT JOIN n USING (i) LEFT JOIN c ON c.a = w.i
""",
    "op3_quality_rules": quality.ORACLE,
    "op7_line_dedup": rf"""
WITH l AS (
  SELECT doc_id, i, lines[i] AS line, regexp_replace(
    translate(lines[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
f AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, CAST(count(f.key) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN f USING (key) GROUP BY doc_id
""",
    "op8_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
h AS (SELECT doc_id, i, k, item_id FROM places JOIN win USING (k, g)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
""",
    "op9_url_filter": urls.ORACLE,
    "op11_phrases": rf"""
WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT doc_id, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, g, count(*) AS f, min(doc_id) AS doc FROM (
    SELECT doc_id, lang, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT doc_id, lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) AS t(k) WHERE len(w) >= k))
  GROUP BY lang, k, g),
n AS (SELECT lang, CAST(sum(f) AS HUGEINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f, doc, string_split(g, ' ') AS w FROM g WHERE k > 1 AND f >= 100),
cut AS (
  SELECT lang, g, f, doc, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (
  SELECT cut.lang, cut.g, cut.f AS a, cut.doc, j, x.f AS l, y.f AS r, n, (1000::HUGEINT * cut.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN g AS x ON x.lang = cut.lang AND x.g = x JOIN g AS y ON y.lang = cut.lang AND y.g = y JOIN n ON n.lang = cut.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
held AS (
  SELECT DISTINCT lang, f, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT lang, f, w, m, unnest(range(1, k - m + 2)) AS i FROM c, range(2, 5) AS t(m) WHERE k > m)),
top AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
  FROM best WHERE NOT EXISTS (FROM held WHERE held.lang = best.lang AND held.g = best.g AND held.f >= best.a))
SELECT lang, CAST(rank AS BIGINT) AS rank, g AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, doc AS first_doc
FROM top WHERE rank <= 2000
""",
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
