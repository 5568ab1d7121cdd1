"""Query of the near-duplicate operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.minhash import near_duplicates


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), width=3, least=85)
    return found.drop("text_hash")


MINHASH_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id,
         CASE WHEN len(w) = 0 THEN []
              WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 1),
                                 lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c
  FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs WHERE 100 * c >= 85 * (n + m - c)
  UNION ALL
  SELECT b, a FROM pairs WHERE 100 * c >= 85 * (n + m - c)
), reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_id AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles,
       least(s.doc_id, coalesce(l.b, s.doc_id)) AS component_id,
       least(s.doc_id, coalesce(l.b, s.doc_id)) = s.doc_id AS kept
FROM sets s LEFT JOIN least_id l ON s.doc_id = l.a
"""

QUERIES = {"op3_minhash_dedup": op3_minhash_dedup}
ORACLES = {"op3_minhash_dedup": MINHASH_SQL}
