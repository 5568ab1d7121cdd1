"""Query of the vector near-duplicate operator and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.caps import near_vectors
from shelfpulse.llm.common import table


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


CAPS_SQL = """
WITH RECURSIVE given AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), vecs AS (
  SELECT vec_id, v, len(v) AS d FROM given
  WHERE v IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vecs a JOIN vecs b ON a.d = b.d AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), counted AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT g.vec_id, coalesce(c.n, 0)::BIGINT AS n_links,
       least(g.vec_id, coalesce(l.b, g.vec_id)) AS component_id,
       least(g.vec_id, coalesce(l.b, g.vec_id)) = g.vec_id AS kept
FROM given g LEFT JOIN least l ON g.vec_id = l.a LEFT JOIN counted c ON g.vec_id = c.a
"""

QUERIES = {"op8_embedding_dedup": op8_embedding_dedup}
ORACLES = {"op8_embedding_dedup": CAPS_SQL}
