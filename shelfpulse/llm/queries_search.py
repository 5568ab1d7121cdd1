"""Query of the ranked search and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.search import search


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SEARCH_SQL = r"""
WITH sides AS (
  SELECT row_number() OVER () AS row, doc_id AS id, FALSE AS query, text FROM documents
  UNION ALL SELECT row_number() OVER (), item_id, TRUE, text FROM benchmark
), found AS (
  SELECT row, id, query,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM sides
), lengths AS (
  SELECT row, count(*)::BIGINT AS n FROM found WHERE NOT query GROUP BY row
), whole AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths
), asked AS (
  SELECT row AS item, id AS item_id, term, count(*)::BIGINT AS times
  FROM found WHERE query GROUP BY ALL
), tf AS (
  SELECT row, id AS doc_id, term, count(*)::BIGINT AS tf
  FROM found WHERE NOT query AND term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, whole GROUP BY term, docs
), impacts AS (
  SELECT tf.row, doc_id, term,
         w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))) AS impact
  FROM tf JOIN weights USING (term) JOIN lengths ON lengths.row = tf.row, whole
), scored AS (
  SELECT item, item_id, row, doc_id, sum(impact * times)::BIGINT AS score
  FROM impacts JOIN asked USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

QUERIES = {"op13_search": op13_search}
ORACLES = {"op13_search": SEARCH_SQL}
