"""Query of the mixing operator and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.mixing import mix


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mix(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) FILTER (WHERE size > 0) AS source_docs
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, 1.0::DOUBLE + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight
  FROM sizes
), shares AS (
  SELECT *, source_size::DOUBLE * 3 AS ceiling, source_size::DOUBLE * 3 / weight AS ratio
  FROM weighed
), levels AS (
  SELECT *,
         ((SELECT sum(source_size) FROM sizes)::DOUBLE
           - (sum(ceiling) OVER by_ratio - ceiling))
         / (sum(weight) OVER () - sum(weight) OVER by_ratio + weight) AS level
  FROM shares
  WINDOW by_ratio AS (ORDER BY ratio, encode(source) NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), first_open AS (
  SELECT level AS common FROM levels WHERE ratio >= level ORDER BY ratio, level LIMIT 1
), targets AS (
  SELECT source, source_size, source_docs,
         least(ceiling, coalesce((SELECT common FROM first_open) * weight, ceiling)) AS target
  FROM levels
), ranked AS (
  SELECT s.doc_id, s.size, t.source, t.source_size, t.source_docs, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size + 1e-12)::BIGINT
              ELSE 0 END AS whole,
         (('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, '-') || ':' ||
           row_number() OVER (PARTITION BY s.doc_id, s.source, s.size)), 1, 13))::BIGINT::DOUBLE
           + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), opened AS (
  SELECT *, target - whole * source_size AS open FROM ranked
), ordered AS (
  SELECT *, (u / (1 - u)) / ((open / source_size) / (1 - open / source_size)
                             * sqrt(size / (source_size / source_docs))) AS rank
  FROM opened WHERE open > 0.5 AND size > 0
  UNION ALL SELECT *, NULL FROM opened WHERE NOT (open > 0.5 AND size > 0)
), summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source, rank IS NULL ORDER BY rank, doc_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM ordered
)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN rank IS NOT NULL AND upto - size < open
                      AND (upto < open OR upto - size / 2.0 < open) THEN 1 ELSE 0 END)::BIGINT
         * size AS taken
FROM summed
"""

QUERIES = {"op10_mixing": op10_mixing}
ORACLES = {"op10_mixing": MIX_SQL}
