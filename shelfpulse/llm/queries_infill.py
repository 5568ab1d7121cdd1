"""Query of the fill-in-the-middle transformation and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.llm.common import table
from shelfpulse.llm.infill import restored, with_infill


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_infill(docs).select(
        "doc_id", "n", "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"),
        F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


INFILL_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), numbers AS (
  SELECT doc_id, text, lines, len(lines)::BIGINT AS n,
         ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM units
), cuts AS (
  SELECT doc_id, text, n, lines,
         least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), pieces AS (
  SELECT doc_id, text, n, form,
         coalesce(array_to_string(lines[1:low], ''), '') AS prefix,
         coalesce(array_to_string(lines[low + 1:high], ''), '') AS middle,
         coalesce(array_to_string(lines[high + 1:n], ''), '') AS suffix
  FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""

QUERIES = {"op12_infill": op12_infill}
ORACLES = {"op12_infill": INFILL_SQL}
