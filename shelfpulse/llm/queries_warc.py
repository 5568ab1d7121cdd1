"""Query of the archive writer and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.warc import archives_for, read_archives, with_revisits, write_archives
from shelfpulse.scratch import scratch_path


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    write_archives(with_revisits(pages), path, archives_for(pages))
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


WARC_SQL = """
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first_page FROM rows GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_page IS NOT NULL
                 AND page_id IS DISTINCT FROM first_page
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_page IS NOT NULL
                 AND page_id IS DISTINCT FROM first_page THEN first_page END AS refers_to
FROM rows JOIN firsts USING (payload_digest)
"""

QUERIES = {"op4_warc": op4_warc}
ORACLES = {"op4_warc": WARC_SQL}
