"""Query op6: write every page to deduplicated archives and read them back."""

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import warc
from paddock.llm.common import read
from paddock.llm.registry import query
from paddock.session import scratch_dir

SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, unhex(sha1(body)) AS h FROM p),
b AS (
  SELECT page_id, payload_bytes, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + v::INTEGER, 1), '' ORDER BY i) AS payload_digest
  FROM (SELECT page_id, payload_bytes, i, (('0b' || substr(bits, 5 * i + 1, 5))::INTEGER) AS v
        FROM (SELECT page_id, payload_bytes, (h::BIT)::VARCHAR AS bits FROM d), range(32) t(i))
  GROUP BY page_id, payload_bytes),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


@query("op6_warc_revisit", SQL)
def op6_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
