"""Query 7: write pages as WARC records and read them back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.registry import query
from sparkq.llm.warc import header, round_trip
from sparkq.sources.views import read

ORACLE = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), firsts AS (
  SELECT html, max(page_id) AS first FROM payloads WHERE n >= 1000 GROUP BY html
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON p.html = f.html
"""


@query(ORACLE)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page. Sizes of responses are those of the payloads read back; a revisit
    has no payload, so its header tells."""
    size = F.when(header("WARC-Type") == "response", F.octet_length("payload")).otherwise(
        header("Page-Payload-Length").cast("long")
    )
    return round_trip(spark, read(spark, sf_dir, "pages")).select(
        header("Page-Id").cast("long").alias("page_id"),
        size.cast("long").alias("payload_bytes"),
        "payload_digest",
        header("WARC-Type").alias("record_type"),
        header("Refers-To-Page-Id").cast("long").alias("refers_to"),
    )
