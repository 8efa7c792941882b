"""Parquet tables as views, and the derived inputs shared by several queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of ``sf_dir``; file or folder of parquet files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Expose tables as temporary views so that SQL text can name them."""
    for name in names or TABLES:
        read(spark, sf_dir, name).createOrReplaceTempView(name)


# The same text runs on Spark and on DuckDB.
CALL_LOG_SQL = """
SELECT event_id AS request_id,
       concat('b', CAST(user_id % 5 AS STRING)) AS backend,
       CASE user_id % 3 WHEN 0 THEN 'postgres' WHEN 1 THEN 'mysql' ELSE 'sqlite' END AS driver,
       CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'timeout'
            WHEN event_type = 'error' THEN 'transport_error'
            WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'invalid_spec'
            ELSE 'success' END AS status,
       ts AS started_at,
       CAST(floor(value * 1000) AS BIGINT) AS duration_ms,
       CAST(floor(value) AS BIGINT) AS n_rows,
       CAST(floor(value * 100) AS BIGINT) AS payload_bytes,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
FROM {events}
"""

PRICE_SPEC_SQL = """
SELECT * FROM (VALUES
  ('b0', 'per_call',  '0.10',     'USD',  CAST(NULL AS STRING)),
  ('b1', 'per_row',   '0.01',     'USD',  '0.50'),
  ('b2', 'per_byte',  '0.000001', 'USDC', CAST(NULL AS STRING)),
  ('b3', 'per_query', '1',        'EUR',  CAST(NULL AS STRING))
) AS t(backend, unit, amount, currency, max_per_call)
"""

LOG_LINES_SQL = """
SELECT doc_id,
       concat(text, ' failed to connect to postgres://u', CAST(doc_id AS STRING),
              ':pw', CAST(doc_id AS STRING), '@db.example:5432/d, retrying.') AS line
FROM {documents}
"""


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A call log derived from ``events``: one row per call."""
    return spark.sql(CALL_LOG_SQL, events=read(spark, sf_dir, "events"))


def price_spec(spark: SparkSession) -> DataFrame:
    """Prices per backend; configuration, not data."""
    return spark.sql(PRICE_SPEC_SQL)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts, each followed by a connection string with a password."""
    return spark.sql(LOG_LINES_SQL, documents=read(spark, sf_dir, "documents"))
