"""Query 6: the ten largest integer inner products of every hundredth vector."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.registry import query
from sparkq.llm.topk import top_k
from sparkq.sources.views import read

ORACLE = """
WITH v AS (
  SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
        FROM embeddings)
), scores AS (
  SELECT q.vec_id AS query_id, p.vec_id AS vec_id, CAST(sum(q.x * p.x) AS BIGINT) AS score
  FROM v q JOIN v p ON q.i = p.i AND q.vec_id <> p.vec_id
  WHERE q.vec_id % 100 = 0
  GROUP BY q.vec_id, p.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id, score
FROM scores
QUALIFY rank <= 10
"""


@query(ORACLE)
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to ten rows per query. A query's own row is every row with its id, so that a
    repeated id is no candidate of its own; other repeated rows take one place."""
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
