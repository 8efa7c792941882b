"""Query 4: the secrets of all documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.registry import query
from sparkq.llm.secrets import forest_of, scan
from sparkq.sources.views import read


@query()
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    forest = forest_of(documents, "text", F.col("source"))
    return scan(documents, forest).select(
        "doc_id", "nth", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score"
    )
