"""Query 9: tokens of every document."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.registry import query
from sparkq.llm.tokens import token_count
from sparkq.sources.views import read

LIMIT = 2048


@query()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; null and empty texts have no bytes and no tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    text = F.coalesce("text", F.lit(""))
    counted = read(spark, sf_dir, "documents").select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        token_count(spark, text, path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
