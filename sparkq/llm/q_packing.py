"""Query 10: token-budget batches of all documents."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.packing import pack
from sparkq.llm.registry import query
from sparkq.llm.tokens import token_count
from sparkq.sources.views import read

VOCABULARY = "word_bpe_49k.json"


def pack_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    tokens = token_count(spark, F.col("text"), public_tokenizers.path(VOCABULARY))
    return pack(docs, "doc_id", tokens)


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sequence. Null and empty texts are sequences of no tokens; a text over
    the budget is several; repeated rows are sequences of their own."""
    return pack_documents(spark, read(spark, sf_dir, "documents"))
