"""Query 5: a sampled segmentation of every document, and its way back."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.pieces import encode_checked
from sparkq.llm.registry import query
from sparkq.sources.views import read

MODEL = "piece_bpe_32k.model"


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document. Null texts have null ids (``n_pieces`` null, the hash of a
    null) and are lossless; empty texts have no pieces."""
    path = public_tokenizers.path(MODEL)
    pieces = read(spark, sf_dir, "documents").select(
        "doc_id", encode_checked(spark, F.col("text"), F.col("doc_id"), path).alias("p")
    )
    return pieces.select(
        "doc_id",
        F.size("p.ids").cast("long").alias("n_pieces"),
        F.xxhash64("p.ids").alias("ids_hash"),
        F.col("p.lossless").alias("lossless"),
    )
