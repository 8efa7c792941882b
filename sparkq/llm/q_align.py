"""Query 11: alignment of two tokenizers, with corpus-wide counts of linked pairs."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.align import align_corpus
from sparkq.llm.registry import query
from sparkq.sources.views import read

SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@query()
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; rows without tokens have zeros and an empty digest."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return align_corpus(
        spark,
        read(spark, sf_dir, "documents"),
        "text",
        public_tokenizers.path(SIDE_A),
        public_tokenizers.path(SIDE_B),
        keep=["doc_id"],
        outputs={"groups_sha256": digest},
    )
