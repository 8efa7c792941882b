"""Query 13: a Merkle manifest of all documents, some of them tampered with."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.manifest import leaf_digest, manifest
from sparkq.llm.registry import query
from sparkq.sources.views import read

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@query()
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document. Ids that 7 divides by their checksum claim one character more."""
    docs = read(spark, sf_dir, "documents")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claim = F.when(changed & F.col("n_chars").isNotNull(), leaf_digest(more if c == "n_chars" else F.col(c) for c in FIELDS))
    return manifest(docs, FIELDS, "doc_id", "lang", claim).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified"
    )
