"""Query 2: fingerprints and components of every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.registry import query
from sparkq.llm.simhash import near_duplicates
from sparkq.sources.views import read


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
