"""Query 1: score every document."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.registry import query
from sparkq.llm.toxicity import Model, fit, toxicity_score
from sparkq.sources.views import read

THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def model_of(spark: SparkSession, sf_dir: str) -> Model:
    """Fitted on labelled documents that are not held out; only texts are inputs."""
    labels = (
        read(spark, sf_dir, "labels")
        .select("doc_id", F.col("toxic").alias("label"))
        .where(~held_out(F.col("doc_id")))
    )
    return fit(read(spark, sf_dir, "documents"), labels)


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = model_of(spark, sf_dir)
    scored = read(spark, sf_dir, "documents").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        toxicity_score(model, F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
