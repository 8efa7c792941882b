"""A corpus pipeline: filter, deduplicate, clean and pack documents.

Every stage takes (spark, docs, sf_dir), works on all that the stage before kept
and returns a DataFrame; its result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.lines import remove_repeated
from sparkq.llm.q_packing import pack_documents
from sparkq.llm.q_toxicity import THRESHOLD, model_of
from sparkq.llm.secrets import forest_of, redact
from sparkq.llm.simhash import BITS, keep_one, near_duplicates
from sparkq.llm.toxicity import toxicity_score
from sparkq.plans.staging import stage
from sparkq.sources.views import read


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold.

    Null and empty texts have a score like any other and stay; repeated rows and other
    columns pass unchanged.
    """
    score = toxicity_score(model_of(spark, sf_dir), F.col("text"))
    return docs.where(score < THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (three-word shingles, at most two bits, as
    in query 2), that of the smallest id.

    Texts without words have one fingerprint, so one of them stays; null ids come last;
    rows that agree in id and text leave one row. Other columns pass unchanged.
    """
    return keep_one(docs, near_duplicates(docs, BITS))


def measured(docs: DataFrame) -> DataFrame:
    """n_chars of the new texts."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines and sentences an earlier one has.

    Null and empty texts stay as they are, as do ids of any type; of rows that agree in
    id and text the units are cut alike. Other columns pass unchanged, whatever their names.
    """
    return measured(remove_repeated(docs, removed=None))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked.

    Null and empty texts stay as they are; repeated rows are masked alike; other columns
    pass unchanged, whatever their names.
    """
    return measured(redact(docs, forest_of(docs, "text", F.col("source"))))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-budget batches of all documents: one row per sequence.

    Null and empty texts are sequences of no tokens; repeated rows are sequences of
    their own; other columns are not kept.
    """
    return pack_documents(spark, docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secrets", secret_scan),
    ("packing", packing),
]

# Learned scores, 64-bit fingerprints and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
