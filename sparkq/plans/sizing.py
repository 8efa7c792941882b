"""Broadcast only what has been measured to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 100_000
MAX_BYTES = 64 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Measure at most ``max_rows + 1`` rows of ``df`` against both bounds."""
    row = (
        df.limit(max_rows + 1)
        .select(F.octet_length(F.to_json(F.struct("*"))).alias("n"))
        .agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("bytes"))
        .first()
    )
    return row["rows"] <= max_rows and row["bytes"] <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Hint a broadcast when ``df`` fits; otherwise leave the join to Spark.

    Without the hint Spark uses a shuffled join, whose hot partitions adaptive
    execution splits, so a large side is slower but never wrong.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
