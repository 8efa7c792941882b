"""Writes to parquet tables that report how many rows they affected."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def append(df: DataFrame, path: str) -> int:
    """Append rows to a parquet folder and return how many were written.

    The count is observed in the writing stage itself, whose task results Spark
    takes once per partition, so retried tasks do not count twice.
    """
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return written.get["n"]


def update_rows(df: DataFrame, where: str, assign: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """``(new table, one row with rows_affected)``; both lazy, neither writes."""
    matched = F.coalesce(F.expr(where), F.lit(False))
    updated = df.select(
        *[
            F.when(matched, F.expr(assign[f.name])).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in assign
            else F.col(f.name)
            for f in df.schema
        ]
    )
    return updated, df.agg(F.count_if(matched).alias("rows_affected"))


def delete_rows(df: DataFrame, where: str) -> tuple[DataFrame, DataFrame]:
    """``(remaining table, one row with rows_affected)``; both lazy."""
    matched = F.coalesce(F.expr(where), F.lit(False))
    return df.where(~matched), df.agg(F.count_if(matched).alias("rows_affected"))
