"""Query specs from ``.sql`` files, one statement each."""

from __future__ import annotations

from pyspark.sql import SparkSession

from sparkq.operators.params import QuerySpec


def spec_from_file(spark: SparkSession, path: str, name: str, **options) -> QuerySpec:
    """A spec whose text is read from ``path`` under the same guards as inline text."""
    rows = spark.read.text(path, wholetext=True).take(2)
    if len(rows) != 1:
        raise ValueError(f"{path}: expected one .sql file")
    return QuerySpec(name=name, sql=rows[0]["value"], **options)
