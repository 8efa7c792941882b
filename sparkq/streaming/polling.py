"""Polling a tracking query into a table of samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkq.operators.changes import DEFAULT_INTERVAL_MS, check_interval

SAMPLE_SCHEMA = (
    "watch string, poll_ts timestamp, cursor string, error string, poll_id bigint"
)


def sample(tracking: DataFrame, watch: str) -> DataFrame:
    """One sample row: the first column of the first row as text, null when empty."""
    column = tracking.columns[0]
    return tracking.limit(1).agg(F.max(F.col(f"`{column}`").cast("string")).alias("cursor")).select(
        F.lit(watch).alias("watch"),
        F.current_timestamp().alias("poll_ts"),
        "cursor",
        F.lit(None).cast("string").alias("error"),
    )


def poll_samples(
    spark: SparkSession,
    watch: str,
    tracking: Callable[[], DataFrame],
    out: str,
    work: str,
    interval_ms: int = DEFAULT_INTERVAL_MS,
) -> StreamingQuery:
    """Run the tracking query on every interval and add a sample to ``out``.

    A poll that fails adds a sample with its error text and polling goes on.
    ``out`` is a parquet folder that can itself be read as a stream.
    """
    check_interval(interval_ms)

    def poll(_batch: DataFrame, batch_id: int) -> None:
        target = f"{out}/poll_id={batch_id}"
        try:
            sample(tracking(), watch).write.mode("overwrite").parquet(target)
        except Exception as error:  # any failure of the query: the next poll may work
            failed = spark.range(1).select(
                F.lit(watch).alias("watch"),
                F.current_timestamp().alias("poll_ts"),
                F.lit(None).cast("string").alias("cursor"),
                F.lit(str(error)).alias("error"),
            )
            failed.write.mode("overwrite").parquet(target)

    # A micro-batch needs a row, so there have to be as many rows as polls.
    rate = -(-1000 // interval_ms)
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rate).load()
    return (
        ticks.writeStream.foreachBatch(poll)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(processingTime=f"{interval_ms} milliseconds")
        .start()
    )
