"""Change detection, notifications and idempotent apply on streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkq.operators.changes import changed, fan_out, parse_notifications
from sparkq.plans.ordered import Running, hashable, scan_in_order
from sparkq.streaming.state import CARRY, TIE, Fold, differ, marked_first, with_carries, write_batches


def notifications(stream: DataFrame, payload: str = "payload") -> DataFrame:
    """Parsed notifications; stateless, so the batch expression serves as is."""
    return parse_notifications(stream, payload)


def _cursor_runs(cursors: pa.Array, starts: pa.Array) -> list[pa.Array]:
    """First and last cursor of each run, and the changes inside it."""
    ends = pa.concat_arrays([pc.subtract(starts[1:], pa.scalar(1, starts.type)), pa.array([len(cursors) - 1], starts.type)])
    changed = pc.and_(pc.is_valid(cursors[:-1]), differ(cursors[:-1], cursors[1:]))
    so_far = pc.cumulative_sum(pa.concat_arrays([pa.array([0], pa.int64()), changed.cast(pa.int64())]))
    inside = pc.subtract(so_far.take(ends), so_far.take(starts))
    return [cursors.take(starts), cursors.take(ends), inside]


def _after_run(state: tuple | None, run: Row) -> tuple:
    previous, version = state or (None, 0)
    return run["last"], version + run["changes"] + (previous is not None and not _same(previous, run["first"]))


def _same(a: Any, b: Any) -> bool:
    return a == b or (a != a and b is not None and b != b)


def change_stream(
    samples: DataFrame,
    watch: str,
    order: Sequence[str],
    cursor: str,
    out: str,
    work: str,
    error: str | None = None,
    trigger: Mapping[str, object] | None = None,
    ttl_ms: int | None = None,
) -> StreamingQuery:
    """Write change events, with ``previous`` and ``version``, below ``out`` as samples arrive.

    The last cursor and version of every watch survive restarts in ``work``. With
    ``ttl_ms`` a watch whose state has not changed for so long starts anew, with a silent
    baseline. A micro-batch is one ordered scan, in which the state of a watch is the
    sample before its first one, so no watch has to fit into one task.
    """
    good = samples if error is None else samples.where(F.col(error).isNull())
    kind = samples.schema[cursor].dataType.simpleString()
    fold = Fold(
        F.col(cursor), _cursor_runs, f"first {kind}, last {kind}, changes bigint", _after_run, f"cursor {kind}, version bigint"
    )
    added = F.when(F.col(CARRY), F.col("__s1")).otherwise(changed("__now", "previous").cast("bigint"))

    def run(batch: DataFrame) -> DataFrame:
        rows = batch.select(
            *samples.columns, TIE, CARRY, (~F.col(CARRY)).alias("__row"), "__s1",
            F.when(F.col(CARRY), F.col("__s0")).otherwise(F.col(cursor)).alias("__now"),
        )
        steps = [Running("previous", "prev", F.col("__now")), Running("version", "sum", added)]
        scanned = scan_in_order(rows, [watch], ["__row", *order, TIE], steps)
        return scanned.where(F.col("__row") & changed("__now", "previous")).select(*samples.columns, "previous", "version")

    return write_batches(with_carries(good, [watch], order, fold, ttl_ms), run, out, work, trigger)


def apply_once_stream(
    requests: DataFrame,
    event_time: str,
    delay: str,
    scope: str = "idempotency_scope_hash",
    key: str = "idempotency_key",
) -> DataFrame:
    """One request of each (scope, key); a repeat within ``delay`` is dropped.

    Of the requests of one micro-batch any may be the one; ``apply_once_batches``
    takes the first.
    """
    return requests.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([scope, key])


def apply_once_batches(
    requests: DataFrame,
    order: Sequence[str],
    out: str,
    work: str,
    scope: str = "idempotency_scope_hash",
    key: str = "idempotency_key",
    trigger: Mapping[str, object] | None = None,
    ttl_ms: int | None = None,
) -> StreamingQuery:
    """The first request in ``order`` of each (scope, key) in the micro-batch it first
    comes in; later repeats are dropped for good, or for ``ttl_ms``.

    The ledger is a mark in the state store for each (scope, key). A micro-batch looks up
    the keys it meets, whatever has been applied before, and reads no output. The first
    request of a key is a minimum, combined before the shuffle.
    """
    told_apart = [F.col(f.name) for f in requests.schema if hashable(f.dataType)]
    place = F.struct(*order, F.xxhash64(*told_apart))

    def run(batch: DataFrame) -> DataFrame:
        row = F.struct(*requests.columns)
        first = F.min_by(row, F.when(~F.col("__new"), place))
        each = batch.groupBy(F.col(scope).alias("__scope"), F.col(key).alias("__key"))
        return each.agg(F.bool_or("__new").alias("__new"), first.alias("__row")).where("__new").select("__row.*")

    return write_batches(marked_first(requests, [scope, key], "__new", ttl_ms), run, out, work, trigger)


def fan_out_stream(
    notifications: DataFrame,
    subscriptions: Callable[[], DataFrame],
    out: str,
    work: str,
    user: str = "user_id",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Deliveries of a stream of parsed notifications, as ``fan_out`` makes them.

    ``subscriptions`` is called for each micro-batch, so that the subscribers are those
    of its time; broadcasts take no part in the join. A micro-batch that is run again
    overwrites its own folder of ``out``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, subscriptions(), user).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        notifications.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def notification_source(
    spark: SparkSession, path: str | None = None, kafka: Mapping[str, str] | None = None
) -> DataFrame:
    """A stream of ``payload`` texts: lines of files below ``path``, or a Kafka topic.

    Kafka needs its connector jar on the class path.
    """
    if (path is None) == (kafka is None):
        raise ValueError("give either a path or Kafka options")
    if path is not None:
        return spark.readStream.text(path).withColumnRenamed("value", "payload")
    stream = spark.readStream.format("kafka").options(**kafka).load()
    return stream.select(F.col("value").cast("string").alias("payload"), "timestamp")
