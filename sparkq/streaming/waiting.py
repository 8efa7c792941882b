"""Waits, failure streaks and call rollups on streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkq.functions.common import div
from sparkq.operators.telemetry import call_rollup
from sparkq.operators.waiting import (
    DEFAULT_POLL_MS,
    DEFAULT_TIMEOUT_MS,
    FAILURE_THRESHOLD,
    FAILURES,
    check_await,
    check_threshold,
)
from sparkq.plans.ordered import Running, scan_in_order
from sparkq.streaming.state import CARRY, TIE, Fold, with_carries, write_batches, write_parquet


def awaited(
    events: DataFrame,
    is_trigger: Column,
    is_check: Column,
    key: Sequence[str],
    event_id: str,
    event_ts: str,
    delay_ms: int = 0,
    timeout_ms: int = DEFAULT_TIMEOUT_MS,
) -> DataFrame:
    """``await_match`` over a stream of triggers and checks, as a stream.

    Triggers and checks meet in a left outer join over their key and the interval of the
    wait; the first match of a trigger is a minimum by its own time. Spark keeps both
    sides until the watermark (the newest event time minus ``delay_ms``, older arrivals
    are dropped) is past the interval, and writes a wait when the deadline of all
    triggers of its instant is behind it. Triggers that agree in all columns are one.
    """
    check_await(min(timeout_ms, DEFAULT_POLL_MS), timeout_ms)
    at = F.col(event_ts).cast("timestamp")

    def side(condition: Column, time: str) -> DataFrame:
        marked = events.withColumn(time, at).withWatermark(time, f"{delay_ms} milliseconds")
        # The time in the filter keeps it behind the watermark, which follows all events.
        return marked.where(F.when(condition, F.col(time)).isNotNull())

    triggers = side(is_trigger, "__t")
    checks = side(is_check, "__c").select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)],
        F.col(event_id).alias("__id"),
        F.col(event_ts).alias("__at"),
        "__c",
    )
    on = (F.col("__c") >= F.col("__t")) & (F.col("__c") <= F.col("__t") + F.expr(f"INTERVAL {int(timeout_ms)} MILLISECONDS"))
    for i, k in enumerate(key):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    hit = F.when(
        F.col("__c").isNotNull(),
        F.struct(F.unix_micros("__c").alias("us"), F.col("__id").alias("id"), F.col("__at").alias("at")),
    )
    first = triggers.join(checks, on, "left").select(*events.columns, "__t", hit.alias("__hit"))
    first = first.groupBy(*events.columns, "__t").agg(F.min("__hit").alias("__hit"))
    matched = F.col("__hit").isNotNull()
    waited = div(F.col("__hit.us") - F.unix_micros("__t"), 1000)
    return first.select(
        *events.columns,
        F.col("__hit.id").alias("matched_id"),
        F.col("__hit.at").alias("matched_at"),
        F.when(matched, "matched").otherwise("timeout").alias("outcome"),
        F.when(matched, waited).otherwise(F.lit(timeout_ms)).cast("bigint").alias("wait_ms"),
    )


def await_stream(
    events: DataFrame,
    is_trigger: Column,
    is_check: Column,
    key: Sequence[str],
    event_id: str,
    event_ts: str,
    out: str,
    work: str,
    delay_ms: int = 0,
    timeout_ms: int = DEFAULT_TIMEOUT_MS,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append the waits of ``awaited`` to the table ``out``."""
    waits = awaited(events, is_trigger, is_check, key, event_id, event_ts, delay_ms, timeout_ms)
    return write_parquet(waits, out, work, trigger)


def _call_runs(failed: pa.Array, starts: pa.Array) -> list[pa.Array]:
    """Failures at the end of each run, and whether there is another call before them."""
    at = pa.array(range(len(failed)), pa.int64())
    reset = pc.fill_null(pc.if_else(failed, pa.scalar(None, pa.int64()), at), -1)
    last = pc.cumulative_max(reset)
    starts = starts.cast(pa.int64())
    ends = pa.concat_arrays([pc.subtract(starts[1:], 1), pa.array([len(failed) - 1], pa.int64())])
    whole = pc.less(last.take(ends), starts)
    before = pc.if_else(whole, pc.subtract(starts, 1), last.take(ends))
    return [pc.subtract(ends, before), pc.invert(whole)]


def _after_run(state: tuple | None, run: Row) -> tuple:
    return (run["failures"] + (0 if run["reset"] or state is None else state[0]),)


def failure_streak_stream(
    calls: DataFrame,
    service: str,
    order: Sequence[str],
    out: str,
    work: str,
    status: str = "status",
    threshold: int = FAILURE_THRESHOLD,
    trigger: Mapping[str, object] | None = None,
    ttl_ms: int | None = None,
) -> StreamingQuery:
    """Calls with ``streak`` and ``tripped``; streaks run on across micro-batches.

    State is a service's streak; with ``ttl_ms`` it is dropped so long after its last
    change. A micro-batch is one ordered scan that starts at these streaks, so no service
    has to fit into one task.
    """
    check_threshold(threshold)
    fails = F.coalesce(F.col(status).isin(*FAILURES), F.lit(False))
    fold = Fold(fails, _call_runs, "failures bigint, reset boolean", _after_run, "streak bigint")
    counted = F.when(F.col(CARRY), F.col("__s0")).otherwise(fails.cast("bigint"))
    steps = [
        Running("__failures", "sum", counted),
        Running("__at_reset", "max", F.when(~F.col(CARRY) & ~fails, F.col("__failures"))),
    ]
    streak = F.col("__failures") - F.coalesce("__at_reset", F.lit(0))

    def run(batch: DataFrame) -> DataFrame:
        rows = batch.withColumn("__row", ~F.col(CARRY))
        scanned = scan_in_order(rows, [service], ["__row", *order, TIE], steps).where("__row")
        return scanned.select(*calls.columns, streak.alias("streak"), (streak == threshold).alias("tripped"))

    return write_batches(with_carries(calls, [service], order, fold, ttl_ms), run, out, work, trigger)


def rollup_stream(
    calls: DataFrame,
    event_time: str,
    width: str,
    delay: str,
    labels: Sequence[str] = ("backend", "driver", "status"),
) -> DataFrame:
    """Call rollups per window of event time, emitted when the watermark passes."""
    windowed = calls.withWatermark(event_time, delay).withColumn(
        "window", F.window(event_time, width)
    )
    return call_rollup(windowed, ["window", *labels])
