"""Aggregations over a call log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkq.functions.common import as_column, div
from sparkq.operators.params import run_batch

# Error kinds by status, and codes of statements gone stale.
STATUS_OF_ERROR = {
    "pool_timeout": "timeout",
    "timeout": "timeout",
    "connect": "transport_error",
    "driver": "transport_error",
    "prepare": "transport_error",
    "execute": "transport_error",
    "serialize": "transport_error",
    "invalid_spec": "invalid_spec",
    "profile_not_found": "invalid_spec",
}
STALE_CODES = ("26000", "42P18", "0A000", "1615")
NOTABLE = {"timeout": "query_timeout", "transport_error": "query_failed"}
DURATION_BUCKETS_MS = (5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 10000)
MIN_HEARTBEAT_MS = 50


def classify_status(error_kind: Column | str) -> Column:
    """Call status of an error kind; null (no error) is success."""
    kind = as_column(error_kind)
    status = F.create_map(*[F.lit(x) for pair in STATUS_OF_ERROR.items() for x in pair])
    return F.when(kind.isNull(), F.lit("success")).otherwise(
        F.coalesce(F.try_element_at(status, kind), F.lit("transport_error"))
    )


def is_stale(code: Column | str) -> Column:
    """True for error codes that call for preparing a statement again."""
    return F.coalesce(as_column(code).isin(*STALE_CODES), F.lit(False))


def call_rollup(
    calls: DataFrame,
    labels: Sequence[str] = ("backend", "driver", "status"),
    duration: str = "duration_ms",
    rows: str = "n_rows",
    buckets_ms: Sequence[int] = DURATION_BUCKETS_MS,
    quantiles: Sequence[float] = (),
) -> DataFrame:
    """Counts, sums and distributions of duration and rows per label.

    The duration histogram is ``le_<bound>`` columns (calls up to the bound),
    exact and mergeable. ``quantiles`` adds approximate percentiles. Works on a
    stream when ``labels`` holds a window of a watermarked time.
    """
    at_most = [
        F.count_if(F.col(duration) <= bound).alias(f"le_{bound}") for bound in buckets_ms
    ]
    approx = [
        F.percentile_approx(duration, q).alias(f"p{q * 100:g}".replace(".", "_"))
        for q in quantiles
    ]
    return calls.groupBy(*labels).agg(
        F.count("*").alias("calls"),
        F.sum(duration).alias("duration_ms_sum"),
        F.min(duration).alias("duration_ms_min"),
        F.max(duration).alias("duration_ms_max"),
        F.sum(rows).alias("rows_sum"),
        F.max(rows).alias("rows_max"),
        *at_most,
        *approx,
    )


# Size of a quantile sketch, and the rank error that it keeps with great certainty.
SKETCH_K = 800
RANK_ERROR = 0.01


def call_sketches(
    calls: DataFrame,
    labels: Sequence[str],
    measures: Sequence[str] = ("duration_ms", "n_rows"),
    k: int = SKETCH_K,
) -> DataFrame:
    """Per label the calls and a quantile sketch of each measure (``<measure>_sketch``).

    Sketches are a few KB whatever the number of calls and can be stored; they are made
    in each task and merged, so no label's calls meet. Nulls take no part. Works on a
    stream as ``call_rollup`` does.
    """
    sketches = [F.kll_sketch_agg_bigint(F.col(m).cast("bigint"), F.lit(k)).alias(f"{m}_sketch") for m in measures]
    return calls.groupBy(*labels).agg(F.count("*").alias("calls"), *sketches)


def merge_sketches(
    sketches: DataFrame,
    labels: Sequence[str],
    measures: Sequence[str] = ("duration_ms", "n_rows"),
    k: int = SKETCH_K,
) -> DataFrame:
    """Sketches of finer labels as those of coarser ones, such as hours as days."""
    merged = [F.kll_merge_agg_bigint(f"{m}_sketch", F.lit(k)).alias(f"{m}_sketch") for m in measures]
    return sketches.groupBy(*labels).agg(F.sum("calls").alias("calls"), *merged)


def sketch_quantiles(
    sketches: DataFrame,
    quantiles: Sequence[float],
    measures: Sequence[str] = ("duration_ms", "n_rows"),
) -> DataFrame:
    """A row for each label, measure and quantile: ``measure``, ``quantile``, ``value``.

    The rank of a value is within ``RANK_ERROR`` of its quantile. A measure without
    values has no rows.
    """
    keep = [c for c in sketches.columns if not c.endswith("_sketch")]
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])

    def pairs(measure: str) -> Column:
        sketch = F.col(f"{measure}_sketch")
        some = F.kll_sketch_get_n_bigint(sketch) > 0
        values = F.when(some, F.kll_sketch_get_quantile_bigint(sketch, wanted))
        return F.coalesce(
            F.transform(
                values,
                lambda v, i: F.struct(F.lit(measure).alias("measure"), F.get(wanted, i).alias("quantile"), v.alias("value")),
            ),
            F.array().cast("array<struct<measure:string,quantile:double,value:bigint>>"),
        )

    return sketches.select(*keep, F.inline(F.concat(*[pairs(m) for m in measures])))


def prepare_retries(
    attempts: DataFrame,
    labels: Sequence[str] = ("backend", "driver"),
    code: str = "code",
    attempt: str = "attempt",
) -> DataFrame:
    """Retries per label: first attempts that failed with a stale code."""
    retried = is_stale(code) & (F.col(attempt) == 0)
    return attempts.groupBy(*labels).agg(F.count_if(retried).alias("retries"))


def _instants(
    calls: DataFrame, labels: Sequence[str], start: str, duration: str
) -> DataFrame:
    """Net change of running calls per label and instant.

    A call without a duration is still running and has no end; one without a start
    has no instant at all.
    """
    start_us = F.unix_micros(F.col(start).cast("timestamp"))
    ends = F.struct((start_us + F.col(duration) * 1000).alias("us"), F.lit(-1).alias("delta"))
    begins = F.struct(start_us.alias("us"), F.lit(1).alias("delta"))
    change = F.inline(F.filter(F.array(begins, ends), lambda e: e["us"].isNotNull()))
    return (
        calls.select(*labels, change)
        .groupBy(*labels, "us")
        .agg(F.sum("delta").alias("delta"))
    )


def concurrency(
    calls: DataFrame,
    labels: Sequence[str] = ("driver",),
    start: str = "started_at",
    duration: str = "duration_ms",
    slice_seconds: int = 60,
) -> DataFrame:
    """Peak number of calls running at once per label, and when it is first reached.

    A call that ends at an instant is gone before calls that start then. Starts
    and ends first collapse to one row per label and instant, then a window runs
    inside each time slice, and slices are joined by their net changes. A label
    with most of the log is thereby spread over its slices, and a slice holds at
    most one row per microsecond.
    """
    labels = list(labels)
    sliced = _instants(calls, labels, start, duration).withColumn(
        "__slice", div(F.col("us"), slice_seconds * 1_000_000)
    )
    inside = W.partitionBy(*labels, "__slice").orderBy("us").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    slices = (
        sliced.withColumn("__level", F.sum("delta").over(inside))
        .groupBy(*labels, "__slice")
        .agg(
            F.sum("delta").alias("__net"),
            F.max(F.struct(F.col("__level").alias("n"), (-F.col("us")).alias("t"))).alias("__top"),
        )
    )
    before = W.partitionBy(*labels).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    peak = F.struct(
        (F.coalesce(F.sum("__net").over(before), F.lit(0)) + F.col("__top.n")).alias("n"),
        F.col("__top.t").alias("t"),
    )
    return (
        slices.withColumn("__peak", peak)
        .groupBy(*labels)
        .agg(F.max("__peak").alias("__peak"))
        .select(
            *labels,
            F.col("__peak.n").cast("bigint").alias("peak"),
            F.timestamp_micros(-F.col("__peak.t")).cast("timestamp_ntz").alias("peak_at"),
        )
    )


def running_at(
    calls: DataFrame, at: Column, start: str = "started_at", duration: str = "duration_ms"
) -> DataFrame:
    """Calls in flight at one instant with their age; the start bound is pushed down.

    A call without a duration has not ended.
    """
    begun = F.col(start).cast("timestamp")
    age_us = F.unix_micros(at.cast("timestamp")) - F.unix_micros(begun)
    return calls.where(begun <= at.cast("timestamp")).where(
        F.col(duration).isNull() | (age_us < F.col(duration) * 1000)
    ).withColumn("age_ms", div(age_us, 1000))


def running_at_each(
    calls: DataFrame,
    instants: DataFrame,
    at: str = "at",
    start: str = "started_at",
    duration: str = "duration_ms",
) -> DataFrame:
    """Calls in flight at each of many instants, with their age then: a row for each
    instant and call that runs at it.

    A call is an interval that takes one or two bins of about its own length, and an
    instant looks up one bin of each length in use; so instants meet calls by equal
    keys, whatever the numbers of both. A call without a duration is still running at
    the last instant.
    """
    begun = F.col(start).cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(begun) + F.col(duration) * 1000)
    last = instants.agg(F.max(F.col(at).cast("timestamp"))).scalar()
    open_end = F.greatest(last, begun) + F.make_dt_interval(secs=F.lit(1))
    names = {c: f"__c{i}" for i, c in enumerate(calls.columns)}
    intervals = calls.withColumns({"__begun": begun, "__ended": F.coalesce(end, open_end)}).withColumnsRenamed(names)
    points = instants.select(F.col(at).alias("__kept"), F.col(at).cast("timestamp").alias("__moment")).distinct()
    met = run_batch(points, intervals, between=("__moment", "__begun", "__ended"))
    age = div(F.unix_micros("__moment") - F.unix_micros("__begun"), 1000)
    return met.select(F.col("__kept").alias(at), *[F.col(n).alias(c) for c, n in names.items()], age.alias("age_ms"))


def cache_counts(
    calls: DataFrame,
    labels: Sequence[str] = ("backend", "driver"),
    outcome: str = "cache",
    written: str = "cache_written",
) -> DataFrame:
    """Hits, misses and writes per label; a write counts only after a miss."""
    hit, miss = F.col(outcome) == "hit", F.col(outcome) == "miss"
    return calls.groupBy(*labels).agg(
        F.count_if(hit).alias("hits"),
        F.count_if(miss).alias("misses"),
        F.count_if(miss & F.col(written)).alias("writes"),
    )


def heartbeats(
    calls: DataFrame,
    interval_ms: int,
    labels: Sequence[str] = ("backend", "driver"),
    duration: str = "duration_ms",
) -> DataFrame:
    """Progress beats per label: one per full interval a call lasted."""
    if interval_ms < MIN_HEARTBEAT_MS:
        raise ValueError(f"heartbeat interval ({interval_ms} ms) is below {MIN_HEARTBEAT_MS} ms")
    return calls.groupBy(*labels).agg(
        F.sum(div(F.col(duration), interval_ms)).alias("heartbeats")
    )


def audit_failures(
    calls: DataFrame,
    status: str = "status",
    details: Sequence[str] = ("request_id", "backend", "driver", "started_at", "duration_ms"),
    uri: str | None = None,
) -> DataFrame:
    """Audit rows of timeouts and transport failures; nothing else is notable."""
    action = F.create_map(*[F.lit(x) for pair in NOTABLE.items() for x in pair])[F.col(status)]
    return calls.where(F.col(status).isin(*NOTABLE)).select(
        *details,
        action.alias("action"),
        F.col(status).alias("reason"),
        *([F.col(uri).alias("resource_uri")] if uri else []),
    )
