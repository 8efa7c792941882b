"""Waiting for a condition after a trigger, and streaks of failures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.functions.common import div
from sparkq.plans.ordered import HOT_GROUP_ROWS, Running, scan_in_order
from sparkq.plans.staging import stage

MIN_POLL_MS = 100
DEFAULT_POLL_MS = 1000
DEFAULT_TIMEOUT_MS = 60_000
FAILURE_THRESHOLD = 5
# Outcomes that count as failures of the service.
FAILURES = ("timeout", "transport_error")


def check_await(poll_ms: int = DEFAULT_POLL_MS, timeout_ms: int = DEFAULT_TIMEOUT_MS) -> None:
    """Bounds of a wait: poll at least 100 ms, timeout at least one poll."""
    if poll_ms < MIN_POLL_MS:
        raise ValueError(f"poll every {MIN_POLL_MS} ms at most, not every {poll_ms} ms")
    if timeout_ms <= 0:
        raise ValueError("the timeout must be positive")
    if timeout_ms < poll_ms:
        raise ValueError(f"a timeout of {timeout_ms} ms ends before the first poll at {poll_ms} ms")


def check_threshold(threshold: int) -> None:
    if threshold < 1:
        raise ValueError("threshold must be at least 1")


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _as_condition(predicate: Column | str) -> Column:
    # A predicate that is null is no match.
    column = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(column, F.lit(False))


def await_match(
    triggers: DataFrame,
    checks: DataFrame,
    key: Sequence[str],
    trigger_id: str,
    trigger_ts: str,
    check_id: str,
    check_ts: str,
    predicate: Column | str = "true",
    poll_ms: int = DEFAULT_POLL_MS,
    timeout_ms: int = DEFAULT_TIMEOUT_MS,
    quantise: bool = False,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """For every trigger, the first check row that satisfies ``predicate``.

    Result: the trigger columns plus ``matched_id``, ``matched_at``, ``outcome``
    (``matched`` or ``timeout``) and ``wait_ms``. A check counts from the
    trigger's own instant up to and including the deadline. A check without a time
    matches nothing; a trigger without one times out.

    Triggers and matching checks are merged in time order and each trigger takes
    the next check behind it, so the work is linear: no trigger is paired with
    more than one check, however many share its key.

    ``quantise`` looks at the state (the latest check row) at each poll tick
    instead, so a condition that flips back between two ticks is missed.
    """
    check_await(poll_ms, timeout_ms)
    checks = checks.where(F.col(check_ts).isNotNull())
    if quantise:
        return _await_ticks(
            triggers, checks, key, trigger_id, trigger_ts, check_id, check_ts,
            _as_condition(predicate), poll_ms, timeout_ms, hot_rows,
        )
    keys = [F.col(k).alias(f"__k{i}") for i, k in enumerate(key)]
    names = [f"__k{i}" for i in range(len(key))]
    hits = checks.where(predicate).select(
        *keys,
        # Descending time: what is scanned last is nearest behind the trigger.
        (-_micros(F.col(check_ts))).alias("__t"),
        F.lit(0).alias("__kind"),
        F.col(check_id).alias("__id"),
        F.struct(
            _micros(F.col(check_ts)).alias("us"),
            F.col(check_id).alias("id"),
            F.col(check_ts).alias("at"),
        ).alias("__hit"),
        F.lit(None).cast(triggers.select(F.struct("*").alias("s")).schema["s"].dataType).alias("__row"),
    )
    fired = triggers.select(
        *keys,
        (-_micros(F.col(trigger_ts))).alias("__t"),
        F.lit(1).alias("__kind"),
        F.col(trigger_id).alias("__id"),
        F.lit(None).cast(hits.schema["__hit"].dataType).alias("__hit"),
        F.struct("*").alias("__row"),
    )
    merged = scan_in_order(
        hits.unionByName(fired),
        names,
        ["__t", "__kind", "__id"],
        [Running("__next", "min", F.col("__hit"))],
        hot_rows,
    ).where("__kind = 1")
    wait_us = F.col("__next.us") + F.col("__t")
    matched = F.coalesce(wait_us <= timeout_ms * 1000, F.lit(False))
    return _outcome(merged, triggers.columns, matched, wait_us, timeout_ms)


def _same_slice(names: Sequence[str]) -> Column:
    """The same key, null included, and time slice on both sides of a join."""
    on = F.col("__slice") == F.col("s__slice")
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"s{n}"))
    return on


def await_condition(
    triggers: DataFrame,
    checks: DataFrame,
    key: Sequence[str],
    trigger_id: str,
    trigger_ts: str,
    check_id: str,
    check_ts: str,
    condition: str,
    timeout_ms: int = DEFAULT_TIMEOUT_MS,
) -> DataFrame:
    """``await_match`` with a condition over both sides, such as
    ``check.value >= trigger.minimum``.

    Key and time slices of the length of the timeout make it an equi join, so a
    trigger meets the checks of its key in two slices only; the first match is taken
    by an aggregation that combines before any shuffle. Triggers are numbered first, so
    each has an answer of its own, whatever its id.
    """
    check_await(min(timeout_ms, DEFAULT_POLL_MS), timeout_ms)
    names = [f"__k{i}" for i in range(len(key))]
    keys = [F.col(k).alias(n) for k, n in zip(key, names)]
    width = timeout_ms * 1000
    seen = checks.where(F.col(check_ts).isNotNull()).select(
        *keys, F.struct("*").alias("check"), _micros(F.col(check_ts)).alias("__us")
    ).withColumn("__slice", F.floor(F.col("__us") / width))
    seen = seen.withColumnsRenamed({n: f"s{n}" for n in [*names, "__slice"]})
    rows = stage(_numbered(triggers, keys), "triggers")
    begun = rows.withColumn("trigger", F.col("__row")).withColumn("__t", _micros(F.col(f"trigger.{trigger_ts}")))
    first_slice = F.floor(F.col("__t") / width)
    sliced = begun.drop("__row").withColumn(
        "__slice", F.explode(F.array(first_slice, first_slice + 1))
    )
    wait_us = F.col("__us") - F.col("__t")
    met = (
        sliced.join(seen, _same_slice(names))
        .where((wait_us >= 0) & (wait_us <= width))
        .where(_as_condition(condition))
        .groupBy("__tid")
        .agg(
            F.min(
                F.struct(
                    F.col("__us").alias("us"), F.col(f"check.{check_id}").alias("id"), F.col(f"check.{check_ts}").alias("at")
                )
            ).alias("__next")
        )
        .withColumnRenamed("__tid", "m__tid")
    )
    joined = rows.join(met, F.col("__tid") == F.col("m__tid"), "left")
    waited = F.col("__next.us") - _micros(F.col(f"__row.{trigger_ts}"))
    return _outcome(joined, triggers.columns, F.col("__next").isNotNull(), waited, timeout_ms)


def _numbered(triggers: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Triggers as a struct with their keys and a number; to be written before use."""
    return triggers.select(F.struct("*").alias("__row"), *keys).withColumn("__tid", F.monotonically_increasing_id())


def _outcome(
    rows: DataFrame, columns: list[str], matched: Column, wait_us: Column, timeout_ms: int
) -> DataFrame:
    return rows.select(
        *[F.col("__row")[c].alias(c) for c in columns],
        F.when(matched, F.col("__next.id")).alias("matched_id"),
        F.when(matched, F.col("__next.at")).alias("matched_at"),
        F.when(matched, F.lit("matched")).otherwise("timeout").alias("outcome"),
        F.when(matched, div(wait_us, 1000))
        .otherwise(F.lit(timeout_ms))
        .cast("bigint")
        .alias("wait_ms"),
    )


def _await_ticks(
    triggers, checks, key, trigger_id, trigger_ts, check_id, check_ts,
    condition, poll_ms, timeout_ms, hot_rows,
) -> DataFrame:
    """The first poll tick at which the state holds.

    A trigger whose state holds at once waits for nothing. The others look at the
    stretches of time, begun before their deadline, in which the state holds: the first
    tick inside a stretch follows from its start, so ticks are never rows.
    """
    names = [f"__k{i}" for i in range(len(key))]
    keys = [F.col(k).alias(n) for k, n in zip(key, names)]
    at = _micros(F.col(check_ts))
    no_trigger = F.lit(None).cast("long").alias("__tid")
    states = checks.select(
        *keys,
        at.alias("__t"),
        F.lit(0).alias("__kind"),
        F.col(check_id).alias("__id"),
        no_trigger,
        F.struct(
            at.alias("us"), F.col(check_id).alias("id"), F.col(check_ts).alias("at"), condition.alias("ok")
        ).alias("__state"),
    )
    no_state = F.lit(None).cast(states.schema["__state"].dataType).alias("__state")
    rows = stage(_numbered(triggers, keys), "triggers")
    fired = rows.select(
        *names,
        _micros(F.col(f"__row.{trigger_ts}")).alias("__t"),
        F.lit(1).alias("__kind"),
        F.col(f"__row.{trigger_id}").alias("__id"),
        "__tid",
        no_state,
    )
    now = scan_in_order(
        states.unionByName(fired), names, ["__t", "__kind", "__id"], [Running("__now", "max", F.col("__state"))], hot_rows
    ).where("__kind = 1 AND __t IS NOT NULL")
    holds = F.coalesce(F.col("__now.ok"), F.lit(False))
    columns = [*names, "__tid", "__t"]
    at_once = now.where(holds).select("__tid", F.col("__now").alias("__next"), F.lit(0).cast("bigint").alias("__waited"))

    # Every state ends with the next one of its key; the last ends never.
    never = states.select(*names).distinct().select(
        *names, F.lit(2**62).alias("__t"), F.lit(0).alias("__kind"),
        F.lit(None).cast(states.schema["__id"].dataType).alias("__id"), no_trigger, no_state,
    )
    stretches = scan_in_order(
        states.unionByName(never), names, ["__t", "__id"], [Running("__from", "prev", F.col("__state"))], hot_rows
    ).where("__from.ok")
    width = timeout_ms * 1000
    begun = stretches.select(
        *[F.col(n).alias(f"s{n}") for n in names], "__from", F.col("__t").alias("__end"), F.floor(F.col("__from.us") / width).alias("s__slice")
    )
    first_slice = F.floor(F.col("__t") / width)
    waiting = now.where(~holds).select(
        *columns, F.explode(F.array(first_slice, first_slice + 1)).alias("__slice")
    )
    poll = poll_ms * 1000
    start = F.col("__from.us") - F.col("__t")
    tick = F.ceil(start / poll) * poll
    # The last poll is at the deadline, whatever the interval.
    wait = F.when(tick < width, tick).otherwise(F.lit(width))
    inside = (F.col("__t") + wait >= F.col("__from.us")) & (F.col("__t") + wait < F.col("__end"))
    late = (F.col("__t") + width >= F.col("__from.us")) & (F.col("__t") + width < F.col("__end"))
    waited = F.when(inside, wait).when(late, F.lit(width))
    later = (
        waiting.join(begun, _same_slice(names))
        .where(start > 0)
        .withColumn("__us", waited.cast("bigint"))
        .where("__us IS NOT NULL")
        .groupBy("__tid")
        .agg(F.min_by("__from", F.struct("__us", "__from")).alias("__next"), F.min("__us").alias("__us"))
        .select("__tid", "__next", div(F.col("__us"), 1000).cast("bigint").alias("__waited"))
    )
    first = at_once.unionByName(later).withColumnRenamed("__tid", "m__tid")
    return _outcome(
        rows.join(first, F.col("__tid") == F.col("m__tid"), "left"),
        triggers.columns,
        F.col("__waited").isNotNull(),
        F.col("__waited") * 1000,
        timeout_ms,
    )


def poll_counts(waits: DataFrame, poll_ms: int = DEFAULT_POLL_MS) -> DataFrame:
    """Add ``polls`` and ``spurious``: polls made, and those without a match.

    One poll at the trigger, then one per interval; the last is at the match or
    the deadline.
    """
    polls = F.lit(1) + F.ceil(F.col("wait_ms") / poll_ms)
    return waits.withColumn("polls", polls.cast("bigint")).withColumn(
        "spurious",
        F.col("polls") - F.when(F.col("outcome") == "matched", 1).otherwise(0),
    )


def await_metrics(
    waits: DataFrame, labels: Sequence[str], poll_ms: int = DEFAULT_POLL_MS
) -> DataFrame:
    """Per label and outcome: waits, polls, spurious polls, total wait."""
    return poll_counts(waits, poll_ms).groupBy(*labels, "outcome").agg(
        F.count("*").alias("waits"),
        F.sum("polls").alias("polls"),
        F.sum("spurious").alias("spurious"),
        F.sum("wait_ms").alias("wait_ms"),
    )


def failure_streaks(
    calls: DataFrame,
    service: Sequence[str],
    order: Sequence[str],
    status: str = "status",
    threshold: int = FAILURE_THRESHOLD,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Every call with ``streak`` (failures in a row up to it) and ``tripped``.

    Only timeouts and transport errors are failures; any other outcome sets the
    streak back to 0. ``tripped`` marks the call that reaches the threshold.
    """
    check_threshold(threshold)
    # A call without a status is no failure.
    failed = F.coalesce(F.col(status).isin(*FAILURES), F.lit(False))
    rows = scan_in_order(
        calls,
        service,
        order,
        [
            Running("__failures", "sum", F.when(failed, 1).otherwise(0).cast("bigint")),
            Running("__at_reset", "max", F.when(~failed, F.col("__failures"))),
        ],
        hot_rows,
    )
    streak = F.col("__failures") - F.coalesce(F.col("__at_reset"), F.lit(0))
    return rows.withColumn("streak", streak).withColumn(
        "tripped", F.col("streak") == threshold
    ).drop("__failures", "__at_reset")
