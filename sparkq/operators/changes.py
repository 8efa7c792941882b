"""Change detection over poll samples, version stamps, notifications, fan-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.functions.common import as_column, bound
from sparkq.functions.jsontext import members
from sparkq.plans.ordered import HOT_GROUP_ROWS, Running, scan_in_order
from sparkq.plans.sizing import is_small

MIN_INTERVAL_MS = 100
DEFAULT_INTERVAL_MS = 1000


def check_interval(interval_ms: int = DEFAULT_INTERVAL_MS) -> int:
    """A poll interval, refused below the floor."""
    if interval_ms < MIN_INTERVAL_MS:
        raise ValueError(f"poll every {MIN_INTERVAL_MS} ms at most, not every {interval_ms} ms")
    return interval_ms


def changed(cursor: str, previous: str = "__prev") -> Column:
    """Whether a cursor is another than the one before, if there was one."""
    return F.col(previous).isNotNull() & ~F.col(previous).eqNullSafe(F.col(cursor))


def _successful(samples: DataFrame, error: str | None) -> DataFrame:
    return samples if error is None else samples.where(F.col(error).isNull())


def change_events(
    samples: DataFrame,
    watch: str,
    order: Sequence[str],
    cursor: str,
    error: str | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Samples whose cursor differs from the one before, per watch.

    The first sample is a silent baseline, and so is a value after an empty
    sample. Samples with an error are skipped and keep the cursor.
    """
    rows = scan_in_order(
        _successful(samples, error),
        [watch],
        order,
        [Running("__prev", "prev", F.col(cursor))],
        hot_rows,
    )
    return rows.where(changed(cursor)).withColumnRenamed("__prev", "previous")


def version_stamps(
    samples: DataFrame,
    watch: str,
    order: Sequence[str],
    cursor: str,
    error: str | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Every successful sample with ``version``: the changes seen so far, from 0."""
    rows = scan_in_order(
        _successful(samples, error),
        [watch],
        order,
        [
            Running("__prev", "prev", F.col(cursor)),
            Running("version", "sum", F.when(changed(cursor), 1).otherwise(0).cast("bigint")),
        ],
        hot_rows,
    )
    return rows.drop("__prev")


def versions_at(
    requests: DataFrame,
    stamps: DataFrame,
    watch: str,
    at: str,
    stamped_at: str,
    version: str = "version",
    out: str = "version",
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Every request with the version its watch had then: that of the latest stamp at or
    before ``at``, 0 before the first one. One ordered pass over both."""
    row = F.struct(*[F.col(c) for c in requests.columns])
    kind = requests.select(row.alias("r")).schema["r"].dataType
    seen = stamps.select(
        F.col(watch).alias("__w"), F.col(stamped_at).alias("__at"), F.lit(0).alias("__kind"),
        F.col(version).cast("bigint").alias("__v"), F.lit(None).cast(kind).alias("__r"),
    ).where("__at IS NOT NULL")
    asked = requests.select(
        F.col(watch).alias("__w"), F.col(at).alias("__at"), F.lit(1).alias("__kind"),
        F.lit(None).cast("bigint").alias("__v"), row.alias("__r"),
    )
    # Versions only rise, so the latest is the largest so far.
    scanned = scan_in_order(
        seen.unionByName(asked), ["__w"], ["__at", "__kind"], [Running("__now", "max", F.col("__v"))], hot_rows
    ).where("__kind = 1")
    return scanned.select(
        *[F.col("__r")[c].alias(c) for c in requests.columns],
        F.coalesce("__now", F.lit(0).cast("bigint")).alias(out),
    )


def _text_member(parsed: Column, name: str) -> Column:
    is_text = F.schema_of_variant(parsed[name]) == "STRING"
    return F.when(is_text, F.try_variant_get(parsed[name], "$", "string"))


def parse_notifications(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``user_id`` and ``session_id`` from JSON payloads; works on streams.

    Only text members count; of a member that comes twice the last one does. Empty,
    malformed and non-object payloads are broadcasts: both columns null.
    """
    text = as_column(payload)
    # Only what can be an object with such a member is parsed; a backslash may
    # spell a member name with escapes.
    named = text.contains("user_id") | text.contains("session_id") | text.contains("\\")
    found = bound(
        F.when(named, members(text, ["user_id", "session_id"])),
        lambda parsed: F.struct(
            _text_member(parsed, "user_id").alias("user_id"),
            _text_member(parsed, "session_id").alias("session_id"),
        ),
    )
    return df.withColumn("__members", found).select(
        *df.columns, F.col("__members.user_id"), F.col("__members.session_id")
    )


def fan_out(events: DataFrame, subscriptions: DataFrame, user: str = "user_id") -> DataFrame:
    """Deliveries of parsed notifications: ``audience``, subscriber columns, event.

    A notification for one user meets that user's subscriptions in an equi join.
    A broadcast is for everyone and stays one row with ``audience = 'all'`` and
    no subscriber, so that a broadcast never multiplies by all subscriptions;
    ``deliveries_for`` reads both kinds for given subscribers.
    """
    subs = subscriptions.withColumnRenamed(user, "__user")
    extra = [c for c in subscriptions.columns if c != user]
    kinds = dict(subscriptions.dtypes)
    aimed = F.col(user) == F.col("__user")
    if not events.isStreaming and is_small(subs):
        # One pass over the notifications; nothing is shuffled.
        met = events.join(F.broadcast(subs.withColumn("__met", F.lit(True))), aimed, "left")
        audience = F.when(F.col(user).isNull(), F.lit("all")).otherwise("user")
        kept = met.where(F.col(user).isNull() | F.col("__met"))
        return kept.select(audience.alias("audience"), *events.columns, *extra)
    # Broadcasts stay out of the join: their null keys would all meet in one task.
    targeted = events.where(F.col(user).isNotNull()).join(subs, aimed)
    everyone = events.where(F.col(user).isNull())
    return targeted.select(
        F.lit("user").alias("audience"), *events.columns, *extra
    ).unionByName(
        everyone.select(
            F.lit("all").alias("audience"),
            *events.columns,
            *[F.lit(None).cast(kinds[c]).alias(c) for c in extra],
        )
    )


def deliveries_for(deliveries: DataFrame, subscriber: str, value) -> DataFrame:
    """What one subscriber receives: rows aimed at it and all broadcasts."""
    return deliveries.where((F.col("audience") == "all") | (F.col(subscriber) == F.lit(value)))
