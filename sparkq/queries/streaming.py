"""Streams over the event files, run until everything available is processed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.plans.staging import new_path
from sparkq.queries import changes as batch
from sparkq.queries.registry import CALL_LOG_CTE, query
from sparkq.sources.views import CALL_LOG_SQL, read
from sparkq.streaming.changes import (
    apply_once_batches,
    apply_once_stream,
    change_stream,
    fan_out_stream,
    notification_source,
    notifications,
)
from sparkq.streaming.waiting import await_stream, failure_streak_stream, rollup_stream


BATCHES = 3
ROW_GROUP_BYTES = 4 << 20


def event_stream(spark: SparkSession, sf_dir: str, closing: bool = False) -> DataFrame:
    """``events`` as a file stream of several micro-batches in time order.

    The table is cut at quantiles of its time and written one part after the other;
    the source takes one file at a time, oldest first, so state crosses batches. With
    ``closing`` two rows of another type follow, weeks later, which move the watermark
    past all that the events leave open.
    """
    events = read(spark, sf_dir, "events")
    folder = new_path(spark, "event-files")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.select(at.cast("double").alias("at")).approxQuantile(
        "at", [i / BATCHES for i in range(1, BATCHES)], 0.01
    )
    part = sum((F.when(at > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    for i in range(BATCHES):
        # One file is one micro-batch; with small row groups many tasks read it.
        events.where(part == i).repartition(1).write.option("parquet.block.size", ROW_GROUP_BYTES).mode("append").parquet(folder)
    for weeks in (1, 2) if closing else ():
        last = events.agg(F.max("ts").alias("ts")).select(
            *[
                (F.col("ts") + F.make_dt_interval(days=F.lit(7 * weeks)) if f.name == "ts" else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in events.schema
            ]
        )
        last.withColumn("event_type", F.lit("closing")).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Write an append-mode stream to a table until its input is used up; read it back."""
    spark, out = stream.sparkSession, new_path(stream.sparkSession, label)
    running = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{new_path(spark, label)}")
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query(f"WITH {batch.NOTIFICATIONS_CTE} SELECT event_id, user_id, session_id FROM n")
def notify_parse_stream(spark, sf_dir):
    payloads = spark.sql(batch.PAYLOADS, events=event_stream(spark, sf_dir))
    return drain(notifications(payloads), "notify").select("event_id", "user_id", "session_id")


@query(
    f"""WITH {batch.SAMPLES_CTE} , versions AS (
         SELECT *, CAST(sum(CASE WHEN changed THEN 1 ELSE 0 END)
                        OVER (PARTITION BY watch ORDER BY ts, event_id) AS BIGINT) AS version FROM marked)
       SELECT watch, event_id, cursor, previous, version FROM versions WHERE changed"""
)
def change_events_stream(spark, sf_dir):
    samples = spark.sql(batch.SAMPLES, events=event_stream(spark, sf_dir))
    out = new_path(spark, "changes")
    change_stream(
        samples, "watch", ["ts", "event_id"], "cursor", out, new_path(spark, "work"), error="error"
    ).awaitTermination()
    return spark.read.parquet(out).select("watch", "event_id", "cursor", "previous", "version")


@query(
    f"""WITH {batch.STREAKS_CTE}
       SELECT request_id, backend, CAST(streak AS BIGINT) AS streak, streak = 3 AS tripped FROM streaks"""
)
def failure_streaks_stream(spark, sf_dir):
    calls = spark.sql(CALL_LOG_SQL, events=event_stream(spark, sf_dir))
    out = new_path(spark, "streaks")
    failure_streak_stream(
        calls, "backend", ["started_at", "request_id"], out, new_path(spark, "work"), threshold=3
    ).awaitTermination()
    return spark.read.parquet(out).select("request_id", "backend", "streak", "tripped")


@query(
    f"""WITH {batch.WAITS_CTE}, mark AS (SELECT max(ts) AS newest FROM events)
       SELECT event_id, user_id, matched_id, matched_at, outcome, wait_ms FROM waits, mark
       WHERE coalesce(matched_at, ts + INTERVAL 1 DAY) < newest"""
)
def await_stream_signups(spark, sf_dir):
    """Waits whose answer is final at the end of the input."""
    events = event_stream(spark, sf_dir, closing=True).select("event_id", "user_id", "ts", "event_type")
    out = new_path(spark, "waits")
    await_stream(
        events, F.col("event_type") == "signup", F.col("event_type") == "purchase",
        ["user_id"], "event_id", "ts", out, new_path(spark, "work"), timeout_ms=batch.DAY_MS,
    ).awaitTermination()
    newest = read(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    final = F.coalesce("matched_at", F.expr("ts + INTERVAL 1 DAY")) < newest
    return spark.read.parquet(out).where(final).select(
        "event_id", "user_id", "matched_id", "matched_at", "outcome", "wait_ms"
    )


@query(
    """SELECT event_id, idempotency_scope_hash, idempotency_key FROM (
         SELECT event_id, CAST(user_id AS VARCHAR) AS idempotency_scope_hash,
                concat(event_type, ':', regexp_extract(props, '([0-9]+)', 1)) AS idempotency_key,
                row_number() OVER (PARTITION BY user_id, event_type, regexp_extract(props, '([0-9]+)', 1)
                                   ORDER BY ts, event_id) AS rn FROM events) AS t
       WHERE rn = 1"""
)
def idempotent_events_stream(spark, sf_dir):
    """The first request of every key, whichever micro-batch it comes in."""
    requests = event_stream(spark, sf_dir).select(
        "event_id",
        "ts",
        F.col("user_id").cast("string").alias("idempotency_scope_hash"),
        F.concat("event_type", F.lit(":"), F.regexp_extract("props", "([0-9]+)", 1)).alias("idempotency_key"),
    )
    out = new_path(spark, "applied")
    apply_once_batches(requests, ["ts", "event_id"], out, new_path(spark, "work")).awaitTermination()
    return spark.read.parquet(out).select("event_id", "idempotency_scope_hash", "idempotency_key")


@query(
    """SELECT DISTINCT CAST(user_id AS VARCHAR) AS idempotency_scope_hash,
              concat(event_type, ':', regexp_extract(props, '([0-9]+)', 1)) AS idempotency_key FROM events"""
)
def idempotent_keys_stream(spark, sf_dir):
    """Keys that pass Spark's own de-duplication, repeats being dropped for a year."""
    requests = event_stream(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("idempotency_scope_hash"),
        F.concat("event_type", F.lit(":"), F.regexp_extract("props", "([0-9]+)", 1)).alias("idempotency_key"),
    )
    applied = drain(apply_once_stream(requests, "ts", "365 days"), "keys")
    return applied.select("idempotency_scope_hash", "idempotency_key")


@query(
    f"""WITH {batch.NOTIFICATIONS_CTE},
       subs AS (SELECT DISTINCT concat('u-', user_id) AS user_id, event_type AS topic FROM events)
       SELECT 'user' AS audience, payload, n.user_id, n.session_id, topic
       FROM n JOIN p ON p.event_id = n.event_id JOIN subs ON n.user_id = subs.user_id
       UNION ALL SELECT 'all', payload, user_id, session_id, NULL
       FROM n JOIN p ON p.event_id = n.event_id WHERE user_id IS NULL"""
)
def notify_fan_out_stream(spark, sf_dir):
    """Payloads arriving as lines of text files, delivered to the subscribers of their time."""
    events = read(spark, sf_dir, "events")
    folder, out = new_path(spark, "payload-files"), new_path(spark, "deliveries")
    payloads = spark.sql(batch.PAYLOADS, events=events).select("payload")
    payloads.repartition(BATCHES).write.text(folder)
    user = F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("user_id")

    def subscriptions():
        return read(spark, sf_dir, "events").select(user, F.col("event_type").alias("topic")).distinct()

    arriving = notifications(notification_source(spark, folder))
    fan_out_stream(arriving, subscriptions, out, new_path(spark, "work")).awaitTermination()
    return spark.read.parquet(out).select("audience", "payload", "user_id", "session_id", "topic")


@query(
    f"""WITH {CALL_LOG_CTE}, mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS newest FROM events),
       w AS (SELECT *, time_bucket(INTERVAL 1 DAY, started_at) AS window_start FROM call_log)
       SELECT window_start, backend, status, count(*) AS calls,
              CAST(sum(duration_ms) AS BIGINT) AS duration_ms_sum
       FROM w, mark WHERE window_start + INTERVAL 1 DAY <= newest
       GROUP BY window_start, backend, status"""
)
def call_rollup_stream(spark, sf_dir):
    """Daily rollups of the windows that the watermark has closed."""
    calls = spark.sql(CALL_LOG_SQL, events=event_stream(spark, sf_dir)).withColumn(
        "started_at", F.col("started_at").cast("timestamp")
    )
    closed = drain(rollup_stream(calls, "started_at", "1 day", "1 hour", ["backend", "status"]), "rollup")
    return closed.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        "backend", "status", "calls", "duration_ms_sum",
    )
