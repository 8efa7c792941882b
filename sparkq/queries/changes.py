"""Changes, notifications, fingerprints, reuse and waits."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from sparkq.functions.common import json_value
from sparkq.functions.encode import inline_json
from sparkq.functions.fingerprints import request_fingerprint
from sparkq.operators import changes, reuse, telemetry, waiting
from sparkq.operators.shape import row_count_hint
from sparkq.queries.registry import CALL_LOG_CTE, query
from sparkq.sources.views import call_log, read

# Poll samples per user: some polls come back empty, some fail.
SAMPLES = """SELECT user_id AS watch, ts, event_id,
  CASE WHEN event_id % 10 = 3 THEN NULL ELSE event_type END AS cursor,
  CASE WHEN event_id % 10 = 7 THEN 'connection lost' END AS error
  FROM {events}"""
SAMPLES_CTE = f"""samples AS ({SAMPLES.format(events="events")}),
  good AS (SELECT *, lag(cursor) OVER (PARTITION BY watch ORDER BY ts, event_id) AS previous
           FROM samples WHERE error IS NULL),
  marked AS (SELECT *, previous IS NOT NULL AND cursor IS DISTINCT FROM previous AS changed FROM good)"""


def samples(spark, sf_dir):
    return spark.sql(SAMPLES, events=read(spark, sf_dir, "events"))


@query(f"WITH {SAMPLES_CTE} SELECT watch, ts, event_id, cursor, previous FROM marked WHERE changed")
def change_events(spark, sf_dir):
    found = changes.change_events(
        samples(spark, sf_dir), "watch", ["ts", "event_id"], "cursor", "error"
    )
    return found.select("watch", "ts", "event_id", "cursor", "previous")


@query(
    f"""WITH {SAMPLES_CTE} SELECT watch, event_id, CAST(sum(CASE WHEN changed THEN 1 ELSE 0 END)
          OVER (PARTITION BY watch ORDER BY ts, event_id) AS BIGINT) AS version FROM marked"""
)
def version_stamps(spark, sf_dir):
    stamps = changes.version_stamps(
        samples(spark, sf_dir), "watch", ["ts", "event_id"], "cursor", "error"
    )
    return stamps.select("watch", "event_id", "version")


PAYLOADS = """SELECT event_id, CASE event_id % 7
    WHEN 0 THEN ''
    WHEN 1 THEN concat('row ', event_id, ' changed')
    WHEN 2 THEN concat('{{"user_id":"u-', user_id, '","session_id":"s-', event_id, '"}}')
    WHEN 3 THEN concat('{{"user_id":', user_id, ',"session_id":"s-', event_id, '"}}')
    WHEN 4 THEN props
    WHEN 5 THEN concat('["u-', user_id, '"]')
    ELSE concat('{{"user_id":"u-', user_id, '"}}') END AS payload
  FROM {events}"""
NOTIFICATIONS_CTE = f"""p AS ({PAYLOADS.format(events="events")}),
  j AS (SELECT event_id, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j FROM p),
  n AS (SELECT event_id,
          CASE WHEN json_type(j) = 'OBJECT' AND json_type(j, '$.user_id') = 'VARCHAR'
               THEN j ->> '$.user_id' END AS user_id,
          CASE WHEN json_type(j) = 'OBJECT' AND json_type(j, '$.session_id') = 'VARCHAR'
               THEN j ->> '$.session_id' END AS session_id FROM j)"""


def notifications(spark, sf_dir):
    payloads = spark.sql(PAYLOADS, events=read(spark, sf_dir, "events"))
    return changes.parse_notifications(payloads).select("event_id", "user_id", "session_id")


@query(f"WITH {NOTIFICATIONS_CTE} SELECT event_id, user_id, session_id FROM n")
def notify_parse(spark, sf_dir):
    return notifications(spark, sf_dir)


# Payloads that a lenient reader takes for others; {{u}} is a user.
STRICT_PAYLOADS = """SELECT event_id, user_id, replace(CASE event_id % 11
    WHEN 0 THEN '{{"user_id":"U"}} junk'
    WHEN 1 THEN '{{''user_id'':''U''}}'
    WHEN 2 THEN '{{"user_id":"U","x":NaN}}'
    WHEN 3 THEN '{{"user_id":"U"}}{{"user_id":"other"}}'
    WHEN 4 THEN '{{"user_id":"first","user_id":"U"}}'
    WHEN 5 THEN '{{"x":{{"a":1,"a":2}},"session_id":"U"}}'
    WHEN 6 THEN '{{"user_id":"U"}},{{"user_id":"other"}}'
    WHEN 7 THEN '{{"user_id":"U"}}],["x"'
    WHEN 8 THEN '{{"user_id":"U","user_id":7}}'
    WHEN 9 THEN '{{"rows_affected":3,"rows_affected":4,"user_id":"U"}}'
    ELSE ' {{"a":1,"a":2,"user_id":"U"}} ' END, 'U', concat('u-', user_id)) AS payload
  FROM {events}"""


@query(
    f"""WITH p AS ({STRICT_PAYLOADS.format(events="events")})
       SELECT event_id, CASE WHEN event_id % 11 IN (4, 9, 10) THEN concat('u-', user_id) END AS user_id,
              CASE WHEN event_id % 11 = 5 THEN concat('u-', user_id) END AS session_id,
              CAST(CASE WHEN event_id % 11 = 9 THEN 4 WHEN event_id % 11 IN (4, 5, 8, 10) THEN 1 END AS BIGINT) AS n_rows,
              CASE WHEN event_id % 11 IN (4, 9, 10) THEN concat('u-', user_id)
                   WHEN event_id % 11 = 8 THEN '7' END AS inlined
       FROM p"""
)
def strict_json(spark, sf_dir):
    """Notifications, row counts and inlined members of payloads that are no JSON, or
    have repeated members."""
    payloads = spark.sql(STRICT_PAYLOADS, events=read(spark, sf_dir, "events")).select("event_id", "payload")
    parsed = changes.parse_notifications(payloads)
    return parsed.select(
        "event_id",
        "user_id",
        "session_id",
        row_count_hint("payload").alias("n_rows"),
        F.try_variant_get(inline_json("payload"), "$.user_id", "string").alias("inlined"),
    )


@query(
    f"""WITH {NOTIFICATIONS_CTE},
       subs AS (SELECT DISTINCT concat('u-', user_id) AS user_id, event_type AS topic FROM events)
       SELECT 'user' AS audience, n.event_id, n.user_id, n.session_id, topic
       FROM n JOIN subs ON n.user_id = subs.user_id
       UNION ALL SELECT 'all', event_id, user_id, session_id, NULL FROM n WHERE user_id IS NULL"""
)
def notify_fan_out(spark, sf_dir):
    subscriptions = (
        read(spark, sf_dir, "events")
        .select(
            F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("user_id"),
            F.col("event_type").alias("topic"),
        )
        .distinct()
    )
    return changes.fan_out(notifications(spark, sf_dir), subscriptions)


def _framed(expr: str) -> str:
    return f"concat(length({expr}), ':', {expr})"


_PARAMS = f"""concat({_framed("'k'")}, {_framed("CAST(k % 10 AS VARCHAR)")},
                     {_framed("'kind'")}, {_framed("concat('" + '"' + "', status, '" + '"' + "')")})"""
_VARS = f"""concat({_framed("'driver'")}, {_framed("driver")})"""


def _fingerprint(version):
    return f"""sha256(concat('sql', {_framed("backend")}, {_framed("'SELECT 1'")},
  {_framed(_PARAMS)}, {_framed(_VARS)}, {_framed(f"CAST({version} AS VARCHAR)")}))"""


_FINGERPRINT = _fingerprint("k % 2")


def fingerprinted(spark, sf_dir):
    """Calls with the fingerprint of an imagined request behind each."""
    return with_fingerprint(call_log(spark, sf_dir), (F.col("k") % 2).cast("bigint"))


def with_fingerprint(calls, version):
    params = F.array(
        F.struct(
            F.lit("k").alias("name"), (F.col("k") % 10).cast("string").alias("value")
        ),
        F.struct(
            F.lit("kind").alias("name"), json_value(F.col("status")).alias("value")
        ),
    )
    return calls.withColumn(
        "fingerprint",
        request_fingerprint(
            "backend",
            F.lit("SELECT 1"),
            params,
            F.create_map(F.lit("driver"), F.col("driver")),
            version,
        ),
    )


@query(f"WITH {CALL_LOG_CTE} SELECT request_id, {_FINGERPRINT} AS fingerprint FROM call_log")
def request_fingerprints(spark, sf_dir):
    return fingerprinted(spark, sf_dir).select("request_id", "fingerprint")


_PRINTED = f"""{CALL_LOG_CTE}, printed AS (SELECT *, {_FINGERPRINT} AS fingerprint FROM call_log),
  fresh AS (SELECT DISTINCT fingerprint FROM printed
            WHERE started_at >= TIMESTAMP '2024-01-10' - INTERVAL 1 HOUR
              AND started_at < TIMESTAMP '2024-01-10' AND status = 'success')"""


def _stored(calls):
    """Results of the calls before a day, an hour of which is still fresh."""
    now = datetime(2024, 1, 10, tzinfo=timezone.utc)
    done = calls.where((F.col("status") == "success") & (F.col("started_at") < F.lit(now)))
    results = done.select("fingerprint", F.col("started_at").alias("computed_at"))
    return reuse.fresh_results(results, now, ttl_seconds=3600)


@query(
    f"""WITH {_PRINTED}
       SELECT fingerprint, count(*) AS n_requests FROM printed
       WHERE started_at >= TIMESTAMP '2024-01-10' AND fingerprint NOT IN (SELECT fingerprint FROM fresh)
       GROUP BY fingerprint"""
)
def missing_requests(spark, sf_dir):
    calls = fingerprinted(spark, sf_dir)
    wanted = calls.where(F.col("started_at") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return reuse.missing_requests(wanted, _stored(calls))


@query(
    f"""WITH {_PRINTED},
       wanted AS (SELECT * FROM printed WHERE started_at >= TIMESTAMP '2024-01-10'),
       first_ok AS (SELECT fingerprint, started_at, request_id FROM (
           SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY started_at, request_id) AS rn
           FROM wanted WHERE status = 'success') AS t WHERE rn = 1),
       tagged AS (SELECT w.backend, w.driver, w.status,
           f.fingerprint IS NOT NULL OR coalesce((w.started_at, w.request_id) > (o.started_at, o.request_id)
             AND o.fingerprint IS NOT NULL, false) AS hit
         FROM wanted w LEFT JOIN fresh f ON w.fingerprint = f.fingerprint
                       LEFT JOIN first_ok o ON w.fingerprint = o.fingerprint)
       SELECT backend, driver, count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses,
              count(*) FILTER (NOT hit AND status = 'success') AS writes
       FROM tagged GROUP BY backend, driver"""
)
def reuse_outcomes(spark, sf_dir):
    calls = fingerprinted(spark, sf_dir)
    wanted = calls.where(F.col("started_at") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    # Within the batch results do not expire.
    return reuse.reuse_outcomes(wanted, _stored(calls), ttl_seconds=0)


# A third of all calls ask for the same.
_ASKED = "CASE WHEN request_id % 3 = 0 THEN 'hot' ELSE concat(backend, '/', k % 10) END"


@query(
    f"""WITH RECURSIVE {CALL_LOG_CTE}, asked AS (SELECT *, {_ASKED} AS fingerprint FROM call_log),
       puts AS (SELECT fingerprint, max(started_at) AS t FROM asked
                WHERE started_at < TIMESTAMP '2024-01-04' AND status = 'success' GROUP BY fingerprint),
       log AS (SELECT * FROM asked WHERE started_at >= TIMESTAMP '2024-01-04'),
       writes AS (
         SELECT fingerprint, t FROM puts
         UNION ALL
         SELECT fingerprint, min(started_at) FROM log
         WHERE status = 'success' AND fingerprint NOT IN (SELECT fingerprint FROM puts) GROUP BY fingerprint
         UNION ALL
         SELECT fingerprint, t FROM (
           SELECT w.fingerprint, (SELECT min(l.started_at) FROM log l WHERE l.fingerprint = w.fingerprint
               AND l.status = 'success' AND l.started_at > w.t + INTERVAL 6 HOUR) AS t FROM writes w) AS n
         WHERE t IS NOT NULL),
       judged AS (SELECT l.request_id, l.started_at, l.status, max(w.t) AS last
                  FROM log l LEFT JOIN writes w ON w.fingerprint = l.fingerprint AND w.t <= l.started_at
                  GROUP BY l.request_id, l.started_at, l.status)
       SELECT request_id, CASE WHEN last <> started_at AND last >= started_at - INTERVAL 6 HOUR THEN 'hit' ELSE 'miss' END AS outcome,
              coalesce(last = started_at, false) AS written,
              CASE WHEN last >= started_at - INTERVAL 6 HOUR THEN last END AS stored_at
       FROM judged"""
)
def reuse_within_ttl(spark, sf_dir):
    """The call log against a store filled by its first days, results living six hours."""
    calls = call_log(spark, sf_dir).withColumn("fingerprint", F.expr(_ASKED))
    start = F.lit("2024-01-04").cast("timestamp_ntz")
    ok = F.col("status") == "success"
    stored = calls.where(ok & (F.col("started_at") < start)).groupBy("fingerprint").agg(F.max("started_at").alias("computed_at"))
    replayed = reuse.reuse_within_ttl(
        calls.where(F.col("started_at") >= start), ok, "started_at", ["request_id"], 6 * 3600, stored
    )
    return replayed.select("request_id", "outcome", "written", "stored_at")


# Each backend has a watch whose cursor changes with the week.
_VERSIONED = f"""{CALL_LOG_CTE}, weeks AS (
    SELECT *, dense_rank() OVER (PARTITION BY backend ORDER BY date_trunc('week', started_at)) - 1 AS version
    FROM call_log)"""


def versioned(spark, sf_dir):
    """Calls with the version their backend's watch had when they came in."""
    calls = call_log(spark, sf_dir)
    polls = calls.select(
        F.col("backend").alias("watch"), "started_at", "request_id",
        F.date_trunc("week", "started_at").cast("date").cast("string").alias("cursor"),
    )
    stamps = changes.version_stamps(polls, "watch", ["started_at", "request_id"], "cursor")
    stamps = stamps.select(F.col("watch").alias("backend"), "started_at", "version")
    return changes.versions_at(calls, stamps, "backend", "started_at", "started_at")


@query(f"WITH {_VERSIONED} SELECT request_id, backend, CAST(version AS BIGINT) AS version FROM weeks")
def request_versions(spark, sf_dir):
    return versioned(spark, sf_dir).select("request_id", "backend", "version")


def _body():
    return F.concat_ws("/", "backend", (F.col("k") % 10).cast("string"), F.col("version").cast("string"))


@query(
    f"""WITH {_VERSIONED}, printed AS (SELECT *, {_fingerprint("version")} AS fingerprint FROM weeks),
       fresh AS (SELECT DISTINCT fingerprint FROM printed
                 WHERE started_at >= TIMESTAMP '2024-01-10' - INTERVAL 1 DAY
                   AND started_at < TIMESTAMP '2024-01-10' AND status = 'success')
       SELECT request_id, concat(backend, '/', k % 10, '/', version) AS body,
              CASE WHEN fresh.fingerprint IS NULL THEN 'miss' ELSE 'hit' END AS outcome
       FROM printed LEFT JOIN fresh ON fresh.fingerprint = printed.fingerprint
       WHERE started_at >= TIMESTAMP '2024-01-10'"""
)
def answered_requests(spark, sf_dir):
    """Stored bodies for the requests they still answer, computed ones for the rest."""
    calls = with_fingerprint(versioned(spark, sf_dir), F.col("version"))
    now = datetime(2024, 1, 10, tzinfo=timezone.utc)
    done = calls.where("status = 'success'").select(
        "fingerprint", _body().alias("body"), F.col("started_at").alias("computed_at")
    )
    fresh = reuse.fresh_results(done, now, ttl_seconds=86_400).select("fingerprint", "body").distinct()
    wanted = calls.where(F.col("started_at") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    answered, _ = reuse.answer_requests(
        wanted, fresh, lambda missing: missing.select("fingerprint", _body().alias("body"))
    )
    return answered.select("request_id", "body", "outcome")


@query(
    f"""WITH {_PRINTED},
       wanted AS (SELECT * FROM printed WHERE started_at >= TIMESTAMP '2024-01-10')
       SELECT request_id, CASE WHEN fresh.fingerprint IS NULL THEN concat('computed/', backend, '/', k % 10)
                               ELSE concat('stored/', substr(w.fingerprint, 1, 8)) END AS body,
              CASE WHEN fresh.fingerprint IS NULL THEN k % 10 > 7 ELSE substr(w.fingerprint, 1, 1) < '8' END AS truncated,
              CASE WHEN fresh.fingerprint IS NULL THEN 'miss' ELSE 'hit' END AS outcome
       FROM wanted w LEFT JOIN fresh ON fresh.fingerprint = w.fingerprint"""
)
def answered_with_flag(spark, sf_dir):
    """Stored bodies differ from computed ones, and each keeps the flag it was stored with.

    The requests carry a map, as session variables are one."""
    calls = fingerprinted(spark, sf_dir).withColumn("vars", F.create_map(F.lit("driver"), F.col("driver")))
    fresh = _stored(calls).select("fingerprint").distinct()
    fresh = fresh.withColumn("body", F.concat(F.lit("stored/"), F.substring("fingerprint", 1, 8))).withColumn(
        "truncated", F.substring("fingerprint", 1, 1) < "8"
    )

    def compute(missing):
        body = F.concat(F.lit("computed/"), "backend", F.lit("/"), (F.col("k") % 10).cast("string"))
        return missing.select("fingerprint", body.alias("body"), (F.col("k") % 10 > 7).alias("truncated"))

    wanted = calls.where(F.col("started_at") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    answered, _ = reuse.answer_requests(wanted, fresh, compute, stored_with=["truncated"])
    return answered.select("request_id", "body", "truncated", "outcome")


DAY_MS = 86_400_000
WAITS_CTE = """triggers AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup'),
  checks AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
  pairs AS (SELECT t.event_id, t.user_id, t.ts, c.event_id AS cid, c.ts AS cts,
                   row_number() OVER (PARTITION BY t.event_id ORDER BY c.ts, c.event_id) AS rn
            FROM triggers t LEFT JOIN checks c ON c.user_id = t.user_id
                 AND c.ts >= t.ts AND c.ts <= t.ts + INTERVAL 1 DAY),
  waits AS (SELECT event_id, user_id, ts, cid AS matched_id, cts AS matched_at,
                   CASE WHEN cid IS NULL THEN 'timeout' ELSE 'matched' END AS outcome,
                   CASE WHEN cid IS NULL THEN 86400000
                        ELSE (epoch_us(cts) - epoch_us(ts)) // 1000 END AS wait_ms
            FROM pairs WHERE rn = 1)"""


def waits(spark, sf_dir, **options):
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    triggers = events.where("event_type = 'signup'").drop("event_type")
    return waiting.await_match(
        triggers, events, ["user_id"], "event_id", "ts", "event_id", "ts",
        "event_type = 'purchase'", timeout_ms=DAY_MS, **options,
    )


@query(
    f"WITH {WAITS_CTE} SELECT event_id, user_id, ts, matched_id, matched_at, outcome, wait_ms FROM waits"
)
def await_signup_purchase(spark, sf_dir):
    return waits(spark, sf_dir)


@query(
    """WITH triggers AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup'),
       ticks AS (SELECT t.event_id, t.user_id, t.ts, i * 21600000 AS wait_ms,
                        t.ts + to_milliseconds(i * 21600000) AS tick
                 FROM triggers t, range(0, 5) AS r(i)),
       states AS (SELECT event_id AS sid, user_id, ts AS sts, event_type,
                         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS until FROM events),
       seen AS (SELECT k.*, s.sid, s.sts, s.event_type FROM ticks k JOIN states s
                ON s.user_id = k.user_id AND s.sts <= k.tick AND (s.until IS NULL OR s.until > k.tick)),
       hits AS (SELECT event_id, min(wait_ms) AS wait_ms, arg_min(sid, wait_ms) AS sid,
                       arg_min(sts, wait_ms) AS sts FROM seen WHERE event_type = 'purchase' GROUP BY event_id)
       SELECT t.event_id, t.user_id, t.ts, h.sid AS matched_id, h.sts AS matched_at,
              CASE WHEN h.sid IS NULL THEN 'timeout' ELSE 'matched' END AS outcome,
              coalesce(h.wait_ms, 86400000) AS wait_ms
       FROM triggers t LEFT JOIN hits h ON h.event_id = t.event_id"""
)
def await_state_at_ticks(spark, sf_dir):
    """Four polls a day: only the state at each poll counts."""
    return waits(spark, sf_dir, poll_ms=DAY_MS // 4, quantise=True)


@query(
    f"""WITH {WAITS_CTE},
       counted AS (SELECT *, user_id % 5 AS backend,
                          1 + CAST(ceil(wait_ms / 3600000) AS BIGINT) AS polls FROM waits)
       SELECT backend, outcome, count(*) AS waits, CAST(sum(polls) AS BIGINT) AS polls,
              CAST(sum(polls - CASE WHEN outcome = 'matched' THEN 1 ELSE 0 END) AS BIGINT) AS spurious,
              CAST(sum(wait_ms) AS BIGINT) AS wait_ms
       FROM counted GROUP BY backend, outcome"""
)
def await_metrics(spark, sf_dir):
    labelled = waits(spark, sf_dir).withColumn("backend", F.col("user_id") % 5)
    return waiting.await_metrics(labelled, ["backend"], poll_ms=3_600_000)


@query(
    f"""WITH {WAITS_CTE},
       edges AS (SELECT user_id % 3 AS driver, epoch_us(ts) AS us, 1 AS delta FROM waits
                 UNION ALL SELECT user_id % 3, epoch_us(ts) + wait_ms * 1000, -1 FROM waits),
       levels AS (SELECT driver, us, sum(delta) OVER (PARTITION BY driver ORDER BY us, delta
                    ROWS UNBOUNDED PRECEDING) AS level FROM edges)
       SELECT driver, CAST(max(level) AS BIGINT) AS peak,
              CAST(make_timestamp(arg_max(us, (level, -us))) AS TIMESTAMP) AS peak_at
       FROM levels GROUP BY driver"""
)
def await_active_peak(spark, sf_dir):
    """Most waits open at once."""
    open_waits = waits(spark, sf_dir).withColumn("driver", F.col("user_id") % 3)
    return telemetry.concurrency(open_waits, ["driver"], "ts", "wait_ms", slice_seconds=3600)


STREAKS_CTE = f"""{CALL_LOG_CTE},
  flagged AS (SELECT *, status IN ('timeout', 'transport_error') AS failed,
                sum(CASE WHEN status IN ('timeout', 'transport_error') THEN 0 ELSE 1 END)
                  OVER (PARTITION BY backend ORDER BY started_at, request_id) AS island FROM call_log),
  streaks AS (SELECT *, CASE WHEN failed THEN row_number() OVER (
                  PARTITION BY backend, island, failed ORDER BY started_at, request_id) ELSE 0 END AS streak
              FROM flagged)"""


@query(
    f"""WITH {STREAKS_CTE}
       SELECT request_id, backend, status, CAST(streak AS BIGINT) AS streak, streak = 3 AS tripped FROM streaks"""
)
def failure_streaks(spark, sf_dir):
    streaks = waiting.failure_streaks(
        call_log(spark, sf_dir), ["backend"], ["started_at", "request_id"], threshold=3
    )
    return streaks.select("request_id", "backend", "status", "streak", "tripped")


@query(
    """WITH t AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'signup'),
       pairs AS (SELECT t.event_id, t.user_id, t.ts, c.event_id AS cid, c.ts AS cts,
                        row_number() OVER (PARTITION BY t.event_id ORDER BY c.ts, c.event_id) AS rn
                 FROM t LEFT JOIN events c ON c.user_id = t.user_id AND c.event_type = 'purchase'
                      AND c.value >= t.value AND c.ts >= t.ts AND c.ts <= t.ts + INTERVAL 1 DAY)
       SELECT event_id, user_id, cid AS matched_id, cts AS matched_at,
              CASE WHEN cid IS NULL THEN 'timeout' ELSE 'matched' END AS outcome,
              CASE WHEN cid IS NULL THEN 86400000 ELSE (epoch_us(cts) - epoch_us(ts)) // 1000 END AS wait_ms
       FROM pairs WHERE rn = 1"""
)
def await_larger_purchase(spark, sf_dir):
    """Signups waiting for a purchase of at least their own value."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    found = waiting.await_condition(
        events.where("event_type = 'signup'"), events, ["user_id"], "event_id", "ts", "event_id", "ts",
        "check.event_type = 'purchase' AND check.value >= trigger.value", timeout_ms=DAY_MS,
    )
    return found.select("event_id", "user_id", "matched_id", "matched_at", "outcome", "wait_ms")
