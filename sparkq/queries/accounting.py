"""Cost accounting and call-log telemetry."""

from pyspark.sql import functions as F

from sparkq.operators import cost, telemetry
from sparkq.plans.staging import stage
from sparkq.queries.registry import CALL_LOG_CTE, query
from sparkq.sources.views import PRICE_SPEC_SQL, call_log, price_spec, read

_PRICED = f"""{CALL_LOG_CTE}, spec AS ({PRICE_SPEC_SQL}),
  priced AS (SELECT c.*, s.unit, s.currency, CAST(s.amount AS DOUBLE) AS base,
                    CAST(s.max_per_call AS DOUBLE) AS cap
             FROM call_log c JOIN spec s ON c.backend = s.backend),
  charged AS (SELECT *, CASE unit WHEN 'per_row' THEN base * n_rows
                                  WHEN 'per_byte' THEN base * payload_bytes ELSE base END AS total
              FROM priced WHERE status = 'success'),
  charges AS (SELECT *, CASE WHEN total > cap THEN 'over_cap' END AS refused_reason,
                     CASE WHEN total > cap THEN NULL ELSE total END AS charge FROM charged),
  refunds AS (SELECT *, CASE status WHEN 'timeout' THEN 'timeout' WHEN 'transport_error' THEN 'transport'
                          ELSE 'invalid_spec' END AS reason,
                     CASE WHEN unit IN ('per_call', 'per_query') THEN base ELSE 0 END AS amount
              FROM priced WHERE status <> 'success')"""


def _charges(spark, sf_dir):
    successful = call_log(spark, sf_dir).where("status = 'success'")
    return cost.charges(successful, price_spec(spark))


def _refunds(spark, sf_dir):
    return cost.refunds(call_log(spark, sf_dir), price_spec(spark))


@query(
    f"""WITH {_PRICED} SELECT request_id, backend, unit, currency, round(charge, 6) AS charge, refused_reason
       FROM charges"""
)
def cost_charges(spark, sf_dir):
    return _charges(spark, sf_dir).select(
        "request_id", "backend", "unit", "currency", F.round("charge", 6).alias("charge"), "refused_reason"
    )


@query(
    f"""WITH {CALL_LOG_CTE}
       SELECT request_id, backend, CASE WHEN price <= 0.1 THEN round(CAST(price AS DOUBLE), 6) END AS charge,
              CASE WHEN price > 0.1 THEN 'over_cap' END AS refused_reason
       FROM (SELECT *, k * 0.001 + 0.01 * CAST(substr(backend, 2) AS INTEGER) AS price
             FROM call_log WHERE status = 'success')"""
)
def cost_expression(spark, sf_dir):
    """Prices computed from the calls' own arguments, with a cap per call."""
    expressions = {f"b{i}": f"k * 0.001 + 0.01 * {i}" for i in range(5)}
    spec = spark.createDataFrame(
        [(b, "per_call", e, "USD", "0.1") for b, e in expressions.items()],
        "backend string, unit string, expression string, currency string, max_per_call string",
    )
    calls = call_log(spark, sf_dir).where("status = 'success'")
    charged = cost.charges(calls, spec, expressions=expressions)
    return charged.select(
        "request_id", "backend", F.round("charge", 6).alias("charge"), "refused_reason"
    )


@query(f"WITH {_PRICED} SELECT request_id, backend, reason, amount, currency FROM refunds")
def cost_refunds(spark, sf_dir):
    return _refunds(spark, sf_dir).select("request_id", "backend", "reason", "amount", "currency")


@query(
    f"""WITH {_PRICED}
       SELECT 'charge' AS kind, backend, driver, currency, unit AS label, count(*) AS calls,
              CAST(sum(coalesce(CAST(round(charge * 1000000) AS BIGINT), 0)) AS BIGINT) AS micro_units
       FROM charges GROUP BY backend, driver, currency, unit
       UNION ALL
       SELECT 'refund', backend, driver, currency, reason, count(*),
              CAST(sum(CAST(round(amount * 1000000) AS BIGINT)) AS BIGINT)
       FROM refunds GROUP BY backend, driver, currency, reason"""
)
def cost_totals(spark, sf_dir):
    labels = ["kind", "backend", "driver", "currency", "label"]
    entries = cost.ledger(call_log(spark, sf_dir), price_spec(spark))
    return cost.totals(entries, labels, "amount").withColumn(
        "micro_units", F.col("micro_units").cast("bigint")
    )


AMOUNTS = """SELECT p_partkey, CASE p_partkey % 8
    WHEN 0 THEN concat(' ', CAST(p_retailprice AS STRING), ' ')
    WHEN 1 THEN concat('-', CAST(p_size AS STRING))
    WHEN 2 THEN ''
    WHEN 3 THEN p_brand
    WHEN 4 THEN 'NaN'
    WHEN 5 THEN 'inf'
    WHEN 6 THEN concat('0.', lpad(CAST(p_size AS STRING), 6, '0'))
    ELSE CAST(p_size AS STRING) END AS text FROM {part}"""


@query(
    f"""WITH a AS ({AMOUNTS.format(part="part")})
       SELECT p_partkey, CASE WHEN p_partkey % 8 IN (0, 6, 7) THEN CAST(trim(text) AS DOUBLE) END AS amount,
              CASE WHEN p_partkey % 8 IN (0, 6, 7)
                   THEN rtrim(rtrim(printf('%.6f', CAST(trim(text) AS DOUBLE)), '0'), '.') END AS shown
       FROM a"""
)
def amounts_parsed(spark, sf_dir):
    texts = spark.sql(AMOUNTS, part=read(spark, sf_dir, "part"))
    amount = cost.parse_amount("text")
    return texts.select(
        "p_partkey",
        amount.alias("amount"),
        F.when(amount.isNotNull(), cost.format_amount(amount)).alias("shown"),
    )


@query(
    f"""WITH {CALL_LOG_CTE}, spec AS ({PRICE_SPEC_SQL}),
       bindings AS (SELECT DISTINCT backend, driver FROM call_log)
       SELECT b.backend, b.driver, 'db.query_ref' AS field, b.backend AS value FROM bindings b
       UNION ALL SELECT b.backend, b.driver, 'db.driver', b.driver FROM bindings b
       UNION ALL SELECT b.backend, b.driver, 'db.cost.unit', unit FROM bindings b JOIN spec s ON s.backend = b.backend
       UNION ALL SELECT b.backend, b.driver, 'db.cost.currency', currency FROM bindings b JOIN spec s ON s.backend = b.backend
       UNION ALL SELECT b.backend, b.driver, 'db.cost.source', amount FROM bindings b JOIN spec s ON s.backend = b.backend
       UNION ALL SELECT b.backend, b.driver, 'db.cost.max_per_call',
         rtrim(rtrim(printf('%.6f', CAST(max_per_call AS DOUBLE)), '0'), '.')
         FROM bindings b JOIN spec s ON s.backend = b.backend WHERE max_per_call IS NOT NULL"""
)
def cost_audit_fields(spark, sf_dir):
    bindings = call_log(spark, sf_dir).select("backend", "driver").distinct()
    spec = bindings.join(price_spec(spark), "backend", "left").withColumn(
        "binding", F.struct("backend", "driver")
    )
    fields = cost.audit_fields(spec, "backend")
    # The map keeps one row per binding; rows of the map compare by value.
    return fields.select(
        "backend", F.col("fields")["db.driver"].alias("driver"), F.explode("fields").alias("field", "value")
    )


_BUCKETS = ", ".join(
    f"count(*) FILTER (duration_ms <= {b}) AS le_{b}" for b in telemetry.DURATION_BUCKETS_MS
)


@query(
    f"""WITH {CALL_LOG_CTE}
       SELECT backend, driver, status, count(*) AS calls, CAST(sum(duration_ms) AS BIGINT) AS duration_ms_sum,
              min(duration_ms) AS duration_ms_min, max(duration_ms) AS duration_ms_max,
              CAST(sum(n_rows) AS BIGINT) AS rows_sum, max(n_rows) AS rows_max, {_BUCKETS}
       FROM call_log GROUP BY backend, driver, status"""
)
def call_rollup(spark, sf_dir):
    return telemetry.call_rollup(call_log(spark, sf_dir))


_QUANTILES = (0.1, 0.5, 0.9, 0.99)


@query(
    f"""WITH {CALL_LOG_CTE}, days AS (SELECT DISTINCT CAST(started_at AS DATE) AS day FROM call_log)
       SELECT day, measure, quantile, calls, true AS within
       FROM days JOIN (SELECT CAST(started_at AS DATE) AS day, count(*) AS calls FROM call_log GROUP BY 1) USING (day),
            (VALUES ('duration_ms'), ('n_rows')) AS m(measure),
            (VALUES {", ".join(f"({q}::DOUBLE)" for q in _QUANTILES)}) AS q(quantile)"""
)
def call_quantiles(spark, sf_dir):
    """Hourly sketches merged by day: whether each quantile's rank is within the stated error."""
    calls = call_log(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "started_at"))
    hourly = stage(telemetry.call_sketches(calls, ["hour"]), "sketches")
    daily = telemetry.merge_sketches(hourly.withColumn("day", F.col("hour").cast("date")), ["day"])
    values = stage(telemetry.sketch_quantiles(daily, _QUANTILES), "quantiles")
    # A few rows a day beside the log.
    of_day = calls.select(
        F.col("started_at").cast("date").alias("d"),
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).cast("bigint").alias("x")) for m in ("duration_ms", "n_rows")])
        ),
    )
    met = values.join(of_day, (F.col("day") == F.col("d")) & (F.col("measure") == F.col("m")))
    ranked = met.groupBy("day", "measure", "quantile", "calls", "value").agg(
        (F.count_if(F.col("x") < F.col("value")) / F.count("*")).alias("below"),
        (F.count_if(F.col("x") <= F.col("value")) / F.count("*")).alias("upto"),
    )
    error = telemetry.RANK_ERROR
    within = (F.col("below") <= F.col("quantile") + error) & (F.col("upto") >= F.col("quantile") - error)
    return ranked.select("day", "measure", "quantile", "calls", within.alias("within"))


@query(
    f"""WITH {CALL_LOG_CTE}, hours AS (SELECT DISTINCT date_trunc('hour', started_at) AS hour FROM call_log),
       lasting AS (SELECT *, CASE WHEN request_id % 50 > 0 THEN duration_ms * 60 END AS lasts FROM call_log)
       SELECT hour, request_id, driver, (epoch_us(hour) - epoch_us(started_at)) // 1000 AS age_ms
       FROM hours JOIN lasting ON started_at <= hour
        AND (lasts IS NULL OR epoch_us(started_at) + lasts * 1000 > epoch_us(hour))"""
)
def running_calls_hourly(spark, sf_dir):
    """Calls in flight at every hour of the log; some of them never end."""
    calls = call_log(spark, sf_dir)
    hours = calls.select(F.date_trunc("hour", "started_at").cast("timestamp_ntz").alias("hour")).distinct()
    lasts = F.when(F.col("request_id") % 50 > 0, F.col("duration_ms") * 60)
    running = telemetry.running_at_each(
        calls.select("request_id", "driver", "started_at", lasts.alias("lasts")), hours, "hour", duration="lasts"
    )
    return running.select("hour", "request_id", "driver", "age_ms")


ATTEMPTS = """SELECT event_id, concat('b', CAST(user_id % 5 AS STRING)) AS backend,
    CASE user_id % 3 WHEN 0 THEN 'postgres' WHEN 1 THEN 'mysql' ELSE 'sqlite' END AS driver,
    CASE event_id % 9 WHEN 0 THEN 'pool_timeout' WHEN 1 THEN 'connect' WHEN 2 THEN 'prepare'
      WHEN 3 THEN 'execute' WHEN 4 THEN 'serialize' WHEN 5 THEN 'invalid_spec'
      WHEN 6 THEN 'profile_not_found' END AS error_kind,
    CASE event_id % 6 WHEN 0 THEN '26000' WHEN 1 THEN '42P18' WHEN 2 THEN '0A000'
      WHEN 3 THEN '1615' WHEN 4 THEN '23505' END AS code,
    CAST(event_id % 2 AS INT) AS attempt
  FROM {events}"""


@query(
    f"""WITH a AS ({ATTEMPTS.format(events="events")})
       SELECT event_id, CASE WHEN error_kind IS NULL THEN 'success' WHEN error_kind = 'pool_timeout' THEN 'timeout'
                WHEN error_kind IN ('invalid_spec', 'profile_not_found') THEN 'invalid_spec'
                ELSE 'transport_error' END AS status,
              coalesce(code IN ('26000', '42P18', '0A000', '1615'), false) AS stale FROM a"""
)
def status_classes(spark, sf_dir):
    attempts = spark.sql(ATTEMPTS, events=read(spark, sf_dir, "events"))
    return attempts.select(
        "event_id",
        telemetry.classify_status("error_kind").alias("status"),
        telemetry.is_stale("code").alias("stale"),
    )


@query(
    f"""WITH a AS ({ATTEMPTS.format(events="events")})
       SELECT backend, driver, count(*) FILTER (attempt = 0 AND code IN ('26000', '42P18', '0A000', '1615')) AS retries
       FROM a GROUP BY backend, driver"""
)
def prepare_retries(spark, sf_dir):
    return telemetry.prepare_retries(spark.sql(ATTEMPTS, events=read(spark, sf_dir, "events")))


@query(
    f"""WITH {CALL_LOG_CTE},
       edges AS (SELECT driver, epoch_us(started_at) AS us, 1 AS delta FROM call_log
                 UNION ALL SELECT driver, epoch_us(started_at) + duration_ms * 1000, -1 FROM call_log),
       levels AS (SELECT driver, us, sum(delta) OVER (PARTITION BY driver ORDER BY us, delta
                    ROWS UNBOUNDED PRECEDING) AS level FROM edges)
       SELECT driver, CAST(max(level) AS BIGINT) AS peak,
              CAST(make_timestamp(arg_max(us, (level, -us))) AS TIMESTAMP) AS peak_at
       FROM levels GROUP BY driver"""
)
def peak_concurrency(spark, sf_dir):
    return telemetry.concurrency(call_log(spark, sf_dir))


@query(
    f"""WITH {CALL_LOG_CTE}
       SELECT request_id, driver, (epoch_us(instant) - epoch_us(started_at)) // 1000 AS age_ms
       FROM call_log, (SELECT max(ts) AS instant FROM events) AS t
       WHERE started_at <= instant AND epoch_us(started_at) + duration_ms * 1000 > epoch_us(instant)"""
)
def running_calls(spark, sf_dir):
    """Calls in flight when the newest one started."""
    at = read(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    return telemetry.running_at(call_log(spark, sf_dir), at).select("request_id", "driver", "age_ms")


@query(
    f"""WITH {CALL_LOG_CTE}, c AS (SELECT *, CASE WHEN k % 3 = 0 THEN 'hit' WHEN k % 3 = 1 THEN 'miss' END AS cache FROM call_log)
       SELECT backend, driver, count(*) FILTER (cache = 'hit') AS hits, count(*) FILTER (cache = 'miss') AS misses,
              count(*) FILTER (cache = 'miss' AND status = 'success') AS writes
       FROM c GROUP BY backend, driver"""
)
def cache_counts(spark, sf_dir):
    calls = call_log(spark, sf_dir)
    third = F.col("k") % 3
    tagged = calls.withColumn(
        "cache", F.when(third == 0, "hit").when(third == 1, "miss")
    ).withColumn("cache_written", F.col("status") == "success")
    return telemetry.cache_counts(tagged)


@query(
    f"""WITH {CALL_LOG_CTE}
       SELECT backend, driver, CAST(sum(duration_ms // 5000) AS BIGINT) AS heartbeats
       FROM call_log GROUP BY backend, driver"""
)
def heartbeats(spark, sf_dir):
    return telemetry.heartbeats(call_log(spark, sf_dir), 5000)


@query(
    f"""WITH {CALL_LOG_CTE}
       SELECT request_id, backend, driver, started_at, duration_ms,
              CASE status WHEN 'timeout' THEN 'query_timeout' ELSE 'query_failed' END AS action, status AS reason
       FROM call_log WHERE status IN ('timeout', 'transport_error')"""
)
def audit_failures(spark, sf_dir):
    return telemetry.audit_failures(call_log(spark, sf_dir))
