"""Parameter binding, derived parameters, sweeps, policies, completion, procedures."""

from pathlib import Path

from pyspark.sql import functions as F

from sparkq.operators.params import (
    QuerySpec,
    apply_once,
    apply_policy,
    call_procedure,
    complete_prefix,
    complete_prefixes,
    complete_variable,
    define_procedure,
    derive_params,
    run_batch,
    run_query,
    sweep_totals,
)
from sparkq.operators.sweeps import sweep_extremes, sweep_rows
from sparkq.queries.registry import query
from sparkq.sources.sqltext import spec_from_file
from sparkq.sources.views import read, register_views

ORDERS_BY_SEGMENT = QuerySpec(
    name="orders_by_segment",
    sql="""SELECT o_orderkey, c_name, o_totalprice, o_orderdate
           FROM customer JOIN orders ON c_custkey = o_custkey
           WHERE c_mktsegment = :segment AND o_totalprice >= :min_total
           ORDER BY o_orderdate DESC, o_orderkey LIMIT :n""",
    params=("segment", "min_total", "n"),
    derived={"n": "page_size * 2"},
)


@query(
    """SELECT o_orderkey, c_name, o_totalprice, o_orderdate
       FROM customer JOIN orders ON c_custkey = o_custkey
       WHERE c_mktsegment = 'BUILDING' AND o_totalprice >= 200000
       ORDER BY o_orderdate DESC, o_orderkey LIMIT 100"""
)
def param_orders_by_segment(spark, sf_dir):
    register_views(spark, sf_dir, ["customer", "orders"])
    args = {"segment": "BUILDING", "min_total": 200000, "page_size": 50}
    return run_query(spark, ORDERS_BY_SEGMENT, args)


@query(
    """WITH bands AS (SELECT n_nationkey AS param_id, n_nationkey * 10000 AS lo,
                             n_nationkey * 10000 + 25000 AS hi FROM nation)
       SELECT param_id, count(*) AS n_orders,
              CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS total
       FROM bands JOIN orders ON o_totalprice >= lo AND o_totalprice < hi
       GROUP BY param_id"""
)
def param_sweep_price_bands(spark, sf_dir):
    bands = derive_params(
        read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("param_id")),
        {"lo": "param_id * 10000", "hi": "param_id * 10000 + 25000"},
    )
    orders = read(spark, sf_dir, "orders").select("o_totalprice")
    found = sweep_totals(
        orders,
        bands,
        between=("o_totalprice", "lo", "hi"),
        sums={"total": F.col("o_totalprice").cast("decimal(15,2)")},
        count="n_orders",
    )
    return found.where("n_orders > 0").select("param_id", "n_orders", F.col("total").cast("double"))


@query(
    """SELECT s.s_suppkey AS param_id, count(c_custkey) AS n_customers, max(c_acctbal) AS best
       FROM supplier s LEFT JOIN customer c ON c_nationkey = s_nationkey AND c_acctbal > s_acctbal
       GROUP BY s.s_suppkey"""
)
def param_sweep_equal(spark, sf_dir):
    """One query per supplier: customers of its nation with a higher balance.

    The best of them is the best of the nation, if there is any at all.
    """
    params = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("param_id"),
        "s_nationkey",
        "s_acctbal",
        F.lit(None).cast("double").alias("no_end"),
    )
    customers = read(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    counted = sweep_totals(
        customers,
        params,
        equal={"c_nationkey": "s_nationkey"},
        between=("c_acctbal", "s_acctbal", "no_end"),
        low_open=True,
        count="n_customers",
    )
    # One row per nation.
    best = customers.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("most"))
    return counted.join(best, F.col("c_nationkey") == F.col("s_nationkey"), "left").select(
        "param_id", "n_customers", F.when(F.col("n_customers") > 0, F.col("most")).alias("best")
    )


@query(
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       WHERE c_nationkey = 7 AND c_acctbal >= 1000"""
)
def policy_customers_by_nation(spark, sf_dir):
    return apply_policy(
        read(spark, sf_dir, "customer"),
        "c_nationkey = :app_nation AND c_acctbal >= :app_floor",
        {"app.nation": 7, "app.floor": 1000},
    ).select("c_custkey", "c_name", "c_acctbal")


@query("SELECT c_custkey FROM customer WHERE c_nationkey = NULL")
def policy_unset_variable(spark, sf_dir):
    """A policy whose variable has no value shows no rows."""
    return apply_policy(
        read(spark, sf_dir, "customer"), "c_nationkey = :app_nation", {}, declared=["app.nation"]
    ).select("c_custkey")


@query(
    """SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def policy_partly_unset(spark, sf_dir):
    """Of a policy with a variable that has no value, the part that does not need it."""
    policy = "c_nationkey = :app_nation OR c_mktsegment = :app_segment"
    return apply_policy(
        read(spark, sf_dir, "customer"), policy, {"app.segment": "BUILDING"}, declared=["app.nation"]
    ).select("c_custkey", "c_mktsegment")


REQUESTS = """SELECT event_id, ts, CAST(user_id AS STRING) AS idempotency_scope_hash,
                     concat(event_type, ':', regexp_extract(props, '([0-9]+)', 1)) AS idempotency_key
              FROM {events}"""


@query(
    f"""WITH requests AS ({REQUESTS.format(events="events")}),
       fresh AS (SELECT * FROM requests WHERE ts >= TIMESTAMP '2024-01-10'),
       ledger AS (SELECT DISTINCT idempotency_scope_hash, idempotency_key FROM requests
                  WHERE ts < TIMESTAMP '2024-01-10'),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY idempotency_scope_hash, idempotency_key
                                               ORDER BY ts, event_id) AS rn FROM fresh)
       SELECT event_id, ts, idempotency_scope_hash, idempotency_key FROM ranked
       WHERE rn = 1 AND NOT EXISTS (
         SELECT 1 FROM ledger l WHERE l.idempotency_scope_hash = ranked.idempotency_scope_hash
                                  AND l.idempotency_key = ranked.idempotency_key)"""
)
def idempotent_events(spark, sf_dir):
    requests = spark.sql(REQUESTS, events=read(spark, sf_dir, "events"))
    cut = F.lit("2024-01-10").cast("timestamp_ntz")
    ledger = requests.where(F.col("ts") < cut).select("idempotency_scope_hash", "idempotency_key")
    return apply_once(requests.where(F.col("ts") >= cut), ["ts", "event_id"], ledger.distinct())


@query("SELECT DISTINCT p_name FROM part WHERE p_name LIKE 'small%' AND p_size = 15 ORDER BY p_name LIMIT 100")
def prefix_part_names(spark, sf_dir):
    return complete_prefix(read(spark, sf_dir, "part"), "p_name", "small", {"p_size": 15})


@query(
    """SELECT DISTINCT o_orderpriority FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '%' ORDER BY o_orderpriority LIMIT 100"""
)
def completion_statement(spark, sf_dir):
    register_views(spark, sf_dir, ["orders"])
    return complete_variable(
        spark,
        """SELECT DISTINCT o_orderpriority FROM orders
           WHERE o_orderstatus = :ctx_status AND o_orderpriority LIKE :prefix || '%'
           ORDER BY o_orderpriority""",
        "",
        {"Status": "F"},
    )


@query(
    """WITH wide AS (SELECT o_orderkey AS param_id, o_totalprice - 50 AS lo,
                            o_totalprice - 50 + 10 * (1 + o_orderkey % 20) AS hi FROM orders)
       SELECT param_id, count(*) AS n_orders FROM wide JOIN orders
         ON o_totalprice >= lo AND o_totalprice < hi GROUP BY param_id"""
)
def param_sweep_many_ranges(spark, sf_dir):
    """A range of its own for every order: too many parameters to broadcast at scale."""
    orders = read(spark, sf_dir, "orders")
    # Parameters derive in name order, so the bounds are named to come that way.
    ranges = derive_params(
        orders.select(F.col("o_orderkey").alias("param_id"), F.col("o_totalprice").alias("price")),
        {"from_price": "price - 50", "to_price": "from_price + 10 * (1 + param_id % 20)"},
    ).drop("price")
    found = sweep_totals(
        orders.select("o_totalprice"),
        ranges,
        between=("o_totalprice", "from_price", "to_price"),
        count="n_orders",
    )
    return found.where("n_orders > 0").select("param_id", "n_orders")


@query(
    """WITH p AS (SELECT event_id AS param_id, ts AS since, ts + INTERVAL 20 MINUTE AS until FROM events
                  WHERE event_type = 'signup')
       SELECT param_id, event_id, CAST(value AS DOUBLE) AS value
       FROM p LEFT JOIN events ON ts >= since AND ts < until AND event_type = 'purchase'"""
)
def param_sweep_times(spark, sf_dir):
    """Purchases in the twenty minutes behind every signup; signups without one stay."""
    events = read(spark, sf_dir, "events")
    params = events.where("event_type = 'signup'").select(
        F.col("event_id").alias("param_id"),
        F.col("ts").alias("since"),
        F.expr("ts + INTERVAL 20 MINUTES").alias("until"),
    )
    purchases = events.where("event_type = 'purchase'").select("event_id", "ts", "value")
    found = run_batch(purchases, params, between=("ts", "since", "until"), keep_unmatched=True)
    return found.select("param_id", "event_id", "value")


# Half hours before every signup; whole days as dates, and odd bounds as fractions.
_SPANS = """SELECT event_id AS param_id, ts - INTERVAL 30 MINUTE AS since, ts AS until FROM events
            WHERE event_type = 'signup'"""


@query(
    f"""WITH p AS ({_SPANS})
       SELECT param_id, min(value) AS least, max(value) AS most, max(ts) AS latest, min(event_type) AS first_type
       FROM p LEFT JOIN events ON ts >= since AND ts < until GROUP BY param_id"""
)
def param_sweep_extremes(spark, sf_dir):
    """Least and greatest values in the half hour before every signup."""
    events = read(spark, sf_dir, "events")
    found = sweep_extremes(
        events,
        spark.sql(_SPANS.replace("FROM events", "FROM {events}"), events=events),
        between=("ts", "since", "until"),
        minima={"least": F.col("value"), "first_type": F.col("event_type")},
        maxima={"most": F.col("value"), "latest": F.col("ts")},
    )
    return found.select("param_id", "least", "most", "latest", "first_type")


@query(
    """WITH p AS (SELECT o_orderkey AS param_id, o_custkey, o_totalprice / 2 AS low FROM orders),
       met AS (SELECT param_id, p.o_custkey, max(o.o_totalprice) AS most, min(o.o_orderdate) AS earliest
               FROM p JOIN orders o ON o.o_custkey = p.o_custkey AND o.o_totalprice > low
                    AND o.o_totalprice < 2 * low GROUP BY param_id, p.o_custkey)
       SELECT p.param_id, most, earliest FROM p LEFT JOIN met USING (param_id)"""
)
def param_sweep_keyed_extremes(spark, sf_dir):
    """Among orders of the same customer, those over half and below the whole of each price."""
    orders = read(spark, sf_dir, "orders")
    params = orders.select(
        F.col("o_orderkey").alias("param_id"),
        F.col("o_custkey").alias("customer"),
        (F.col("o_totalprice") / 2).alias("low"),
        (F.col("o_totalprice") / 2 * 2).alias("high"),
    )
    found = sweep_extremes(
        orders.select("o_custkey", "o_totalprice", "o_orderdate"),
        params,
        between=("o_totalprice", "low", "high"),
        equal={"o_custkey": "customer"},
        low_open=True,
        minima={"earliest": F.col("o_orderdate")},
        maxima={"most": F.col("o_totalprice")},
    )
    return found.select("param_id", "most", "earliest")


@query(
    f"""WITH p AS ({_SPANS}),
       met AS (SELECT param_id, event_id, value, row_number() OVER (PARTITION BY param_id ORDER BY ts, event_id) AS row_no,
                      count(*) OVER (PARTITION BY param_id) > 5 AS truncated
               FROM p JOIN events ON ts >= since AND ts < until)
       SELECT p.param_id, coalesce(row_no, 0) AS row_no, coalesce(truncated, false) AS truncated, event_id, value
       FROM p LEFT JOIN met USING (param_id) WHERE coalesce(row_no, 0) <= 5"""
)
def param_sweep_capped_rows(spark, sf_dir):
    """The first five events of the half hour before every signup, and whether there were more."""
    events = read(spark, sf_dir, "events")
    params = spark.sql(_SPANS.replace("FROM events", "FROM {events}"), events=events)
    found = sweep_rows(
        events.select("event_id", "ts", "value"), params, between=("ts", "since", "until"), order=["event_id"], max_rows=5
    )
    return found.select("param_id", "row_no", "truncated", "event_id", "value")


@query(
    f"""WITH p AS ({_SPANS}),
       met AS (SELECT param_id, event_id, value, event_type, row_number() OVER (PARTITION BY param_id ORDER BY ts, event_id) AS rn
               FROM p JOIN events ON ts >= since AND ts < until)
       SELECT 'single' AS mode, p.param_id, event_id, value FROM p LEFT JOIN met ON met.param_id = p.param_id AND rn = 1
       UNION ALL
       SELECT 'scalar', p.param_id, event_id, NULL FROM p LEFT JOIN met ON met.param_id = p.param_id AND rn = 1"""
)
def param_sweep_first_rows(spark, sf_dir):
    """The first event of the half hour before every signup, as a row and as a scalar."""
    events = read(spark, sf_dir, "events")
    params = spark.sql(_SPANS.replace("FROM events", "FROM {events}"), events=events)
    rows, of = events.select("event_id", "ts", "value"), {"between": ("ts", "since", "until"), "order": ["event_id"]}
    single = sweep_rows(rows, params, row_mode="single", **of)
    scalar = sweep_rows(rows, params, row_mode="scalar", **of)
    return single.select(F.lit("single").alias("mode"), "param_id", "event_id", "value").unionByName(
        scalar.select(F.lit("scalar").alias("mode"), "param_id", F.col("value").alias("event_id")), allowMissingColumns=True
    )


@query(
    """WITH p AS (SELECT s_suppkey AS param_id, s_suppkey + 0.5 AS low, s_suppkey * 1.5 + 10.25 AS high,
                         DATE '2024-01-01' + CAST(s_suppkey % 30 AS INTEGER) AS day FROM supplier)
       SELECT param_id, (SELECT count(*) FROM events WHERE user_id >= low AND user_id < high) AS users,
              (SELECT count(*) FROM events WHERE ts >= day AND ts < day + INTERVAL 12 HOUR) AS mornings,
              (SELECT count(*) FROM events WHERE CAST(ts AS DATE) >= day + INTERVAL 12 HOUR
                                             AND CAST(ts AS DATE) < day + INTERVAL 60 HOUR) AS days
       FROM p"""
)
def param_sweep_mixed_types(spark, sf_dir):
    """Fractions as bounds of whole numbers, days of instants, and instants of days."""
    events = read(spark, sf_dir, "events").select("user_id", "ts", F.col("ts").cast("date").alias("day"))
    supplier = F.col("param_id")
    params = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("param_id"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), (supplier % 30).cast("int"))

    def hours(n):
        return start.cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(n))

    asked = (
        ("users", "user_id", supplier + F.lit(0.5), supplier * F.lit(1.5) + 10.25),
        ("mornings", "ts", start, hours(12)),
        ("days", "day", hours(12), hours(60)),
    )
    out = params
    for name, column, low, high in asked:
        ranges = params.withColumns({"low": low, "high": high})
        out = out.join(sweep_totals(events, ranges, between=(column, "low", "high"), count=name).select("param_id", name), "param_id")
    return out


@query(
    """WITH names AS (SELECT DISTINCT c_name AS value FROM customer),
       prefixes AS (SELECT DISTINCT substr(s_name, 1, 1) AS p FROM supplier
                    UNION SELECT DISTINCT substr(c_name, 1, 16) FROM customer),
       ranked AS (SELECT p AS prefix, value, row_number() OVER (PARTITION BY p ORDER BY value) AS rn
                  FROM prefixes JOIN names ON starts_with(value, p))
       SELECT prefix, value FROM ranked WHERE rn <= 20"""
)
def prefix_sweep_customers(spark, sf_dir):
    customers = read(spark, sf_dir, "customer")
    prefixes = (
        read(spark, sf_dir, "supplier")
        .select(F.substring("s_name", 1, 1).alias("prefix"))
        .union(customers.select(F.substring("c_name", 1, 16)))
    )
    return complete_prefixes(customers, "c_name", prefixes, max_results=20)


_WORDS = r"[A-Za-z]+"


@query(
    rf"""WITH words AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{_WORDS}'))) AS value FROM documents),
       prefixes AS (SELECT DISTINCT substr(value, 1, n) AS p FROM words, (VALUES (0), (1), (2)) AS l(n)),
       ranked AS (SELECT p AS prefix, value, row_number() OVER (PARTITION BY p ORDER BY value) AS rn
                  FROM prefixes JOIN words ON starts_with(value, p))
       SELECT prefix, value FROM ranked WHERE rn <= 1200"""
)
def prefix_sweep_words(spark, sf_dir):
    """Completions of every short prefix, the empty one too, over all words of all documents."""
    words = read(spark, sf_dir, "documents").select(
        F.explode(F.regexp_extract_all("text", F.lit(_WORDS), 0)).alias("word")
    ).select(F.lower("word").alias("word"))
    prefixes = words.select(F.explode(F.array(*[F.substring("word", 1, n) for n in (0, 1, 2)])).alias("prefix"))
    return complete_prefixes(words, "word", prefixes, max_results=1200)


@query(
    """SELECT s_suppkey, s_name, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND s_acctbal > 1000"""
)
def procedure_suppliers(spark, sf_dir):
    register_views(spark, sf_dir, ["supplier", "nation", "region"])
    define_procedure(
        spark,
        "suppliers_in",
        {"region_name": "STRING", "floor": "DOUBLE"},
        "s_suppkey BIGINT, s_name STRING, s_acctbal DOUBLE",
        """SELECT s_suppkey, s_name, s_acctbal FROM supplier
           JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
           WHERE r_name = region_name AND s_acctbal > floor""",
    )
    return call_procedure(spark, "suppliers_in", {"region_name": "ASIA", "floor": 1000.0})


@query(
    """SELECT n_name, count(*) AS n_suppliers,
              CAST(sum(CAST(s_acctbal AS DECIMAL(15,2))) AS DOUBLE) AS balance
       FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0 GROUP BY n_name"""
)
def sql_file_supplier_balance(spark, sf_dir):
    register_views(spark, sf_dir, ["supplier", "nation"])
    # The file ships with the package, so it is read on the driver's file system.
    path = (Path(__file__).parent / "sql" / "supplier_balance.sql").as_uri()
    spec = spec_from_file(spark, path, "supplier_balance", params=("floor",))
    return run_query(spark, spec, {"floor": 0})
