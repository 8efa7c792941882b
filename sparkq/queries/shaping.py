"""Row modes."""

from pyspark.sql import functions as F

from sparkq.operators.execute import execute
from sparkq.operators.params import QuerySpec, run_query
from sparkq.operators.procedures import Procedures
from sparkq.operators.shape import (
    first_per_key,
    resource_contents,
    result_sets,
    row_count_hint,
    scalar,
    single,
)
from sparkq.queries.registry import query
from sparkq.sources.views import read, register_views


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def single_top_order(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return single(orders.orderBy(F.desc("o_totalprice"), "o_orderkey"))


@query(
    """SELECT user_id, event_id, ts, event_type FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) AS t
       WHERE rn = 1"""
)
def single_per_user(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return first_per_key(events, ["user_id"], ["ts", "event_id"])


@query(
    """SELECT c_custkey, c_name, (SELECT count(*) > 1000 FROM customer) AS truncated
       FROM customer ORDER BY c_custkey LIMIT 1000"""
)
def many_customers(spark, sf_dir):
    """A response with a cap, and the flag that says whether the cap cut it."""
    register_views(spark, sf_dir, ["customer"])
    spec = QuerySpec("customers", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey", (), max_rows=1000)
    answer = execute(spark, spec)
    return answer.rows.withColumn("truncated", F.lit(answer.truncated))


@query("SELECT count(*) AS n_open FROM orders WHERE o_orderstatus = 'O'")
def scalar_open_orders(spark, sf_dir):
    register_views(spark, sf_dir, ["orders"])
    spec = QuerySpec(
        name="open_orders",
        sql="SELECT count(*) AS n_open, max(o_orderkey) AS newest FROM orders WHERE o_orderstatus = :s",
        row_mode="scalar",
    )
    return scalar(run_query(spark, spec, {"s": "O"}))


# Every fifth page of each kind lacks something, so that all messages occur.
CONTENTS = """SELECT page_id, CASE WHEN page_id % 5 = 1 THEN NULL ELSE url END AS uri,
                     CASE WHEN page_id % 5 = 2 THEN NULL ELSE html END AS text,
                     CASE WHEN page_id % 5 = 3 THEN 'AAAA' END AS blob,
                     CASE WHEN page_id % 5 = 4 THEN NULL ELSE 'text/html' END AS mime_type
              FROM {pages}"""


@query(
    f"""WITH c AS ({CONTENTS.format(pages="pages")})
       SELECT uri, mime_type, text, blob,
              CASE WHEN uri IS NULL THEN concat('resource_contents[', page_id, '] missing required ''uri'' column')
                   WHEN text IS NOT NULL AND blob IS NOT NULL
                   THEN concat('resource_contents[', page_id, '] has both ''text'' and ''blob''; pick one per row')
                   WHEN text IS NULL AND blob IS NULL
                   THEN concat('resource_contents[', page_id, '] must have either ''text'' or ''blob''') END AS error
       FROM c"""
)
def resource_contents_pages(spark, sf_dir):
    rows = spark.sql(CONTENTS, pages=read(spark, sf_dir, "pages"))
    return resource_contents(rows, position="page_id")


@query(
    """WITH sets AS (
         SELECT 0 AS set_no, CAST(r_regionkey AS BIGINT) AS k, r_name AS name FROM region
         UNION ALL SELECT 1, CAST(n_nationkey AS BIGINT), n_name FROM nation
         UNION ALL SELECT 2, s_suppkey, s_name FROM supplier
         UNION ALL SELECT 3, c_custkey, c_name FROM customer),
       numbered AS (SELECT *, row_number() OVER (ORDER BY set_no, k) AS rn FROM sets)
       SELECT set_no, k, name FROM numbered WHERE rn <= 1000"""
)
def result_sets_budget(spark, sf_dir):
    def named(table, key, name):
        df = read(spark, sf_dir, table)
        return df.select(F.col(key).cast("bigint").alias("k"), F.col(name).alias("name")), ["k"]

    empty = read(spark, sf_dir, "region").where("r_regionkey < 0")
    sets = [
        named("region", "r_regionkey", "r_name"),
        (empty.select(F.lit(0).cast("bigint").alias("k"), F.col("r_name").alias("name")), ["k"]),
        named("nation", "n_nationkey", "n_name"),
        named("supplier", "s_suppkey", "s_name"),
        named("customer", "c_custkey", "c_name"),
    ]
    return result_sets(sets, max_rows=1000).rows()


def _overview(spark, sf_dir, region, floor):
    """Statements of a procedure: its nations, what nobody has, suppliers and customers."""
    nations = read(spark, sf_dir, "nation").where(F.col("n_regionkey") == region)
    yield nations.select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_name").alias("name")), ["k"]
    yield nations.where("n_nationkey < 0").select(F.col("n_nationkey").alias("k"), F.lit("nobody").alias("name")), ["k"]
    for table, key, at, name, balance in (
        ("supplier", "s_suppkey", "s_nationkey", "s_name", "s_acctbal"),
        ("customer", "c_custkey", "c_nationkey", "c_name", "c_acctbal"),
    ):
        rows = read(spark, sf_dir, table).where(F.col(balance) >= floor).join(nations, F.col(at) == F.col("n_nationkey"), "left_semi")
        yield rows.select(F.col(key).alias("k"), F.col(name).alias("name")), ["k"]


@query(
    """WITH here AS (SELECT * FROM nation WHERE n_regionkey = 2),
       sets AS (SELECT 0 AS set_no, n_nationkey AS k, n_name AS name FROM here
         UNION ALL SELECT 1, s_suppkey, s_name FROM supplier JOIN here ON s_nationkey = n_nationkey WHERE s_acctbal >= 0
         UNION ALL SELECT 2, c_custkey, c_name FROM customer JOIN here ON c_nationkey = n_nationkey WHERE c_acctbal >= 0),
       numbered AS (SELECT *, row_number() OVER (ORDER BY set_no, k) AS rn, count(*) OVER () > 100 AS truncated FROM sets)
       SELECT set_no, k, name, truncated FROM numbered WHERE rn <= 100"""
)
def procedure_result_sets(spark, sf_dir):
    """A procedure of four statements, one of them without rows, under one budget."""
    procedures = Procedures()
    procedures.define(
        "overview", ["region", "floor"], lambda spark, region, floor: _overview(spark, sf_dir, region, floor)
    )
    answer = procedures.call(spark, "overview", {"region": 2, "floor": 0}, max_rows=100)
    return answer.rows().withColumn("truncated", F.lit(answer.truncated))


PAYLOADS = """SELECT event_id,
  CASE event_id % 8
    WHEN 0 THEN concat('[', event_id, ',', user_id, ',', props, ']')
    WHEN 1 THEN concat('{{"rows_affected":', user_id, '}}')
    WHEN 2 THEN concat('{{"contents":[', props, ',', props, '],"note":"', event_type, '"}}')
    WHEN 3 THEN props
    WHEN 4 THEN 'null'
    WHEN 5 THEN concat('{{"rows_affected":"', user_id, '"}}')
    WHEN 6 THEN CAST(user_id AS STRING)
    ELSE event_type END AS payload
  FROM {events}"""


@query(
    f"""WITH p AS ({PAYLOADS.format(events="events")}),
       j AS (SELECT event_id, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j FROM p)
       SELECT event_id, CAST(
         CASE json_type(j)
           WHEN 'ARRAY' THEN json_array_length(j)
           WHEN 'OBJECT' THEN
             CASE WHEN json_type(j, '$.rows_affected') IN ('UBIGINT', 'BIGINT')
                  THEN CAST(json_extract(j, '$.rows_affected') AS BIGINT)
                  WHEN json_type(j, '$.contents') = 'ARRAY' THEN json_array_length(j, '$.contents')
                  ELSE 1 END
         END AS BIGINT) AS n_rows
       FROM j"""
)
def row_count_hints(spark, sf_dir):
    payloads = spark.sql(PAYLOADS, events=read(spark, sf_dir, "events"))
    return payloads.select("event_id", row_count_hint("payload").alias("n_rows"))
