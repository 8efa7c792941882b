"""Writes with counts, and atomic groups of writes."""

from pyspark.sql import functions as F

from sparkq.operators.txgroup import Step, run_group
from sparkq.plans.staging import new_path
from sparkq.queries.registry import query
from sparkq.sources.sinks import append, delete_rows, update_rows
from sparkq.sources.views import read


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
              CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment FROM customer"""
)
def update_customers(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    updated, _ = update_rows(
        customers, "c_acctbal < 0", {"c_acctbal": "0", "c_mktsegment": "'REVIEW'"}
    )
    return updated


@query(
    """SELECT 'update' AS write, count(*) AS rows_affected FROM customer WHERE c_acctbal < 0
       UNION ALL SELECT 'delete', count(*) FROM orders WHERE o_orderstatus = 'F'"""
)
def affected_rows_counts(spark, sf_dir):
    _, updated = update_rows(read(spark, sf_dir, "customer"), "c_acctbal < 0", {"c_acctbal": "0"})
    _, deleted = delete_rows(read(spark, sf_dir, "orders"), "o_orderstatus = 'F'")
    return updated.select(F.lit("update").alias("write"), "rows_affected").unionByName(
        deleted.select(F.lit("delete").alias("write"), "rows_affected")
    )


@query(
    """SELECT s.n AS reported, count(*) AS stored, CAST(sum(o_orderkey) AS BIGINT) AS keys
       FROM orders, (SELECT count(*) AS n FROM orders WHERE o_totalprice > 100000) AS s
       WHERE o_totalprice > 100000 GROUP BY s.n"""
)
def append_orders(spark, sf_dir):
    """Append to a table and compare the reported count with what is stored."""
    path = new_path(spark, "appended")
    orders = read(spark, sf_dir, "orders").where("o_totalprice > 100000")
    reported = append(orders.select("o_orderkey", "o_totalprice"), path)
    return spark.read.parquet(path).agg(
        F.lit(reported).cast("bigint").alias("reported"),
        F.count("*").alias("stored"),
        F.sum("o_orderkey").alias("keys"),
    )


@query(
    """WITH accounts AS (
         SELECT c_custkey AS id, CASE WHEN c_nationkey = 7 THEN c_acctbal + 100 ELSE c_acctbal END AS balance
         FROM customer
         UNION ALL SELECT s_suppkey + 1000000000, s_acctbal FROM supplier WHERE s_nationkey = 7)
       SELECT id, balance FROM accounts WHERE balance >= 50"""
)
def transaction_group_accounts(spark, sf_dir):
    """Insert, update, delete and count in one group; the rows it leaves."""
    customers, suppliers = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    accounts = customers.select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"),
    )
    steps = [
        Step("raise", "update", "accounts", assign={"balance": "balance + :bonus"}, where="nation = :nation"),
        Step(
            "join", "insert", "accounts",
            sql="""SELECT s_suppkey + 1000000000 AS id, s_acctbal AS balance, s_nationkey AS nation
                   FROM suppliers WHERE s_nationkey = :nation""",
        ),
        Step("close", "delete", "accounts", where="balance < :floor"),
        Step("left", "query", sql="SELECT count(*) AS n FROM accounts", row_mode="scalar"),
    ]
    tables = {"accounts": accounts, "suppliers": suppliers}
    _, written = run_group(spark, tables, steps, {"bonus": 100, "nation": 7, "floor": 50})
    return written["accounts"].select("id", "balance")
