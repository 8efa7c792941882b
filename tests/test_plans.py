"""Ordered scans on skewed groups, size checks, and the plans of all queries."""

import random

import pytest
from pyspark.sql import functions as F

from sparkq.operators.shape import many
from sparkq.plans import ordered, sizing, staging
from sparkq.plans.ordered import Running, row_index, scan_in_order
from sparkq.queries import QUERIES
from sparkq.sources.views import TABLES, read


def scanned(data):
    out, state = [], {}
    for g, o, v in sorted(data, key=lambda r: (repr(r[0]), r[1])):
        s = state.setdefault(g, {"sum": None, "max": None, "min": None, "prev": None})
        prev = s["prev"]
        if v is not None:
            s["sum"] = v + (s["sum"] or 0)
            s["max"] = v if s["max"] is None else max(v, s["max"])
            s["min"] = v if s["min"] is None else min(v, s["min"])
        s["prev"] = v
        out.append((g, o, s["sum"], s["max"], s["min"], prev))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [10**9, 100, 1])
def test_scan_matches_brute_force(spark, rows, hot_rows):
    rng = random.Random(2)
    # One group holds most rows; one group key is null.
    data = [
        ("hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", None]), i, rng.choice([None, 1, 2, 3]))
        for i in range(600)
    ]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, o int, v bigint")
    steps = [Running("s", "sum", F.col("v")), Running("hi", "max", F.col("v")),
             Running("lo", "min", F.col("v")), Running("p", "prev", F.col("v"))]
    got = scan_in_order(df, ["g"], ["o"], steps, hot_rows)
    assert rows(got.select("g", "o", "s", "hi", "lo", "p")) == scanned(data)


def test_hot_group_is_spread_over_tasks(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.col("id").alias("o"))
    got = scan_in_order(df, ["g"], ["o"], [Running("n", "sum", F.lit(1))], hot_rows=100)
    assert got.agg(F.max("n")).first()[0] == 4000
    # Small ranges are merged at run time; without that the one group fills them all.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = df.repartitionByRange("g", "o").select(F.spark_partition_id().alias("p"))
        assert ranges.distinct().count() == 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_steps_may_use_earlier_ones(spark, rows):
    df = spark.createDataFrame([("a", i, i % 2) for i in range(9)], "g string, o int, v int")
    steps = [Running("s", "sum", F.col("v")), Running("m", "max", F.when(F.col("v") == 0, F.col("s")))]
    plain = rows(scan_in_order(df, ["g"], ["o"], steps))
    assert rows(scan_in_order(df, ["g"], ["o"], steps, hot_rows=2)) == plain


def test_row_index_on_a_hot_leading_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    got = row_index(df.repartition(5), ["k", "id"]).collect()
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["row_index"])] == sorted(map(tuple, df.collect()))
    assert sorted(r["row_index"] for r in got) == list(range(3000))


def test_size_check(spark):
    df = spark.range(1000)
    assert sizing.is_small(df) and not sizing.is_small(df, max_rows=999)
    assert not sizing.is_small(df, max_bytes=1000)
    assert sizing.is_small(df.limit(0))
    assert "broadcast" in sizing.broadcast_if_small(df)._jdf.queryExecution().analyzed().toString().lower()
    assert sizing.broadcast_if_small(df, 10) is df


def test_staged_rows_can_be_dropped(spark):
    staged = staging.stage(spark.range(5), "test")
    path = staged.inputFiles()[0]
    assert staging.shared_dir(spark) in path and staged.count() == 5
    kept, staging._STAGED[spark.sparkContext.applicationId] = staging._STAGED[spark.sparkContext.applicationId], [
        path.removeprefix("file://").rsplit("/", 1)[0]
    ]
    assert staging.drop_staged(spark) == 1
    staging._STAGED[spark.sparkContext.applicationId] = kept


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {name: plan(fn(spark, sf_dir)) for name, fn in QUERIES.items() if "stream" not in name}


def test_no_python_in_any_query(plans):
    for name, text in plans.items():
        assert "EvalPython" not in text and "InPandas" not in text and "MapInArrow" not in text, name


def test_no_cartesian_products(plans):
    # A range condition over a handful of literal bands or over a size-checked
    # parameter table, or a price table of one literal row: the broadcast side
    # of the nested loop is bounded.
    nested = {"q04_range_join", "param_sweep_price_bands", "cost_expression"}
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        assert "NestedLoopJoin" not in text or name in nested, name


def test_windows_are_partitioned(plans):
    # Offsets of ranges are summed in one task: one row per range partition.
    offsets = {"page_manifest_lineitem", "resource_listing_pages", "paged_events", "paged_events_nullable"}
    for name, text in plans.items():
        one_task = "Exchange SinglePartition" in text and "Window [" in text
        assert not one_task or name in offsets, name


def test_filters_and_columns_reach_the_scan(plans):
    assert "GreaterThanOrEqual(o_totalprice,100000.0)" in plans["q01_filter"]
    assert "StringStartsWith(p_name,small)" in plans["prefix_part_names"]
    assert "EqualTo(c_nationkey,7)" in plans["policy_customers_by_nation"]
    assert "o_orderdate" in plans["keyset_page_orders"] and "GreaterThanOrEqual(o_orderdate" in plans["keyset_page_orders"]
    scan = [line for line in plans["q05_pricing_summary"].splitlines() if "ReadSchema" in line][0]
    assert "l_tax" not in scan and "l_orderkey" not in scan


def test_top_n_does_not_sort_everything(plans, spark, sf_dir):
    for name in ("keyset_page_orders", "q08_top_orders", "param_orders_by_segment"):
        assert "TakeOrderedAndProject" in plans[name], name
    capped = many(read(spark, sf_dir, "customer"), 1000, order=["c_custkey"])
    assert "TakeOrderedAndProject" in capped._jdf.queryExecution().executedPlan().toString()


def test_tables_are_listed(spark, sf_dir):
    for name in TABLES:
        assert read(spark, sf_dir, name).columns
    assert ordered.HOT_GROUP_ROWS > 1_000_000


def test_ordered_scans_grow_in_proportion_to_their_steps(spark):
    df = spark.range(4000).selectExpr("id % 2 AS g", "id", "id % 7 AS v")
    scans, exchanges = [], []
    for n in (1, 2, 3, 4):
        steps = [Running(f"s{i}", "sum", F.col("v" if i == 0 else f"s{i - 1}")) for i in range(n)]
        out = scan_in_order(df, ["g"], ["id"], steps, hot_rows=100)
        text = out._jdf.queryExecution().executedPlan().toString()
        scans.append(text.count("FileScan"))
        exchanges.append(text.count("Exchange "))
    assert scans[1] - scans[0] >= scans[3] - scans[2] and scans[3] <= scans[0] + 3 * 2
    assert exchanges[3] - exchanges[2] <= exchanges[1] - exchanges[0] + 1


def test_ordered_scans_agree_on_ties(spark):
    df = spark.range(3000).selectExpr("id % 2 AS g", "id DIV 50 AS at", "id % 11 AS v")
    step = [Running("s", "sum", F.col("v")), Running("p", "prev", F.col("v"))]
    one = scan_in_order(df, ["g"], ["at"], step, hot_rows=10**9)
    many_ = scan_in_order(df, ["g"], ["at"], step, hot_rows=100)
    assert one.exceptAll(many_).isEmpty() and many_.exceptAll(one).isEmpty()


def test_a_group_of_millions_is_no_single_task(spark):
    """By default a group of 2.5 million rows is scanned in ranges."""
    n = 2_500_000
    df = spark.range(n).select(F.lit("one").alias("g"), "id")
    got = scan_in_order(df, ["g"], ["id"], [Running("n", "sum", F.lit(1))])
    assert got.where(F.col("n") != F.col("id") + 1).count() == 0 and got.count() == n
    assert "__range" in got._jdf.queryExecution().executedPlan().toString()
