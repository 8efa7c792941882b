"""Sweeps answered by numbers and blocks, against plain loops over all pairs."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkq.operators import params as P
from sparkq.operators import sweeps as S

DATA = "id int, k string, v double, w int, t timestamp_ntz"
PARAMS = "pid int, pk string, lo double, hi double"
T0 = datetime(2024, 1, 1)


def data_rows(n=300, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = None if i % 41 == 0 else float(rng.randrange(80))
        w = None if i % 7 == 0 else rng.randrange(-50, 50)
        out.append((i, rng.choice(["a", "a", "a", "b", None]), v, w, T0 + timedelta(seconds=rng.randrange(999))))
    return out


def param_rows(n=60, seed=3):
    rng = random.Random(seed)
    out = [(i, rng.choice(["a", "b", "none"]), float(rng.randrange(-5, 80)), 0.0) for i in range(n)]
    out = [(i, k, lo, lo + rng.choice([0, 0.5, 1, 7, 33, 100])) for i, k, lo, _ in out]
    return [*out, (100, "a", None, 20.0), (101, "a", 20.0, None), (102, "b", None, None), (103, "a", 30.0, 10.0), (104, None, 0.0, 99.0), (100, "a", None, 20.0)]


def inside(d, p, keyed, low_open):
    if d[2] is None or (keyed and (d[1] is None or d[1] != p[1])):
        return False
    return (p[2] is None or (d[2] > p[2] if low_open else d[2] >= p[2])) and (p[3] is None or d[2] < p[3])


def matches(keyed, low_open):
    data = sorted(data_rows(), key=lambda r: (r[2] is not None, r[2], r[0]))
    return {p: [d for d in data if inside(d, p, keyed, low_open)] for p in param_rows()}


def tables(spark):
    return spark.createDataFrame(data_rows(), DATA).repartition(3), spark.createDataFrame(param_rows(), PARAMS)


def options(keyed, low_open):
    return {"between": ("v", "lo", "hi"), "equal": {"k": "pk"} if keyed else None, "low_open": low_open}


def answers(df, n=4):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 2, 10])
@pytest.mark.parametrize("keyed, low_open", [(False, False), (True, True)])
def test_extremes(spark, bits, keyed, low_open):
    got = S.sweep_extremes(
        *tables(spark), **options(keyed, low_open), bits=bits,
        minima={"least": F.col("w"), "first": F.col("t")}, maxima={"most": F.col("w"), "last": F.col("t")},
    )
    want = []
    for p, rows in matches(keyed, low_open).items():
        w = [d[3] for d in rows if d[3] is not None]
        t = [d[4] for d in rows]
        want.append((*p, min(w, default=None), min(t, default=None), max(w, default=None), max(t, default=None)))
    assert answers(got) == sorted(want, key=repr)


@pytest.mark.parametrize("keyed, low_open", [(False, True), (True, False)])
@pytest.mark.parametrize("cap", [0, 3, 1000])
def test_many_with_cap_and_flag(spark, keyed, low_open, cap):
    got = S.sweep_rows(*tables(spark), **options(keyed, low_open), order=["id"], max_rows=cap)
    want = []
    for p, rows in matches(keyed, low_open).items():
        shown = [(n, d) for n, d in enumerate(rows[:cap], 1)] or [(0, (None,) * 5)]
        want += [(*p, n, len(rows) > cap, *d) for n, d in shown]
    assert answers(got) == sorted(want, key=repr)


def test_single_and_scalar(spark):
    found = matches(False, False)
    single = S.sweep_rows(*tables(spark), **options(False, False), order=["id"], row_mode="single")
    assert answers(single) == sorted(((*p, *(rows[0] if rows else (None,) * 5)) for p, rows in found.items()), key=repr)
    scalar = S.sweep_rows(*tables(spark), **options(False, False), order=["id"], row_mode="scalar")
    assert answers(scalar) == sorted(((*p, rows[0][0] if rows else None) for p, rows in found.items()), key=repr)
    for bad in ({"row_mode": "stream"}, {"max_rows": -1}):
        with pytest.raises(ValueError):
            S.sweep_rows(*tables(spark), **options(False, False), **bad)


def test_clashing_names_and_empty_sides(spark):
    data, params = tables(spark)
    clash = params.selectExpr("pid AS id", "pk AS size", "lo AS found", "hi AS first")
    got = S.sweep_extremes(data.select("v", "w"), clash, between=("v", "found", "first"), minima={"least": F.col("w")})
    assert got.columns == ["id", "size", "found", "first", "least"] and got.count() == len(set(param_rows()))
    totals = P.sweep_totals(data, clash, between=("v", "found", "first"), sums={"total": F.col("w").cast("long")})
    want = {p: sum(d[3] or 0 for d in rows) if rows else None for p, rows in matches(False, False).items()}
    assert {tuple(r)[:4]: r.total for r in totals.collect()} == want
    none = data.limit(0)
    assert S.sweep_extremes(none, params, between=("v", "lo", "hi"), maxima={"m": F.col("w")}).where("m IS NOT NULL").count() == 0
    assert S.sweep_rows(none, params, between=("v", "lo", "hi")).where("row_no <> 0 OR truncated").count() == 0
    assert S.sweep_rows(data, params.limit(0), between=("v", "lo", "hi")).count() == 0


def test_bounds_of_other_types(spark):
    """Fractions bound whole numbers; instants bound days, and days instants."""
    data = spark.createDataFrame([(10,), (11,)], "n int")
    ranges = spark.createDataFrame([(1, 10.5, 20.0), (2, 5.0, 10.5)], "pid int, lo double, hi double")
    of = {"between": ("n", "lo", "hi")}
    assert {r.pid: r.n for r in P.sweep_totals(data, ranges, **of, count="n").select("pid", "n").collect()} == {1: 1, 2: 1}
    assert {(r.n, r.pid) for r in P.run_batch(data, ranges, **of).collect()} == {(11, 1), (10, 2)}
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3)], "d date")
    spans = spark.createDataFrame([(1, T0 + timedelta(hours=12), T0 + timedelta(hours=60))], "pid int, a timestamp_ntz, b timestamp_ntz")
    assert P.sweep_totals(days, spans, between=("d", "a", "b")).first().n == 2
    assert sorted(r.d.day for r in P.run_batch(days, spans, between=("d", "a", "b")).collect()) == [2, 3]
    times = spark.createDataFrame([(T0 + timedelta(hours=12 * i),) for i in range(6)], "at timestamp_ntz")
    whole = spark.createDataFrame([(1, date(2024, 1, 1), date(2024, 1, 2))], "pid int, a date, b date")
    assert P.sweep_totals(times, whole, between=("at", "a", "b")).first().n == 2
    assert P.run_batch(times, whole, between=("at", "a", "b")).count() == 2
    decimals = spark.sql("SELECT 1 AS pid, CAST(10.25 AS DECIMAL(5,2)) AS lo, CAST(11.75 AS DECIMAL(5,2)) AS hi")
    assert P.sweep_totals(data, decimals, **of, count="n").first().n == 1


def test_nothing_pairs_ranges_with_rows(spark):
    """Ranges over all rows cost a few blocks each."""
    n = 3000
    data = spark.range(n).select(F.col("id").cast("double").alias("v"))
    params = spark.range(500).select(F.col("id").alias("pid"), F.lit(0.0).alias("lo"), F.lit(float(n)).alias("hi"))
    placed = S.sweep_positions(data, params, ("v", "lo", "hi"), None, [F.col("v")])
    parts = S._by_blocks(placed.rows, placed.ranges, placed.keys, [False], 4)
    assert parts.count() <= 500 * 2 * math.ceil(math.log(n, 16))
