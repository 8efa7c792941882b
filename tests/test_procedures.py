import pytest
from pyspark.sql import functions as F

from sparkq.operators.params import MissingParameter, first_per_group
from sparkq.operators.procedures import Procedures
from sparkq.operators.shape import run_result_sets


def sets(spark, *sizes):
    for i, n in enumerate(sizes):
        yield spark.range(n).select(F.col("id").alias("k"), F.lit(i).alias("of")), ["k"]


@pytest.mark.parametrize(
    "sizes, budget, kept, truncated",
    [
        ((3, 0, 2, 4), 100, (3, 2, 4), False),
        ((3, 0, 2, 4), 9, (3, 2, 4), False),
        ((3, 0, 2, 4), 8, (3, 2, 3), True),
        ((3, 0, 2, 4), 4, (3, 1, 0), True),
        ((3, 2), 3, (3, 0), True),
        ((3, 0), 3, (3,), False),
        ((2, 2), 0, (0, 0), True),
        ((0, 0), 5, (), False),
    ],
)
def test_sets_share_the_budget(spark, sizes, budget, kept, truncated):
    got = run_result_sets(sets(spark, *sizes), budget)
    assert (got.kept, got.truncated) == (kept, truncated)
    assert [sorted(r.k for r in s.collect()) for s in got.sets] == [list(range(n)) for n in kept]


def test_each_statement_runs_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def counted(n):
        rows = spark.sparkContext.parallelize([(i,) for i in range(n)], 1).map(lambda r: (runs.add(1), r)[1])
        return spark.createDataFrame(rows, "k int"), ["k"]

    got = run_result_sets((counted(n) for n in (5, 7)), 8)
    assert got.rows().count() == got.rows().count() == 8
    assert runs.value == 12


def test_registry(spark):
    calls = []

    def body(spark, n, tag):
        calls.append((n, tag))
        yield spark.range(n).select("id", F.lit(tag).alias("tag")), ["id"]

    procedures = Procedures()
    procedures.define("some", ["n", "tag"], body)
    answer = procedures.call(spark, "some", {"n": 2, "tag": None, "other": 1})
    assert sorted((r.id, r.tag) for r in answer.rows().collect()) == [(0, None), (1, None)] and calls == [(2, None)]
    with pytest.raises(MissingParameter, match="tag"):
        procedures.call(spark, "some", {"n": 2})
    with pytest.raises(KeyError):
        procedures.call(spark, "other")
    with pytest.raises(ValueError):
        procedures.call(spark, "some", {"n": 1, "tag": "x"}, max_rows=-1)
    with pytest.raises(ValueError):
        procedures.define("no; name", [], body)


@pytest.mark.parametrize("n", [0, 1, 1500])
def test_first_of_hot_groups(spark, n):
    rows = [("hot" if i % 3 else f"g{i % 5}", i * 7919 % 10_007) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = first_per_group(df, ["g"], ["v"], n, parts=8)
    want = [(g, v) for name in {g for g, _ in rows} for g, v in sorted(r for r in rows if r[0] == name)[:n]]
    assert sorted(map(tuple, got.collect())) == sorted(want) and got.columns == df.columns
