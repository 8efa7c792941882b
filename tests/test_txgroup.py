import pytest

from sparkq.operators.txgroup import Step, StepFailed, Transaction, TransactionClosed, run_group


@pytest.fixture
def tables(spark):
    return {"t": spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, s string")}


def ns(df):
    return sorted(r["n"] for r in df.collect())


def test_steps_see_the_writes_before_them(spark, tables):
    got, written = run_group(
        spark,
        tables,
        [
            Step("insert", "insert", "t", sql="SELECT :n AS n, 'new' AS s", params=("n",)),
            Step("raise", "update", "t", assign={"n": "n + 10"}, where="s = 'a'"),
            Step("drop", "delete", "t", where="s = :gone"),
            Step("count", "query", sql="SELECT count(*) FROM t", row_mode="scalar"),
            Step("one", "query", sql="WITH x AS (SELECT * FROM t) SELECT n, s FROM x WHERE n = :n;", row_mode="single"),
            Step("none", "query", sql="SELECT n FROM t WHERE n < 0", row_mode="single"),
            Step("all", "query", sql="SELECT n FROM t", row_mode="many"),
            Step("brace", "query", sql="SELECT '{n}'", row_mode="scalar"),
        ],
        {"n": 42, "gone": "b"},
    )
    assert got["insert"] == {"rows_affected": 1}
    assert got["raise"] == {"rows_affected": 1} and got["drop"] == {"rows_affected": 1}
    assert got["count"] == 3 and got["one"] == {"n": 42, "s": "new"} and got["none"] is None
    assert ns(got["all"]) == [3, 11, 42] == ns(written["t"]) and got["brace"] == "{n}"
    assert ns(tables["t"]) == [1, 2, 3]
    assert not [t for t in spark.catalog.listTables() if t.name == "t"]


@pytest.mark.parametrize(
    "bad",
    [
        Step("boom", "insert", "missing", sql="SELECT 1 AS n, 'x' AS s"),
        Step("boom", "query", sql="SELECT nothing FROM t", row_mode="scalar"),
        Step("boom", "query", sql="SELECT 1", row_mode="stream"),
        Step("boom", "insert", "t", sql="SELECT :absent AS n, 'x' AS s"),
        Step("boom", "insert", "t", sql="SELECT 1 AS n, 'x' AS s", params=("absent",)),
        Step("boom", "merge", "t"),
    ],
)
def test_failure_names_the_step(spark, tables, bad):
    with pytest.raises(StepFailed, match="boom"):
        run_group(spark, tables, [Step("first", "insert", "t", sql="SELECT 9 AS n, 'x' AS s"), bad], {})
    assert ns(tables["t"]) == [1, 2, 3]


def test_null_condition_is_not_a_match(spark, tables):
    with Transaction(spark, tables) as tx:
        assert tx.update("t", {"n": "0"}, "s <> 'a'") == 1
        assert tx.delete("t", "s <> 'zzz'") == 2
        assert ns(tx.commit()["t"]) == [3]


def test_closed_and_left_transactions(spark, tables):
    tx = Transaction(spark, tables)
    tx.delete("t")
    assert ns(tx.commit()["t"]) == [] and tx.is_closed
    for call in (tx.commit, tx.rollback, lambda: tx.read("t")):
        with pytest.raises(TransactionClosed):
            call()
    with Transaction(spark, tables) as left:
        left.insert("t", spark.sql("SELECT 1 AS n, 'x' AS s"))
    assert left.is_closed and ns(tables["t"]) == [1, 2, 3]


def test_only_written_tables_come_out(spark, tables):
    _, written = run_group(spark, {**tables, "other": tables["t"]}, [Step("d", "delete", "t", where="n = 1")])
    assert set(written) == {"t"} and ns(written["t"]) == [2, 3]


def test_every_write_runs_once(spark):
    """Counts are of the rows kept, and later steps do not run earlier ones again."""
    runs = spark.sparkContext.accumulator(0)
    source = spark.sparkContext.parallelize([(i, "x") for i in range(10)], 2).map(lambda r: (runs.add(1), r)[1])
    tables = {"t": spark.createDataFrame([(1, "a")], "n int, s string"), "new": spark.createDataFrame(source, "n int, s string")}
    with Transaction(spark, tables) as tx:
        assert tx.insert("t", tx.query("SELECT n, s FROM new WHERE rand() < 0.5 OR n = 0")) == tx.read("t").count() - 1
        before = runs.value
        assert before == 10
        n = tx.read("t").count()
        assert tx.update("t", {"s": "'y'"}, "s = 'x'") == n - 1
        assert tx.delete("t", "n >= 0 AND s = 'y'") == n - 1
        assert tx.insert("t", tx.query("SELECT 1 AS n, 'z' AS s WHERE false")) == 0
        assert tx.delete("t", "false") == 0
        assert sorted(map(tuple, tx.commit()["t"].collect())) == [(1, "a")]
    assert runs.value == before
