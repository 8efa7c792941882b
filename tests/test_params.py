import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from sparkq.operators import params as P


@pytest.fixture
def orders(spark):
    df = spark.createDataFrame(
        [(1, "a", 10.0), (2, "a", 20.0), (3, "b", 30.0), (4, None, 40.0)], "id int, tenant string, total double"
    )
    df.createOrReplaceTempView("t_orders")
    return df


def ask(spark, sql, args=None, **options):
    spec = P.QuerySpec(name="q", sql=sql, **{k: v for k, v in options.items() if k in ("params", "derived", "session_vars")})
    rest = {k: v for k, v in options.items() if k in ("after", "idempotency", "views")}
    return [tuple(r) for r in P.run_query(spark, spec, args, **rest).collect()]


def test_named_parameters(spark, orders):
    sql = "SELECT id FROM t_orders WHERE tenant = :tenant AND total > :low ORDER BY id"
    assert ask(spark, sql, {"tenant": "a", "low": 15}) == [(2,)]


def test_quotes_casts_and_comments_are_not_parameters(spark, orders):
    sql = "SELECT ':low' AS s, id::string /* :x */ FROM t_orders WHERE id = :id -- :y"
    assert ask(spark, sql, {"id": 3}) == [(":low", "3")]


def test_value_never_becomes_sql(spark, orders):
    assert ask(spark, "SELECT id FROM t_orders WHERE tenant = :t", {"t": "a' OR '1'='1"}) == []


def test_missing_parameter_is_named(spark, orders):
    with pytest.raises(P.MissingParameter, match="low"):
        ask(spark, "SELECT id FROM t_orders WHERE total > :low", {})
    with pytest.raises(P.MissingParameter, match="tenant"):
        ask(spark, "SELECT 1", {}, params=("tenant",))


def test_null_is_bound_and_extras_are_ignored(spark, orders):
    sql = "SELECT id FROM t_orders WHERE tenant <=> :t"
    assert ask(spark, sql, {"t": None, "unused": 1}) == [(4,)]


def test_arguments_must_be_an_object(spark):
    with pytest.raises(TypeError):
        ask(spark, "SELECT 1", [1])
    assert ask(spark, "SELECT 1", None) == [(1,)]


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError, match="reserved"):
        ask(spark, "SELECT 1", {"idempotency_key": "x"})


def test_idempotency_binds_or_is_missing(spark):
    sql = "SELECT :idempotency_scope_hash AS s, :idempotency_key AS k"
    assert ask(spark, sql, idempotency=("s1", "k1")) == [("s1", "k1")]
    with pytest.raises(P.MissingParameter, match="idempotency"):
        ask(spark, sql)


def test_bind_values(spark):
    big = 2**70
    row = ask(
        spark,
        "SELECT :i AS i, :big AS big, :b AS b, :d AS d, :l AS l",
        {"i": 5, "big": big, "b": True, "d": {"k": [1]}, "l": [1, 2]},
    )
    assert row == [(5, str(big), True, '{"k": [1]}', [1, 2])]


def test_derived_parameters_run_in_name_order_and_override(spark):
    derived = {"a": "base", "b": "a + 1", "tenant": "'fixed'"}
    got = P.derive_arguments(spark, {"base": 10, "tenant": "spoofed"}, derived)
    assert got == {"base": 10, "a": 10, "b": 11, "tenant": "fixed"}
    assert P.derive_arguments(spark, {}, {"x": "1 + 1"}) == {"x": 2}


def test_derived_over_a_table_is_one_plan(spark):
    df = spark.createDataFrame([(50,), (7,)], "page_size int")
    out = P.derive_params(df, {"limit": "page_size * 2", "next": "limit + 1"})
    assert sorted(map(tuple, out.collect())) == [(7, 14, 15), (50, 100, 101)]


def test_specs_refuse_bad_text():
    for sql in ("SELECT 1; SELECT 2", "GRANT x TO y", "-- c\ndrop user u"):
        with pytest.raises(ValueError):
            P.QuerySpec(name="q", sql=sql)
    P.QuerySpec(name="q", sql="SELECT ';' AS s;")
    with pytest.raises(ValueError):
        P.QuerySpec(name="q", sql="SELECT 1", session_vars={"a;b": "x"})


def test_policy(spark, orders, rows):
    keep = P.apply_policy(orders, "tenant = :app_tenant", {"app.tenant": "a"})
    assert [r[0] for r in rows(keep)] == [1, 2]
    unset = P.apply_policy(orders, "tenant = :app_tenant", {}, declared=["app.tenant"])
    assert rows(unset) == []
    with pytest.raises(PySparkException):
        P.apply_policy(orders, "tenant = :other", {"app.tenant": "a"}).collect()


def test_session_variables_last_one_call(spark, orders):
    with P.session_variables(spark, {"app.tenant": "b"}):
        got = spark.sql("SELECT id FROM t_orders WHERE tenant = app_tenant").collect()
    assert [r[0] for r in got] == [3]
    with pytest.raises(PySparkException):
        spark.sql("SELECT app_tenant").collect()


def test_session_vars_of_a_spec_are_markers(spark, orders):
    sql = "SELECT id FROM t_orders WHERE tenant = :app_tenant ORDER BY id"
    assert ask(spark, sql, session_vars={"app.tenant": "a"}) == [(1,), (2,)]


@pytest.fixture
def sweep(spark):
    data = spark.createDataFrame([(i, i % 3, float(i)) for i in range(200)], "id int, k int, v double")
    params = spark.createDataFrame(
        [(p, p % 3, p * 7.0 - 20, p * 7.0 + p) for p in range(40)],
        "pid int, pk int, lo double, hi double",
    )
    return data, params


def brute(data, params, test):
    left, right = [tuple(r) for r in data.collect()], [tuple(r) for r in params.collect()]
    return sorted((d[0], p[0]) for d in left for p in right if test(d, p))


def test_batch_sweep_matches_brute_force(spark, sweep):
    data, params = sweep

    def pairs(df):
        return sorted(map(tuple, df.select("id", "pid").collect()))

    between = P.run_batch(data, params, between=("v", "lo", "hi"))
    assert pairs(between) == brute(data, params, lambda d, p: p[2] <= d[2] < p[3])
    equal = P.run_batch(data, params, equal={"k": "pk"}, where="v > hi")
    assert pairs(equal) == brute(data, params, lambda d, p: d[1] == p[1] and d[2] > p[3])
    both = P.run_batch(data, params, equal={"k": "pk"}, between=("v", "lo", "hi"))
    assert pairs(both) == brute(data, params, lambda d, p: d[1] == p[1] and p[2] <= d[2] < p[3])


def test_large_range_sweep_joins_on_bins(spark, sweep):
    data, params = sweep
    # Widths from far below one to the whole domain, an empty and a reversed range.
    odd = spark.createDataFrame(
        [(100, 0, 3.0, 3.001), (101, 0, -1e6, 1e9), (102, 0, 5.0, 5.0), (103, 0, 9.0, 1.0), (104, 0, 16.0, 32.0),
         (105, 0, None, 4.0)],
        params.schema,
    )
    every = params.union(odd)
    swept = P.run_batch(data, every, between=("v", "lo", "hi"))
    got = sorted(map(tuple, swept.select("id", "pid").collect()))
    assert got == brute(data, every, lambda d, p: p[2] is not None and p[2] <= d[2] < p[3])
    assert swept.columns == [*data.columns, *params.columns]
    text = swept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert P.run_batch(data, params.limit(0), between=("v", "lo", "hi")).count() == 0


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_sweep_over_times(spark, kind):
    at = f"CAST(timestamp_ntz'2024-03-10' + make_interval(0, 0, 0, CAST(id % 40 AS INT), 0, 0, id / 1000000) AS {kind})"
    data = spark.range(120).selectExpr("id", f"{at} AS t")
    params = spark.range(30).selectExpr(
        "id AS pid", f"{at} AS lo",
        f"CAST(CAST({at} AS timestamp_ntz) + make_interval(0, 0, 0, CAST(id % 3 AS INT), 0, 0, id / 1000000)"
        f" AS {kind}) AS hi",
    )
    got = P.run_batch(data, params, between=("t", "lo", "hi")).select("id", "pid").collect()
    ranges = params.collect()
    assert sorted(map(tuple, got)) == sorted(
        (d.id, p.pid) for d in data.collect() for p in ranges if p.lo <= d.t < p.hi
    )


def test_sweep_answers_every_parameter_row(spark, sweep):
    data, params = sweep
    odd = spark.createDataFrame([(200, 0, None, None), (201, 0, 9.0, 1.0), (201, 0, 9.0, 1.0)], params.schema)
    every = params.union(odd)
    got = P.run_batch(data, every, between=("v", "lo", "hi"), keep_unmatched=True)
    met = {(d, p) for d, p in brute(data, every, lambda d, p: p[2] is not None and p[2] <= d[2] < p[3])}
    answered = {r.pid for r in got.collect()}
    assert answered == {r.pid for r in every.collect()}
    assert {(r.id, r.pid) for r in got.collect() if r.id is not None} == met
    assert got.where("id IS NULL AND pid = 201").count() == 1


@pytest.mark.parametrize("low_open", [False, True])
@pytest.mark.parametrize("keyed", [False, True])
def test_sweep_totals(spark, sweep, monkeypatch, low_open, keyed):
    data, params = sweep
    odd = [(50, 1, None, 20.0), (51, 1, 20.0, None), (52, 2, None, None), (53, 2, 9.0, 1.0), (54, 7, 0.0, 99.0)]
    every = params.union(spark.createDataFrame(odd, params.schema))
    data = data.union(spark.createDataFrame([(900, 1, None), (901, 1, 20.0), (902, 1, 20.0)], data.schema))
    monkeypatch.setattr(P, "SWEEP_ROWS", 60)
    got = P.sweep_totals(
        data, every, between=("v", "lo", "hi"), equal={"k": "pk"} if keyed else None,
        sums={"total": F.col("id").cast("long")}, low_open=low_open,
    )

    def inside(d, p):
        above = p.lo is None or (d.v > p.lo if low_open else d.v >= p.lo)
        return above and (p.hi is None or d.v < p.hi) and (not keyed or d.k == p.pk)

    rows = [d for d in data.collect() if d.v is not None]
    for r in got.collect():
        ids = [d.id for d in rows if inside(d, r)]
        assert (r.n, r.total) == (len(ids), sum(ids) if ids else None), r
    assert got.count() == every.count()


def test_undeclared_name_is_not_bound(spark, orders):
    with pytest.raises(P.MissingParameter, match="low"):
        ask(spark, "SELECT id FROM t_orders WHERE total > :low AND id > :id", {"low": 1, "id": 1}, params=("id",))
    sql = "SELECT id FROM t_orders WHERE id > :_after_id ORDER BY id"
    assert ask(spark, sql, {"_after_id": 0}, params=(), after={"id": 2}) == [(3,), (4,)]


def test_completion_statement(spark, orders, rows):
    sql = "SELECT DISTINCT tenant FROM t_orders WHERE tenant LIKE :prefix || '%' AND total > :ctx_low"
    assert rows(P.complete_variable(spark, sql, "", {"LOW": "5"})) == [("a",), ("b",)]
    assert rows(P.complete_variable(spark, sql, "b", {"low": "5"})) == [("b",)]
    assert rows(P.complete_variable(spark, "SELECT id FROM t_orders WHERE tenant = :prefix", "a")) == []
    with pytest.raises(P.MissingParameter):
        P.complete_variable(spark, sql, "", {"bad-key": "5"})
    with pytest.raises(ValueError, match="prefix"):
        P.complete_variable(spark, "SELECT 1", "")


def test_apply_once_first_wins_and_ledger_blocks(spark, rows):
    batch = spark.createDataFrame(
        [(2, "s", "k1"), (1, "s", "k1"), (3, "s", "k2"), (4, "t", "k1"), (5, None, "k1"), (6, None, "k1")],
        "seq int, idempotency_scope_hash string, idempotency_key string",
    )
    ledger = spark.createDataFrame([("s", "k2")], "idempotency_scope_hash string, idempotency_key string")
    assert [r[0] for r in rows(P.apply_once(batch, ["seq"], ledger))] == [1, 4, 5]
    assert [r[0] for r in rows(P.apply_once(batch, ["seq"]))] == [1, 3, 4, 5]


def test_completion(spark, rows):
    df = spark.createDataFrame(
        [("alpha", "x"), ("alps", "x"), ("beta", "x"), ("alpine", "y"), ("alps", "x"), (None, "x")],
        "name string, owner string",
    )
    got = P.complete_prefix(df, "name", "al", {"Owner": "x", "bad-key": "z"})
    assert [r[0] for r in got.collect()] == ["alpha", "alps"]
    assert [r[0] for r in P.complete_prefix(df, "name", "al", max_results=2).collect()] == ["alpha", "alpine"]
    wanted = spark.createDataFrame([("al",), ("b",), ("",), ("zz",), (None,)], "prefix string")
    got = P.complete_prefixes(df, "name", wanted, max_results=2)
    assert rows(got) == [("", "alpha"), ("", "alpine"), ("al", "alpha"), ("al", "alpine"), ("b", "beta")]


def test_procedure(spark, orders, rows):
    P.define_procedure(
        spark, "orders_of", {"who": "STRING"}, "id INT, total DOUBLE",
        "SELECT id, total FROM t_orders WHERE tenant = who",
    )
    assert rows(P.call_procedure(spark, "orders_of", {"who": "a"})) == [(1, 10.0), (2, 20.0)]
    with pytest.raises(ValueError):
        P.call_procedure(spark, "x; drop", {})


def test_views_are_registered(spark, orders):
    assert ask(spark, "SELECT count(*) FROM v", views={"v": orders.where("id > 1")}) == [(3,)]


def test_parameter_in_limit(spark, orders):
    assert len(ask(spark, "SELECT id FROM t_orders ORDER BY id LIMIT :n", {"n": 2})) == 2


def test_positional_style_list(spark):
    assert spark.sql("SELECT ? + ?", args=[1, 2]).first()[0] == 3
