import pytest

from sparkq.operators import cost as M

CALLS = "request_id int, backend string, driver string, status string, n_rows bigint, payload_bytes bigint, fee string"
SPEC = "backend string, unit string, amount string, currency string, max_per_call string"


@pytest.fixture
def calls(spark):
    return spark.createDataFrame(
        [
            (1, "flat", "pg", "success", 10, 100, "0.5"),
            (2, "row", "pg", "success", 10, 100, "1"),
            (3, "row", "pg", "success", 50, 100, "1"),
            (4, "row", "pg", "success", 51, 100, "1"),
            (5, "byte", "pg", "success", 10, 100, "x"),
            (6, "free", "pg", "success", 10, 100, "1"),
            (7, "flat", "pg", "timeout", 0, 0, "2"),
            (8, "row", "pg", "transport_error", 0, 0, "2"),
            (9, "flat", "pg", "invalid_spec", 0, 0, "-1"),
        ],
        CALLS,
    )


@pytest.fixture
def spec(spark):
    return spark.createDataFrame(
        [
            ("flat", "per_call", "0.10", "USD", None),
            ("row", "per_row", "0.01", "USD", "0.50"),
            ("byte", "per_byte", "0.000001", "USDC", None),
        ],
        SPEC,
    )


def by_id(df, *columns):
    return {r["request_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_charges(calls, spec):
    got = by_id(M.charges(calls.where("status = 'success'"), spec), "charge", "refused_reason")
    assert got[1] == (0.1, None)
    assert got[2][0] == pytest.approx(0.1) and got[3] == (0.5, None)  # the cap itself is fine
    assert got[4] == (None, "over_cap")
    assert got[5][0] == pytest.approx(0.0001)
    assert 6 not in got


def test_expressions(calls, spec):
    def charge(expression):
        found = M.charges(calls.where("status = 'success' AND backend IN ('flat', 'byte')"), spec,
                          {"flat": expression, "byte": "fee"})
        return by_id(found, "charge", "refused_reason")

    assert charge("n_rows * 2")[1] == (20.0, None)
    assert charge("fee")[1] == (0.5, None)  # text that reads as a number
    assert charge("fee")[5] == (None, "not_a_number")
    assert charge("-1")[1] == (None, "not_payable")
    assert charge("n_rows > 1")[1] == (None, "not_a_number")


def test_refunds(calls, spec):
    got = by_id(M.refunds(calls, spec), "amount", "reason")
    assert got == {7: (0.1, "timeout"), 8: (0.0, "transport"), 9: (0.1, "invalid_spec")}
    broken = by_id(M.refunds(calls, spec, {"flat": "fee"}), "amount")
    assert broken[7] == (2.0,) and broken[9] == (0.0,)


def test_ledger_is_charges_and_refunds_in_one_pass(calls, spec):
    got = by_id(M.ledger(calls, spec, {"flat": "fee"}), "kind", "label", "amount", "refused_reason")
    charged = by_id(M.charges(calls.where("status = 'success'"), spec, {"flat": "fee"}), "unit", "charge", "refused_reason")
    refunded = by_id(M.refunds(calls, spec, {"flat": "fee"}), "reason", "amount")
    want = {i: ("charge", *v) for i, v in charged.items()}
    want.update({i: ("refund", *v, None) for i, v in refunded.items()})
    assert got == want


def test_totals_are_exact_micro_units(spark, rows):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", 0.0000004), ("a", 0.0000006), ("b", None)], "k string, charge double")
    got = M.totals(df, ["k"]).selectExpr("k", "calls", "CAST(micro_units AS bigint) AS m")
    assert rows(got) == [("a", 4, 300001), ("b", 1, 0)]


def test_parse_and_format(spark):
    cases = {
        " 0.10 ": 0.1, "1": 1.0, "1e3": 1000.0, ".5": 0.5, "0": 0.0, "": None, "  ": None, "-1": None, "x": None,
        "NaN": None, "inf": None, "Infinity": None, "1d": None, "1e999": None, "0x10": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", M.parse_amount("t")).collect()} == cases
    shown = {1.0: "1", 0.000001: "0.000001", 12.5: "12.5", 100.0: "100", 0.0: "0", 1e9: "1000000000"}
    df = spark.createDataFrame([(k,) for k in shown], "v double")
    assert {r[0]: r[1] for r in df.select("v", M.format_amount("v")).collect()} == shown


def test_price_checks(spark):
    rows = [
        ("per_call", "1", None, "USD", None, None),
        ("per_call", "1", "x", "USD", None, "both amount and expression"),
        ("per_call", None, None, "USD", None, "neither amount nor expression"),
        ("per_call", "-1", None, "USD", None, "bad amount"),
        ("per_call", "NaN", None, "USD", None, "bad amount"),
        ("per_call", None, " ", "USD", None, "empty expression"),
        ("per_call", "1", None, " ", None, "empty currency"),
        ("per_call", "1", None, "U\nD", None, "control character"),
        ("per_call", "1", None, "USD", "x", "bad max_per_call"),
        ("per_day", "1", None, "USD", None, "unknown unit"),
    ]
    df = spark.createDataFrame(rows, "unit string, amount string, expression string, currency string, max_per_call string, want string")
    assert all(r["error"] == r["want"] for r in M.check_prices(df).collect())


def test_await_charges_count_the_match(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, matched_id int")
    assert rows(M.charge_await(df).select("id", "n_rows")) == [(1, 1), (2, 0)]


def test_audit_fields(spec):
    got = {r["backend"]: r["fields"] for r in M.audit_fields(spec).collect()}
    assert got["row"] == {
        "db.query_ref": "row", "db.cost.unit": "per_row", "db.cost.currency": "USD",
        "db.cost.source": "0.01", "db.cost.max_per_call": "0.5",
    }
    assert "db.cost.max_per_call" not in got["flat"]


def test_amounts_between_white_space_of_any_kind(spark):
    texts = {"\t1.5\n": 1.5, "\u2003 2 \u3000": 2.0, "\x0b3\x0c\r": 3.0, "1 2": None, "\t": None, "\x1c1": None, "4": 4.0}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.a for r in df.select("t", M.parse_amount("t").alias("a")).collect()} == texts
