"""Charges, refunds and totals over a call log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkq.functions.common import WHITE_SPACE, as_column, bound
from sparkq.plans.sizing import broadcast_if_small

# Billing units, and refund reasons by call status.
FLAT_UNITS = ("per_call", "per_query")
UNITS = (*FLAT_UNITS, "per_row", "per_byte")
REFUND_REASONS = {
    "timeout": "timeout",
    "transport_error": "transport",
    "invalid_spec": "invalid_spec",
}
MICRO = 1_000_000
# White space of any kind at either end.
_AROUND = rf"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+\z"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def _finite(c: Column) -> Column:
    return F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))


def parse_amount(text: Column | str) -> Column:
    """A decimal text as a finite, non-negative double; anything else is null."""
    trimmed = F.regexp_replace(as_column(text), _AROUND, "")
    value = F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))
    return F.when(_finite(value) & (value >= 0), value)


def format_amount(amount: Column | str) -> Column:
    """At most six fraction digits, no trailing zeros, no exponent."""
    fixed = F.format_string("%.6f", as_column(amount))
    return F.regexp_replace(F.regexp_replace(fixed, "0+$", ""), r"\.$", "")


def check_prices(spec: DataFrame) -> DataFrame:
    """Price rows with ``error``: null when a row is usable.

    Exactly one of ``amount`` and ``expression``, a known unit, amounts that are
    finite and not negative, and a currency without control characters.
    """
    have = set(spec.columns)

    def text(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    amount, expression, cap = text("amount"), text("expression"), text("max_per_call")
    error = (
        F.when(~F.coalesce(F.col("unit").isin(*UNITS), F.lit(False)), F.lit("unknown unit"))
        .when(amount.isNotNull() & expression.isNotNull(), F.lit("both amount and expression"))
        .when(amount.isNull() & expression.isNull(), F.lit("neither amount nor expression"))
        .when(amount.isNotNull() & parse_amount(amount).isNull(), F.lit("bad amount"))
        .when(expression.isNotNull() & (F.trim(expression) == ""), F.lit("empty expression"))
        .when(F.coalesce(F.trim("currency"), F.lit("")) == "", F.lit("empty currency"))
        .when(F.col("currency").rlike(r"[\x00-\x1F\x7F-\x9F]"), F.lit("control character"))
        .when(cap.isNotNull() & parse_amount(cap).isNull(), F.lit("bad max_per_call"))
    )
    return spec.withColumn("error", error)


def _base(priced: DataFrame, key: str, expressions: Mapping[str, str] | None) -> Column:
    """Base rate: the amount, or the expression of the backend over the call's columns.

    An expression may give a number or a text that reads as one.
    """
    base = F.col("__amount")
    for backend, expression in (expressions or {}).items():
        value = F.expr(expression)
        if isinstance(priced.select(value.alias("e")).schema["e"].dataType, T.NumericType):
            number = bound(value.cast("double"), lambda v: F.when(_finite(v), v))
        else:
            text = F.trim(value.cast("string"))
            number = bound(text, lambda t: F.when(t.rlike(_NUMBER), t.try_cast("double")))
        base = F.when(F.col(key) == backend, number).otherwise(base)
    return base


def _priced(calls: DataFrame, spec: DataFrame, key: str) -> DataFrame:
    """Calls with the price of their backend; calls without a price drop out.

    A price that ``check_prices`` finds fault with fails the job, and so does a second
    price of one backend.
    """

    def text(name: str) -> Column:
        return F.col(name) if name in spec.columns else F.lit(None).cast("string")

    # Amounts are read here, once for each price.
    amount, cap = parse_amount(text("amount")), parse_amount(text("max_per_call"))
    price = F.struct("unit", amount.alias("__amount"), "currency", cap.alias("__cap"))
    checked = check_prices(spec).groupBy(F.col(key).alias("__backend")).agg(
        F.min(price).alias("p"), F.count("*").alias("n"), F.max("error").alias("error")
    )
    problem = F.when(F.col("n") > 1, F.lit("more than one price")).otherwise(F.col("error"))
    message = F.concat(F.lit("price of "), F.col("__backend"), F.lit(": "), problem)
    usable = F.when(problem.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
    prices = checked.where("__backend IS NOT NULL").where(usable).select("__backend", "p.*")
    return calls.join(broadcast_if_small(prices), F.col(key) == F.col("__backend")).drop("__backend")


def charges(
    calls: DataFrame,
    spec: DataFrame,
    expressions: Mapping[str, str] | None = None,
    key: str = "backend",
    rows: str = "n_rows",
    payload_bytes: str = "payload_bytes",
) -> DataFrame:
    """Charge of every successful call of a priced backend.

    Adds ``unit``, ``currency``, ``charge`` and ``refused_reason``. A charge is
    the base rate times rows, bytes or nothing. It is refused (null charge) when
    negative, not finite, or above ``max_per_call``. ``rows`` is the count before
    any truncation.
    """
    return _with_charge(_priced(calls, spec, key), key, expressions, rows, payload_bytes).drop(
        "__amount", "__cap"
    )


def _with_charge(
    priced: DataFrame, key: str, expressions: Mapping[str, str] | None, rows: str, payload_bytes: str
) -> DataFrame:
    base = _base(priced, key, expressions)
    total = (
        F.when(F.col("unit") == "per_row", base * F.col(rows))
        .when(F.col("unit") == "per_byte", base * F.col(payload_bytes))
        .otherwise(base)
    )

    def judged(total: Column) -> Column:
        reason = (
            F.when(total.isNull(), F.lit("not_a_number"))
            .when(~_finite(total) | (total < 0), F.lit("not_payable"))
            .when(F.coalesce(total > F.col("__cap"), F.lit(False)), F.lit("over_cap"))
        )
        return F.struct(reason.alias("reason"), F.when(reason.isNull(), total).alias("charge"))

    return (
        priced.withColumn("__judged", bound(total, judged))
        .withColumn("refused_reason", F.col("__judged.reason"))
        .withColumn("charge", F.col("__judged.charge"))
        .drop("__judged")
    )


def charge_await(waits: DataFrame, matched_id: str = "matched_id") -> DataFrame:
    """Waits as calls to charge: one row when something matched, else none."""
    return waits.withColumn(
        "n_rows", F.when(F.col(matched_id).isNotNull(), 1).otherwise(0).cast("bigint")
    )


def refunds(
    calls: DataFrame,
    spec: DataFrame,
    expressions: Mapping[str, str] | None = None,
    key: str = "backend",
    status: str = "status",
) -> DataFrame:
    """Refund of every failed call of a priced backend: ``amount`` and ``reason``.

    Flat prices give back the base rate (0 when it has none); prices by rows or
    bytes give back 0.
    """
    failed = calls.where(F.col(status).isin(*REFUND_REASONS))
    return _with_refund(_priced(failed, spec, key), key, expressions, status).drop(
        "__amount", "__cap"
    )


def _with_refund(
    priced: DataFrame, key: str, expressions: Mapping[str, str] | None, status: str
) -> DataFrame:
    reasons = F.create_map(*[F.lit(x) for pair in REFUND_REASONS.items() for x in pair])
    base = _base(priced, key, expressions)
    payable = F.when(_finite(base) & (base >= 0), base)
    amount = F.when(F.col("unit").isin(*FLAT_UNITS), payable)
    return priced.withColumn("amount", F.coalesce(amount, F.lit(0.0))).withColumn(
        "reason", F.try_element_at(reasons, F.col(status))
    )


def ledger(
    calls: DataFrame,
    spec: DataFrame,
    expressions: Mapping[str, str] | None = None,
    key: str = "backend",
    rows: str = "n_rows",
    payload_bytes: str = "payload_bytes",
    status: str = "status",
) -> DataFrame:
    """Charges and refunds of a whole log in one pass.

    Adds ``kind`` (``charge`` or ``refund``), ``label`` (the unit or the refund
    reason), ``currency``, ``amount`` (null when refused) and ``refused_reason``.
    """
    known = calls.where(F.col(status).isin("success", *REFUND_REASONS))
    priced = _with_charge(_priced(known, spec, key), key, expressions, rows, payload_bytes)
    both = _with_refund(priced, key, expressions, status)
    charged = F.col(status) == "success"
    return both.select(
        *calls.columns,
        F.when(charged, F.lit("charge")).otherwise("refund").alias("kind"),
        F.when(charged, F.col("unit")).otherwise(F.col("reason")).alias("label"),
        "currency",
        F.when(charged, F.col("charge")).otherwise(F.col("amount")).alias("amount"),
        F.when(charged, F.col("refused_reason")).alias("refused_reason"),
    )


def micro_units(amount: Column | str) -> Column:
    """Millionths as a whole number, rounded per call; refused amounts count 0."""
    amount = as_column(amount)
    usable = _finite(amount) & (amount >= 0)
    return F.when(usable, F.round(amount * MICRO).cast("decimal(28,0)")).otherwise(0)


def totals(amounts: DataFrame, labels: Sequence[str], amount: str = "charge") -> DataFrame:
    """``calls`` and exact ``micro_units`` per label."""
    return amounts.groupBy(*labels).agg(
        F.count("*").alias("calls"), F.sum(micro_units(amount)).alias("micro_units")
    )


def audit_fields(spec: DataFrame, key: str = "backend") -> DataFrame:
    """``(key, fields)``: audit labels of every binding as a map."""
    have = set(spec.columns)

    def text(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    cap = parse_amount(text("max_per_call"))
    pairs = [
        ("db.driver", text("driver")),
        ("db.query_ref", F.col(key)),
        ("db.cost.unit", text("unit")),
        ("db.cost.currency", text("currency")),
        ("db.cost.source", F.coalesce(text("amount"), text("expression"))),
        ("db.cost.max_per_call", F.when(cap.isNotNull(), format_amount(cap))),
    ]
    every = F.create_map(*[c for name, value in pairs for c in (F.lit(name), value)])
    return spec.select(key, F.map_filter(every, lambda _, v: v.isNotNull()).alias("fields"))
