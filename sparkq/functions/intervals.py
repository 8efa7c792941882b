"""ISO-8601 durations from (months, days, microseconds)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkq.functions.common import as_column, div


def interval_iso8601(months: Column | str, days: Column | str, micros: Column | str) -> Column:
    """Text such as ``P1Y2M3DT4H5M6.5S``; null when any part is null.

    Zero parts are left out and zero as a whole is ``PT0S``. Hours never roll
    into days. A leading ``-`` appears when no part is positive; parts of mixed
    sign are written as absolute values without a sign.
    """
    m, d, us = (as_column(c).cast("bigint") for c in (months, days, micros))
    zero = F.lit(0).cast("bigint")
    # Divide before taking absolute values: the smallest bigint has no negative.
    months_abs, days_abs = F.abs(m), F.abs(d)
    secs, frac = F.abs(div(us, 1_000_000)), F.abs(us % 1_000_000)

    def part(value: Column, unit: str) -> Column:
        return F.when(value != 0, F.concat(value.cast("string"), F.lit(unit))).otherwise("")

    digits = F.rtrim(F.lpad(frac.cast("string"), 6, "0"), F.lit("0"))
    whole = (secs % 60).cast("string")
    seconds = (
        F.when(frac != 0, F.concat(whole, F.lit("."), digits, F.lit("S")))
        .when(secs % 60 != 0, F.concat(whole, F.lit("S")))
        .otherwise("")
    )
    clock = F.when(
        us != 0,
        F.concat(
            F.lit("T"), part(div(secs, 3600), "H"), part(div(secs, 60) % 60, "M"), seconds
        ),
    ).otherwise("")
    sign = F.when((m <= 0) & (d <= 0) & (us <= 0), F.lit("-")).otherwise("")
    text = F.concat(
        sign,
        F.lit("P"),
        part(div(months_abs, 12), "Y"),
        part(months_abs % 12, "M"),
        part(days_abs, "D"),
        clock,
    )
    known = m.isNotNull() & d.isNotNull() & us.isNotNull()
    return F.when((m == zero) & (d == zero) & (us == zero), F.lit("PT0S")).when(known, text)
