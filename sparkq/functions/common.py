"""Small pieces shared by the expression modules."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space in text jobs (Unicode White_Space),
# written as a regular-expression class body.
WHITE_SPACE = (
    r"\x09-\x0D\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

_SAFE_COLUMN = re.compile(r"[A-Za-z0-9_]+")
_SAFE_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")


def as_column(value: Column | str) -> Column:
    """A column from a column or its name."""
    return F.col(value) if isinstance(value, str) else value


def div(left: Column, right: int | Column) -> Column:
    """Whole-number division that truncates toward zero."""
    return F.call_function("div", left, F.lit(right))


def base64_text(binary: Column) -> Column:
    """Base64 on one line; Spark breaks the text every 76 characters."""
    return F.translate(F.base64(binary), "\r\n", "")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Branches of CASE expressions share no work, so an expensive value that
    several of them use would otherwise be computed again for each.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Timestamps keep their microseconds; instants are written in UTC.
_EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timeZone": "UTC",
}


def json_value(c: Column) -> Column:
    """One value as JSON text, null included."""
    text = F.to_json(F.array(c), _EXACT_TIMES)
    return F.substring(text, F.lit(2), F.length(text) - 2)


def require_column_name(name: str) -> str:
    """Return ``name`` when it may be used as a cursor column."""
    if not _SAFE_COLUMN.fullmatch(name):
        raise ValueError(f"'{name}' is not a safe column name (letters, digits, `_`)")
    return name


def require_identifier(name: str) -> str:
    """Return ``name`` when it may be spliced into SQL as an identifier."""
    if not _SAFE_IDENTIFIER.fullmatch(name):
        raise ValueError(f"'{name}' is not a safe SQL identifier")
    return name
