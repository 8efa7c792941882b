"""Text jobs over whole columns: redaction and linting of SQL text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkq.functions.common import WHITE_SPACE, as_column, bound

# Statements that administer users or rights.
PRIVILEGED_FIRST = ("GRANT", "REVOKE")
SCHEMA_VERBS = ("CREATE", "ALTER", "DROP")
PRIVILEGED_OBJECTS = ("USER", "ROLE", "DATABASE", "GROUP")

# scheme://user:password@; the password ends at the last @ of the authority. Texts are cut
# at ://, so that only the last word before each cut and the beginning behind it are
# matched. Runs are tried from their start only, so each is read once, however long.
_SCHEME_WORD = rf"(?<![^{WHITE_SPACE}])[A-Za-z][A-Za-z0-9+.\-]*+\z"
_SCHEME_RUN = r"(?<![A-Za-z0-9+.\-])[0-9+.\-]*+[A-Za-z][A-Za-z0-9+.\-]*+\z"
_SECRET = rf"^([^{WHITE_SPACE}/?#:]*+:)[^{WHITE_SPACE}/?#]+@"
# White space beyond ASCII (tested against a wide range first, which is cheap),
# and ASCII white space that is not one plain space already.
_WIDE_SPACE = (
    r"[\x85\xA0\u1680\u2000-\u3000&&[\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]]"
)
_UNEVEN_SPACE = r"[\t-\r][\t-\r ]*+| [\t-\r ]++"
_QUOTED = r"""'[^']*('|\z)|"[^"]*("|\z)"""
_SECOND_STATEMENT = rf";[{WHITE_SPACE}]*[^{WHITE_SPACE}]"
# White space, a line comment, or a block comment that ends at its first */.
_SKIP = rf"(?:[{WHITE_SPACE}]+|--[^\n]*\n|/\*[^*]*\*+(?:[^/*][^*]*\*+)*/)*"
_LEADING_WORDS = rf"^{_SKIP}([A-Za-z_]+){_SKIP}([A-Za-z_]*)"


def redact_credentials(
    c: Column | str, collapse_white_space: bool = True, anywhere: bool = False
) -> Column:
    """Replace the password of ``scheme://user:password@host`` with ``***``.

    URLs are recognised at the start of a word (``anywhere`` also finds them
    after other characters). Runs of white space become one space unless
    ``collapse_white_space`` is off.
    """
    c = as_column(c)
    if collapse_white_space:
        ascii_only = F.length(c) == F.octet_length(c)
        plain = F.when(ascii_only, c).otherwise(F.regexp_replace(c, _WIDE_SPACE, " "))
        c = F.trim(F.regexp_replace(plain, _UNEVEN_SPACE, " "))
    def joined(parts: Column) -> Column:
        def hidden(part: Column, i: Column) -> Column:
            # Behind a cut a word began before the cut, unless there is white space.
            last = F.concat(F.when(i > 1, "/").otherwise(""), F.get(parts, i - 1))
            word = F.substring_index(last, " ", -1)
            named = (i > 0) & part.contains("@") & word.rlike(_SCHEME_RUN if anywhere else _SCHEME_WORD)
            return F.when(named, F.regexp_replace(part, _SECRET, "$1***@")).otherwise(part)

        return F.array_join(F.transform(parts, hidden), "://")

    return F.when(c.contains("://"), bound(F.split(c, "://", -1), joined)).otherwise(c)


def is_multi_statement(sql: Column | str) -> Column:
    """True when more than one statement stands outside quotes.

    A single trailing ``;`` is fine.
    """
    bare = F.regexp_replace(as_column(sql), _QUOTED, "")
    return bare.rlike(_SECOND_STATEMENT)


def leading_words(sql: Column | str) -> Column:
    """``struct<first,second>``: the first two words after comments, upper case."""
    sql = as_column(sql)
    return F.struct(
        F.upper(F.regexp_extract(sql, _LEADING_WORDS, 1)).alias("first"),
        F.upper(F.regexp_extract(sql, _LEADING_WORDS, 2)).alias("second"),
    )


def is_privileged_ddl(sql: Column | str) -> Column:
    """True for statements that manage users, roles, databases or grants."""
    words = leading_words(sql)
    return words["first"].isin(*PRIVILEGED_FIRST) | (
        words["first"].isin(*SCHEMA_VERBS) & words["second"].isin(*PRIVILEGED_OBJECTS)
    )


def is_safe_identifier(c: Column | str) -> Column:
    """Letters, digits, ``_`` and ``.``, not starting with a digit or dot."""
    return as_column(c).rlike(r"^[A-Za-z_][A-Za-z0-9_.]*\z")


def is_safe_column_name(c: Column | str) -> Column:
    """Letters, digits and ``_`` only."""
    return as_column(c).rlike(r"^[A-Za-z0-9_]+\z")


def _python_pattern(pattern: str) -> re.Pattern[str]:
    widened = re.sub(r"\\x\{([0-9A-F]+)\}", r"\\u\1", pattern).replace(r"\z", r"\Z")
    return re.compile(widened)


def check_statement(sql: str) -> str:
    """Guard for one statement given in code; returns it or raises ValueError."""
    bare = _python_pattern(_QUOTED).sub("", sql)
    if _python_pattern(_SECOND_STATEMENT).search(bare):
        raise ValueError("the SQL text holds more than one statement")
    words = _python_pattern(_LEADING_WORDS).match(sql)
    if words:
        first, second = words.group(1).upper(), words.group(2).upper()
        if first in PRIVILEGED_FIRST or (
            first in SCHEMA_VERBS and second in PRIVILEGED_OBJECTS
        ):
            raise ValueError(f"privileged statement refused: {first} {second}".rstrip())
    return sql
