"""Redaction and linting of text columns."""

from pyspark.sql import functions as F

from sparkq.functions.text import (
    is_multi_statement,
    is_privileged_ddl,
    is_safe_column_name,
    is_safe_identifier,
    leading_words,
    redact_credentials,
)
from sparkq.queries.registry import LOG_LINES_CTE, query
from sparkq.sources.views import log_lines, read

# The class body that the oracle's regular expressions use for white space.
_WS = (
    r"\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
_URL = rf"(^|[{_WS}])([A-Za-z][A-Za-z0-9+.\-]*://[^{_WS}/?#:]*:)[^{_WS}/?#]+@"


@query(
    f"""WITH {LOG_LINES_CTE}
       SELECT doc_id, regexp_replace(trim(regexp_replace(line, '[{_WS}]+', ' ', 'g')),
                                     '{_URL}', '\\1\\2***@', 'g') AS line FROM log_lines"""
)
def redact_log_lines(spark, sf_dir):
    return log_lines(spark, sf_dir).select("doc_id", redact_credentials("line").alias("line"))


@query(
    f"""WITH {LOG_LINES_CTE}
       SELECT doc_id, regexp_replace(line, '{_URL}', '\\1\\2***@', 'g') AS line FROM log_lines"""
)
def redact_keep_layout(spark, sf_dir):
    line = redact_credentials("line", collapse_white_space=False)
    return log_lines(spark, sf_dir).select("doc_id", line.alias("line"))


# One statement per customer: sixteen forms, with the customer's own values in them.
STATEMENTS = r"""SELECT c_custkey, c_mktsegment AS word, CASE c_custkey % 16
    WHEN 0 THEN concat('SELECT ', CAST(c_custkey AS STRING), ';')
    WHEN 1 THEN concat('SELECT 1; DROP TABLE t', CAST(c_custkey AS STRING))
    WHEN 2 THEN concat('SELECT ''', c_name, '; x''')
    WHEN 3 THEN concat('GRANT ALL ON t TO u', CAST(c_custkey AS STRING))
    WHEN 4 THEN concat('  create', chr(9), 'user u', CAST(c_custkey AS STRING))
    WHEN 5 THEN concat('-- ', c_name, chr(10), 'GRANT x TO y')
    WHEN 6 THEN concat('/* ', c_name, ' */ revoke x from y')
    WHEN 7 THEN concat('/* a */ 1 /* ', c_name, ' */ GRANT x')
    WHEN 8 THEN concat('CREATE TABLE t', CAST(c_custkey AS STRING), ' (a int)')
    WHEN 9 THEN concat('DROP /* ', c_name, ' */ ROLE r')
    WHEN 10 THEN concat('ALTER DATABASE d', CAST(c_custkey AS STRING), '; ;')
    WHEN 11 THEN concat('SELECT "a;b", ''', c_name, ''';', chr(10), ' ')
    WHEN 12 THEN concat('drop index i', CAST(c_custkey AS STRING), ';;')
    WHEN 13 THEN concat('SELECT ''unclosed ; ', c_name)
    WHEN 14 THEN concat('-- GRANT ', c_name)
    ELSE c_name END AS sql FROM {customer}"""

_SKIP = rf"(?:[{_WS}]+|--[^\n]*\n|/\*[^*]*\*+(?:[^/*][^*]*\*+)*/)*"
_WORDS = rf"^{_SKIP}([A-Za-z_]+){_SKIP}([A-Za-z_]*)"


@query(
    rf"""WITH s AS ({STATEMENTS.format(customer="customer")}),
       w AS (SELECT *, upper(regexp_extract(sql, '{_WORDS}', 1)) AS first_word,
                    upper(regexp_extract(sql, '{_WORDS}', 2)) AS second_word FROM s)
       SELECT c_custkey, first_word, second_word,
              regexp_matches(regexp_replace(sql, '''[^'']*(''|\z)|"[^"]*("|\z)', '', 'g'),
                             ';[{_WS}]*[^{_WS}]') AS multi,
              first_word IN ('GRANT', 'REVOKE') OR (first_word IN ('CREATE', 'ALTER', 'DROP')
                AND second_word IN ('USER', 'ROLE', 'DATABASE', 'GROUP')) AS privileged,
              regexp_matches(sql, '^[A-Za-z_][A-Za-z0-9_.]*\z') AS identifier,
              regexp_matches(word, '^[A-Za-z0-9_]+\z') AS column_name
       FROM w"""
)
def sql_lint(spark, sf_dir):
    statements = spark.sql(STATEMENTS, customer=read(spark, sf_dir, "customer"))
    words = leading_words("sql")
    return statements.select(
        "c_custkey",
        words["first"].alias("first_word"),
        words["second"].alias("second_word"),
        is_multi_statement("sql").alias("multi"),
        is_privileged_ddl("sql").alias("privileged"),
        is_safe_identifier("sql").alias("identifier"),
        is_safe_column_name(F.col("word")).alias("column_name"),
    )
