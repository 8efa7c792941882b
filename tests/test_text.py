import pytest

from sparkq.functions import text as X

REDACT = {
    "postgres://u:hunter2@h/d": "postgres://u:***@h/d",
    "postgres://u@h/d": "postgres://u@h/d",
    "mysql://u:@h/d": "mysql://u:@h/d",
    "not a url": "not a url",
    "sqlite:///tmp/x.db": "sqlite:///tmp/x.db",
    "failed to connect to postgres://u:pw@h:5432/d: timed out": "failed to connect to postgres://u:***@h:5432/d: timed out",
    "see postgres://u:pw@h/d.": "see postgres://u:***@h/d.",
    "a postgres://u:p@w@h/d, b mysql://x:y@z/d;": "a postgres://u:***@h/d, b mysql://x:***@z/d;",
    "postgres://u:***@h/d": "postgres://u:***@h/d",
    "x\u2003\u00a0y\u3000 z\u200bw": "x y z\u200bw",
    "à postgres://u:p@h/d\u2009b": "à postgres://u:***@h/d b",
    "://u:p@h 1a://u:p@h a1+.-b://u:p@h": "://u:p@h 1a://u:p@h a1+.-b://u:***@h",
    "http://a:b@c/http://d:e@f": "http://a:***@c/http://d:e@f",
    "": "",
    None: None,
}


def test_redaction(spark):
    df = spark.createDataFrame([(k,) for k in REDACT], "t string")
    assert {r[0]: r[1] for r in df.select("t", X.redact_credentials("t")).collect()} == REDACT


def test_white_space(spark):
    df = spark.createDataFrame([("a \t\n b  c  http://u:p@h",)], "t string")
    kept = X.redact_credentials("t", collapse_white_space=False)
    assert df.select(X.redact_credentials("t")).first()[0] == "a b c http://u:***@h"
    assert df.select(kept).first()[0] == "a \t\n b  c  http://u:***@h"


def test_url_inside_a_word(spark):
    df = spark.createDataFrame([("(url=postgres://u:p@h/d)",)], "t string")
    assert df.select(X.redact_credentials("t")).first()[0] == "(url=postgres://u:p@h/d)"
    assert df.select(X.redact_credentials("t", anywhere=True)).first()[0] == "(url=postgres://u:***@h/d)"


MULTI = {
    "SELECT 1": False, "SELECT 1;": False, "SELECT 1; \n ": False, "SELECT 1; SELECT 2": True, "SELECT 1;;": True,
    "SELECT ';' AS s": False, 'SELECT "a;b" AS s;': False, "SELECT ';'; DROP TABLE t": True,
    "SELECT 'it''s; fine'": False, "SELECT 'open ; x": False, "": False, ";": False, "'\"' ; x": True,
    "SELECT 1; ": False,
}
PRIVILEGED = {
    "GRANT ALL ON t TO PUBLIC": True, "  revoke x from y": True, "create user u": True, "ALTER ROLE r": True,
    "DROP DATABASE d": True, "create\n\tgroup g": True, "-- x\nGRANT a TO b": True, "/* c */ GRANT a": True,
    "/* a */ -- b\n /* c */DROP/* d */ROLE r": True, "CREATE TABLE t (a int)": False, "DROP INDEX i": False,
    "ALTER TABLE t ADD user int": False, "SELECT 'GRANT'": False, "-- GRANT x": False, "/* GRANT": False,
    "/* a */ 1 /* b */ GRANT x": False, "GRANTED x": False, "CREATE USERS u": False, "GRANT1": True, "": False,
    "SELECT * FROM grant_log": False, "/** x **/ GRANT a": True, "create or replace view v": False,
}


@pytest.mark.parametrize("rule,cases", [(X.is_multi_statement, MULTI), (X.is_privileged_ddl, PRIVILEGED)])
def test_lint_rules(spark, rule, cases):
    df = spark.createDataFrame([(k,) for k in cases], "sql string")
    assert {r[0]: r[1] for r in df.select("sql", rule("sql")).collect()} == cases


@pytest.mark.parametrize("sql", [*MULTI, *PRIVILEGED])
def test_guard_in_code_agrees_with_the_columns(sql):
    bad = MULTI.get(sql, False) or PRIVILEGED.get(sql, False)
    if bad:
        with pytest.raises(ValueError):
            X.check_statement(sql)
    else:
        assert X.check_statement(sql) == sql


def test_identifiers(spark):
    names = {"app.current_tenant": True, "_x": True, "a1": True, "1a": False, ".a": False, "a b": False, "a;": False,
             "a\n": False, "": False, "é": False}
    df = spark.createDataFrame([(k,) for k in names], "n string")
    assert {r[0]: r[1] for r in df.select("n", X.is_safe_identifier("n")).collect()} == names
    columns = {"id": True, "1a": True, "a.b": False, "": False, "a-b": False}
    df = spark.createDataFrame([(k,) for k in columns], "n string")
    assert {r[0]: r[1] for r in df.select("n", X.is_safe_column_name("n")).collect()} == columns


REDACTED = {
    "postgres://u:p@h": ("postgres://u:***@h", "postgres://u:***@h"),
    "xpostgres://u:p@h a://b:c@d://e:f@g": ("xpostgres://u:***@h a://b:***@d://e:f@g", "xpostgres://u:***@h a://b:***@d://e:***@g"),
    "(a://u:p@h)": ("(a://u:p@h)", "(a://u:***@h)"),
    "9a://u:p@h 9://u:p@h +a://u:p@h": ("9a://u:p@h 9://u:p@h +a://u:p@h", "9a://u:***@h 9://u:p@h +a://u:***@h"),
    "://u:p@h a://u@h a://u:@h a://:p@h a://u:p@q@h": (
        "://u:p@h a://u@h a://u:@h a://:***@h a://u:***@h", "://u:p@h a://u@h a://u:@h a://:***@h a://u:***@h"
    ),
    "a://u:p/x@h b\u2003c://u:p@h": ("a://u:p/x@h b c://u:***@h", "a://u:p/x@h b c://u:***@h"),
    "a://b://u:p@h a://u:p#@h": ("a://b://u:p@h a://u:p#@h", "a://b://u:***@h a://u:p#@h"),
}


def test_redaction_at_cuts(spark):
    df = spark.createDataFrame([(t,) for t in REDACTED], "t string")
    got = df.select("t", X.redact_credentials("t").alias("w"), X.redact_credentials("t", anywhere=True).alias("a")).collect()
    assert {r.t: (r.w, r.a) for r in got} == REDACTED


def test_redaction_of_long_runs_is_linear(spark):
    """Runs of scheme characters without an end in sight, many cuts, long passwords."""
    texts = ["a" * 400_000 + "!://u:p@h", "a://" * 50_000, "a://u:" + "p" * 400_000, " a://u:p@h" * 20_000, "x" * 300_000 + "://u:" + "p" * 300_000 + "@h"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.t for r in df.select("i", X.redact_credentials("t", anywhere=True).alias("t")).collect()}
    assert got[0] == texts[0] and got[1] == texts[1] and got[2] == texts[2]
    assert got[3] == (" a://u:***@h" * 20_000).strip() and got[4].endswith("://u:***@h")
