import pytest

from sparkq.sources import jdbc as J
from sparkq.sources.sinks import append, delete_rows, update_rows
from sparkq.sources.sqltext import spec_from_file


def test_urls():
    assert J.jdbc_url("postgres", "postgres://h/d?x=1") == "jdbc:postgresql://h/d?x=1"
    assert J.jdbc_url("postgres", "jdbc:postgresql://h/d") == "jdbc:postgresql://h/d"
    assert J.jdbc_url("mysql", "mariadb://h/d") == "jdbc:mysql://h/d"
    assert J.jdbc_url("mariadb", "mysql://h/d") == "jdbc:mysql://h/d"
    assert J.jdbc_url("sqlite", "sqlite:/data/x.db") == "jdbc:sqlite:/data/x.db"
    for driver, url in (("postgres", "mysql://h"), ("sqlite", "postgres://h"), ("mysql", "h/d"), ("oracle", "oracle://h")):
        with pytest.raises(ValueError):
            J.jdbc_url(driver, url)


def test_parallel_table_read():
    got = J.reader_options(
        J.JdbcTable("postgres", "postgres://h/d", table="app.orders", partition_column="id", lower_bound=0,
                    upper_bound=10**9, num_partitions=500, statement_timeout_ms=1500)
    )
    assert got["dbtable"] == "app.orders" and got["partitionColumn"] == "id" and got["numPartitions"] == "500"
    assert got["queryTimeout"] == "2" and got["fetchsize"] == "10000"


def test_query_reads():
    single = J.reader_options(J.JdbcTable("mysql", "mysql://h/d", query="SELECT 1;"))
    assert single["query"] == "SELECT 1" and single["sessionInitStatement"] == "SET NAMES utf8mb4"
    parallel = J.reader_options(
        J.JdbcTable("mysql", "mysql://h/d", query="SELECT * FROM t", partition_column="id", lower_bound=0,
                    upper_bound=9, num_partitions=3, properties={"user": "u"})
    )
    assert parallel["dbtable"] == "(SELECT * FROM t) AS q" and parallel["user"] == "u"


@pytest.mark.parametrize(
    "options",
    [
        {}, {"table": "t", "query": "SELECT 1"}, {"table": "t; DROP"}, {"query": "SELECT 1; SELECT 2"},
        {"query": "GRANT a TO b"}, {"table": "t", "partition_column": "id"},
        {"table": "t", "partition_column": "i d", "lower_bound": 0, "upper_bound": 1, "num_partitions": 2},
    ],
)
def test_bad_options(options):
    with pytest.raises(ValueError):
        J.reader_options(J.JdbcTable("postgres", "postgres://h/d", **options))


def test_sql_file(spark, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("-- one\nSELECT :a + 1 AS b;\n")
    spec = spec_from_file(spark, path.as_uri(), "q", params=("a",))
    from sparkq.operators.params import run_query

    assert run_query(spark, spec, {"a": 1}).first()["b"] == 2
    path.write_text("SELECT 1; SELECT 2")
    with pytest.raises(ValueError):
        spec_from_file(spark, path.as_uri(), "q")


def test_append_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append(spark.range(10), path) == 10
    assert append(spark.range(5).repartition(3), path) == 5
    assert append(spark.range(5).where("id < 0"), path) == 0
    assert spark.read.parquet(path).count() == 15


def test_update_and_delete(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "n int, s string")
    updated, n = update_rows(df, "s = 'a'", {"n": "n * 10"})
    assert rows(updated) == [(10, "a"), (2, None), (3, "b")] and n.first()[0] == 1
    assert updated.schema == df.schema
    kept, n = delete_rows(df, "s = 'a'")
    assert rows(kept) == [(2, None), (3, "b")] and n.first()[0] == 1
