"""Reading database tables and queries through Spark's JDBC source."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from sparkq.functions.common import require_identifier
from sparkq.functions.text import check_statement

# Accepted URL schemes and JDBC spelling per driver.
SCHEMES = {
    "postgres": ("postgres", "postgresql"),
    "mysql": ("mysql", "mariadb"),
    "mariadb": ("mysql", "mariadb"),
    "sqlite": ("sqlite",),
}
JDBC_SCHEMES = {
    "postgres": "postgresql",
    "mysql": "mysql",
    "mariadb": "mysql",
    "sqlite": "sqlite",
}
SESSION_INIT = {"mysql": "SET NAMES utf8mb4", "mariadb": "SET NAMES utf8mb4"}


@dataclass(frozen=True)
class JdbcTable:
    """One table or query of a database.

    Give ``partition_column`` with its bounds and a count to read in parallel;
    rows outside the bounds are read too, by the first and last task. Without it
    everything comes through one task.
    """

    driver: str
    url: str
    table: str | None = None
    query: str | None = None
    partition_column: str | None = None
    lower_bound: Any = None
    upper_bound: Any = None
    num_partitions: int | None = None
    fetch_size: int = 10_000
    statement_timeout_ms: int | None = None
    properties: dict[str, str] = field(default_factory=dict)


def jdbc_url(driver: str, url: str) -> str:
    """The JDBC spelling of a database URL; its scheme must suit the driver."""
    if driver not in SCHEMES:
        raise ValueError(f"unknown driver {driver!r}; one of {sorted(SCHEMES)}")
    bare = url.removeprefix("jdbc:")
    scheme, colon, rest = bare.partition(":")
    if not colon or scheme.lower() not in SCHEMES[driver]:
        raise ValueError(f"driver {driver!r} needs a URL scheme of {SCHEMES[driver]}")
    if driver == "sqlite":
        # sqlite://rel.db and sqlite:///abs.db: what follows the slashes is the file.
        return f"jdbc:sqlite:{rest.removeprefix('//')}"
    return f"jdbc:{JDBC_SCHEMES[driver]}:{_AUTHORITY.sub('//', rest, count=1)}"


_AUTHORITY = re.compile(r"^//([^/?#]*)@")


def url_credentials(url: str) -> dict[str, str]:
    """User and password written in a database URL, percent-decoded; the JDBC driver
    takes them as options only."""
    found = _AUTHORITY.match(url.removeprefix("jdbc:").partition(":")[2])
    if not found:
        return {}
    user, colon, password = found.group(1).partition(":")
    given = {"user": unquote(user)} if user else {}
    return given | ({"password": unquote(password)} if colon else {})


def reader_options(spec: JdbcTable) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``."""
    if (spec.table is None) == (spec.query is None):
        raise ValueError("give either a table or a query")
    options = {"url": jdbc_url(spec.driver, spec.url), "fetchsize": str(spec.fetch_size)}
    if spec.driver != "sqlite":
        options |= url_credentials(spec.url)
    if spec.query is not None:
        check_statement(spec.query)
        text = spec.query.strip().removesuffix(";")
        # Partitioned reads take a table; a query becomes a derived one.
        if spec.partition_column:
            options["dbtable"] = f"({text}) AS q"
        else:
            options["query"] = text
    else:
        options["dbtable"] = require_identifier(spec.table)
    if spec.partition_column:
        if None in (spec.lower_bound, spec.upper_bound, spec.num_partitions):
            raise ValueError("a partition column needs both bounds and a partition count")
        options["partitionColumn"] = require_identifier(spec.partition_column)
        options["lowerBound"] = str(spec.lower_bound)
        options["upperBound"] = str(spec.upper_bound)
        options["numPartitions"] = str(spec.num_partitions)
    if spec.statement_timeout_ms is not None:
        options["queryTimeout"] = str(math.ceil(spec.statement_timeout_ms / 1000))
    if spec.driver in SESSION_INIT:
        options["sessionInitStatement"] = SESSION_INIT[spec.driver]
    return {**options, **spec.properties}


def read_table(spark: SparkSession, spec: JdbcTable) -> DataFrame:
    """A lazy DataFrame; Spark pushes filters, columns and limits to the database.

    The driver's JDBC jar must be on the class path.
    """
    return spark.read.format("jdbc").options(**reader_options(spec)).load()
