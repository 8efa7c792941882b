"""Values of Spark and DuckDB results in one comparable form."""

import math
from datetime import date, datetime
from decimal import Decimal


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) and abs(value) < 2**53 else round(value, 6)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def table(names, rows):
    """Column names in order, and sorted rows with columns in that order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    body = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(body, key=repr)


def oracle(sf_dir, names):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in names:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection
