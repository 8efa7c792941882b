"""Parameterised queries and change tracking as Spark DataFrame operators.

Sub-packages:

* ``sources``    tables in (parquet views, JDBC, ``.sql`` files) and out
* ``functions``  column expressions (JVM side, no Python per row)
* ``plans``      helpers that keep plans sound at scale: size-checked broadcast,
                 staging in the shared folder, ordered scans without hot groups
* ``operators``  DataFrame -> DataFrame operators
* ``streaming``  Structured Streaming forms of the stateful operators
* ``queries``    the registered queries with their oracle SQL
"""
