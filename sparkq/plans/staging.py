"""Staged intermediate tables in the folder the cluster shares.

Range partitioning samples its bounds, so two executions of the same plan may
place rows differently. An operator that reads such a layout twice writes it
once here and reads it back; a lost executor then costs a re-read, not a
different answer.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAGED: dict[str, list[str]] = {}
_SCOPE: ContextVar[list[str] | None] = ContextVar("staged_scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``, or its checkpoint
    folder. Where neither is set, a session without a cluster gets a new folder as its
    checkpoint folder; a cluster has to name one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    from_context = spark.sparkContext._jsc.sc().getCheckpointDir()
    if from_context.isDefined():
        return from_context.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sparkq-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    path = f"{shared_dir(spark)}/sparkq/{label}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is None:
        scope = _STAGED.setdefault(spark.sparkContext.applicationId, [])
    scope.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet and return a reader of the written rows."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


POSITION = "__position"


def settle(df: DataFrame, n: int | None = None) -> DataFrame:
    """Run ``df`` once and return its first ``n`` rows (all, if None) as written, with
    their place in ``POSITION``. What is read off them later is of one snapshot."""
    rows = df if n is None else df.limit(n)
    named = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    void = [f.name for f in named.schema if f.dataType.typeName() == "void"]
    named = named.withColumns({c: F.col(c).cast("string") for c in void})
    written = stage(named.withColumn(POSITION, F.monotonically_increasing_id()), "page")
    return written.toDF(*df.columns, POSITION)


def drop_staged(spark: SparkSession) -> int:
    """Delete what this application staged; returns the number of folders.

    Call it when results that read staged rows have been written out.
    """
    return _drop(spark, _STAGED.pop(spark.sparkContext.applicationId, []))


@contextmanager
def staged_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what this thread stages inside; results must be written by then."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _drop(spark, paths)


def _drop(spark: SparkSession, paths: Iterable[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        if path.getFileSystem(conf).delete(path, True):
            dropped += 1
    return dropped
