"""Operators with a value of state for each key, kept in Spark's state store.

The store is RocksDB below the query's checkpoint: a micro-batch reads and writes the
state of the keys it meets and no other, and a query that is started again goes on
where the last committed batch ended.

Rows of a key are taken in order inside a micro-batch, and micro-batches in arrival
order. The rows themselves stay in Spark, where a key with very many of them fills many
tasks. What meets the state is a summary for each run of a key's rows in a range of the
micro-batch, so that Python neither holds nor loops over rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sparkq.plans.ordered import hashable
from sparkq.plans.staging import staged_scope

# State in RocksDB, committed as changes instead of snapshots, all of a join in one store.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The settings of ``STATE_STORE`` for a query that is started inside; a running query
    keeps the settings it was started with, and the session gets back its own."""
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def in_order(names: Sequence[str]) -> Callable[[Row], tuple]:
    """A sort key over columns, nulls first as in Spark."""

    def key(row: Row) -> tuple:
        return tuple((row[n] is not None, row[n]) for n in names)

    return key


# Columns that ``with_carries`` adds to rows and carries, and how rows are ordered by them.
CARRY, TIE = "__carry", "__tie"


@dataclass(frozen=True)
class Fold:
    """What a fold over ordered rows has to know of a run of them, and its state.

    ``value`` is what it reads of a row. ``summarise`` gets the values of some runs one
    after the other and where each starts, and gives the columns of ``summary`` (DDL), one
    entry for each run. ``merge`` takes the state (None at first) over the next run.
    """

    value: Column
    summarise: Callable[[pa.Array, pa.Array], Sequence[pa.Array]]
    summary: str
    merge: Callable[[tuple | None, Row], tuple]
    state: str


def differ(left: pa.Array, right: pa.Array) -> pa.Array:
    """Where two columns differ; nulls are equal, and so are NaNs, as in Spark."""
    if pa.types.is_nested(left.type):
        return pa.array([a != b for a, b in zip(left.to_pylist(), right.to_pylist())], pa.bool_())
    other = pc.fill_null(pc.not_equal(left, right), False)
    if pa.types.is_floating(left.type):
        both = pc.and_(pc.is_nan(left), pc.is_nan(right))
        other = pc.and_(other, pc.invert(pc.fill_null(both, False)))
    return pc.or_(other, pc.xor(pc.is_null(left), pc.is_null(right)))


def _sortable(name: str, kind: T.DataType) -> list[Column]:
    """Columns that Arrow sorts as Spark does ``name``: nulls first, NaN last."""
    if isinstance(kind, T.BooleanType):
        return [F.col(name).cast("int")]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [F.isnan(name).cast("int"), F.col(name)]
    return [F.col(name)]


def _runs(
    summarise: Callable[[pa.Array, pa.Array], Sequence[pa.Array]], keys: int, orders: int, names: Sequence[str]
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The runs of one range of rows: key, first place, summary."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A range holds the columns of key, order and value only.
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        by = [(c, "ascending") for c in rows.column_names[: keys + orders]]
        rows = rows.take(pc.sort_indices(rows, sort_keys=by, null_placement="at_start")).combine_chunks()
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in rows.columns]
        new = pa.array([False] * (len(rows) - 1), pa.bool_())
        for c in columns[:keys]:
            new = pc.or_(new, differ(c[:-1], c[1:]))
        starts = pc.indices_nonzero(pa.concat_arrays([pa.array([True]), new]))
        summary = summarise(columns[-1], starts)
        yield pa.RecordBatch.from_arrays([*[c.take(starts) for c in columns[: keys + orders]], *summary], names)

    return run


@dataclass
class Carried(StatefulProcessor):
    """Hands out the state that each key has before a micro-batch, and takes it over the
    runs of the micro-batch."""

    merge: Callable[[tuple | None, Row], tuple]
    order: Sequence[str]
    schema: T.StructType
    names: Sequence[str]
    ttl_ms: int | None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = Row(*self.names)
        self.value = handle.getValueState("value", self.schema, self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = state = tuple(self.value.get()) if self.value.exists() else None
        for run in sorted(rows, key=in_order(self.order)):
            state = self.merge(state, run)
        if before is not None:
            yield self.row(*key, *before)
        if state != before:
            self.value.update(state)

    def close(self) -> None:
        pass


@dataclass
class First(StatefulProcessor):
    """Each key once, until its mark is dropped."""

    ttl_ms: int | None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        if self.seen.exists():
            return
        yield Row(*key)
        self.seen.update((True,))

    def close(self) -> None:
        pass


def with_state(
    stream: DataFrame, key: Sequence[str], processor: StatefulProcessor, schema: T.StructType, ttl_ms: int | None
) -> DataFrame:
    """Rows of ``processor``, applied to each key of an append-only stream. The query has
    to be started with ``STATE_STORE``, as ``write_parquet`` does."""
    return stream.groupBy(*key).transformWithState(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )


def with_carries(
    stream: DataFrame, key: Sequence[str], order: Sequence[str], fold: Fold, ttl_ms: int | None = None
) -> DataFrame:
    """The rows of an append-only stream and, for each key of a micro-batch that has
    state, a row with the state before it.

    Rows have ``TIE``, by which equal places in ``order`` are told apart, and no state;
    carries (``CARRY`` is true) have their key and the columns of ``fold.state``, named
    ``__s0`` and so on. ``order`` has plain columns. With ``ttl_ms`` a key's state is
    dropped so long after its last change.
    """
    told_apart = [F.col(f.name) for f in stream.schema if hashable(f.dataType)]
    tied = stream.withColumn(TIE, F.xxhash64(*told_apart))
    kinds = {f.name: f.dataType for f in stream.schema}
    places = [c for name in order for c in _sortable(name, kinds[name])] + [F.col(TIE)]
    slim = tied.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)],
        *[c.alias(f"__o{i}") for i, c in enumerate(places)],
        fold.value.alias("__value"),
    )
    by = slim.columns[:-1]
    summary = T.StructType.fromDDL(fold.summary)
    found = T.StructType([*[slim.schema[c] for c in by], *summary.fields])
    runs = slim.repartitionByRange(*by).mapInArrow(_runs(fold.summarise, len(key), len(places), found.names), found)
    state = T.StructType([T.StructField(f"__s{i}", f.dataType) for i, f in enumerate(T.StructType.fromDDL(fold.state))])
    schema = T.StructType([*[T.StructField(k, kinds[k]) for k in key], *state.fields])
    processor = Carried(fold.merge, by[len(key) :], state, schema.names, ttl_ms)
    carries = with_state(runs, by[: len(key)], processor, schema, ttl_ms)
    return tied.withColumn(CARRY, F.lit(False)).unionByName(
        carries.withColumn(CARRY, F.lit(True)), allowMissingColumns=True
    )


def marked_first(stream: DataFrame, key: Sequence[str], mark: str, ttl_ms: int | None = None) -> DataFrame:
    """The rows of a stream and, for each key that a micro-batch is the first to meet, a
    row with the key and ``mark``. With ``ttl_ms`` a key is forgotten so long after it
    was met, in Python; without, Spark's own de-duplication keeps the keys."""
    keys = stream.select(*key)
    if ttl_ms is None:
        new = keys.dropDuplicates()
    else:
        new = with_state(keys, key, First(ttl_ms), keys.schema, ttl_ms)
    return stream.withColumn(mark, F.lit(False)).unionByName(
        new.withColumn(mark, F.lit(True)), allowMissingColumns=True
    )


def write_parquet(
    stream: DataFrame, out: str, work: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Append a stream to the parquet table ``out``, exactly once, with its state in
    RocksDB; ``work`` is the folder of its checkpoint and must be one the cluster shares."""
    with state_store(stream.sparkSession):
        return (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", out)
            .option("checkpointLocation", f"{work}/checkpoint")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def write_batches(
    stream: DataFrame,
    run: Callable[[DataFrame], DataFrame],
    out: str,
    work: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Write ``run`` of every micro-batch below ``out``, with the stream's state in RocksDB.

    A micro-batch has a folder of its own (``batch_id``), which it overwrites when it is
    run again. What ``run`` stages is dropped when the folder is written; ``run`` has to
    read its argument once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with staged_scope(batch.sparkSession):
            run(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with state_store(stream.sparkSession):
        return (
            stream.writeStream.foreachBatch(write)
            .outputMode("append")
            .option("checkpointLocation", f"{work}/checkpoint")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
