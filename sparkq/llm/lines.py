"""Substring deduplication by hashing lines and the sentences in them.

A unit is a stretch of a line that begins with the line or with a sentence of at
least ``MIN_WORDS`` words; shorter sentences belong to the unit before them. So a
passage that somebody put into the middle of a line falls into the same units as
elsewhere, apart from the sentence it is glued to. Units are normalised (lower case,
white space collapsed, outer punctuation dropped) and hashed. Of equal units in all
documents the earliest ranked occurrence stays, by (doc_id, offset); the others are
removed, with their offsets in the original text retained. Units of fewer than
``MIN_WORDS`` words are left alone.

A null doc_id ranks first. Rows that agree in doc_id and text are one document and
get the same answer. Null texts have no units and stay null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.llm.common import HOT_KEYS
from sparkq.plans.staging import stage

MIN_WORDS = 5
# White space of words, as in the other operators: ASCII only.
_W, _B = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
_INNER = r"(?:[^\x20\x09-\x0D]*[^\x20\x09-\x0D.!?])"
# Where a unit begins: behind a line break, or behind the end of a sentence if the
# next sentence has MIN_WORDS words (none of the words before the last ends it).
_CUT = re.compile(
    rf"(?<=\n)|(?<=[.!?]\x20)(?=(?:{_INNER}[\x20\t]+){{{MIN_WORDS - 1}}}{_W})"
)
_BLANKS = " \t\n\x0b\x0c\r"
_EDGE = ".,;:!?\"'()[]"


def cut(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the units of a text; together they are the whole text."""
    at = 0
    for mark in _CUT.finditer(text):
        if mark.start() > at:
            yield at, mark.start()
            at = mark.start()
    if at < len(text):
        yield at, len(text)


def normalise(unit: str) -> bytes:
    words = unit.lower().encode("utf-8", "surrogatepass").split()
    return b" ".join(words).strip(_EDGE.encode())


UNITS = "doc_id {}, key long, start int, end int, n_words int, digest binary"


def units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per unit of at least MIN_WORDS words; ``key`` is a hash of the text. Ids
    keep their type."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            kind = batch.column(0).type
            out: list[list] = [[], [], [], [], [], []]
            for i, key, whole in zip(*(c.to_pylist() for c in batch.columns)):
                for start, end in cut(whole):
                    unit = normalise(whole[start:end])
                    n = unit.count(b" ") + 1
                    if n >= MIN_WORDS:
                        for column, value in zip(out, (i, key, start, end, n, digest(unit))):
                            column.append(value)
                if len(out[0]) > 200_000:
                    yield _batch(out, kind)
                    out = [[], [], [], [], [], []]
            yield _batch(out, kind)

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("text")
    )
    schema = UNITS.format(rows.schema["doc_id"].dataType.simpleString())
    return rows.where("text IS NOT NULL").mapInArrow(find, schema)


def _batch(out: list[list], id_kind: pa.DataType) -> pa.RecordBatch:
    kinds = (id_kind, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    names = ("doc_id", "key", "start", "end", "n_words", "digest")
    return pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], list(names))


def repeated_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The units to remove: doc_id, key, start, end, n_words, digest, and where the
    kept occurrence is (first_doc_id, first_start)."""
    found = stage(units(docs, doc_id, text), "units")
    rank = F.struct("doc_id", "key", "start")
    firsts = stage(
        found.groupBy("digest")
        .agg(F.min(rank).alias("first"), F.max(rank).alias("last"), F.count(F.lit(1)).alias("n"))
        .where(F.col("first") != F.col("last"))
        .drop("last"),
        "repeated",
    )
    # Passages that very many documents share are few: fewer than HOT_KEYS digests
    # have more than that share of all units. They go to every task instead.
    limit = found.count() // HOT_KEYS
    hot = F.broadcast(firsts.where(F.col("n") > limit))
    by_copy = found.join(hot, "digest")
    by_digest = found.join(hot.select("digest"), "digest", "left_anti").join(
        firsts.where(F.col("n") <= limit), "digest"
    )
    return (
        by_copy.unionByName(by_digest)
        .where(~F.struct("doc_id", "key", "start").eqNullSafe(F.col("first")))
        .select(
            "doc_id",
            "key",
            "start",
            "end",
            "n_words",
            "digest",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first.start").alias("first_start"),
        )
    )


def without(text: Column, spans: Column) -> Column:
    """``text`` less the sorted, disjoint ``spans`` (array of start, end in characters)."""

    @F.arrow_udf("string")
    def rest(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for whole, removed in texts:
            out = []
            for t, gone in zip(whole.to_pylist(), removed.to_pylist()):
                if t is None or not gone:
                    out.append(t)
                    continue
                at, parts = 0, []
                for span in gone:
                    parts.append(t[at : span["start"]])
                    at = span["end"]
                parts.append(t[at:])
                out.append("".join(parts))
            yield pa.array(out, pa.string())

    return rest(text, spans)


def remove_repeated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", removed: str | None = "removed"
) -> DataFrame:
    """``docs`` with repeated units taken out of ``text``, and in the column ``removed``
    (start, end of each in the original text; null if there are none). A column of that
    name is replaced; with None there is no such column and all others stay. Documents
    stay, also those of which nothing is left."""
    spans = (
        repeated_units(docs, doc_id, text)
        .select("doc_id", "key", F.struct("start", "end").alias("span"))
        # Repeated rows of one document find the same units.
        .dropDuplicates(["doc_id", "key", "span"])
        .groupBy(F.col("doc_id").alias("id"), F.col("key").alias("of"))
        # The units of one document: bounded by its text.
        .agg(F.array_sort(F.collect_list("span")).alias("spans"))
    )
    # The row travels as one value, so that none of its names meets those used here.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(text).alias("key"))
    on = F.col("row")[doc_id].eqNullSafe(F.col("id")) & (F.col("key") == F.col("of"))
    joined = keyed.join(spans, on, "left")
    rest = without(F.col("row")[text], F.col("spans"))
    names = [c for c in docs.columns if c != removed]
    kept = [(rest if c == text else F.col("row")[c]).alias(c) for c in names]
    return joined.select(*kept, *([F.col("spans").alias(removed)] if removed else []))
