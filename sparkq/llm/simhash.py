"""SimHash near-duplicates by anchor-point covering.

``fingerprint`` maps a text to 64 bits. ``links`` finds all pairs of distinct
fingerprints that differ in at most ``threshold`` bits, and ``components`` the
groups they form.

Anchors are the words of a covering code: a product of perfect codes over blocks
of the fingerprint, so that every fingerprint lies within the covering radius of
exactly one anchor, its home. Each fingerprint is replicated to every anchor
within covering radius plus threshold and is compared there with the
fingerprints whose home the anchor is: if x and y differ in at most
``threshold`` bits, the home of x is within radius plus threshold of y.

Only distinct fingerprints are replicated; exact copies are one fingerprint, and
copies are never paired with each other. The code grows with the number of
fingerprints (``code_for``), which keeps the fingerprints per anchor few; results
do not depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.llm.common import join_unique
from sparkq.plans.staging import stage

# Words of a shingle, and bits in which linked fingerprints may differ.
SHINGLE, BITS = 3, 2
# Hashes held at a time; longer texts are summed in slices.
SLICE = 1 << 18


def text_fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bits set in over half of the XXH64 hashes of the word shingles, as unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    stops = ends[len(words) - n :].tolist()
    starts = starts[:n].tolist()
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SLICE):
        h = np.fromiter(
            (digest(joined[a:b], 42) for a, b in zip(starts[at : at + SLICE], stops[at : at + SLICE])),
            np.uint64,
        )
        set_bits += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(
            0, dtype=np.int64
        )
    return int.from_bytes(np.packbits(set_bits * 2 > n).tobytes(), "big")


def fingerprint(text: Column) -> Column:
    """Fingerprints as signed 64-bit numbers; null and wordless texts give zero."""

    @F.pandas_udf("long")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = np.fromiter((text_fingerprint(t) for t in texts), np.uint64, len(texts))
            yield pd.Series(out.view(np.int64))

    return compute(text)


# --- covering codes -------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """A perfect code over ``length`` bits: ``2**parity`` syndromes, one per error
    of at most ``radius`` bits. ``columns[i]`` is the syndrome of bit i."""

    length: int
    parity: int
    radius: int
    columns: tuple[int, ...]

    @lru_cache
    def leaders(self) -> np.ndarray:
        """The error of at most ``radius`` bits for each syndrome."""
        table = np.zeros(1 << self.parity, np.uint64)
        for weight in range(1, self.radius + 1):
            for bits in combinations(range(self.length), weight):
                syndrome = error = 0
                for b in bits:
                    syndrome ^= self.columns[b]
                    error |= 1 << b
                table[syndrome] = error
        return table

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.uint64)
        for b, column in enumerate(self.columns):
            out ^= ((words >> np.uint64(b)) & np.uint64(1)) * np.uint64(column)
        return out.astype(np.int64)

    @lru_cache
    def table(self, most: int) -> ErrorTable:
        """Errors of up to ``most`` bits by syndrome, lightest first: the differences
        between a word of that syndrome and the anchors within ``most`` bits."""
        # As arrays throughout: 880,970 errors of a Golay block, in every Python worker.
        columns = np.array(self.columns, np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for weight in range(min(most, self.length) + 1):
            n = comb(self.length, weight)
            bits = chain.from_iterable(combinations(range(self.length), weight))
            bits = np.fromiter(bits, np.uint8, n * weight).reshape(n, weight)
            syndromes, errors = np.zeros(n, np.int64), np.zeros(n, np.uint64)
            for b in bits.T:
                syndromes ^= columns[b]
                errors |= np.uint64(1) << b.astype(np.uint64)
            found.append((syndromes, np.full(n, weight), errors))
        by, weights, errors = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((errors, weights, by))
        size = 1 << self.parity
        each = np.zeros((size, most + 1), np.int64)
        np.add.at(each, (by, weights), 1)
        upto = each.cumsum(axis=1)
        start = np.cumsum(upto[:, -1]) - upto[:, -1]
        return ErrorTable(errors[order], weights[order], start, each, upto, (upto == 0).sum(axis=1))


@dataclass(frozen=True)
class ErrorTable:
    errors: np.ndarray
    weights: np.ndarray
    start: np.ndarray  # of each syndrome in errors
    each: np.ndarray  # errors of a syndrome that have exactly so many bits
    upto: np.ndarray  # errors of a syndrome that have at most so many bits
    least: np.ndarray  # bits of the lightest error of a syndrome


def golay() -> Block:
    """The perfect binary Golay code of 23 bits, radius 3, from its generator polynomial."""
    generator = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
    columns = []
    rest = 1
    for _ in range(23):
        columns.append(rest)
        rest <<= 1
        if rest >> 11:
            rest ^= generator
    return Block(23, 11, 3, tuple(columns))


def hamming(parity: int) -> Block:
    """The perfect Hamming code of 2**parity - 1 bits, radius 1."""
    n = (1 << parity) - 1
    return Block(n, parity, 1, tuple(range(1, n + 1)))


@dataclass(frozen=True)
class Code:
    """A product of perfect codes over consecutive bits; further bits are not coded."""

    blocks: tuple[Block, ...]

    @property
    def radius(self) -> int:
        return sum(b.radius for b in self.blocks)

    @property
    def mask(self) -> int:
        return (1 << sum(b.length for b in self.blocks)) - 1

    def home(self, words: np.ndarray) -> np.ndarray:
        """The one anchor within the covering radius of each word."""
        out, shift = words & np.uint64(self.mask), 0
        for block in self.blocks:
            out = out ^ (block.leaders()[block.syndromes(words >> np.uint64(shift))] << np.uint64(shift))
            shift += block.length
        return out

    def near(self, words: np.ndarray, reach: int) -> np.ndarray:
        """How many anchors ``within`` finds for each word."""
        by_bits = np.zeros((len(words), reach + 1), np.int64)
        by_bits[:, 0] = 1
        shift = 0
        for block in self.blocks:
            each = block.table(reach).each[block.syndromes(words >> np.uint64(shift))]
            so_far, by_bits = by_bits, np.zeros_like(by_bits)
            for bits in range(reach + 1):
                by_bits[:, bits:] += so_far[:, : reach + 1 - bits] * each[:, bits, None]
            shift += block.length
        return by_bits.sum(axis=1)

    def within(self, words: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """All anchors that differ from a word in at most ``reach`` coded bits.

        Returns positions in ``words`` and anchors. Blocks are taken one after the
        other; a partial anchor goes on while the blocks to come can still fit.
        """
        shifts = np.cumsum([0, *(b.length for b in self.blocks)])
        syndromes = [b.syndromes(words >> np.uint64(s)) for b, s in zip(self.blocks, shifts)]
        tables = [b.table(reach) for b in self.blocks]
        at = np.arange(len(words))
        anchors = words & np.uint64(self.mask)
        left = np.full(len(words), reach) - sum(t.least[s] for t, s in zip(tables, syndromes))
        for table, syndrome, shift in zip(tables, syndromes, shifts):
            s = syndrome[at]
            # What this block may use: its own least weight and what is left over.
            spend = left + table.least[s]
            count = np.where(left >= 0, table.upto[s, np.clip(spend, 0, reach)], 0)
            row = np.repeat(np.arange(len(at)), count)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            pick = table.start[s[row]] + nth
            anchors = anchors[row] ^ (table.errors[pick] << np.uint64(shift))
            left = spend[row] - table.weights[pick]
            at = at[row]
        return at, anchors


TWO_GOLAY = Code((golay(), golay()))
TWO_GOLAY_HAMMING = Code((golay(), golay(), hamming(4)))
# Beyond this many fingerprints comparing costs more than replicating further.
MANY = 50_000_000


def code_for(n: int) -> Code:
    """24 anchor bits, or 35 for very many fingerprints; results are the same."""
    return TWO_GOLAY if n <= MANY else TWO_GOLAY_HAMMING


# Replicas held at a time, and fingerprints replicated by one task.
REPLICAS, TASK = 1 << 18, 16_384
# Fingerprints whose replicas are counted at a time.
CHUNK = 4096
# Rows that a partition or file has room for.
FILE = 16_384


def slices(words: np.ndarray, code: Code, reach: int) -> Iterator[np.ndarray]:
    """``words`` in runs that have at most ``REPLICAS`` anchors within ``reach`` bits, or
    are one word. A word near an anchor has 20 times as many as most, and near copies
    share theirs."""
    for i in range(0, len(words), CHUNK):
        part = words[i : i + CHUNK]
        ends, done = np.cumsum(code.near(part, reach)), 0
        while done < len(part):
            before = ends[done - 1] if done else 0
            upto = max(done + 1, int(np.searchsorted(ends, before + REPLICAS, "right")))
            yield part[done:upto]
            done = upto


def fitted(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in as many partitions as they fill: few rows go to
    few files, not to one for each shuffle partition. Each file costs its executor time
    and, where the mode is set by a command, a child process."""
    return df.coalesce(-(-rows // FILE) or 1)


def packed(df: DataFrame, label: str, rows: int) -> DataFrame:
    return stage(fitted(df, rows), label)


def links(
    fingerprints: DataFrame, threshold: int = BITS, code: Code | None = None, rows: int | None = None
) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct values of column ``fp`` that differ in at
    most ``threshold`` bits. Nulls take no part. ``rows``: how many there are, if known."""
    distinct = fingerprints.select("fp").dropna().distinct()
    distinct = stage(distinct, "fingerprints") if rows is None else packed(distinct, "fingerprints", rows)
    n = distinct.count()
    used = code or code_for(n)
    reach = used.radius + threshold
    tasks = -(-n // TASK) or 1
    # Eight bytes a row here, but many times the rows behind it.
    spread = distinct.repartition(tasks)

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False)
            home = used.home(fp.view(np.uint64)).view(np.int64)
            yield pa.record_batch([home, fp], ["anchor", "a"])

    def replicated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False)
            for part in slices(fp.view(np.uint64), used, reach):
                at, anchors = used.within(part, reach)
                yield pa.record_batch(
                    [anchors.view(np.int64), part[at].view(np.int64)], ["anchor", "b"]
                )

    homes = distinct.mapInArrow(at_home, "anchor long, a long")
    replicas = spread.mapInArrow(replicated, "anchor long, b long")
    return (
        replicas.join(homes, "anchor")
        .where(
            (F.col("a") < F.col("b"))
            & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold)
        )
        .select("a", "b")
        # Few of the comparisons give links, and those of near copies come from few anchors.
        .repartition(tasks)
    )


def connected(pairs: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over ``pairs`` (a, b).

    Each round takes the smallest root among the neighbours, then the root's root.
    Only the links themselves are joined by node, so no node gathers more rows than
    it has links; rounds are written to the shared folder.
    """
    pairs = stage(pairs, "links")
    nodes = 2 * pairs.count()
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = packed(
        both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("root")
        ),
        "roots",
        nodes,
    )
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("root")
        )
        lower = packed(lower, "roots", nodes)
        above = lower.select(F.col("node").alias("up"), F.col("root").alias("top"))
        jumped = packed(
            lower.join(above, F.col("root") == F.col("up"), "left").select(
                "node", "old", F.least("root", F.coalesce("top", "root")).alias("root")
            ),
            "roots",
            nodes,
        )
        labels = jumped.select("node", "root")
        if jumped.where(F.col("root") != F.col("old")).isEmpty():
            return labels


def components(docs: DataFrame, threshold: int = BITS, code: Code | None = None) -> DataFrame:
    """Component of every row of ``docs`` (columns doc_id and fp, others are kept).

    Adds ``component_id``, the smallest doc_id of the component (null ids count for
    none). Rows of equal fingerprints are one node; repeated rows stay repeated.
    """
    docs = stage(docs, "signatures")
    return grouped(docs, connected(links(docs, threshold, code, docs.count())))


def grouped(docs: DataFrame, roots: DataFrame) -> DataFrame:
    """``docs`` (staged) with the ``component_id`` that the roots (node, root) of ``fp`` give."""
    rows = docs.count()
    ids = packed(
        docs.groupBy("fp").agg(F.min("doc_id").alias("__least"), F.count(F.lit(1)).alias("__n")),
        "fingerprint-ids",
        rows,
    )
    ids = packed(ids.join(roots, F.col("fp") == F.col("node"), "left"), "fingerprint-ids", rows)
    # Fingerprints without links are components of their own; the others meet by root,
    # where the smallest id is found by an aggregation that combines before the shuffle.
    alone = ids.where(F.col("root").isNull()).select("fp", F.col("__least").alias("component_id"), "__n")
    linked = ids.where(F.col("root").isNotNull()).select("fp", "root", "__n", "__least")
    least = linked.groupBy("root").agg(F.min("__least").alias("component_id"), F.count(F.lit(1)).alias("__of"))
    linked = join_unique(linked.drop("__least"), packed(least, "components", rows), "root", "__of")
    verdict = alone.unionByName(linked.select("fp", "component_id", "__n"))
    return fitted(join_unique(docs, packed(verdict, "components", rows), "fp", "__n"), rows)


def near_duplicates(docs: DataFrame, threshold: int = BITS, code: Code | None = None) -> DataFrame:
    """doc_id, fp, key (hash of the text) and component_id of every row of ``docs``."""
    signed = docs.select(
        F.col("doc_id"), fingerprint(F.col("text")).alias("fp"), F.xxhash64("text").alias("key")
    )
    return components(signed, threshold, code)


def keep_one(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """One row of each component: that of the smallest doc_id (then text hash).
    ``found`` gives the components, else ``near_duplicates`` does.

    Rows that agree in doc_id and text are one document and leave one row.
    """
    found = near_duplicates(docs) if found is None else found
    # Nulls come first in a struct, so a document without id would win; it comes last.
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    rep = (
        found.groupBy(F.coalesce("component_id", "fp"), F.col("component_id").isNull())
        .agg(F.min(rank).alias("r"))
        .select(F.col("r.doc_id").alias("__id"), F.col("r.key").alias("__rep"))
    )
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    on = keyed["doc_id"].eqNullSafe(rep["__id"]) & (keyed["__key"] == rep["__rep"])
    return keyed.join(rep, on, "left_semi").dropDuplicates(["doc_id", "__key"]).select(*docs.columns)
