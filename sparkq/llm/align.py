"""Alignment of two tokenizers over a corpus, with counts of linked id pairs.

Every text is cut by both tokenizers; byte offsets where tokens of both end cut it into
groups, and every token of one side links to every token of the other in its group. A
pair's count is the number of rows that hold it linked.

Counting is external. Tasks take texts in slices; a slice leaves its pair-document
records (*postings*) as one compressed block, and its distinct pairs with their counts
as sorted zstd runs, one for each radix of the A id. Runs of a radix are merged by heap,
``FAN_IN`` at a time, level by level, until one run of each radix is left; it is in
order of the A side, so the highest count of every A id is read off as its pairs go
by. What was merged then learns the totals on the way down, and at the bottom every
slice adds up what its documents' links contribute. No task holds more than ``FAN_IN``
runs, and a run holds no more than the pairs of its radix.

Defined results: null and empty texts, and texts that a tokenizer does not give back
byte for byte, have no tokens (zeros, and '' as groups). Repeated rows count each for
itself. The columns asked for with ``keep`` come back unchanged, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from heapq import merge

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.tokens import byte_letters
from sparkq.plans.staging import stage

# Runs that one task merges.
FAN_IN = 64
# Radix bits of the A id; pairs are kept as radix, A id, B id.
RADIX_BITS, A_BITS, B_BITS = 8, 18, 18
PAIR_BITS = A_BITS + B_BITS
# Characters of text in a slice, and rows at most.
SLICE, SLICE_ROWS = 2_000_000, 1 << 16
DOC_BITS = 16
# Characters tokenised at a time.
STEP = 400_000
# Groups of more links than this are counted by their distinct ids.
LARGE = 4096
LEVEL = 3

# The pre-token pattern of byte-level vocabularies, and the space mark.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARK = "▁"
# The fast library refuses long runs of white space; such texts go to the other one.
BLANKS = re.compile(r"\s{500}")


class ByteSide:
    """Side A: a byte-level BPE file; special strings are plain text."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        of_letter = {letter: byte for byte, letter in byte_letters().items()}
        ids = {bytes(of_letter[c] for c in piece): i for piece, i in model["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError(f"{path}: ids do not rise with the merges")
        self.spelling = [b""] * (max(ids.values()) + 1)
        for spelled, i in ids.items():
            self.spelling[i] = spelled
        self.fast = tiktoken.Encoding("side-a", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})
        self.slow = None

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return [self.plain(t) if BLANKS.search(t) else self.fast.encode_ordinary(t) for t in texts]

    def plain(self, text: str) -> list[int]:
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids


class PieceSide:
    """Side B: a SentencePiece file, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelling = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)])
            if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace(MARK, " ").encode()
            for i in range(self.model.get_piece_size())
        ]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as one zstd block; each in its smallest type."""
    head, body = [len(arrays)], []
    for one in arrays:
        top = int(one.max()) if len(one) else 0
        kind = next(k for k in range(4) if top < 1 << (8 << k))
        body.append(one.astype(f"<u{1 << kind}").tobytes())
        head += [kind, len(one)]
    return zstandard.compress(np.array(head, "<u8").tobytes() + b"".join(body), LEVEL)


def unpack(block: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(block)
    n = int(np.frombuffer(data, "<u8", 1)[0])
    at, out = 8 * (1 + 2 * n), []
    for kind, size in np.frombuffer(data, "<u8", 2 * n, 8).reshape(-1, 2).tolist():
        out.append(np.frombuffer(data, f"<u{1 << kind}", size, at).astype(np.int64))
        at += size << kind
    return out


def steps(values: np.ndarray) -> np.ndarray:
    """Rising numbers as their steps."""
    return np.diff(values, prepend=0)


def radix_of(a: np.ndarray) -> np.ndarray:
    """A mixed radix, so that ids of like frequency do not fall together."""
    return ((a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - RADIX_BITS)).astype(np.int64)


def count_runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of equal values, and their lengths."""
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])
    return starts, np.diff(np.r_[starts, len(values)])


@dataclass
class Aligned:
    """A slice of texts, aligned: numbers of each text, its groups, and its records
    (radix and pair, place of the text, links), sorted and distinct."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pair: np.ndarray
    doc: np.ndarray
    links: np.ndarray


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteSide(a_path), PieceSide(b_path)
        if len(self.a.spelling) >= 1 << A_BITS or len(self.b.spelling) >= 1 << B_BITS:
            raise ValueError("a vocabulary has more ids than pairs have room for")
        self.a_sizes = np.array([len(s) for s in self.a.spelling], np.int64)
        self.b_sizes = np.array([len(s) for s in self.b.spelling], np.int64)
        # Every id with each sign that may stand behind it.
        self.a_text = self.written(len(self.a_sizes), (",", "|"))
        self.b_text = self.written(len(self.b_sizes), (",", ";", ""))

    @staticmethod
    def written(n: int, signs: Sequence[str]) -> np.ndarray:
        return np.array([f"{i}{s}".encode() for s in signs for i in range(n)])

    def tokens(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides in a row, and how many each text has."""
        ids: tuple[list, list] = ([], [])
        sizes = (np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64))
        some = [i for i, t in enumerate(texts) if t]
        at = 0
        while at < len(some):
            end, chars = at, 0
            while end < len(some) and (end == at or chars < STEP):
                chars += len(texts[some[end]])
                end += 1
            part = [texts[i] for i in some[at:end]]
            both = zip(self.a.encode([" " + t for t in part]), self.b.encode(part))
            for i, text, (a, b) in zip(some[at:end], part, both):
                want = b" " + text.encode()
                if all(b"".join(map(s.spelling.__getitem__, one)) == want for s, one in ((self.a, a), (self.b, b))):
                    for side, one in enumerate((a, b)):
                        ids[side].append(np.array(one, np.int32))
                        sizes[side][i] = len(one)
            at = end
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in ids)
        return a, b, *sizes

    def align(self, texts: Sequence[str | None]) -> Aligned:
        a, b, n_a, n_b = self.tokens(texts)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        # Both sides spell the same bytes, so the ends of texts are ends of both.
        length = int(a_ends[-1]) if len(a) else 0
        ends_here = np.zeros(length + 1, bool)
        ends_here[b_ends] = True
        a_last = ends_here[a_ends]
        ends_here[:] = False
        ends_here[a_ends] = True
        b_last = ends_here[b_ends]
        a_stop, b_stop = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
        a_start, b_start = np.r_[0, a_stop][:-1], np.r_[0, b_stop][:-1]
        in_a, in_b = a_stop - a_start, b_stop - b_start
        doc_of = np.searchsorted(np.cumsum(n_a), a_start, side="right")
        links = in_a * in_b
        n = len(texts)
        pair, doc, times = self.records(a, b, a_start, b_start, in_a, in_b, doc_of)
        return Aligned(
            n_a,
            n_b,
            np.bincount(doc_of, minlength=n),
            np.bincount(doc_of, links, n).astype(np.int64),
            self.groups(a, b, n_a, n_b, a_last, b_last, a_stop, b_start),
            pair,
            doc,
            times,
        )

    def groups(self, a, b, n_a, n_b, a_last, b_last, a_stop, b_start) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        # A token stands behind the tokens of its side and the other side's of earlier groups.
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        written = np.empty(len(a) + len(b), f"S{max(self.a_text.itemsize, self.b_text.itemsize)}")
        written[np.arange(len(a)) + b_start[a_group]] = self.a_text[a + len(self.a_sizes) * a_last]
        sign = b_last.astype(np.int64)
        sign[np.cumsum(n_b)[n_b > 0] - 1] = 2
        written[np.arange(len(b)) + a_stop[b_group]] = self.b_text[b + len(self.b_sizes) * sign]
        ends = np.cumsum(n_a + n_b).tolist()
        # Short ids are padded with zero bytes.
        return [written[x:y].tobytes().translate(None, b"\0").decode() for x, y in zip([0, *ends], ends)]

    def records(self, a, b, a_start, b_start, in_a, in_b, doc_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = in_a * in_b
        usual = np.flatnonzero(n <= LARGE)
        size = n[usual]
        group = np.repeat(usual, size)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
        which, other = np.divmod(nth, in_b[group])
        found = [self.record(a[a_start[group] + which], b[b_start[group] + other], doc_of[group])]
        times = [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(n > LARGE).tolist():
            one, a_times = np.unique(a[a_start[g] : a_start[g] + in_a[g]], return_counts=True)
            two, b_times = np.unique(b[b_start[g] : b_start[g] + in_b[g]], return_counts=True)
            found.append(self.record(np.repeat(one, len(two)), np.tile(two, len(one)), np.full(len(one) * len(two), doc_of[g])))
            times.append(np.outer(a_times, b_times).ravel())
        if len(found) == 1:
            codes = found[0]
            codes.sort()
            starts, times = count_runs(codes)
        else:
            codes, times = np.concatenate(found), np.concatenate(times)
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            starts, _ = count_runs(codes)
            times = np.add.reduceat(times[order], starts)
        codes = codes[starts]
        return codes >> DOC_BITS, codes & ((1 << DOC_BITS) - 1), times

    @staticmethod
    def record(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
        a = a.astype(np.int64)
        pair = (radix_of(a) << PAIR_BITS) | (a << B_BITS) | b
        return (pair << DOC_BITS) | doc


def slices(rows: Iterator[tuple], size: int = SLICE, most: int = SLICE_ROWS) -> Iterator[list[tuple]]:
    """Rows (text first) in lists of about ``size`` characters; no text is cut."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[0] or "")
        if chars >= size or len(held) == most:
            yield held
            held, chars = [], 0
    if held:
        yield held


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
RUN = "radix int, member long, run binary"
# What tells slices of one task apart.
SLICES_OF_TASK = 1 << 24


def slice_rows(docs: DataFrame, text: Column, a_path: str, b_path: str, keep: Sequence[str], size: int) -> DataFrame:
    """A row for each document (with ``place`` in its slice), each run, and the postings of each slice."""
    kept = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]) if keep else F.struct(F.lit(0).alias("k"))
    given = docs.select(text.alias("text"), kept.alias("kept"))
    schema = (
        f"slice long, place int, kept {given.schema['kept'].dataType.simpleString()}, "
        + ", ".join(f"{c} long" for c in COUNTS)
        + ", groups string, radix int, run binary, postings binary"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        names = [f.split(" ")[0] for f in ("slice", "place", "kept", *COUNTS, "groups", "radix", "run", "postings")]
        kind = None

        def rows() -> Iterator[tuple]:
            nonlocal kind
            for batch in batches:
                kind = batch["kept"].type
                yield from zip(batch["text"].to_pylist(), batch["kept"])

        def out(n: int, **columns) -> pa.RecordBatch:
            types = {"place": pa.int32(), "kept": kind, "groups": pa.string(), "radix": pa.int32(), "run": pa.binary(), "postings": pa.binary()}
            arrays = [
                pa.array(columns[c], types.get(c, pa.int64())) if c in columns else pa.nulls(n, types.get(c, pa.int64()))
                for c in names
            ]
            return pa.record_batch(arrays, names)

        task = TaskContext.get().partitionId()
        for nth, held in enumerate(slices(rows(), size)):
            me = task * SLICES_OF_TASK + nth
            got = aligner.align([text for text, _ in held])
            n = len(held)
            yield out(
                n,
                slice=np.full(n, me),
                place=np.arange(n, dtype=np.int32),
                kept=[row.as_py() if row.is_valid else None for _, row in held],
                groups=got.groups,
                **{c: getattr(got, c) for c in COUNTS},
            )
            starts, counts = count_runs(got.pair)
            pairs = got.pair[starts]
            cuts = np.searchsorted(pairs, np.arange((1 << RADIX_BITS) + 1) << PAIR_BITS)
            radix = np.flatnonzero(np.diff(cuts))
            runs = [pack(steps(pairs[cuts[r] : cuts[r + 1]]), counts[cuts[r] : cuts[r + 1]]) for r in radix]
            yield out(len(radix), slice=np.full(len(radix), me), radix=radix.astype(np.int32), run=runs)
            # Inside a pair documents ascend; between pairs the step may go back.
            back = steps(got.doc) + n
            yield out(1, slice=[me], postings=[pack(np.array([n]), counts, back, got.links)])

    return given.mapInArrow(work, schema)


def merged(runs: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs (pairs, counts) as one: a heap takes the least pair of all runs, and
    equal pairs add up."""
    if len(runs) == 1:
        return runs[0]
    bits = (len(runs) - 1).bit_length()
    keyed = [((pairs << bits) | i).tolist() for i, (pairs, _) in enumerate(runs)]
    order = np.fromiter(merge(*keyed), np.int64, sum(map(len, keyed)))
    # Rows of one run come in its order, so its counts fall into place.
    counts = np.empty(len(order), np.int64)
    counts[np.argsort(order & ((1 << bits) - 1), kind="stable")] = np.concatenate([c for _, c in runs])
    pairs = order >> bits
    starts, _ = count_runs(pairs)
    return pairs[starts], np.add.reduceat(counts, starts)


def highest(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each pair's count is the highest of its A id; pairs are in A order."""
    starts, sizes = count_runs(pairs >> B_BITS)
    return counts == np.repeat(np.maximum.reduceat(counts, starts), sizes)


def read_run(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    pairs, counts = unpack(block)
    return np.cumsum(pairs), counts


def answer(run: bytes, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> bytes:
    """Totals of the pairs of a run, in its order."""
    at = np.searchsorted(pairs, read_run(run)[0])
    return pack(counts[at], best[at])


def merge_runs(table: pa.Table) -> pa.Table:
    """Runs of one radix and group as one run."""
    pairs, counts = merged([read_run(x) for x in table["run"].to_pylist()])
    row = {"radix": [table["radix"][0].as_py()], "member": [table["up"][0].as_py()], "run": [pack(steps(pairs), counts)]}
    return pa.table(row, pa.schema([("radix", pa.int32()), ("member", pa.int64()), ("run", pa.binary())]))


def replies_of(table: pa.Table, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> pa.Table:
    totals = [answer(x, pairs, counts, best) for x in table["run"].to_pylist()]
    return pa.table([table["radix"], table["member"], table["run"], pa.array(totals, pa.binary())], ["radix", "member", "run", "totals"])


def settle_runs(table: pa.Table) -> pa.Table:
    """The last runs of a radix: merge them, find the maxima, answer each run."""
    pairs, counts = merged([read_run(x) for x in table["run"].to_pylist()])
    return replies_of(table, pairs, counts, highest(pairs, counts))


def hand_down(key: tuple, children: pa.Table, parent: pa.Table) -> pa.Table:
    """Answer the runs of a group from the totals of what they were merged to."""
    counts, best = unpack(parent["totals"][0].as_py())
    return replies_of(children, read_run(parent["run"][0].as_py())[0], counts, best)


REPLY = "radix int, member long, run binary, totals binary"


def totals(runs: DataFrame, n_members: int, fan_in: int = FAN_IN) -> DataFrame:
    """Runs (radix, member, run) with the corpus-wide count and best flag of their pairs.

    ``n_members`` bounds the members; groups of about ``fan_in`` of them are merged at
    each level, members being dealt to groups by a hash.
    """
    levels, n = [], n_members
    while n > fan_in:
        n = -(-n // fan_in)
        dealt = runs.withColumn("up", F.pmod(F.xxhash64("member"), F.lit(n)))
        levels.append(dealt)
        runs = stage(dealt.groupBy("radix", "up").applyInArrow(merge_runs, RUN), "runs")
    replies = runs.groupBy("radix").applyInArrow(settle_runs, REPLY)
    for dealt in reversed(levels):
        above = stage(replies, "totals").withColumnRenamed("member", "up")
        replies = dealt.groupBy("radix", "up").cogroup(above.groupBy("radix", "up")).applyInArrow(hand_down, REPLY)
    return replies


def contributions(key: tuple, blocks: pa.Table, replies: pa.Table) -> pa.Table:
    """Links at the highest count of each document of a slice, and the sum of its counts."""
    (n,), per_pair, back, links = unpack(blocks["postings"][0].as_py())
    order = np.argsort(replies["radix"].to_numpy())
    got = [unpack(replies["totals"][int(i)].as_py()) for i in order]
    count = np.repeat(np.concatenate([c for c, _ in got]) if got else np.zeros(0, np.int64), per_pair)
    best = np.repeat(np.concatenate([b for _, b in got]) if got else np.zeros(0, np.int64), per_pair)
    doc = np.cumsum(back - n)
    return pa.table(
        {
            "slice": np.full(n, blocks["slice"][0].as_py()),
            "place": np.arange(n, dtype=np.int32),
            # Whole sums: weights would be added in floating point.
            "n_best": summed(doc, links * best, int(n)),
            "count_sum": summed(doc, links * count, int(n)),
        }
    )


def summed(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, doc, values)
    return out


def align_corpus(
    spark: SparkSession,
    docs: DataFrame,
    text: str,
    a_path: str,
    b_path: str,
    keep: Sequence[str] = (),
    outputs: Mapping[str, Column] | None = None,
    fan_in: int = FAN_IN,
    slice_chars: int = SLICE,
) -> DataFrame:
    """Every row of ``docs`` aligned: the columns ``keep``, n_a, n_b, n_groups, n_links,
    n_best, count_sum, and ``groups`` (ids as ``a1,a2|b1;a3|b2,b3``).

    ``outputs`` may name other columns instead of ``groups``, as expressions over it;
    they are computed before anything is written, so that long texts of ids need not be.
    """
    taken = {*COUNTS, "n_best", "count_sum", *(outputs or {"groups": None})}
    if clash := taken & set(keep):
        raise ValueError(f"columns to keep that are results, too: {sorted(clash)}")
    outputs = {"groups": F.col("groups")} if outputs is None else dict(outputs)
    made = [f"o{i}" for i in range(len(outputs))]
    rows = slice_rows(docs, F.col(f"`{text}`"), a_path, b_path, keep, slice_chars)
    rows = stage(
        rows.select(
            "slice", "place", "kept", *COUNTS, *[c.alias(m) for m, c in zip(made, outputs.values())], "radix", "run", "postings"
        ),
        "aligned",
    )
    runs = rows.where("run IS NOT NULL").select("radix", F.col("slice").alias("member"), "run")
    blocks = rows.where("postings IS NOT NULL").select("slice", "postings")
    replies = totals(runs, blocks.count(), fan_in).select("radix", F.col("member").alias("slice"), "totals")
    sums = (
        blocks.groupBy("slice")
        .cogroup(replies.groupBy("slice"))
        .applyInArrow(contributions, "slice long, place int, n_best long, count_sum long")
    )
    found = rows.where("place IS NOT NULL").select("slice", "place", "kept", *COUNTS, *made)
    return found.join(sums, ["slice", "place"]).select(
        *[F.col(f"kept.k{i}").alias(c) for i, c in enumerate(keep)],
        *COUNTS,
        "n_best",
        "count_sum",
        *[F.col(m).alias(name) for m, name in zip(made, outputs)],
    )
