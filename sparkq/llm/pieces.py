"""SentencePiece encoding with sampled segmentations, and lossless decoding.

A text becomes a lattice: its positions, and as arcs the pieces between them. Forward
filtering sums the weight of all ways to each position; backward sampling walks from
the end, taking each arc with its share of that sum. Random numbers are a hash of
seed, row key and position, so a row is cut alike wherever and whenever it is read.

No piece goes on behind a space mark into another word, so a text is cut into words
first, the lattice of each distinct word is filtered once, and all words of a slice
are sampled in step.

Files of the BPE kind hold merge ranks, not probabilities; pieces then get Zipf
weights by rank. ``theta`` flattens (below 1) or sharpens (above 1) the choice.
Characters without a piece are spelled in bytes. Space marks that stand in the text
itself are spelled in bytes, too, so decoding gives back every text.

Null texts give null, empty texts no pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.arrays import IntTable

MARK = "▁"
# Stands for a space mark of the text; no valid text holds a lone surrogate.
OWN_MARK = "\udfff"
# Bits of a character in the keys of the tree.
CHAR = 21
# Log weight of each byte of a character that has no piece.
BYTE_WEIGHT = -12.0


@dataclass(frozen=True)
class Pieces:
    """A tree of the pieces, log weights, ids of bytes, and the bytes of every id.

    The tree's table leads from (node, character) to the next node; ``piece_at`` has
    the piece that ends in a node, or -1.
    """

    tree: IntTable
    piece_at: np.ndarray
    weights: np.ndarray
    bytes_: tuple[int, ...]
    spelling: tuple[bytes, ...]

    @staticmethod
    def load(path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [
            i
            for i in range(n)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        scores = np.array([model.get_score(i) for i in range(n)])
        whole = all(float(scores[i]).is_integer() for i in plain)
        if whole:  # ranks
            scores[plain] = -np.log(np.arange(len(plain)) + 10.0)
        bytes_ = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
        spelling = [b""] * n
        for i in plain:
            spelling[i] = model.id_to_piece(i).replace(MARK, " ").encode()
        for b, i in enumerate(bytes_):
            spelling[i] = bytes([b])
        scores[list(bytes_)] = BYTE_WEIGHT
        nodes: dict[int, int] = {}
        piece_at = {0: -1}
        for i in plain:
            node = 0
            for char in model.id_to_piece(i):
                node = nodes.setdefault((node << CHAR) | ord(char), len(nodes) + 1)
            piece_at[node] = i
        ends = np.array([piece_at.get(n, -1) for n in range(len(nodes) + 1)], np.int64)
        return Pieces(IntTable.of(np.array(list(nodes))), ends, scores, bytes_, tuple(spelling))


def _mix(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit values (the finaliser of SplitMix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Shares of arcs and random numbers have so many bits.
BITS = 24


def uniforms(keys: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """A number below 2**BITS for each (mixed) key and position."""
    mixed = _mix(keys + positions.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


WORD = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
# Characters of text whose words are sampled together, and characters of distinct
# words whose lattices a worker keeps.
SLICE = 200_000
MEMO = 400_000


class Arcs:
    """Arrays that grow in place, so that no second copy of all arcs is made."""

    KINDS = (np.int64, np.int32, np.int32)

    def __init__(self):
        self.size = 0
        self.held = [np.empty(1 << 16, kind) for kind in self.KINDS]

    def add(self, *arrays: np.ndarray) -> None:
        end = self.size + len(arrays[0])
        if end > len(self.held[0]):
            for one in self.held:
                one.resize(end + end // 2, refcheck=False)
        for one, more in zip(self.held, arrays):
            one[self.size : end] = more
        self.size = end

    def views(self) -> tuple[np.ndarray, ...]:
        return tuple(one[: self.size] for one in self.held)


class Lattices:
    """Arcs of all words seen, by the node they end in; a word's nodes are its positions."""

    def __init__(self, pieces: Pieces, theta: float):
        self.pieces, self.theta = pieces, theta
        self.clear()

    def clear(self) -> None:
        self.base: dict[str, int] = {}
        self.nodes = 0
        self.arcs = Arcs()
        self.spelled: dict[str, int] = {}
        self.unknown: list[tuple[int, ...]] = []

    def add(self, words: Sequence[str]) -> None:
        """Filter the lattices of new words, all positions of one number together."""
        if not words:
            return
        first = self.nodes
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        bases = first + np.cumsum(sizes + 1) - sizes - 1
        self.base.update(zip(words, bases.tolist()))
        self.nodes = int(bases[-1] + sizes[-1] + 1)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        # Where each character is, among characters and among nodes.
        left = (np.cumsum(sizes)[word] - np.arange(len(chars))).astype(np.int64)
        node_of = np.arange(len(chars)) + word + first
        tree, piece_at = self.pieces.tree, self.pieces.piece_at
        at, state, depth = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0
        starts, ends, ids = [], [], []
        spelled = np.ones(len(chars), bool)
        while len(at):
            state = tree.find((state << CHAR) | chars[at + depth]) + 1
            depth += 1
            at, state = at[state > 0], state[state > 0]
            found = piece_at[state]
            some = found >= 0
            starts.append(node_of[at[some]])
            ends.append(starts[-1] + depth)
            ids.append(found[some])
            if depth == 1:
                spelled[at[some]] = False
            longer = left[at] > depth
            at, state = at[longer], state[longer]
        rest = np.flatnonzero(spelled)
        starts.append(node_of[rest])
        ends.append(node_of[rest] + 1)
        ids.append(np.array([self.spell(chr(c)) for c in chars[rest].tolist()], np.int64))
        start, end, piece = (np.concatenate(x) for x in (starts, ends, ids))
        weight = self.weigh(piece) * self.theta
        of = np.repeat(bases, sizes + 1)
        depth = end - of[end - first]
        order = np.lexsort((start, end, depth))
        total = np.full(self.nodes - first, -np.inf)
        total[bases - first] = 0.0
        start, end, piece, weight, depth = (x[order] for x in (start, end, piece, weight, depth))
        level = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1], True])
        share = np.empty(len(start))
        for a, b in zip(level[:-1], level[1:]):
            node = end[a:b] - first
            value = total[start[a:b] - first] + weight[a:b]
            group = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            size = np.diff(np.r_[group, b - a])
            most = np.repeat(np.maximum.reduceat(value, group), size)
            part = np.exp(value - most)
            sums = np.add.reduceat(part, group)
            total[node[group]] = most[group] + np.log(sums)
            share[a:b] = part / np.repeat(sums, size)
        order = np.lexsort((start, end))
        start, end, piece, share = (x[order] for x in (start, end, piece, share))
        # Cumulative shares of each node, one arc after the other so that they do not
        # depend on what other words are here; with the node above they rise throughout.
        group = np.flatnonzero(np.r_[True, end[1:] != end[:-1]])
        size = np.diff(np.r_[group, len(end)])
        for nth in range(1, int(size.max())):
            more = group[size > nth] + nth
            share[more] += share[more - 1]
        rising = np.rint(share * (1 << BITS)).astype(np.int64)
        rising[group + size - 1] = 1 << BITS
        rising += end << BITS
        self.arcs.add(rising, start, piece)

    def spell(self, char: str) -> int:
        """The byte id of a character without piece, or for several bytes a number
        beyond the pieces that stands for them."""
        found = self.spelled.get(char)
        if found is None:
            data = (MARK if char == OWN_MARK else char).encode("utf-8", "surrogatepass")
            ids = tuple(self.pieces.bytes_[b] for b in data)
            found = ids[0] if len(ids) == 1 else len(self.pieces.weights) + len(self.unknown)
            if len(ids) > 1:
                self.unknown.append(ids)
            self.spelled[char] = found
        return found

    def weigh(self, piece: np.ndarray) -> np.ndarray:
        extra = [BYTE_WEIGHT * len(ids) for ids in self.unknown]
        return np.concatenate([self.pieces.weights, extra])[piece]


class Encoder:
    def __init__(self, pieces: Pieces, seed: int, theta: float):
        self.lattices = Lattices(pieces, theta)
        self.seed = np.uint64(seed & (2**64 - 1))

    def encode(self, texts: Sequence[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        marked = [
            MARK + t.replace(MARK, OWN_MARK).replace(" ", MARK) if t else "" for t in texts
        ]
        words = [WORD.findall(t) for t in marked]
        lattices = self.lattices
        flat = [w for one in words for w in one]
        if not flat:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        new = [w for w in dict.fromkeys(flat) if w not in lattices.base]
        if lattices.nodes + sum(map(len, new)) > MEMO:
            lattices.clear()
            new = list(dict.fromkeys(flat))
        lattices.add(new)
        rising, start, piece = lattices.arcs.views()
        sizes = np.fromiter(map(len, flat), np.int64, len(flat))
        base = np.fromiter(map(lattices.base.__getitem__, flat), np.int64, len(flat))
        row = np.repeat(np.arange(len(texts)), [len(one) for one in words])
        # Position of each word's beginning in its text.
        ends = np.cumsum(sizes)
        text_start = np.r_[0, np.cumsum([len(t) for t in marked])][:-1]
        offset = ends - sizes - text_start[row] - base
        key = _mix(keys.astype(np.uint64) ^ self.seed)[row]

        node, open_ = base + sizes, np.arange(len(flat))
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        count = np.zeros(len(flat), np.int64)
        while len(open_):
            at = node[open_]
            u = uniforms(key[open_], at + offset[open_])
            arc = np.searchsorted(rising, (at << BITS) + u, side="right")
            taken.append((open_, arc))
            count[open_] += 1
            node[open_] = start[arc]
            open_ = open_[node[open_] > base[open_]]
        place = np.cumsum(count)
        out = np.empty(place[-1], np.int64)
        for step, (which, arc) in enumerate(taken):
            out[place[which] - 1 - step] = piece[arc]
        n_pieces = np.bincount(row, weights=count, minlength=len(texts)).astype(np.int64)
        return self.spelled(out, n_pieces)

    def spelled(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace numbers that stand for several bytes by their ids."""
        unknown, n = self.lattices.unknown, len(self.lattices.pieces.weights)
        at = np.flatnonzero(ids >= n)
        if not len(at):
            return ids, counts
        repeats = np.ones(len(ids), np.int64)
        repeats[at] = [len(unknown[i - n]) for i in ids[at].tolist()]
        row = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(row, weights=repeats, minlength=len(counts)).astype(np.int64)
        out = np.repeat(ids, repeats)
        first = np.cumsum(repeats) - repeats
        for i, to in zip(ids[at].tolist(), first[at].tolist()):
            spelling = unknown[i - n]
            out[to : to + len(spelling)] = spelling
        return out, counts

    def batch(self, texts: Sequence[str | None], keys: np.ndarray) -> pa.Array:
        """Ids of all texts as one array of lists."""
        parts = [ids for _, ids in self.slices(pa.array(texts, pa.string()), keys)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def slices(self, texts: pa.Array, keys: np.ndarray) -> Iterator[tuple[list[str | None], pa.Array]]:
        """The texts in slices of about ``SLICE`` characters, with the ids of each."""
        sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + SLICE, side="right")))
            part = texts.slice(at, end - at).to_pylist()
            ids, counts = self.encode([t or "" for t in part], keys[at:end])
            offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            missing = pa.array([t is None for t in part], pa.bool_())
            yield part, pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)), mask=missing)
            at = end


def _key_numbers(keys: pa.Array) -> np.ndarray:
    return keys.to_numpy(zero_copy_only=False).view(np.uint64)


def encode(
    spark: SparkSession, text: Column, key: Column, path: str, seed: int = 0, theta: float = 1.0
) -> Column:
    """Sampled piece ids of each text, as array<int>; ``key`` is the row's key."""
    # Pieces and weights of a vocabulary: a few MB whatever the data.
    shared = spark.sparkContext.broadcast(Pieces.load(path))

    @F.arrow_udf("array<int>")
    def sample(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value, seed, theta)
        for texts, keys in batches:
            for _, ids in encoder.slices(texts, _key_numbers(keys)):
                yield ids

    return sample(text, F.xxhash64(key))


def encode_checked(
    spark: SparkSession, text: Column, key: Column, path: str, seed: int = 0, theta: float = 1.0
) -> Column:
    """``encode`` with the way back: a struct of ``ids`` and ``lossless``, whether decoding
    gives back the text. One pass and one worker do both."""
    shared = spark.sparkContext.broadcast(Pieces.load(path))
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("lossless", pa.bool_())])

    @F.arrow_udf("struct<ids:array<int>,lossless:boolean>")
    def sample(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value, seed, theta)
        for texts, keys in batches:
            for part, ids in encoder.slices(texts, _key_numbers(keys)):
                same = [a == b for a, b in zip(decoded(ids, shared.value.spelling), part)]
                yield pa.StructArray.from_arrays([ids, pa.array(same, pa.bool_())], fields=list(kind))

    return sample(text, F.xxhash64(key))


def decoded(rows: pa.Array, spelling: Sequence[bytes]) -> Iterator[str | None]:
    """The text of each list of ids."""
    for one in rows:
        if not one.is_valid:
            yield None
            continue
        values = one.values.to_numpy(zero_copy_only=False).tolist()
        text = b"".join([spelling[i] for i in values]).decode("utf-8", "replace")
        yield text[1:] if text.startswith(" ") else text


def decode(spark: SparkSession, ids: Column, path: str) -> Column:
    """The text of piece ids; exact for ids that ``encode`` made. Bytes that form no
    text (in ids from elsewhere) become replacement characters."""
    shared = spark.sparkContext.broadcast(Pieces.load(path).spelling)

    @F.arrow_udf("string")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            yield pa.array(decoded(rows, shared.value), pa.string())

    return read(ids)
