"""Token counts by rank-synchronous merging of ragged symbol arrays.

The vocabulary is a tokenizer file of the byte-level BPE kind with word ends; it is
read once on the driver and broadcast as arrays. Inside a task texts are normalised
and cut into pre-tokens; the pre-tokens not seen before are held together as one
ragged array of symbols. In each round every pre-token looks up its lowest-rank pair
and applies it at all its places at once; those without a pair are done, and the
symbols they have left are their tokens.

Null and empty texts have no tokens. Memory is bounded: texts are taken in slices,
and the memo of counted words is emptied when full.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sparkq.llm.arrays import IntTable

NO_RANK = np.int64(1) << 40


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes
    stand for themselves, the others follow from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def check_normalizer(normalizer: dict | None, path: str) -> None:
    """Refuse a file whose texts are prepared in another way than ``Counter.words`` does:
    NFC, white space collapsed, lower case."""
    steps = (normalizer or {}).get("normalizers", [normalizer or {}])
    kinds = [s.get("type") for s in steps]
    if kinds != ["NFC", "Replace", "Lowercase"] or steps[1] != {
        "type": "Replace",
        "pattern": {"Regex": r"\s+"},
        "content": " ",
    }:
        raise ValueError(f"{path}: texts are to be prepared by {kinds}, which is not supported")


@dataclass(frozen=True)
class Vocabulary:
    """Arrays of a tokenizer file: symbols of single bytes (inside and at the end of a
    word), and a table of symbol pairs with their ranks and what they merge to. The
    last rank is that of no pair."""

    inside: np.ndarray
    at_end: np.ndarray
    pairs: IntTable
    ranks: np.ndarray
    merged: np.ndarray
    special: tuple[str, ...]
    pattern: str

    @staticmethod
    def load(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        check_normalizer(whole.get("normalizer"), path)
        model = whole["model"]
        ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        codes = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        codes, rank = np.unique(codes, return_index=True)
        split = next(
            p["pattern"]["Regex"] for p in whole["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        return Vocabulary(
            np.array([ids[letters[b]] for b in range(256)], np.int64),
            np.array([ids[letters[b] + suffix] for b in range(256)], np.int64),
            IntTable.of(codes),
            np.append(rank, NO_RANK),
            made[rank],
            tuple(t["content"] for t in whole["added_tokens"] if not t["normalized"]),
            split,
        )


def merge_counts(vocabulary: Vocabulary, words: Sequence[bytes]) -> np.ndarray:
    """Symbols left of each word after all merges."""
    sizes = np.array([len(w) for w in words], np.int64)
    counts = sizes.copy()
    data = np.frombuffer(b"".join(words), np.uint8)
    symbols = vocabulary.inside[data]
    ends = np.cumsum(sizes)
    filled = sizes > 0
    symbols[ends[filled] - 1] = vocabulary.at_end[data[ends[filled] - 1]]
    word = np.flatnonzero(filled)
    sizes = sizes[filled]

    def slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return vocabulary.pairs.find((left << np.int64(32)) | right)

    empty = -1
    slot = np.full(len(symbols), empty)
    if len(symbols) > 1:
        slot[:-1] = slots(symbols[:-1], symbols[1:])
        slot[np.cumsum(sizes)[:-1] - 1] = empty
    while len(word):
        rank = vocabulary.ranks[slot]
        starts = np.cumsum(sizes) - sizes
        lowest = np.minimum.reduceat(rank, starts)
        # Words without a pair are done.
        going = lowest < NO_RANK
        if not going.all():
            counts[word[~going]] = sizes[~going]
            keep = np.repeat(going, sizes)
            symbols, slot, rank = symbols[keep], slot[keep], rank[keep]
            word, sizes, lowest = word[going], sizes[going], lowest[going]
            if not len(word):
                break
        of = np.repeat(np.arange(len(word)), sizes)
        chosen = rank == lowest[of]
        # Overlapping places of one pair: every other one, from the left.
        run = np.flatnonzero(chosen)
        fresh = np.ones(len(run), bool)
        fresh[1:] = run[1:] != run[:-1] + 1
        nth = np.arange(len(run)) - np.maximum.accumulate(np.where(fresh, np.arange(len(run)), 0))
        at = run[nth % 2 == 0]
        symbols[at] = vocabulary.merged[slot[at]]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        # A merged symbol inherits the place of its right half as to what follows.
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(sizes) - 1] = True
        last[at] = last[at + 1]
        np.subtract.at(sizes, of[at], 1)
        position = np.cumsum(keep) - 1
        symbols, slot, last = symbols[keep], slot[keep], last[keep]
        at = position[at]
        changed = np.zeros(len(symbols), bool)
        changed[at] = True
        changed[at[at > 0] - 1] = True
        touched = np.flatnonzero(changed)
        inner = touched[~last[touched]]
        slot[touched] = empty
        slot[inner] = slots(symbols[inner], symbols[inner + 1])
    return counts


# White space as the tokenizer's patterns see it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = re.compile(f"[{SPACE}]+")
# Characters that str.split takes for white space and the patterns do not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
# Words whose counts a worker remembers.
MEMO = 800_000
# Characters of text taken at a time.
SLICE = 2_000_000


class Counter:
    """Counts tokens of texts with a memo of words (pieces between white space)."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces = regex.compile(vocabulary.pattern.replace(r"\s", SPACE))
        marks = "|".join(map(re.escape, vocabulary.special))
        self.special = re.compile(marks) if marks else None
        self.memo: dict[str, int] = {}

    def words(self, text: str) -> tuple[list[str], int]:
        """The words of a text after normalising, and the special tokens beside them."""
        if self.special is None or "<" not in text:
            parts, specials = [text], 0
        else:
            parts = self.special.split(text)
            specials = len(parts) - 1
        out: list[str] = []
        for part in parts:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            low = part.lower()
            out += _SPACES.split(low) if any(c in low for c in _SEPARATORS) else low.split()
        return out, specials

    def learn(self, words: Iterable[str]) -> None:
        """Put the counts of new words into the memo."""
        plain: dict[str, int] = {}
        mixed: dict[str, list[str]] = {}
        for w in words:
            if w.isalpha():
                plain[w] = 0
                continue
            stem = w.rstrip(".,;:!?")
            mixed[w] = found = [stem, w[len(stem) :]] if stem.isalpha() else self.pieces.findall(w)
            plain.update(dict.fromkeys(found, 0))
        if not plain:
            self.memo.update(dict.fromkeys(mixed, 0))
            return
        counts = merge_counts(self.vocabulary, [p.encode("utf-8", "replace") for p in plain])
        plain = dict(zip(plain, counts.tolist()))
        self.memo.update(plain)
        for w, found in mixed.items():
            self.memo[w] = sum([plain[p] for p in found])

    def count(self, texts: Sequence[str | None]) -> list[int]:
        out: list[int] = []
        held: list[tuple[list[str], int]] = []
        size = 0

        def flush() -> None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            new: set[str] = set()
            for words, _ in held:
                new.update(words)
            new.difference_update(self.memo)
            self.learn(new)
            get = self.memo.__getitem__
            out.extend(sum(map(get, words)) + n for words, n in held)
            held.clear()

        for text in texts:
            held.append(self.words(text or ""))
            size += len(text or "")
            if size > SLICE:
                flush()
                size = 0
        flush()
        return out


def token_count(spark: SparkSession, text: Column, path: str) -> Column:
    """Tokens of each text under the tokenizer file at ``path``, as a long column."""
    # Arrays of a vocabulary, a few MB whatever the data.
    shared = spark.sparkContext.broadcast(Vocabulary.load(path))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(shared.value)
        for texts in batches:
            yield pd.Series(np.array(counter.count(texts.tolist()), np.int64))

    return count(text)
