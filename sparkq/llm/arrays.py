"""A hash table of whole numbers that looks up many keys at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


@dataclass(frozen=True)
class IntTable:
    """Distinct keys from 0 on, with open addressing; ``find`` gives their places."""

    keys: np.ndarray
    places: np.ndarray
    probes: int

    @staticmethod
    def of(keys: np.ndarray) -> IntTable:
        size = 1 << max(4, (4 * len(keys)).bit_length())
        held, places, probes = np.full(size, -1, np.int64), np.full(size, -1, np.int64), 1
        for place, (key, slot) in enumerate(zip(keys.tolist(), _slots(keys, size).tolist())):
            tries = 1
            while held[slot] != -1:
                slot = (slot + 1) & (size - 1)
                tries += 1
            held[slot], places[slot] = key, place
            probes = max(probes, tries)
        return IntTable(held, places, probes)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key among the keys of the table, or -1."""
        size = len(self.keys)
        slot = _slots(keys, size)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for _ in range(self.probes):
            held = self.keys[slot]
            hit = held == keys[open_]
            out[open_[hit]] = self.places[slot[hit]]
            more = ~hit & (held != -1)
            open_, slot = open_[more], (slot[more] + 1) & (size - 1)
            if not len(open_):
                break
        return out
