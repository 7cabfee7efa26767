"""Texts cut where byte-level pre-tokenization surely cuts, and tables for numpy lookups.

A space after a character that is no white space always starts a new pre-token, whatever
stands around. What lies between two such places is a unit; its tokens depend on nothing
else, so units seen before need not be tokenized again. Whole texts are covered.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np

#: Marks the unit that begins a text, which no space precedes. No valid text holds it.
FIRST = "\ud800"
#: Entries after which a cache starts anew, and the longest unit it keeps.
CACHED, LONGEST = 800_000, 64

_LOOSE = re.compile(r"(?<=\S)(?= )")
# fixed values: the white space characters
_WHITE = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)]
_BEFORE_SPACE = [w + " " for w in _WHITE]
_ASCII_BEFORE_SPACE = [w for w in _BEFORE_SPACE if w.isascii()]


def units(text: str) -> list[str]:
    """The units of a text; of all but the first, the leading space is left out."""
    if any(w in text for w in (_ASCII_BEFORE_SPACE if text.isascii() else _BEFORE_SPACE)):
        first, *rest = _LOOSE.split(text)
        return [FIRST + first, *(u[1:] for u in rest)]
    found = text.split(" ")
    found[0] = FIRST + found[0]
    return found


def spelled(unit: str) -> str:
    """The characters of a unit."""
    return unit[1:] if unit[:1] == FIRST else " " + unit


class UnitCache:
    """What a function makes of units, asked for many new units at once; of bounded size."""

    def __init__(self, make: Callable[[list[str]], Iterable]):
        self.make, self.known = make, {}

    def over(self, texts: list[str], step: int | None = None) -> list[list]:
        """For each text, what is made of its units, in order.

        ``step`` texts at a time are cut into units and looked up; few leave the strings in the processor's cache,
        many ask for more new units in one call.
        """
        if step and step < len(texts):
            return [x for i in range(0, len(texts), step) for x in self.over(texts[i : i + step])]
        split = [units(t) for t in texts]
        new = list(set().union(*split).difference(self.known)) if split else []
        if len(self.known) + len(new) > CACHED:
            self.known = {}
            new = list(set().union(*split))
        self.known.update(zip(new, self.make(new)))
        out = [list(map(self.known.__getitem__, s)) for s in split]
        for unit in new:
            if len(unit) > LONGEST:
                del self.known[unit]
        return out


class Lookup:
    """Whole numbers to whole numbers by open addressing, for arrays; -1 where there is none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(4 * len(keys)).bit_length()))
        self.mask = (1 << (64 - int(self.shift))) - 1
        self.keys = np.full(self.mask + 1, -1, dtype=np.int64)
        self.values = np.full(self.mask + 1, -1, dtype=np.int64)
        keys, values = np.asarray(keys, dtype=np.int64), np.asarray(values, dtype=np.int64)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == -1)
            _, one = np.unique(slot[free], return_index=True)
            placed = free[one]
            self.keys[slot[placed]], self.values[slot[placed]] = keys[placed], values[placed]
            left = np.setdiff1d(np.arange(len(keys)), placed)
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            there = self.keys[slot[open_]]
            same = there == keys[open_]
            out[open_[same]] = self.values[slot[open_[same]]]
            open_ = open_[~same & (there != -1)]
        return out
