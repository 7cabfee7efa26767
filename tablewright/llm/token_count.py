"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of arrays.

Pre-tokens of many texts lie end to end in one array. In each turn every pre-token applies
its pair of lowest rank, wherever it occurs in it, at the same time as all others; what is left when
no pair has a rank are its tokens.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.units import Lookup, UnitCache, spelled

# fixed value: the pattern that splits text before the merges of this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Rows of a batch that are counted together, and bytes of new pre-tokens merged together.
ROWS, BYTES = 1000, 1 << 20
_NONE = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from 256 up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class MergeCounter:
    """Counts the tokens of texts under the merges of a tokenizer file."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text())
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], dtype=np.int64) for i in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.rank = Lookup(left << 20 | right, np.arange(len(pairs)))
        self.start = np.array([vocab[c] for c in byte_letters()], dtype=np.int64)
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, specials)) + ")") if specials else None
        self.pattern = regex.compile(PATTERN)
        self.cache = UnitCache(self.counts)

    def merged(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols that survive in each pre-token."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        out = np.zeros(len(words), dtype=np.int64)
        symbols = self.start[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        rank = self._ranks(symbols, owner, np.arange(max(0, len(symbols) - 1)))
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            padded = np.append(rank, _NONE)
            best = np.minimum.reduceat(padded, first)
            sizes = np.diff(np.append(first, len(symbols)))
            done = best == _NONE
            out[owner[first[done]]] = sizes[done]
            if done.any():
                stay = np.repeat(~done, sizes)
                symbols, owner, padded = symbols[stay], owner[stay], padded[stay]
                best, sizes = best[~done], sizes[~done]
                if not len(symbols):
                    break
            at = np.flatnonzero(padded == np.repeat(best, sizes))
            at = at[(at - self._run_starts(at)) % 2 == 0]  # of x x x, the left two
            symbols[at] = self.made[padded[at]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, owner, rank = symbols[keep], owner[keep], padded[keep][:-1]
            at = at - np.arange(len(at))
            stale = np.unique(np.concatenate([at, at - 1]))
            stale = stale[(stale >= 0) & (stale < len(rank))]
            rank[stale] = self._ranks(symbols, owner, stale)
        return out

    @staticmethod
    def _run_starts(at: np.ndarray) -> np.ndarray:
        new = np.concatenate([[True], np.diff(at) != 1])
        return at[new][np.cumsum(new) - 1]

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        found = self.rank(symbols[at] << 20 | symbols[at + 1])
        return np.where((found >= 0) & (owner[at] == owner[at + 1]), found, _NONE)

    def counts(self, new: list[str]) -> list[int]:
        """Tokens of each unit; strings of special tokens count one each."""
        where: dict[str, int] = {}
        index, sizes, extra = [], [], []
        for unit in map(spelled, new):
            parts, specials = [unit], 0
            if self.special and self.special.search(unit):
                split = self.special.split(unit)
                parts, specials = split[::2], len(split) // 2
            words = [w for p in parts for w in self.pattern.findall(p)]
            index += [where.setdefault(w, len(where)) for w in words]
            sizes.append(len(words))
            extra.append(specials)
        per_word, held, size = [], [], 0
        for word in where:
            held.append(word.encode())
            size += len(held[-1])
            if size > BYTES:
                per_word.append(self.merged(held))
                held, size = [], 0
        per_word = np.concatenate([*per_word, self.merged(held)])
        sums = np.concatenate([[0], np.cumsum(per_word[np.array(index, dtype=np.int64)])])
        stops = np.cumsum(sizes, dtype=np.int64)
        return (sums[stops] - sums[stops - np.array(sizes, dtype=np.int64)] + np.array(extra)).tolist() if new else []

    def tokens(self, texts: list[str]) -> list[int]:
        return list(map(sum, self.cache.over(texts)))


@functools.cache
def counter(path: str) -> MergeCounter:
    """One per worker and file; it stays for later tasks."""
    return MergeCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one per document, in any order.

    Every whole text is counted; null counts as empty, with 0 bytes and 0 tokens. Repeated
    rows give repeated rows; a null doc_id stays null. ``path`` is a byte-level BPE file
    in JSON form that every worker has. There is no shuffle.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = counter(path)
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                found = counting.tokens([t or "" for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, type=pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    counted = docs.select("doc_id", "text", size).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
