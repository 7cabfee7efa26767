"""SentencePiece encoding and decoding as a max-plus parallel scan.

A text is a path over its character positions; each step is a piece, and a path weighs the
sum of its pieces' weights. Unigram models weigh pieces by their scores. BPE models allow a piece after
another only if merging the two pieces' characters gives just these two again, which leaves
one path, the one that merging the whole text gives; allowed steps weigh 0, others minus infinity.

A chunk of text does not know which piece runs over its start. It computes, for every piece
that may (the boundary state), the weights to every piece that may run over its end: a
max-plus matrix. Matrices of a document's chunks are combined from the left, which tells each chunk its
entry and exit states, and every chunk is traced back on its own.

Pieces never hold a space mark after another character. A mark that follows one therefore
starts a new run that nothing crosses; runs repeat and are encoded once per worker, and at such a
place the matrix has one state.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored
from tablewright.llm.units import CACHED, FIRST, LONGEST, Lookup

MARK = "▁"
#: Characters of a chunk (documents of one chunk need no scan), characters searched in one go
#: where there is no sure cut, rows worked on together.
CHUNK, BLOCK, ROWS = 1 << 16, 256, 1000
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_NEVER = -np.inf
_RUN = re.compile(f"(?<=[^{MARK}])(?={MARK})")


def _parsed(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message: number and value."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


#: A state at a place in the text: how far the piece over it reaches beyond, and that piece.
State = tuple[int, int]
#: The state where a path is free: at the ends of a text and at sure cuts.
FREE: State = (0, -1)


@dataclass
class Block:
    """Characters searched in one go, those after them, and the states at both ends.

    Exits are None where the path must end with the block.
    """

    text: str
    after: str
    entries: list[State]
    exits: list[State] | None

    @functools.cached_property
    def codes(self) -> np.ndarray:
        return np.frombuffer(self.text.encode("utf-32-le"), dtype="<u4").astype(np.int64)


def combined(a: dict[State, dict[State, float]], b: dict[State, dict[State, float]]) -> dict[State, dict[State, float]]:
    """Max-plus product of two matrices; it is associative."""
    out: dict[State, dict[State, float]] = {}
    for entry, row in a.items():
        found: dict[State, float] = {}
        for middle, weight in row.items():
            for leave, more in b.get(middle, {}).items():
                if weight + more > found.get(leave, _NEVER):
                    found[leave] = weight + more
        if found:
            out[entry] = found
    return out


def scanned(matrices: list[dict[State, dict[State, float]]], entry: State, leave: State | None = None) -> list[State]:
    """The states at all ends of a row of matrices on the best way from an entry to an exit."""
    front: dict[State, float] = {entry: 0.0}
    origins: list[dict[State, State]] = []
    for matrix in matrices:
        ahead: dict[State, float] = {}
        origin: dict[State, State] = {}
        for state, weight in front.items():
            for to, more in matrix.get(state, {}).items():
                if weight + more > ahead.get(to, _NEVER):
                    ahead[to], origin[to] = weight + more, state
        front = ahead
        origins.append(origin)
    states = [leave if leave is not None else max(front, key=lambda k: front[k])]
    for origin in reversed(origins):
        states.append(origin[states[-1]])
    return states[::-1]


class PieceModel:
    """The pieces of a model file, and the max-plus search over them."""

    def __init__(self, data: bytes):
        self.pieces, scores, kinds = [], [], []
        self.bpe, self.dummy, self.byte_ids, self.unknown = False, True, {}, 0
        for field, value in _parsed(data):
            if field == 1:
                piece = dict(_parsed(value))
                self.pieces.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), dtype="<f4")[0]))
                kinds.append(piece.get(3, 1))
            elif field == 2:
                self.bpe = dict(_parsed(value)).get(3, 1) == 2
            elif field == 3:
                spec = dict(_parsed(value))
                if spec.get(2) or spec.get(4, 1):
                    raise ValueError("the model's normalizer changes texts; only the identity is supported")
                self.dummy = bool(spec.get(3, 1))
        self.size = len(self.pieces)
        for i, (piece, kind) in enumerate(zip(self.pieces, kinds)):
            if kind == 6:
                self.byte_ids[int(piece[3:5], 16)] = i
            elif kind == 2:
                self.unknown = i
        usable = [i for i, kind in enumerate(kinds) if kind in (1, 4)]
        if any(MARK in self.pieces[i].lstrip(MARK) for i in usable):
            raise ValueError("a piece holds a space mark after another character")
        self.ids = {self.pieces[i]: i for i in usable}
        # one more id stands for a character that is no piece
        self.weights = np.zeros(self.size + 1)
        rank = np.array(scores, dtype=np.float64)
        if self.bpe:
            self._merges(-rank)
        else:
            self.weights[: self.size] = rank
            self.weights[self.size] = min(rank[usable]) - 10  # fixed value: what an unknown character costs
        self.longest = max((len(self.pieces[i]) for i in usable), default=1)
        if self.longest > min(BLOCK, CHUNK):
            raise ValueError("a piece is longer than a block")
        wanted = [i for i in usable if not self.bpe or self.whole[i]]
        hashes = np.array([self._hash(self.pieces[i]) for i in wanted], dtype=np.uint64).view(np.int64) & ((1 << 62) - 1)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces have one hash")
        self.lookup = Lookup(hashes, np.array(wanted))
        self.known: dict[str, np.ndarray] = {}

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_MULTIPLY) + ord(c) + 1) & ((1 << 64) - 1)
        return h

    def _merges(self, order: np.ndarray) -> None:
        """When a piece is made, of which two, and whether merging its own characters gives it."""
        keys, made = [], []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    made.append(i)
        self.pairs = dict(zip(keys, made))
        self.pair = Lookup(np.array(keys, dtype=np.int64), np.array(made, dtype=np.int64))
        self.order = np.append(order, np.inf)
        self.left, self.right = np.arange(self.size + 1), np.arange(self.size + 1)
        self.whole = np.zeros(self.size + 1, dtype=bool)
        for piece, i in self.ids.items():
            symbols, last = [self.ids.get(c, self.size) for c in piece], None
            while len(symbols) > 1:
                options = [(order[m], at, m) for at, pair in enumerate(zip(symbols, symbols[1:])) if (m := self.pairs.get(pair[0] << 20 | pair[1])) is not None]
                if not options:
                    break
                _, at, m = min(options)
                last = symbols[at], symbols[at + 1]
                symbols[at : at + 2] = [m]
            self.whole[i] = symbols == [i]
            if self.whole[i] and last:
                self.left[i], self.right[i] = last
        # a single character is there from the start
        self.order[[i for p, i in self.ids.items() if len(p) == 1]] = -1
        self.order[self.size] = -1

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of both pieces gives the two pieces again.

        Looks back in time from the finished pieces: undoing the later of their last merges shows
        the symbols that met at the border before. If these have a merge that came first (at
        equal order the left one does), it would have crossed the border.
        """
        good = np.ones(len(a), dtype=bool)
        at, x, y = np.arange(len(a)), a.copy(), b.copy()
        limit, strict = np.full(len(a), np.inf), np.zeros(len(a), dtype=bool)
        while len(at):
            met = self.pair(x << 20 | y)
            when = np.where(met >= 0, self.order[met], np.inf)
            crossed = (when < limit) | (~strict & (when == limit) & (met >= 0))
            good[at[crossed]] = False
            undo_x = self.order[x] > self.order[y]
            open_ = ~crossed & (np.maximum(self.order[x], self.order[y]) >= 0)
            at, x, y, undo_x = at[open_], x[open_], y[open_], undo_x[open_]
            limit, strict = np.where(undo_x, self.order[x], self.order[y]), undo_x
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def search(self, codes: np.ndarray, lengths: np.ndarray, start: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best weight, last piece and its start for every position of every row.

        Rows hold code points, filled up. A row's path begins at position ``start`` after the
        piece ``before`` (-1: none). Positions are reached in step for all rows.
        """
        n, width = codes.shape
        sums = np.zeros((n, width + 1), dtype=np.uint64)
        for i in range(width):
            sums[:, i + 1] = sums[:, i] * _MULTIPLY + codes[:, i].astype(np.uint64) + np.uint64(1)
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(self.longest, _MULTIPLY)]))
        best = np.full((n, width + 1), _NEVER)
        last = np.full((n, width + 1), -1, dtype=np.int64)
        back = np.zeros((n, width + 1), dtype=np.int32)
        best[np.arange(n), start] = 0
        last[np.arange(n), start] = before
        for end in range(1, width + 1):
            alive = np.flatnonzero((lengths >= end) & (start < end))
            for size in range(1, min(self.longest, end) + 1):
                rows = alive[best[alive, end - size] > _NEVER]
                if not len(rows):
                    continue
                hashes = sums[rows, end] - sums[rows, end - size] * powers[size]
                piece = self.lookup(hashes.view(np.int64) & ((1 << 62) - 1))
                if size == 1:
                    piece = np.where(piece < 0, self.size, piece)
                there = piece >= 0
                rows, piece = rows[there], piece[there]
                if self.bpe and len(rows):
                    prior = last[rows, end - size]
                    bound = prior >= 0
                    fits = np.ones(len(rows), dtype=bool)
                    fits[bound] = self.follows(prior[bound], piece[bound])
                    rows, piece = rows[fits], piece[fits]
                weight = best[rows, end - size] + self.weights[piece]
                better = weight > best[rows, end]
                rows = rows[better]
                best[rows, end], last[rows, end], back[rows, end] = weight[better], piece[better], end - size
        return best, last, back

    def entries(self, around: str, at: int) -> list[tuple[int, int]]:
        """Boundary states: (characters after the place, piece) of pieces that may run over it or end there."""
        out = []
        for begin in range(max(0, at - self.longest), at):
            for end in range(at, min(len(around), begin + self.longest) + 1):
                piece = self.ids.get(around[begin:end])
                if piece is None and end - begin == 1:
                    piece = self.size
                if piece is not None and (not self.bpe or piece == self.size or self.whole[piece]):
                    out.append((end - at, piece))
        return out

    def spelled(self, trace: list[int], text: str, ends: list[int]) -> list[int]:
        """Ids of a path; characters that are no piece become their bytes, or the unknown piece."""
        out = []
        for piece, end in zip(trace, ends):
            if piece < self.size:
                out.append(piece)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in text[end - 1].encode()]
            else:
                out.append(self.unknown)
        return out

    def runs(self, new: list[str]) -> list[np.ndarray]:
        """Ids of whole runs, searched together with others of like length."""
        out: list = [None] * len(new)
        order = sorted(range(len(new)), key=lambda i: len(new[i]))
        while order and len(new[order[-1]]) > BLOCK:
            i = order.pop()
            out[i] = self.stretch(new[i], FREE, "", FREE)
        at = 0
        while at < len(order):
            stop = at + 1
            width = len(new[order[at]])
            while stop < len(order) and stop - at < 20_000 and len(new[order[stop]]) <= width + 2 and (stop - at) * (width + 3) < 1 << 20:
                stop += 1
            some = order[at:stop]
            lengths = np.array([len(new[i]) for i in some])
            codes = np.zeros((len(some), int(lengths[-1])), dtype=np.int64)
            flat = np.frombuffer("".join(new[i] for i in some).encode("utf-32-le"), dtype="<u4")
            codes[np.arange(codes.shape[1]) < lengths[:, None]] = flat
            zero = np.zeros(len(some), dtype=np.int64)
            _, last, back = self.search(codes, lengths, zero, zero - 1)
            self._collect(some, new, lengths, last, back, out)
            at = stop
        return out

    def _collect(self, some: list[int], new: list[str], lengths: np.ndarray, last: np.ndarray, back: np.ndarray, out: list) -> None:
        """Traces all rows back in step."""
        end, steps = lengths.copy(), []
        rows = np.arange(len(some))
        while True:
            open_ = end > 0
            if not open_.any():
                break
            steps.append(np.where(open_, last[rows, end], -1))
            end = np.where(open_, back[rows, end], 0)
        if not steps:
            for i in some:
                out[i] = np.zeros(0, dtype=np.int32)
            return
        table = np.stack(steps[::-1], axis=1)
        kept = table >= 0
        odd = (table == self.size).any(axis=1)
        flat, stops = table[kept].astype(np.int32), np.cumsum(kept.sum(axis=1))
        starts = stops - kept.sum(axis=1)
        for k, i in enumerate(some):
            ids = flat[starts[k] : stops[k]]
            if odd[k]:
                ends = np.cumsum([len(self.pieces[p]) if p < self.size else 1 for p in ids.tolist()]).tolist()
                ids = np.array(self.spelled(ids.tolist(), new[i], ends), dtype=np.int32)
            out[i] = ids

    def marked(self, text: str) -> str:
        return ((MARK if self.dummy and text else "") + text).replace(" ", MARK)

    def split(self, marked: str) -> list[str]:
        """Runs that no piece crosses the ends of."""
        return _RUN.split(marked)

    def keys(self, text: str) -> list[str]:
        """The runs of a text: what follows a mark, or FIRST and a run that begins without one."""
        if self.dummy and text and text[0] != " " and "  " not in text and MARK not in text:
            return text.split(" ")
        marked = self.marked(text)
        return [r[1:] if r[0] == MARK else FIRST + r for r in self.split(marked)] if marked else []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, each a single chunk."""
        return self._encode([self.keys(t) for t in texts])

    def encode_marked(self, marked: str) -> np.ndarray:
        """Ids of marked text between two sure cuts."""
        return self._encode([[r[1:] if r[0] == MARK else FIRST + r for r in self.split(marked)] if marked else []])[0]

    def _encode(self, split: list[list[str]]) -> list[np.ndarray]:
        new = list(set().union(*split).difference(self.known))
        if len(self.known) + len(new) > CACHED:
            self.known = {}
            new = list(set().union(*split))
        runs = [k[1:] if k[:1] == FIRST else MARK + k for k in new]
        kind = np.uint16 if self.size <= 1 << 16 else np.int32
        self.known.update(zip(new, (i.astype(kind).tobytes() for i in self.runs(runs))))
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, s)), dtype=kind).astype(np.int32) for s in split]
        for key in new:
            if len(key) > LONGEST:
                del self.known[key]
        return out

    def matrices(self, blocks: list[Block]) -> list[dict[State, dict[State, float]]]:
        """The transfer matrix of each block, by entry and exit; impossible pairs are left out."""
        rows = [(i, entry) for i, block in enumerate(blocks) for entry in block.entries]
        size = np.array([len(blocks[i].text) for i, _ in rows])
        reach = np.array([entry[0] for _, entry in rows])
        inside = reach < size
        codes = np.zeros((len(rows), max(len(b.text) for b in blocks)), dtype=np.int64)
        for row, (i, _) in enumerate(rows):
            codes[row, : size[row]] = blocks[i].codes
        best, last, _ = self.search(codes, np.where(inside, size, 0), np.where(inside, reach, 0), np.array([entry[1] for _, entry in rows]))
        out: list[dict[State, dict[State, float]]] = [{} for _ in blocks]
        tried = []
        for row, (i, entry) in enumerate(rows):
            if not inside[row]:
                leave = (entry[0] - int(size[row]), entry[1])
                if blocks[i].exits is not None:
                    out[i][entry] = {leave: 0.0}
                elif leave[0] == 0:
                    out[i][entry] = {FREE: 0.0}
            elif blocks[i].exits is None:
                if best[row, size[row]] > _NEVER:
                    out[i][entry] = {FREE: float(best[row, size[row]])}
            else:
                begins = ((int(size[row]) + x[0] - self._long(x[1]), x) for x in blocks[i].exits)
                tried += [(row, i, entry, at, x) for at, x in begins if entry[0] <= at < size[row] and best[row, at] > _NEVER]
        if tried:
            prior = np.array([last[t[0], t[3]] for t in tried])
            fits = prior < 0
            if self.bpe:
                bound = np.flatnonzero(~fits)
                fits[bound] = self.follows(prior[bound], np.array([t[4][1] for t in tried])[bound])
            else:
                fits[:] = True
            for (row, i, entry, at, leave), good in zip(tried, fits):
                if good:
                    out[i].setdefault(entry, {})[leave] = float(best[row, at] + self.weights[leave[1]])
        return out

    def paths(self, blocks: list[tuple[Block, State, State]]) -> list[np.ndarray]:
        """Ids of the pieces that start in each block, given its entry and exit."""
        size = np.array([len(b.text) for b, _, _ in blocks])
        reach = np.array([entry[0] for _, entry, _ in blocks])
        inside = reach < size
        codes = np.zeros((len(blocks), int(size.max())), dtype=np.int64)
        for row, (block, _, _) in enumerate(blocks):
            codes[row, : size[row]] = block.codes
        _, last, back = self.search(codes, np.where(inside, size, 0), np.where(inside, reach, 0), np.array([entry[1] for _, entry, _ in blocks]))
        out = []
        for row, (block, entry, leave) in enumerate(blocks):
            if not inside[row]:
                out.append(np.zeros(0, dtype=np.int32))
                continue
            stop = int(size[row]) + leave[0]
            end, pieces, ends = (stop, [], []) if leave == FREE else (stop - self._long(leave[1]), [leave[1]], [stop])
            while end > entry[0]:
                pieces.append(int(last[row, end]))
                ends.append(end)
                end = int(back[row, end])
            out.append(np.array(self.spelled(pieces[::-1], block.text + block.after, ends[::-1]), dtype=np.int32))
        return out

    def blocks(self, text: str, entries: list[State], after: str, exits: list[State] | None) -> list[Block]:
        """A stretch of text as blocks of at most BLOCK characters, with the states between them."""
        out = []
        for at in range(0, len(text), BLOCK):
            stop = min(len(text), at + BLOCK)
            ahead = (text[stop : stop + self.longest] + after)[: self.longest]
            if stop < len(text):
                back = max(0, stop - self.longest)
                leave = self.entries(text[back:stop] + ahead, stop - back)
            else:
                leave = exits
            out.append(Block(text[at:stop], ahead, entries, leave))
            entries = leave
        return out

    def product(self, blocks: list[Block]) -> dict[State, dict[State, float]]:
        """The matrix of a stretch: its blocks' matrices combined."""
        found: dict[State, dict[State, float]] | None = None
        for some in (blocks[i : i + 64] for i in range(0, len(blocks), 64)):
            for matrix in self.matrices(some):
                found = matrix if found is None else combined(found, matrix)
        return found or {}

    def stretch(self, text: str, entry: State, after: str, leave: State) -> np.ndarray:
        """Ids of a stretch without a sure cut, given the states at its ends."""
        blocks = self.blocks(text, [entry], after, None if leave == FREE else [leave])
        if not blocks:
            return np.zeros(0, dtype=np.int32)
        matrices = [m for i in range(0, len(blocks), 64) for m in self.matrices(blocks[i : i + 64])]
        states = scanned(matrices, entry, leave)
        steps = list(zip(blocks, states, states[1:]))
        return np.concatenate([ids for i in range(0, len(steps), 64) for ids in self.paths(steps[i : i + 64])])

    def _long(self, piece: int) -> int:
        return len(self.pieces[piece]) if piece < self.size else 1

    def sure_cuts(self, before: str, chunk: str, after: str) -> tuple[int, int] | None:
        """The first and the last place in or at the ends of a chunk that no piece crosses."""
        whole = before + chunk + after
        found = [m.start() - len(before) for m in _RUN.finditer(whole, max(0, len(before) - 1), len(before) + len(chunk) + 1)]
        found = [p for p in found if 0 <= p <= len(chunk)]
        return (found[0], found[-1]) if found else None

    def transfer(self, before: str, chunk: str, after: str) -> dict[State, dict[State, float]]:
        """The matrix of a chunk. ``before`` and ``after`` are the characters around it, as many
        as a piece has at most; empty at the ends of the document. Between two sure cuts the path
        is the same whatever enters and leaves, so its weight is left out."""
        whole = before + chunk + after
        entries = self.entries(whole, len(before)) if before else [FREE]
        exits = self.entries(whole, len(before) + len(chunk)) if after else None
        cut = self.sure_cuts(before, chunk, after)
        if cut is None:
            return self.product(self.blocks(chunk, entries, after, exits))
        head = self.product(self.blocks(chunk[: cut[0]], entries, chunk[cut[0] :], None)) if cut[0] else {e: {FREE: 0.0} for e in entries if e[0] == 0}
        rest = chunk[cut[1] :]
        if rest:
            tail = self.product(self.blocks(rest, [FREE], after, exits))
        else:
            tail = {FREE: {x: 0.0 for x in exits or [FREE] if x[0] == 0}}
        return combined(head, tail)

    def traced(self, before: str, chunk: str, after: str, entry: State, leave: State) -> np.ndarray:
        """Ids of the pieces that start in a chunk, given its entry and exit."""
        cut = self.sure_cuts(before, chunk, after)
        if cut is None:
            return self.stretch(chunk, entry, after, leave)
        head = self.stretch(chunk[: cut[0]], entry, chunk[cut[0] :], FREE)
        middle = self.encode_marked(chunk[cut[0] : cut[1]])
        tail = self.stretch(chunk[cut[1] :], FREE, after, leave)
        return np.concatenate([head, middle, tail])

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: marks become spaces, the first one goes, bytes join to characters."""
        out, held = [], bytearray()
        by_id = self._bytes
        for i in ids:
            if (b := by_id.get(i)) is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held.clear()
            out.append(self._texts[i])
        if held:
            out.append(held.decode(errors="replace"))
        text = "".join(out)
        return text[1:] if self.dummy and text[:1] == " " else text

    @functools.cached_property
    def _bytes(self) -> dict[int, int]:
        return {i: b for b, i in self.byte_ids.items()}

    @functools.cached_property
    def _texts(self) -> list[str]:
        return [p.replace(MARK, " ") for p in self.pieces]


@functools.cache
def model(path: str) -> PieceModel:
    """One per worker and file; it stays for later tasks."""
    return PieceModel(Path(path).read_bytes())


_STATES = "no int, entry_reach int, entry_piece int, exit_reach int, exit_piece int"


def _chunked(long_: DataFrame, path: str) -> DataFrame:
    """Rows (key, no, before, chunk, after) of marked texts (key, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                marked = pieces.marked(text.as_py())
                starts = range(0, len(marked), CHUNK)
                for some in (starts[i : i + 16] for i in range(0, len(starts), 16)):
                    parts = [[marked[max(0, a - pieces.longest) : a] for a in some], [marked[a : a + CHUNK] for a in some], [marked[a + CHUNK : a + CHUNK + pieces.longest] for a in some]]
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(some)), pa.array([a // CHUNK for a in some], type=pa.int32()), *(pa.array(x) for x in parts)], ["key", "no", "before", "chunk", "after"])

    return long_.select("key", "text").mapInArrow(run, "key string, no int, before string, chunk string, after string")


def _giant(docs: DataFrame, path: str) -> DataFrame:
    """Rows (key, ids) of distinct long texts (key, text): chunk matrices, their scan, chunk paths."""
    chunks = stored(_chunked(docs, path), "chunks")
    names = ["key", "no", "entry_reach", "entry_piece", "exit_reach", "exit_piece", "weight"]

    def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            for key, no, before, chunk, after in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [(key, no, *a, *b, w) for a, row in pieces.transfer(before, chunk, after).items() for b, w in row.items()]
                kinds = [pa.string(), *[pa.int32()] * 5, pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(kinds)], names)

    def scan(table: pa.Table) -> pa.Table:
        found: dict[int, dict[State, dict[State, float]]] = {}
        for _, no, a, b, c, d, w in zip(*(table.column(n).to_pylist() for n in names)):
            found.setdefault(no, {}).setdefault((a, b), {})[c, d] = w
        states = scanned([found[no] for no in sorted(found)], FREE, FREE)
        rows = [(no, *a, *b) for no, a, b in zip(sorted(found), states, states[1:])]
        key = pa.array([table.column("key")[0].as_py()] * len(rows))
        return pa.Table.from_arrays([key, *(pa.array([r[i] for r in rows], type=pa.int32()) for i in range(5))], names[:6])

    def trace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            for key, no, before, chunk, after, a, b, c, d in zip(*(x.to_pylist() for x in batch.columns)):
                ids = pieces.traced(before, chunk, after, (a, b), (c, d))
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([no], type=pa.int32()), pa.array([ids], type=pa.list_(pa.int32()))], ["key", "no", "ids"])

    schema = "key string, " + _STATES
    # a document's matrices are a few states for each 65,536 characters of its one row
    states = chunks.mapInArrow(matrices, schema + ", weight double").groupBy("key").applyInArrow(scan, schema)
    placed = chunks.join(states, ["key", "no"]).select(*chunks.columns, *names[2:6])
    traced = placed.mapInArrow(trace, "key string, no int, ids array<int>")
    lists = traced.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts"))
    return lists.select("key", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def _parted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of one chunk (row, text), and giant ones (row, text, key)."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    small = F.length("text") < CHUNK
    return rows.where(small), rows.where(~small).select("row", "text", F.md5("text").alias("key"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Rows (row, ids): every document (all its columns) and the ids of its whole text.

    Null and empty texts have no ids. Repeated rows repeat; equal giant texts are searched
    once. Ids are those the library gives for the model file, begin and end signs left out.
    """
    short, giant = _parted(docs)
    fields = f"row {short.schema['row'].dataType.simpleString()}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                ids = pieces.encode(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, type=pa.list_(pa.int32()))], ["row", "ids"])

    found = _giant(giant.select("key", "text").dropDuplicates(["key"]), path)
    return short.mapInArrow(run, f"{fields}, ids array<int>").unionByName(giant.join(found, "key").select("row", "ids"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Rows (row, ids, decoded): the text of ids, as the library decodes them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                texts = [pieces.decode(ids or []) for ids in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, type=pa.string())], ["row", "ids", "decoded"])

    fields = f"row {encoded.schema['row'].dataType.simpleString()}"
    return encoded.select("row", "ids").mapInArrow(run, f"{fields}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Rows (row, n_pieces, ids_crc32, same): how many ids a text has, their checksum (as
    little-endian 32-bit numbers), and whether decoding them gives the text again.

    It does for every text without the space mark itself, which decodes to a space.
    """

    names = ["row", "n_pieces", "ids_crc32", "same"]

    def checked(rows: pa.Array, texts: list[str], ids: list[np.ndarray], pieces: PieceModel) -> pa.RecordBatch:
        same = [pieces.decode(x.tolist()) == t for x, t in zip(ids, texts)]
        sums = [zlib.crc32(x.astype("<i4").tobytes()) for x in ids]
        counts = pa.array([len(x) for x in ids], type=pa.int64())
        return pa.RecordBatch.from_arrays([rows, counts, pa.array(sums, type=pa.int64()), pa.array(same, type=pa.bool_())], names)

    def both(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                texts = batch.column(1).to_pylist()
                yield checked(batch.column(0), texts, pieces.encode(texts), pieces)

    def back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for whole in batches:
            for batch in (whole.slice(i, 16) for i in range(0, whole.num_rows, 16)):
                ids = [np.asarray(x.values.to_numpy(), dtype=np.int32) for x in batch.column(2)]
                yield checked(batch.column(0), batch.column(1).to_pylist(), ids, pieces)

    # ids of short texts are decoded in the worker that made them and never leave it
    short, giant = _parted(docs)
    schema = f"row {short.schema['row'].dataType.simpleString()}, n_pieces long, ids_crc32 long, same boolean"
    found = giant.join(_giant(giant.select("key", "text").dropDuplicates(["key"]), path), "key").select("row", "text", "ids")
    return short.mapInArrow(both, schema).unionByName(found.mapInArrow(back, schema))
