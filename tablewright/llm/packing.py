"""Packing of token sequences: dominance reduction, then best fit, planned on counts and applied in Spark.

Pieces of one length are alike, so an instance is its number of pieces of each length: a table no longer
than the capacity, however many documents there are. The reduction after Martello and Toth looks, from
the longest down, at what a piece can share a sequence with. If one small set is at least as good as any
other set with that piece, it is fixed for good, for as many copies as last. What cannot be decided
so is placed by best fit in falling length, again many copies at a time. The plan is a list of patterns with
their numbers; Spark ranks the pieces of each length and looks up which sequence and place each rank has.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import stored
from tablewright.llm.token_files import TEXTS, encoder

#: Rows of a batch encoded together, and pieces of one length and group that are ranked in one place.
ROWS, GROUP = 1000, 1 << 16
Pattern = tuple[tuple[int, int], ...]


def pieces(docs: DataFrame, path: str, capacity: int, end: int = 0, ids: bool = True) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) of whole texts, with the ids if wanted.

    Every text ends in the end id; a null one is empty. One longer than ``capacity`` is cut into pieces of it,
    the first of which holds what is left over.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path)
        last = np.array([end], dtype=encoding.kind).tobytes()
        width = len(last)
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                units = encoding.cache.over([t or "" for t in batch.column(1).to_pylist()], TEXTS)
                owners, numbers, starts, lengths, sums, lists = [], [], [], [], [], []
                for row, parts in enumerate(units):
                    raw = b"".join(parts) + last
                    if width == 2:
                        raw = np.frombuffer(raw, dtype="<u2").astype("<u4").tobytes()
                    n = len(raw) // 4
                    cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        own = raw[4 * a : 4 * b]
                        owners.append(row)
                        numbers.append(i)
                        starts.append(a)
                        lengths.append(b - a)
                        sums.append(zlib.crc32(own))
                        if ids:
                            lists.append(np.frombuffer(own, dtype="<u4").astype(np.int64))
                columns = [batch.column(0).take(pa.array(owners, type=pa.int64())), pa.array(numbers, type=pa.int32()), *(pa.array(x, type=pa.int64()) for x in (starts, lengths, sums))]
                columns += [pa.array(lists, type=pa.list_(pa.int64()))] if ids else []
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def reduced(counts: np.ndarray, capacity: int) -> tuple[list[tuple[Pattern, int]], np.ndarray]:
    """Sets fixed because they dominate, with how often, and the counts of what is left.

    For a piece j let k be how many of the shortest others fit beside it, and s the longest one that fits.
    With k = 0 j stays alone. If k = 1, or j and s fill a sequence, or k = 2 and s is no shorter than
    any two that fit together, then j and s are no worse than any other set with j. If k = 2 and the
    best two that fit are s and b, and no two longer than b fit, they are no worse either: of any
    two that fit, one is at most s and the other at most b. Taking copies away only removes
    sets, so a set once fixed stays right until a length of it runs out.
    """
    left, fixed = counts.astype(np.int64).copy(), []

    def shortest(without: int) -> list[int]:
        out = []
        for size in np.flatnonzero(left)[:4].tolist():
            out += [size] * min(3, int(left[size]) - (size == without))
        return out[:3]

    def best_two(sizes: np.ndarray, own: int, room: int) -> tuple[int, int] | None:
        """The longest pair (a, b), a >= b, that fits the room; of equal pairs the one with the longest a."""
        at = np.searchsorted(sizes, room - sizes, side="right") - 1
        best = None
        for a, i in zip(sizes.tolist(), at.tolist()):
            while i >= 0 and sizes[i] >= a and not (sizes[i] == a and left[a] - (a == own) >= 2):
                i -= 1
            if i >= 0:
                b = int(sizes[i])
                if left[b] - (b == own) > 0 and left[a] - (a == own) > 0 and (best is None or (a + b, a) > (best[0] + best[1], best[0])):
                    best = (a, b)
        return best

    def dominating(j: int) -> Pattern | None:
        room = capacity - j
        small = shortest(j)
        fit = int(np.searchsorted(np.cumsum(small), room, side="right")) if small else 0
        if not small or fit == 0:
            return ((j, 1),)
        there = np.flatnonzero(left[: room + 1])
        there = there[(there != j) | (left[there] > 1)]
        s = int(there[-1])
        if fit == 1 or s == room:
            return _as_pattern([j, s])
        if fit == 2:
            pair = best_two(there, j, room)
            if pair is None or s >= sum(pair):
                return _as_pattern([j, s])
            longer = [x for x in there[there > pair[1]].tolist() for _ in range(min(2, int(left[x]) - (x == j)))][:2]
            if pair[0] == s and (len(longer) < 2 or sum(longer) > room):
                return _as_pattern([j, *pair])
        return None

    again = True
    while again:
        again = False
        for j in range(capacity, 0, -1):
            while left[j] and (pattern := dominating(j)):
                times = min(int(left[size]) // copies for size, copies in pattern)
                for size, copies in pattern:
                    left[size] -= times * copies
                fixed.append((pattern, times))
                again = True
    return fixed, left


def _as_pattern(sizes: list[int]) -> Pattern:
    return tuple((size, sizes.count(size)) for size in sorted(set(sizes), reverse=True))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit in falling length, for all copies at a time: (pattern, how often).

    A piece goes where the least room is left that holds it. After that the same sequence is the
    fullest one that holds the next copy, so a sequence takes copies until it holds no more.
    """
    rooms: list[int] = []
    groups: dict[int, list[tuple[Pattern, int]]] = {}

    def put(room: int, pattern: Pattern, times: int) -> None:
        if room not in groups:
            bisect.insort(rooms, room)
            groups[room] = []
        groups[room].append((pattern, times))

    for size in range(capacity, 0, -1):
        n = int(counts[size])
        while n:
            at = bisect.bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else capacity
            if at < len(rooms):
                pattern, there = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                pattern, there = (), n
            most = room // size
            full = min(there, n // most)
            if full:
                put(room - most * size, (*pattern, (size, most)), full)
                n -= full * most
                there -= full
            if there and n and n < most:
                put(room - n * size, (*pattern, (size, n)), 1)
                n, there = 0, there - 1
            if there and pattern:
                put(room, pattern, there)
    return [x for found in groups.values() for x in found]


def planned(counts: Mapping[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns of lengths with how many sequences have each: fixed sets, then best fit of the rest."""
    table = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in counts.items():
        table[size] = n
    fixed, left = reduced(table, capacity)
    return fixed + best_fit(left, capacity)


def places(plan: list[tuple[Pattern, int]]) -> np.ndarray:
    """One row for each length in each pattern: (length, first rank, first sequence, copies, offset), sorted."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for size, copies in pattern:
            rows.append((size, taken.get(size, 0), sequence, copies, offset))
            taken[size] = taken.get(size, 0) + copies * times
            offset += size * copies
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, ids: bool = True) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), with the ids if wanted.

    Reads ``doc_id`` and ``text``; other columns may have any names. A null text counts as empty and is packed
    as its end id; very long texts are encoded whole and cut; repeated rows and doc_ids, null ones too, are
    packed each for itself; an empty table gives no rows. What reaches the driver is one number per length.
    Pieces of one length are ranked within groups by hash of doc_id and piece, about ``GROUP`` pieces each if
    all were of one length, so a length that many pieces share is spread out.
    """
    cut = stored(pieces(docs, path, capacity, end, ids), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = places(planned(counts, capacity))
    groups = max(64, -(-sum(counts.values()) // GROUP))
    spread = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).alias("group")
    sizes = cut.groupBy("length", spread).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "group", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "group").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("group", spread).withColumn("place", F.row_number().over(order))
    rank = (F.col("before") + F.col("place") - 1).alias("rank")
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"][:ids]]
    ranked = ranked.join(sizes, ["length", "group"]).select(*kept, rank)
    keys = plan[:, 0] << 48 | plan[:, 1]
    names = [*kept, "sequence_id", "offset"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(len(kept)).to_numpy()
            row = plan[np.searchsorted(keys, length << 48 | rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(sequence), pa.array(offset)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * ids
    return ranked.mapInArrow(run, schema + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """Rows (sequence_id, ids, doc_ids): the packed sequences themselves, from a packing with its ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    found = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return found.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
