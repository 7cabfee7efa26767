"""Near copies: texts whose sets of five-word shingles have a Jaccard likeness of 0.8 or more.

Candidates share one of BANDS independent fingerprints, each of ROWS least hashes; a pair of likeness
s is missed with probability (1 - s ** ROWS) ** BANDS, at 0.8 about 3 in 100,000. Every candidate is
held to the exact likeness of the two sets of 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import components, discard, stored
from tablewright.llm.simhash import shingle_hashes

BANDS, ROWS = 20, 4
#: Sets under one key that are compared pair by pair; more are dealt out in pairs of blocks of so many.
CROWD, BLOCK = 32, 128
#: Shingles of a block that are counted at once.
CELLS = 1 << 16
#: Shingles hashed at once.
AT_ONCE = 4096
_RANDOM = np.random.default_rng(42)
_XOR = _RANDOM.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64)
_TIMES = _RANDOM.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: bytes, words: int) -> np.ndarray:
    """The different shingle hashes of a text, sorted."""
    return np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *shingle_hashes(data, words)]))


def band_keys(found: np.ndarray) -> list[int]:
    """One number for each band; none for an empty set."""
    if not len(found):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), AT_ONCE):
        np.minimum(least, ((found[at : at + AT_ONCE, None] ^ _XOR) * _TIMES).min(axis=0), out=least)
    keys = [xxhash.xxh64_intdigest(least[i * ROWS : (i + 1) * ROWS].tobytes(), i) for i in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def _prints(docs: DataFrame, words: int) -> DataFrame:
    """Rows (doc_id, digest, set, keys); equal sets have equal numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, keys = [], []
            for text in batch.column(2):
                found = shingles(text.as_py() or b"", words)
                sets.append(xxhash.xxh64_intdigest(found.tobytes(), 0))
                keys.append(band_keys(found))
            columns = [*batch.columns[:2], pa.array(np.array(sets, dtype=np.uint64).view(np.int64)), pa.array(keys, type=pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "set", "keys"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest long, set long, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Rows (set, shingles) for wanted rows (set, id, of): one document and its digest stand for the set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py() or b"", words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=pa.binary())], ["set", "shingles"])

    texts = docs.select(F.xxhash64("text").alias("digest"), F.col("doc_id").alias("_id"), F.col("text").cast("binary").alias("text"))
    met = wanted.join(texts, (F.col("of") == F.col("digest")) & F.col("id").eqNullSafe(F.col("_id")))
    rows = met.select("set", "text").mapInArrow(run, "set long, shingles binary")
    return rows.dropDuplicates(["set"])


def _alike(pairs: DataFrame, sets: DataFrame, likeness: float) -> DataFrame:
    """Of pairs (a, b) those whose sets are alike enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for left, right in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (left, right))
                both = len(np.intersect1d(a, b, assume_unique=True)) if min(len(a), len(b)) >= likeness * max(len(a), len(b)) else 0
                near.append(both >= likeness * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(near, type=pa.bool_()))

    left, right = (sets.select(F.col("set").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def alike_within(sets: list[np.ndarray], likeness: float) -> tuple[list[int], list[int]]:
    """Numbers (a, b) of sets that are alike, enough of them to connect all that are.

    Shingles of one set alone cannot be shared, so only the others become columns; the product of
    the incidence matrix with itself counts what each two sets have in common.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, common = np.repeat(np.arange(len(sets)), sizes), np.cumsum(seen > 1) - 1
    shared = seen[column] > 1
    owner, column = owner[shared], common[column[shared]]
    both = np.zeros((len(sets), len(sets)))
    for low in range(0, int(column.max(initial=-1)) + 1, CELLS):
        own = (column >= low) & (column < low + CELLS)
        cells = np.zeros((len(sets), CELLS if low + CELLS <= column.max() else int(column.max()) + 1 - low), dtype=np.float32)
        cells[owner[own], column[own] - low] = 1
        both += cells @ cells.T
    near = both >= likeness * (sizes[:, None] + sizes - both)
    root, left, right = list(range(len(sets))), [], []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in np.argwhere(np.triu(near, 1)).tolist():
        x, y = top(a), top(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            left.append(a)
            right.append(b)
    return left, right


def _crowded(bands: DataFrame, counts: DataFrame, sets: DataFrame, likeness: float) -> DataFrame:
    """Links (a, b) among the sets under crowded keys (key, n), enough to connect all that are alike.

    Every two blocks of a key meet somewhere, so every two sets do; a meeting holds two blocks at most and
    returns fewer links than it has sets.
    """
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = bands.join(counts, "key").select("key", "set", parts.alias("parts"), F.pmod(F.xxhash64("set", "key"), parts).cast("int").alias("part"))
    meetings = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(j, F.col("part")) * F.lit(1 << 32) + F.greatest(j, F.col("part")))
    dealt = dealt.select("key", F.explode(meetings).alias("block"), "set")
    met = dealt.join(sets, "set").select("key", "block", "set", "shingles")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, held = None, [], []

        def linked() -> pa.RecordBatch:
            a, b = alike_within(held, likeness)
            return pa.RecordBatch.from_arrays([pa.array([names[i] for i in x], type=pa.int64()) for x in (a, b)], ["a", "b"])

        for batch in batches:
            for key, block, name, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, block) != at:
                    if len(held) > 1:
                        yield linked()
                    at, names, held = (key, block), [], []
                names.append(name)
                held.append(np.frombuffer(raw, dtype=np.uint64))
        if len(held) > 1:
            yield linked()

    return met.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(run, "a long, b long").distinct()


def near_copies(docs: DataFrame, words: int = 5, likeness: float = 0.8, groups: DataFrame | None = None) -> DataFrame:
    """Rows (doc_id, digest, component), one per document; texts without a word are alike.

    Reads ``doc_id`` and ``text``; other columns may have any names. Null and empty texts have no word; long
    ones are read whole; repeated rows keep their rows; an empty table gives no rows. Equal sets of shingles meet
    once. Every two sets that share a key are compared, pair by pair under most keys and block by block
    under crowded ones, so both ways find the same components. Documents of one of the ``groups`` (doc_id, digest,
    component) that another search found, such as SimHash, share a key as well and are held to the same likeness.
    """
    prints = stored(_prints(docs, words), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("first")
    distinct = prints.groupBy("set").agg(first, F.first("keys").alias("keys"))
    keyed = distinct.select("set", "first", F.explode("keys").alias("key"))
    if groups is not None:
        of = groups.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.xxhash64("component", F.lit("group")).alias("key"))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
        members = prints.select("doc_id", "digest", "set").join(of, same).select("set", "key").distinct()
        keyed = keyed.unionByName(distinct.select("set", "first").join(members, "set")).distinct()
    bands = stored(keyed, "bands")
    counts = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(bands.join(counts, "key").select("key", "n", "set", F.col("first.doc_id").alias("id"), F.col("first.digest").alias("of")), "shared")
    sets = stored(_sets(docs, shared.select("set", "id", "of").distinct(), words), "sets")
    few, many = shared.where(F.col("n") <= CROWD).select("key", "set"), shared.where(F.col("n") > CROWD).select("key", "set")
    crowds = shared.where(F.col("n") > CROWD).select("key", "n").distinct()
    pairs = few.withColumnRenamed("set", "a").join(few.withColumnRenamed("set", "b"), "key").where("a < b").select("a", "b").distinct()
    found = _alike(pairs, sets, likeness).unionByName(_crowded(many, crowds, sets, likeness))
    roots = components(found, "copies")
    for table in (bands, shared, sets):
        discard(table)
    placed = prints.select("doc_id", "digest", "set").join(roots, F.col("set") == F.col("node"), "left")
    return placed.select("doc_id", "digest", F.coalesce("root", "set").alias("component"))
