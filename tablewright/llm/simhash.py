"""SimHash fingerprints and near-duplicate groups by multi-index hashing.

A fingerprint is cut into three segments. Two fingerprints at four or fewer differing bits
differ by at most one bit in one of the first two segments or not at all in the third: were it
otherwise, they would differ by 2 + 2 + 1 bits. So every fingerprint is filed under each
of its segments and looked up under each segment of its small Hamming balls; what meets
is compared over all 64 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import components, stored

SEED = 42
#: Segments as (lowest bit, bits, radius of the ball).
SEGMENTS = ((0, 23, 1), (23, 23, 1), (46, 18, 0))
#: A key under which more rows meet is split into blocks of about so many.
BLOCK = 2048
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20

_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def _pieces(data: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(data):
        cut = _BLANK.search(data, start + PIECE) if len(data) - start > PIECE else None
        stop = cut.start() if cut else len(data)
        yield data[start:stop]
        start = stop


def shingle_hashes(data: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``words`` words, repeats included; of all words if fewer."""
    digest, held, any_yet = xxhash.xxh64_intdigest, [], False
    for piece in _pieces(data.lower()):
        held += piece.split()
        if len(held) < words:
            continue
        any_yet = True
        line = b" ".join(held)
        stops = np.cumsum([len(w) + 1 for w in held])
        starts = [0, *stops[: len(held) - words].tolist()]
        stops = (stops[words - 1 :] - 1).tolist()
        yield np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64)
        held = held[len(held) - words + 1 :] if words > 1 else []
    if held and not any_yet:
        yield np.array([digest(b" ".join(held), SEED)], dtype=np.uint64)


def fingerprint(data: bytes, words: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; no word gives 0."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(data, words):
        total += len(hashes)
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for i in range(8):
            ones[8 * i : 8 * i + 8] += np.bincount(octets[:, i], minlength=256) @ _BITS
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist()))


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """Rows (doc_id, digest, fingerprint) for every document; a null text counts as empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py() or b"", words) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found.view(np.int64))], ["doc_id", "digest", "fingerprint"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest long, fingerprint long")


def _entries(prints: DataFrame) -> DataFrame:
    """Every fingerprint under its own segments (probe 0) and under those of its balls (probe 1).

    Balls only turn zeros to ones: of two segments one bit apart, one finds the other.
    """
    own, near = [], []
    for number, (low, bits, radius) in enumerate(SEGMENTS):
        key = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << bits) - 1))
        tag = number << 32
        own.append(F.struct(key.bitwiseOR(F.lit(tag)).alias("key"), F.lit(0).alias("probe")))
        for bit in range(bits if radius else 0):
            turned = F.struct(key.bitwiseOR(F.lit(tag | 1 << bit)).alias("key"), F.lit(1).alias("probe"))
            near.append(F.when(key.bitwiseAND(F.lit(1 << bit)) == 0, turned))
    each = F.explode(F.array_compact(F.array(*own, *near))).alias("e")
    return prints.select("fp", each).select("e.key", "e.probe", "fp")


def _linked(keys: np.ndarray, probe: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by key: a spanning forest of the links among rows of equal key."""
    at, left, right, step = np.arange(len(keys)), [], [], 0
    while True:
        step += 1
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        other = at + step
        differing = (prints[at] ^ prints[other]).view(np.uint64)  # of signed numbers the magnitude is counted
        near = np.bitwise_count(differing) <= distance
        near &= (probe[at] & probe[other]) == 0
        left.append(at[near])
        right.append(other[near])
    a = np.concatenate(left) if left else at
    b = np.concatenate(right) if right else at
    root = np.arange(len(keys))
    while len(a):
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        np.minimum.at(root, before, root)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(keys)))
    return prints[moved], prints[root[moved]]


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp), enough of them to connect
    all that are ``distance`` or fewer bits apart, directly or over others.

    A key under which many rows meet is dealt out in blocks, and every pair of blocks meets
    somewhere; each meeting returns fewer links than it has rows, never all its pairs.
    """
    if distance >= sum(radius + 1 for _, _, radius in SEGMENTS):
        raise ValueError("the segments find fingerprints at four or fewer differing bits")
    entries = _entries(prints)
    crowded = stored(entries.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "crowded")
    parts = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
    dealt = entries.join(crowded, "key", "left").withColumn("parts", parts)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp", "probe"), F.col("parts")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(j, F.col("part")) * F.lit(1 << 32) + F.greatest(j, F.col("part")))
    dealt = dealt.select("key", F.explode(pairs).alias("block"), "probe", "fp")
    dealt = dealt.repartition("key", "block").sortWithinPartitions("key", "block")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), dtype=np.int64)
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            held = np.concatenate([held, rows])
            new = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1)) + 1
            if len(new):
                yield found(held[: new[-1]])
                held = held[new[-1] :]
        if len(held):
            yield found(held)

    def found(rows: np.ndarray) -> pa.RecordBatch:
        starts = np.concatenate([[1], (rows[1:, :2] != rows[:-1, :2]).any(axis=1).astype(np.int64)])
        a, b = _linked(np.cumsum(starts), rows[:, 2], rows[:, 3], distance)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """Rows (doc_id, digest, fingerprint, component, component_id), one per document.

    component_id is the smallest doc_id that links of ``distance`` or fewer differing bits
    reach. Null and empty texts have fingerprint 0 and link like any other. A null doc_id
    keeps its row and is never a component's id unless the component has no other. Equal texts
    meet as one fingerprint before any search. ``component`` tells components apart and
    ``digest`` texts of one doc_id. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, words), "fingerprints")
    distinct = stored(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), distance), "simhash")
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = placed.join(least, "root").select("fp", F.col("root").alias("component"), "component_id")
    columns = ("doc_id", "digest", "fingerprint", "component", "component_id")
    return prints.join(placed, prints["fingerprint"] == placed["fp"]).select(*columns)
