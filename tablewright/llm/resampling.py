"""Importance resampling towards a target text distribution, with hashed n-gram features.

A feature is a run of one to three words; its bucket is the CRC-32 of its bytes modulo a number of buckets.
The distinct features of a batch are grouped by length into two-dimensional byte arrays, and all
checksums of an array advance together, one column at a time; buckets are then scattered back to
every occurrence. A document's weight is the sum of its features' gains, and Gumbel noise by document
makes the highest scores a draw without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import stored

#: Bytes of text taken together, words whose runs are hashed together, cells of a byte array, and the
#: longest feature that goes into one; the few longer ones are hashed one by one.
BYTES, WORDS, CELLS, WIDEST = 1 << 22, 1 << 19, 1 << 22, 512
#: Width of the score ranges by which the rank of a score is found.
STEP = 1024
_GAP = 32
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else _GAP for c in range(256)], dtype=np.uint8)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc_of_slices(text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of many slices of a byte array, those of one length side by side."""
    out = np.empty(len(start), dtype=np.uint32)
    order = np.argsort(length, kind="stable")
    sizes, first = np.unique(length[order], return_index=True)
    for size, low, high in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        own = order[low:high]
        if size > WIDEST:
            out[own] = [zlib.crc32(text[s : s + size]) for s in start[own].tolist()]
            continue
        many = max(1, CELLS // size)
        for i in range(0, len(own), many):
            part = own[i : i + many]
            cells = text[np.arange(size)[:, None] + start[part]]
            crc = np.full(len(part), 0xFFFFFFFF, dtype=np.uint32)
            for column in cells:
                crc = _CRC[(crc ^ column) & 0xFF] ^ (crc >> 8)
            out[part] = ~crc
    return out


class _Words(dict):
    """Numbers words by first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def feature_buckets(texts: Sequence[bytes], longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words in a run, text numbers, buckets) of all runs of up to ``longest`` words, repeats included.

    Arrays come for each length and each stretch of words, so that memory stays bounded
    for texts of any length. No run crosses from one text to the next.
    """
    raw = _FOLD[np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    inside = raw != _GAP
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return
    inside[ends] = True  # one space behind each word
    spaced = raw[inside]
    lengths = ends - starts
    at = np.cumsum(lengths + 1) - (lengths + 1)
    owner = np.searchsorted(begins, starts, side="right") - 1
    for low in range(0, len(at), WORDS):
        high = min(low + WORDS + longest - 1, len(at))
        begin, size, own = at[low:high], lengths[low:high], owner[low:high]
        codes = _Words()
        words = spaced[begin[0] : begin[-1] + size[-1]].tobytes().split(b" ")
        word = np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=len(words))
        run = word
        for n in range(1, longest + 1):
            if n > 1:
                there = len(run) - 1
                if there < 1:
                    break
                _, run = np.unique(run[:there] * len(codes) + word[n - 1 : n - 1 + there], return_inverse=True)
            first = np.zeros(int(run.max()) + 1, dtype=np.int64)
            first[run] = np.arange(len(run))
            last = first + n - 1
            crc = crc_of_slices(spaced, begin[first], begin[last] + size[last] - begin[first])
            # runs that start behind the stretch belong to the next one
            few = min(WORDS, len(run))
            whole = np.flatnonzero(own[:few] == own[n - 1 : n - 1 + few])
            yield n, own[whole], (crc % np.uint32(buckets)).astype(np.int64)[run[whole]]


def _batches(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Numbers and bytes of texts, about ``BYTES`` at a time; null is empty."""
    raw, held, first = texts.cast(pa.binary()), [], 0
    size = 0
    for i, text in enumerate(raw):
        text = text.as_py() or b""
        if held and size + len(text) > BYTES:
            yield first, held
            held, first, size = [], i, 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


def bucket_counts(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket: one number for each bucket reaches the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts in _batches(batch.column(0)):
                for _, _, bucket in feature_buckets(texts, longest, buckets):
                    seen += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "n"])

    found = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much more often a bucket is hit in the target than in the raw texts."""
    size = float(len(raw))
    a, b = float(raw.sum()), float(target.sum())
    ratio = [((t + 1.0) * (a + size)) / ((s + 1.0) * (b + size)) for s, t in zip(raw.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int, keep: Sequence[str] | None = None) -> DataFrame:
    """Rows (row, n_words, n_features, weight); ``row`` holds the columns to keep, all by default."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), "text")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_words long, n_features long, weight long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _batches(batch.column(1)):
                words, features, weight = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
                for n, owner, bucket in feature_buckets(texts, longest, len(gain)):
                    counted = np.bincount(owner, minlength=len(texts))
                    features += counted
                    words += counted if n == 1 else 0
                    weight += np.bincount(owner, weights=gain[bucket], minlength=len(texts)).astype(np.int64)
                parts = [pa.array(x) for x in (words, features, weight)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *parts], ["row", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, schema)


def _noise(key, seed: int):
    """floor(-1000 ln(-ln u)) with u from the digest of seed and key; a null key has an empty spelling."""
    spelled = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.conv(F.substring(F.sha2(spelled, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((digest + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    min_words: int = 20,
    longest: int = 3,
    buckets: int = 10_000,
    seed: int = 42,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Rows (row, n_words, n_features, weight, score, rank) for every document; ``rank`` is null if undrawn.

    ``row`` holds the document's columns, all or those in ``keep``, so no name can clash; it must hold
    ``doc_id``, which decides noise and ties (a null one comes first; rows equal in score and doc_id
    are ordered by weight and features and are alike otherwise). Null and empty texts have no features
    and weight 0. ``target`` needs ``text`` alone; an empty one leaves gains to the raw counts, an
    empty ``docs`` gives no rows. Texts are read whole, long ones in stretches of words. The draw takes
    ``percent`` of the documents of ``min_words`` words or more, rounded down.

    The rank of a score comes from counts: per range of scores, then per score inside a range, then rows of
    one score. Only scores that may be drawn are ordered, and no task orders them all.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    scored = weighed(docs, gain, longest, keep)
    scored = scored.withColumn("score", F.col("weight") + _noise(F.col("row.doc_id"), seed))
    scored = stored(scored, "weighed")
    able = F.col("n_words") >= min_words
    scores = stored(scored.where(able).groupBy("score").agg(F.count("*").alias("n")), "scores")
    drawn = percent * (scores.agg(F.sum("n")).first()[0] or 0) // 100
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.floor(F.col("score") / STEP).alias("part")
    ranges = scores.groupBy(part).agg(F.sum("n").alias("n"))
    ranges = ranges.select("part", before(Window.orderBy(F.desc("part"))).alias("above")).where(F.col("above") < drawn)
    starts = scores.withColumn("part", part).join(ranges, "part")
    inside = before(Window.partitionBy("part").orderBy(F.desc("score")))
    starts = stored(starts.select("score", (F.col("above") + inside).alias("above")).where(F.col("above") < drawn), "starts")
    least = starts.agg(F.min("score")).first()[0]
    hopeful = able & (F.col("score") >= least) if least is not None else F.lit(False)
    order = Window.partitionBy("score").orderBy(F.col("row.doc_id").asc_nulls_first(), "weight", "n_features")
    ranked = scored.where(hopeful).withColumn("place", F.row_number().over(order)).join(starts, "score")
    rank = F.col("above") + F.col("place")
    ranked = ranked.withColumn("rank", F.when(rank <= drawn, rank))
    names = ["row", "n_words", "n_features", "weight", "score", "rank"]
    rest = scored.where(~hopeful).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*names).unionByName(rest.select(*names))


def drawn(resampled: DataFrame) -> DataFrame:
    """The drawn documents with their own columns."""
    return resampled.where("rank IS NOT NULL").select("row.*")
