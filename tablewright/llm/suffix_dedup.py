"""Removal of repeated passages with a logarithmic family of sparse suffix arrays.

A suffix is indexed if it starts at an anchor: the k-byte string of smallest hash in some
window of ``length`` bytes. Every window has one anchor, equal windows have equal anchors
at equal places, so two equal windows meet where their anchors' suffixes meet. A batch's
suffix array holds, sorted by anchor, one entry for each different stretch of text around an anchor
(all windows that share the anchor). It is merged with the existing levels in a sorted scan:

* a stretch seen before repeats as a whole, and its windows are all repeats;
* anchors whose stretches differ are contested: their windows are compared byte range by
  byte range at the end, with the text of just these stretches;
* levels of the batch's own size are merged with it in that same scan, so an index of n
  batches has at most log2(n) + 1 levels and writes each entry as often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cuts, delete, range_of, stored
from tablewright.session import scratch_path

#: Bytes of an anchor, and bytes of text worked on at once.
ANCHOR, PIECE = 24, 1 << 17
#: Contested stretches of one anchor compared inside one task; more are compared by a join.
TOGETHER = 4096
#: Bytes of text filed as one batch, and batches at least.
BATCH_BYTES, BATCHES = 1 << 38, 4
_MASK = np.uint64((1 << 19) - 1)
_BASE, _MIX = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
_LETTER = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_STRETCH = "key long, ctx long, doc long, pos long, left int, right int"


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_UP, _DOWN = _powers(_BASE, 2 * PIECE + 4096), _powers(_BACK, 2 * PIECE + 4096)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def _rolling(letters: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte strings, put together from those of halves."""
    powers, span, whole, done = {1: letters}, 1, None, 0
    while 2 * span <= k:
        h = powers[span]
        powers[2 * span] = h[:-span] * _UP[span] + h[span:]
        span *= 2
    for part in sorted(powers, reverse=True):
        if not k & part:
            continue
        h = powers[part]
        if whole is None:
            whole = h
        else:
            n = len(letters) - done - part + 1
            whole = whole[:n] * _UP[part] + h[done : done + n]
        done += part
    return _mixed(whole)


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while 2 * span <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if span < w else x


def stretches(buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of all windows inside the given parts of a buffer: (key, ctx, anchor, left, right, part).

    The windows of a stretch start ``left`` to ``right`` bytes before its anchor.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(buffer) < length:
        return (none,) * 6
    letters = _LETTER[buffer]
    key = _rolling(letters, ANCHOR)
    packed = (key & ~_MASK) | np.arange(len(key), dtype=np.uint64)
    at = (_window_min(packed, length - ANCHOR + 1) & _MASK).astype(np.int64)
    inside = np.zeros(len(at) + 1, dtype=np.int8)
    enough = stops - starts >= length
    np.add.at(inside, starts[enough], 1)
    np.add.at(inside, stops[enough] - length + 1, -1)
    p = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(p):
        return (none,) * 6
    anchor = at[p]
    new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(p) != 1)])
    low, high, anchor = p[new], p[np.concatenate([new[1:], [True]])], anchor[new]
    part = np.searchsorted(starts, low, side="right") - 1
    left, right = anchor - low, anchor - high
    sums = np.concatenate([[np.uint64(0)], np.cumsum(letters * _DOWN[: len(letters)])])
    ctx = (sums[high + length] - sums[low]) * _UP[low]
    ctx = _mixed(ctx + (left << 8 | right).astype(np.uint64) * _MIX)
    return key[anchor].view(np.int64), ctx.view(np.int64), anchor, left, right, part


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Buffers of whole short texts or pieces of long ones: (row, offset in text, start, stop) of each part."""
    held, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), PIECE):
            piece = text[offset : offset + PIECE + length - 1]
            held.append(piece)
            parts.append((row, offset, size, size + len(piece)))
            size += len(piece)
            if size >= PIECE:
                yield b"".join(held), parts
                held, parts, size = [], [], 0
    if held:
        yield b"".join(held), parts


def suffix_rows(docs: DataFrame, length: int) -> DataFrame:
    """Stretches of documents (doc, text); those repeated inside a batch of rows come as spans.

    Spans have ``span`` true, ``pos`` their start and ``left`` their length: copies are
    settled before anything is shuffled.
    """
    names = ["key", "ctx", "doc", "pos", "left", "right", "span"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            found = []
            for buffer, parts in _pieces([t or b"" for t in batch.column(1).to_pylist()], length):
                row, offset, start, stop = np.array(parts, dtype=np.int64).T
                key, ctx, anchor, left, right, part = stretches(np.frombuffer(buffer, dtype=np.uint8), start, stop, length)
                found.append((key, ctx, ids[row[part]], anchor - start[part] + offset[part], left, right))
            key, ctx, doc, pos, left, right = (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0, dtype=np.int64)] * 6
            order = np.lexsort((pos, doc, ctx, key))
            again = np.zeros(len(order), dtype=bool)
            again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (ctx[order[1:]] == ctx[order[:-1]])
            first = ~again
            doc2, start, stop = merged(doc[again], (pos - left)[again], (pos - right)[again] + length)
            zero = np.zeros(len(doc2), dtype=np.int64)
            salt = _mixed(doc2.astype(np.uint64) * _MIX + start.astype(np.uint64)).view(np.int64)
            columns = zip((key[first], ctx[first], doc[first], pos[first], left[first], right[first]), (salt, zero, doc2, start, stop - start, zero))
            arrays = [pa.array(np.concatenate(c)) for c in columns]
            spans = pa.array(np.arange(int(first.sum()) + len(doc2)) >= first.sum())
            arrays[4], arrays[5] = arrays[4].cast(pa.int32()), arrays[5].cast(pa.int32())
            yield pa.RecordBatch.from_arrays([*arrays, spans], names)

    return docs.select("doc", F.col("text").cast("binary").alias("text")).mapInArrow(run, _STRETCH + ", span boolean")


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans sorted and joined where they touch or overlap."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    other = np.concatenate([[True], doc[1:] != doc[:-1]])
    base = np.cumsum(other) * np.int64(1 << 40)  # keeps the running maximum inside a document
    reach = np.maximum.accumulate(stop + base) - base
    new = other | np.concatenate([[True], start[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(doc) - 1]])
    return doc[new], start[new], reach[last]


class SuffixLevels:
    """The index: levels of geometrically growing size, and what the scans have found.

    Batches are added in ascending document order; earlier is a smaller doc, then a smaller
    position. Levels are stored tables; the settled entries of one that was merged are deleted, those of the
    last levels by ``close``. Contested ones stay, as ``contested`` reads them.
    """

    def __init__(self, spark: SparkSession, length: int = 100):
        self.spark, self.length = spark, length
        self.levels: list[tuple[int, DataFrame, str]] = []
        self.scans: list[DataFrame] = []

    def add(self, docs: DataFrame) -> None:
        """Scans a batch (doc, text) against all levels and files it, merged with those of its size."""
        size, joining = 1, 0
        for have, _, _ in reversed(self.levels):
            if have != size:
                break
            size, joining = 2 * size, joining + 1
        stay = len(self.levels) - joining
        rows = suffix_rows(docs, self.length).withColumn("level", F.lit(-1))
        for number, (_, level, _) in enumerate(self.levels):
            rows = rows.unionByName(level.withColumn("span", F.lit(False)).withColumn("level", F.lit(number)))
        # one shuffle and one sort serve both windows
        rows = rows.repartition("key").sortWithinPartitions("key", "ctx", "doc", "pos")
        by_class = Window.partitionBy("key", "ctx").orderBy("doc", "pos")
        own = F.when(~F.col("span"), F.col("ctx"))
        around = Window.partitionBy("key")
        rows = rows.withColumn("first", ~F.col("span") & (F.row_number().over(by_class) == 1))
        rows = rows.withColumn("contested", F.min(own).over(around) < F.max(own).over(around))
        rows = rows.withColumn("contested", F.col("first") & F.coalesce("contested", F.lit(False)))
        fresh = F.col("level") == -1
        # a contested entry of a level that is not merged now is written as a witness only
        held = fresh | (F.col("level") >= stay)
        part = F.when(fresh & ~F.col("first"), F.lit("span")).when(F.col("contested"), F.lit("contested")).when(held, F.lit("settled"))
        path = scratch_path(self.spark, "suffixes")
        out = rows.withColumn("part", part).where("part is not null").withColumn("held", held)
        out.select("part", "key", "ctx", "doc", "pos", "left", "right", "span", "held").write.partitionBy("part").parquet(path)
        schema = f"{_STRETCH}, span boolean, held boolean, part string"
        scan = self.spark.read.schema(schema).parquet(path)
        self.scans.append(scan)
        level = scan.where("part in ('contested', 'settled') and held").select("key", "ctx", "doc", "pos", "left", "right")
        merged_now, self.levels = self.levels[stay:], [*self.levels[:stay], (size, level, path)]
        self._settle(merged_now)

    def close(self) -> None:
        """No batch comes after this."""
        self._settle(self.levels)
        self.levels = []

    def _settle(self, levels: list[tuple[int, DataFrame, str]]) -> None:
        for _, _, path in levels:
            delete(self.spark, f"{path}/part=settled")
        # Spark deletes shuffle files once the driver's collector has found their plans gone
        self.spark._jvm.java.lang.System.gc()

    def spans(self) -> DataFrame:
        """Spans (doc, start, stop) of repeated stretches whose text need not be seen."""
        whole = F.col("span")
        start = F.when(whole, F.col("pos")).otherwise(F.col("pos") - F.col("left"))
        stop = F.when(whole, F.col("pos") + F.col("left")).otherwise(F.col("pos") - F.col("right") + self.length)
        return self._all().where("part = 'span'").select("doc", start.alias("start"), stop.alias("stop"))

    def contested(self) -> DataFrame:
        """Stretches whose anchors have different ones: (key, doc, pos, left, right)."""
        return self._all().where("part = 'contested'").select("key", "doc", "pos", "left", "right").distinct()

    def _all(self) -> DataFrame:
        out = self.scans[0]
        for scan in self.scans[1:]:
            out = out.unionByName(scan)
        return out


def window_hashes(bytes_: list[bytes], left: np.ndarray, length: int) -> np.ndarray:
    """Hash of the window that starts 0, 1, ... bytes before the anchor, for each stretch."""
    reach = length - ANCHOR
    matrix = np.zeros((len(bytes_), reach + length), dtype=np.uint8)
    for i, (b, k) in enumerate(zip(bytes_, left.tolist())):
        matrix[i, reach - k : reach - k + len(b)] = np.frombuffer(b, dtype=np.uint8)
    sums = np.zeros((len(bytes_), reach + length + 1), dtype=np.uint64)
    np.cumsum(_LETTER[matrix] * _DOWN[: reach + length], axis=1, out=sums[:, 1:])
    begin = reach - np.arange(reach + 1)
    return _mixed((sums[:, begin + length] - sums[:, begin]) * _UP[begin])


def _windows(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, ...]:
    """Hashes and validity of all windows of a batch of (key, doc, pos, left, right, bytes)."""
    key, doc, pos, left, right = (batch.column(i).to_numpy().astype(np.int64) for i in range(5))
    hashes = window_hashes(batch.column(5).to_pylist(), left, length)
    back = np.arange(hashes.shape[1])
    return key, doc, pos, hashes, (back >= right[:, None]) & (back <= left[:, None])


def _compared(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Spans of windows seen earlier under the same anchor; rows sorted by key, doc, pos."""
    key, doc, pos, hashes, valid = _windows(batch, length)
    row, back = np.nonzero(valid)
    seen = hashes[row, back]
    order = np.lexsort((np.arange(len(row)), seen, key[row]))
    again = np.zeros(len(row), dtype=bool)
    a, b = order[1:], order[:-1]
    again[a] = (key[row[a]] == key[row[b]]) & (seen[a] == seen[b])
    start = pos[row[again]] - back[again]
    found = merged(doc[row[again]], start, start + length)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["doc", "start", "stop"])


def resolve(docs: DataFrame, contested: DataFrame, length: int) -> DataFrame:
    """Spans (doc, start, stop) of repeated windows among contested stretches.

    Stretches of an anchor meet in one task unless they are very many; those spread over
    the cluster by window, and the earliest of each window is found by a pre-aggregated minimum.
    """
    size = (F.col("left") - F.col("right") + length).cast("int")
    cut = F.substring(F.col("text").cast("binary"), (F.col("pos") - F.col("left") + 1).cast("int"), size).alias("bytes")
    rows = contested.join(docs, "doc").select("key", "doc", "pos", "left", "right", cut)
    rows = stored(rows, "contested")
    many = stored(rows.groupBy("key").count().where(F.col("count") > TOGETHER), "crowded").select("key")
    few = rows.join(many, "key", "left_anti").repartition("key").sortWithinPartitions("key", "doc", "pos")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            held = table.to_batches()[0] if table.num_rows else None
            if held is None:
                continue
            key = held.column(0).to_numpy()
            edges = np.flatnonzero(key[1:] != key[:-1]) + 1
            done = 0
            for stop in edges.tolist():
                if stop - done >= TOGETHER or stop == edges[-1]:
                    yield _compared(held.slice(done, stop - done), length)
                    done = stop
            held = held.slice(done)
        if held is not None and held.num_rows:
            yield _compared(held, length)

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, TOGETHER) for i in range(0, whole.num_rows, TOGETHER)):
                key, doc, pos, hashes, valid = _windows(batch, length)
                row, back = np.nonzero(valid)
                out = [key[row], hashes[row, back].view(np.int64), doc[row], pos[row] - back]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["key", "seen", "doc", "start"])

    spans = few.mapInArrow(compare, "doc long, start long, stop long")
    windows = rows.join(many, "key", "left_semi").mapInArrow(expand, "key long, seen long, doc long, start long")
    first = windows.groupBy("key", "seen").agg(F.min(F.struct("doc", "start")).alias("first"))
    later = windows.join(first, ["key", "seen"]).where(F.struct("doc", "start") > F.col("first"))
    return spans.unionByName(later.select("doc", "start", (F.col("start") + length).alias("stop")))


def numbered(docs: DataFrame) -> DataFrame:
    """Adds ``doc``, a number that orders the rows: the doc_id, where it tells them apart.

    If a doc_id repeats or is null, rows are numbered by doc_id (null first), then by text.
    """
    doubtful = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1)
    if doubtful.isEmpty():
        return docs.withColumn("doc", F.col("doc_id"))
    at = cuts(docs, "doc_id", 64)
    placed = docs.withColumn("_range", range_of(F.col("doc_id"), at))
    counts = {r["_range"]: r["count"] for r in placed.groupBy("_range").count().collect()}
    before = [sum(counts.get(j, 0) for j in range(i)) for i in range(len(at) + 1)]
    row = F.row_number().over(Window.partitionBy("_range").orderBy("doc_id", "text"))
    return stored(placed.withColumn("doc", (F.get(F.lit(before), F.col("_range")) + row).cast("long")).drop("_range"), "numbered")


def batches_of(docs: DataFrame) -> int:
    """How many batches a table is filed in: one for each BATCH_BYTES of text, BATCHES at least."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(BATCHES, -(-size // BATCH_BYTES))


def repeats(docs: DataFrame, length: int = 100, batches: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows (doc, row, text), spans (doc, start, stop)): what is to be removed from each text.

    A byte is repeated if a string of ``length`` bytes that covers it also starts earlier: in
    a document of smaller doc_id, or earlier in the same document. Texts count as UTF-8; a null
    text is empty, a text below ``length`` bytes has no repeats of its own. Documents of one
    doc_id, and those of none, are ordered by text, so of repeated rows one stays. ``row``
    holds the document with all its columns. Rows are filed in ``batches`` batches (by default those of
    ``batches_of``) by number; results do not depend on them.
    """
    struct = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = numbered(docs.select(F.col("doc_id"), F.col("text"), struct))
    index = SuffixLevels(docs.sparkSession, length)
    at = cuts(rows, "doc", batches or batches_of(docs))
    for number in range(len(at) + 1):
        batch = rows.where(range_of(F.col("doc"), at) == number) if at else rows
        index.add(batch.select("doc", "text"))
    index.close()
    texts = rows.select("doc", "text").where("doc is not null")
    spans = index.spans().unionByName(resolve(texts, index.contested(), length))
    return rows, spans


def removed(docs: DataFrame, length: int = 100, batches: int | None = None, keep_rows: bool = False) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), with ``row`` and the kept text
    (``kept``, cut to whole characters) if wanted; an empty table gives none. Other columns of the input,
    also those named like the result's, are left out or stay inside ``row``. A very long text is worked
    on in pieces, and its spans come from all of it."""
    rows, spans = repeats(docs, length, batches)
    lists = spans.groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    columns = ["doc", "doc_id", "text", *(["row"] if keep_rows else [])]
    joined = rows.where("doc is not null").select(*columns).join(lists, "doc", "left")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_rows
    carried = ["doc_id", *(["row"] if keep_rows else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [cut(t or b"", s or ()) for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())]
            columns = [pa.array([o[i] for o in out], type=t) for i, t in enumerate([pa.int64(), pa.int64(), pa.int64(), pa.string()])]
            kept = [pa.array([o[4].decode(errors="ignore") for o in out], type=pa.string())] if keep_rows else []
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *columns, *kept], carried + names)

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.select(*carried).schema.fields]
    schema += ["n_bytes long, n_removed long, n_spans long, kept_sha256 string"] + ["kept string"] * keep_rows
    texts = joined.withColumn("text", F.col("text").cast("binary")).select(*carried, "text", "spans")
    return texts.mapInArrow(run, ", ".join(schema))


def cut(text: bytes, spans: Iterable[dict]) -> tuple[int, int, int, str, bytes]:
    """Bytes, removed bytes, removed runs, digest of the rest, and the rest."""
    kept, at, runs, gone = [], 0, 0, 0
    reach = -1
    for span in spans:
        start, stop = span["start"], span["stop"]
        if start > reach:
            runs += 1
            kept.append(text[at:start])
            reach, at, gone = stop, stop, gone + stop - start
        elif stop > reach:
            gone += stop - reach
            reach = at = stop
    kept.append(text[at:])
    rest = b"".join(kept)
    return len(text), gone, runs, hashlib.sha256(rest).hexdigest(), rest
