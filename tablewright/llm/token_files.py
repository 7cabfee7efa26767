"""Files of token ids: frequency-ranked, byte-aligned, variable length, control bytes apart.

The ids of a corpus are numbered anew by falling frequency, so most of them fit one byte. Four
ids share a control byte that holds their lengths; data bytes follow in an array of their own.
A table of 256 rows gives the lengths and offsets that a control byte stands for, so
decoding is a few numpy lookups over whole blocks. A file set is a Parquet folder ``ids`` of
segments in ascending document order and a small folder ``ranks``.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cuts, discard, range_of, stored
from tablewright.llm.units import FIRST, UnitCache, spelled

#: Rows of a batch encoded together, texts looked up together, units joined into one call, ids aimed at in a segment.
ROWS, TEXTS, JOINED, SEGMENT = 1000, 32, 100, 1 << 24

_ENDS = (",", ".")
_LENGTHS = (np.arange(256)[:, None] >> (2 * np.arange(4)) & 3) + 1
_TOTALS = _LENGTHS.sum(axis=1)
_OFFSETS = np.cumsum(_LENGTHS, axis=1) - _LENGTHS
_KEPT = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def pack_all(lists: list[np.ndarray]) -> tuple[list[bytes], list[bytes]]:
    """Control and data bytes of lists of numbers below 2**32; each list's last four are filled up with zeros."""
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    fours = -(-sizes // 4)
    flat = np.concatenate(lists) if lists else np.zeros(0)
    starts = np.cumsum(fours) * 4 - fours * 4
    padded = np.zeros(int(fours.sum()) * 4, dtype="<u4")
    padded[np.arange(len(flat)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)] = flat
    lengths = 1 + (padded > 0xFF).astype(np.uint8) + (padded > 0xFFFF) + (padded > 0xFFFFFF)
    codes = (lengths - 1).reshape(-1, 4).astype(np.uint8)
    control = (codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6).tobytes()
    data = padded.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(fours)])
    places = np.concatenate([[0], np.cumsum(lengths.reshape(-1, 4).sum(axis=1, dtype=np.int64))])[ends].tolist()
    ends = ends.tolist()
    return [control[a:b] for a, b in zip(ends, ends[1:])], [data[a:b] for a, b in zip(places, places[1:])]


def unpack(control: bytes, data: bytes) -> np.ndarray:
    """The numbers, with the zeros that fill up the last four."""
    control = np.frombuffer(control, dtype=np.uint8)
    padded = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    starts = np.cumsum(_TOTALS[control]) - _TOTALS[control]
    at = (starts[:, None] + _OFFSETS[control]).ravel()
    words = padded[at].astype(np.uint32)
    for byte in (1, 2, 3):
        words |= padded[at + byte].astype(np.uint32) << np.uint32(8 * byte)
    return words & _KEPT[_LENGTHS[control].ravel()]


class IdEncoder:
    """Ids of texts by the tokenizers library, new units in calls of many."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.size = max(vocab.values()) + 1
        self.lengths = np.zeros(self.size, dtype=np.int64)
        for token, number in vocab.items():
            self.lengths[number] = len(token.encode()) if token in special else len(token)
        self.kind = "<u2" if self.size <= 1 << 16 else "<u4"
        encoded = ((e, self.tokenizer.encode(e, add_special_tokens=False).ids) for e in _ENDS)
        self.ends = {e: np.array(ids, dtype=self.kind).tobytes() for e, ids in encoded}
        self.cache = UnitCache(self.ids_of)

    def ids_of(self, new: list[str]) -> list[bytes]:
        """The ids of each unit.

        A comma or full stop after letters is a pre-token of its own, so such units are put together
        from two. Others are joined, and the byte lengths of tokens part them again.
        """
        known, out = self.cache.known, {}
        ended = [u for u in new if u[-1:] in _ENDS and u[:-1].isalpha()]
        plain = set(new).difference(ended)
        plain.update(c for c in {u[:-1] for u in ended} if c not in known)
        joined, alone = [], []
        for unit in plain:
            (alone if unit[:1] == FIRST or not unit[-1:].strip() else joined).append(unit)
        blocks = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)]
        texts = [" " + " ".join(block) for block in blocks] + [spelled(u) for u in alone]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for unit, encoding in zip(alone, found[len(blocks) :]):
            out[unit] = np.array(encoding.ids, dtype=self.kind).tobytes()
        for block, encoding in zip(blocks, found):
            ids = np.array(encoding.ids, dtype=self.kind)
            stops = np.cumsum([len(u.encode()) + 1 for u in block])
            at = np.searchsorted(np.cumsum(self.lengths[ids]), stops) + 1
            raw, width, start = ids.tobytes(), ids.itemsize, 0
            for unit, stop in zip(block, (at * width).tolist()):
                out[unit] = raw[start:stop]
                start = stop
        for unit in ended:
            core = out.get(unit[:-1])
            out[unit] = (known[unit[:-1]] if core is None else core) + self.ends[unit[-1]]
        return [out[u] for u in new]


@functools.cache
def encoder(path: str) -> IdEncoder:
    """One per worker and file; it stays for later tasks."""
    return IdEncoder(path)


def encode(docs: DataFrame, path: str, end: int = 0) -> DataFrame:
    """Rows (doc_id, n_tokens, ids, counts): ids of the whole text and the end id, compressed.

    Each task ends in a row of its own that holds nothing but how often it met each id.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path)
        last = np.array([end], dtype=encoding.kind).tobytes()
        press = zstandard.ZstdCompressor(level=1).compress
        seen = np.zeros(encoding.size, dtype=np.int64)
        names = ["doc_id", "n_tokens", "ids", "counts"]
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                raw = [b"".join(x) + last for x in encoding.cache.over(texts, TEXTS)]
                seen += np.bincount(np.frombuffer(b"".join(raw), dtype=encoding.kind), minlength=len(seen))
                sizes = pa.array([len(x) // len(last) for x in raw], type=pa.int64())
                packed = pa.array([press(x) for x in raw], type=pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), sizes, packed, pa.nulls(len(raw), pa.binary())], names)
        counts = pa.array([press(seen.tobytes())], type=pa.binary())
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), counts], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary, counts binary")


def _raw(ids: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), dtype=kind)


def write_ids(docs: DataFrame, path: str, folder: str, end: int = 0) -> None:
    """Encodes every whole text, appends the end id and writes the file set to ``folder``.

    Null texts count as empty and hold the end id alone. Documents are written in ascending
    doc_id order, nulls first, rows of one doc_id by their ids. Ranges of doc_id are written side by side;
    what is known of all of them are one sum for each range and one count for each id.
    """
    spark = docs.sparkSession
    whole = stored(encode(docs, path, end), "ids")
    coded = whole.where("ids IS NOT NULL").drop("counts")
    size, kind = encoder(path).size, encoder(path).kind

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                seen += _raw(packed.as_py(), "<i8")
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["id", "n"])

    counts = whole.where("counts IS NOT NULL").select("counts").mapInArrow(count, "id long, n long")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n"))
    order = Window.orderBy(F.desc("n"), "id")  # one row for each id of the vocabulary
    counts.select((F.row_number().over(order) - 1).alias("rank"), "id").write.parquet(f"{folder}/ranks")
    to_rank = np.zeros(size, dtype=np.uint32)
    for row in spark.read.parquet(f"{folder}/ranks").collect():
        to_rank[row["id"]] = row["rank"]

    total = coded.agg(F.sum("n_tokens")).first()[0] or 0
    at = cuts(coded, "doc_id", -(-total // SEGMENT))
    placed = coded.withColumn("segment", range_of(F.col("doc_id"), at))
    sums = {r["segment"]: r["n"] for r in placed.groupBy("segment").agg(F.sum("n_tokens").alias("n")).collect()}
    before = [sum(sums.get(j, 0) for j in range(i)) for i in range(len(at) + 1)]
    upto = Window.partitionBy("segment").orderBy("doc_id", "_tie").rowsBetween(Window.unboundedPreceding, 0)

    def shrink(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                packed = pack_all([to_rank[_raw(ids.as_py(), kind)] for ids in batch.column(3)])
                parts = [pa.array(p, type=pa.binary()) for p in packed]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *parts], ["segment", "doc_id", "n_tokens", "control", "data"])

    small = placed.select("segment", "doc_id", "n_tokens", "ids").mapInArrow(shrink, "segment int, doc_id long, n_tokens long, control binary, data binary")
    start = F.get(F.lit(before), F.col("segment")) + F.sum("n_tokens").over(upto) - F.col("n_tokens")
    rows = small.withColumn("_tie", F.xxhash64("control", "data")).withColumn("start", start).drop("_tie")
    rows.write.option("compression", "none").partitionBy("segment").parquet(f"{folder}/ids")
    discard(whole)


def read_ids(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of a file set, with the ids as an array if wanted."""
    ranks = spark.read.parquet(f"{folder}/ranks").collect()  # bounded by the vocabulary
    to_id = np.zeros(len(ranks) or 1, dtype="<u4")
    for row in ranks:
        to_id[row["rank"]] = row["id"]
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                n = batch.column(2).to_numpy()
                flat = to_id[unpack(b"".join(batch.column(3).to_pylist()), b"".join(batch.column(4).to_pylist()))]
                fours = -(-n // 4) * 4
                starts = np.cumsum(fours) - fours
                rows = [flat[a : a + k] for a, k in zip(starts.tolist(), n.tolist())]
                sums = pa.array([zlib.crc32(r.tobytes()) for r in rows], type=pa.int64())
                more = [pa.array(rows, type=pa.list_(pa.int64()))] if ids else []
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], sums, *more], names)

    schema = "segment int, doc_id long, n_tokens long, control binary, data binary, start long"
    there = spark.read.schema(schema).parquet(f"{folder}/ids").select("doc_id", "start", "n_tokens", "control", "data")
    return there.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)
