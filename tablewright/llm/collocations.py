"""Collocations by dynamic itemset counting: phrases join a cyclic scan as soon as their parts are frequent.

Texts become blocks of word codes, dealt out to shards. Round r scans shard r modulo their number and counts
every phrase that is open: one whose first and last words but one have both reached the threshold in
an earlier round. A phrase stays open for one full cycle, so each shard is counted once for it, and lengths
interleave: longer phrases start while shorter ones are still being counted. The scan ends when a whole
cycle has passed in which nothing new reached the threshold.

Which round a phrase reached the threshold in is looked up in an array of fixed size by its hash. Two phrases
may share a place there; the later one then opens too early and is counted for its own full cycle all the
same, so results stay exact and only work is added. Words are told apart by 64-bit hashes of language
and spelling, phrases by a hash of the pair (hash of all words but the last, hash of the last). Open counts
are dealt by that hash, in sorted parts whose gaps are compressed, with 16 bits of the last word. The hash
of a pair can be undone where one half is known: of frequent words with those bits the last is the one that
leaves a frequent phrase.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import discard, stored
from tablewright.session import scratch_path

#: Word codes of a block, rows of a batch and bytes of text cut into words at once, and counts a task keeps before
#: it hands them on.
BLOCK, ROWS, SLICE, HELD = 1 << 19, 500, 1 << 20, 1 << 19
#: Places in the array of rounds (one byte each), whatever the number of phrases.
PLACES = 1 << 24
#: Words of the corpus to a part of the open counts.
DEALT = 1 << 21
_NEVER = 255
_TIMES = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: ``kind`` holds the number of words in its last three bits and the round a phrase opened in above them.
_ROW = "kind int, key long, tail int, n long"
_CLASSES = bytes(10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Codes(dict):
    """Numbers words by first use; 0 ends a piece and 1 is no word at all."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


class _Block:
    """Codes of texts of one language, gathered until there are enough for a row."""

    def __init__(self):
        self.codes, self.parts, self.tokens, self.size = _Codes(), [], 0, 0

    def add(self, text: bytes) -> None:
        found = text.replace(b"\n", b" \n ").split(b" ")
        codes = np.fromiter(map(self.codes.__getitem__, found), dtype=np.uint32, count=len(found))
        codes = codes[codes != 1]
        ends = codes == 0
        codes = codes[~(ends & np.concatenate([[False], ends[:-1]]))] if len(codes) else codes
        self.tokens += int(np.count_nonzero(codes))
        self.size += len(codes) + 1
        self.parts += [codes, np.zeros(1, dtype=np.uint32)]

    def row(self, shard: int, lang: str) -> list:
        words = list(self.codes)
        seed = seed_of(lang)
        hashes = np.array([0, 0, *(xxhash.xxh64_intdigest(w, seed) for w in words[2:])], dtype=np.uint64)
        packed = zstandard.ZstdCompressor(level=1).compress(np.concatenate(self.parts).tobytes())
        return [shard, lang, self.tokens, hashes.tobytes(), packed, b"\n".join(words[2:])]


def seed_of(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def joined_key(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all words but the last and that of the last."""
    x = prefix * np.uint64(_TIMES[0]) + last
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_TIMES[1])
    return x ^ (x >> np.uint64(29))


def prefix_of(key: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Undoes ``joined_key``: the hash of all words but the last."""
    back = [np.uint64(pow(x, -1, 1 << 64)) for x in _TIMES]
    x = (key ^ (key >> np.uint64(29)) ^ (key >> np.uint64(58))) * back[1]
    return ((x ^ (x >> np.uint64(32))) - last) * back[0]


def tail_of(last: np.ndarray) -> np.ndarray:
    """What open counts keep of the hash of a last word; for a single word, of that of its language."""
    return (last & np.uint64(0xFFFF)).astype(np.int32)


def place_of(key: np.ndarray, places: int) -> np.ndarray:
    bits = places.bit_length() - 1
    return ((key * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


def _slices(text: bytes) -> Iterator[bytes]:
    """The text in parts that end where a piece ends, so that none of a long one is held twice as words."""
    start = 0
    while start < len(text):
        stop = text.find(b"\n", start + SLICE)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop]
        start = stop


def coded_blocks(docs: DataFrame, shards: int) -> DataFrame:
    """Rows (shard, lang, tokens, hashes, codes, words): whole texts as codes, in blocks of one language."""
    names = ["shard", "lang", "tokens", "hashes", "codes", "words"]
    types = [pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, open_ = TaskContext.get().partitionId(), {}

        def rows(langs: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            for lang in langs:
                row = open_.pop(lang).row(made % shards, lang)
                made += 1
                yield pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in zip(row, types)], names)

        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            texts = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                texts.setdefault(lang, []).append((text or b"").translate(_CLASSES))
            for lang, found in texts.items():
                for part in _slices(b"\n".join(found)):
                    block = open_.setdefault(lang, _Block())
                    block.add(part)
                    if block.size >= BLOCK:
                        yield from rows([lang])
            if sum(b.size for b in open_.values()) > 2 * BLOCK:
                yield from rows(list(open_))
        yield from rows(list(open_))

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return texts.mapInArrow(run, "shard int, lang string, tokens long, hashes binary, codes binary, words binary")


class _Counts:
    """Counts of phrases a task has met; handed on in rows when there are many."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, words: int, start, prefix, last, key, n=None) -> None:
        """Copies inside the block are put together at once."""
        if n is None:
            key, at, n = np.unique(key, return_index=True, return_counts=True)
            start, prefix, last = start[at], prefix[at], last[at]
        kind = np.broadcast_to(np.asarray(start, dtype=np.int32) * 8 + words, key.shape)
        self.parts.append((kind, prefix, last, key, n))
        self.held += len(key)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        kind, prefix, last, key, n = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.held = [], 0
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        n = np.add.reduceat(n[order], first)
        at = order[first]
        # phrases of one last word, and in it of one kind, stand together: their equal bytes are what is compressed
        near = np.lexsort((kind[at], last[at]))
        at, n = at[near], n[near]
        columns = [kind[at].astype(np.int32), prefix[at].view(np.int64), last[at].view(np.int64), n.astype(np.int64)]
        for i in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 16)]) for c in columns], ["kind", "prefix", "last", "n"])


def _summed(key: np.ndarray, kind: np.ndarray, tail: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each phrase once, in order of its hash."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[first], kind[order[first]], tail[order[first]], np.add.reduceat(n[order], first) if len(first) else n


def _packed(key: np.ndarray, kind: np.ndarray, tail: np.ndarray, n: np.ndarray) -> bytes:
    """Counts in order of their hashes, as gaps; bytes of one weight stand together for compression."""
    columns = [(np.diff(key, prepend=np.uint64(0)), "<u8"), (n, "<u8"), (kind, "<u2"), (tail, "<u2")]
    planes = [c.astype(t).view(np.uint8).reshape(len(c), int(t[-1])).T.tobytes() for c, t in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(20, -1)
    column = lambda i, j, t: np.ascontiguousarray(planes[i:j].T).view(t).ravel()
    key = np.cumsum(column(0, 8, "<u8"), dtype=np.uint64)
    return key, column(16, 18, "<u2").astype(np.int32), column(18, 20, "<u2").astype(np.int32), column(8, 16, "<i8")


class _Open:
    """Counts of open phrases a task has met; handed on in parts by the highest bits of their hashes."""

    def __init__(self, bits: int):
        self.bits, self.parts, self.held = bits, [], 0

    def add(self, words: int, start, key: np.ndarray, last: np.ndarray, n=None) -> None:
        if n is None:
            key, at, n = np.unique(key, return_index=True, return_counts=True)
            start, last = start[at], last[at]
        self.parts.append((key, np.broadcast_to(np.asarray(start, dtype=np.int32) * 8 + words, key.shape), tail_of(last), n))
        self.held += len(key)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        columns = _summed(*(np.concatenate(x) for x in zip(*self.parts)))
        key, self.parts, self.held = columns[0], [], 0
        part = (key >> np.uint64(64 - self.bits)).astype(np.int32) if self.bits else np.zeros(len(key), dtype=np.int32)
        stops = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part))
        starts = np.append(0, stops[:-1])
        packed = [_packed(*(c[i:j] for c in columns)) for i, j in zip(starts, stops)]
        yield pa.RecordBatch.from_arrays([pa.array(part[starts]), pa.array(packed, type=pa.binary())], ["part", "open"])


def _scan(blocks: DataFrame, rounds, number: int, shards: int, longest: int, bits: int) -> DataFrame:
    """Counts, in one shard, of the phrases that are open in this round, in packed parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = np.frombuffer(zstandard.ZstdDecompressor().decompress(rounds.value), dtype=np.uint8)
        counts = _Open(bits)
        for batch in batches:
            for lang, raw, packed in zip(*(c.to_pylist() for c in batch.columns)):
                hashes = np.frombuffer(raw, dtype=np.uint64)
                codes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint32)
                if number < shards:
                    own = np.full(len(hashes) - 2, seed_of(lang), dtype=np.uint64)
                    counts.add(1, 0, hashes[2:], own, np.bincount(codes, minlength=len(hashes))[2:])
                of_word = reached[place_of(hashes, len(reached))].astype(np.int32)
                of_word[:2] = _NEVER
                when = of_word[codes]
                at = np.flatnonzero(when != _NEVER)
                key, when = hashes[codes[at]], when[at]
                for words in range(2, longest + 1):
                    two = np.flatnonzero(at[1:] == at[:-1] + 1)
                    start = 1 + np.maximum(when[two], when[two + 1])
                    at, prefix = at[two], key[two]
                    last = hashes[codes[at + words - 1]]
                    key = joined_key(prefix, last)
                    now = (start <= number) & (start > number - shards)
                    if now.any():
                        counts.add(words, start[now], key[now], last[now])
                    if words < longest:
                        # a phrase cannot have got there before the round it opened in
                        when = reached[place_of(key, len(reached))].astype(np.int32)
                        stay = when != _NEVER
                        at, key, when = at[stay], key[stay], np.maximum(when, start)[stay]
                if counts.held > HELD:
                    yield from counts.rows()
        yield from counts.rows()

    return blocks.select("lang", "hashes", "codes").mapInArrow(run, "part int, open binary")


def _added_up(met: DataFrame, number: int, shards: int, threshold: int) -> DataFrame:
    """Rows (part, open, often): counts that go on in the next round, and those that reached the threshold."""

    def run(rows: pa.Table) -> pa.Table:
        columns = _summed(*(np.concatenate(x) for x in zip(*(_unpacked(x.as_py()) for x in rows.column("open")))))
        chosen = [columns[1] >> 3 > number - shards + 1, columns[3] >= threshold]
        packed = [pa.array([_packed(*(c[x] for c in columns))], type=pa.binary()) for x in chosen]
        return pa.Table.from_arrays([rows.column("part").slice(0, 1), *packed], ["part", "open", "often"])

    return met.groupBy("part").applyInArrow(run, "part int, open binary, often binary")


def _spread(packed: DataFrame) -> DataFrame:
    """Packed counts as rows (kind, key, tail, n)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in (x for batch in batches for x in batch.column(0).to_pylist()):
            key, kind, tail, n = _unpacked(data)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (kind, key.view(np.int64), tail, n)], ["kind", "key", "tail", "n"])

    return packed.mapInArrow(run, _ROW)


def _bits_of(last: str) -> Column:
    return F.col(last).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("tail")


def _words(blocks: DataFrame, ones: DataFrame, seeds: DataFrame, places: int) -> DataFrame:
    """Rows (key, of): each frequent word and the hash of its language. Blocks are read for it only if languages share a tail."""
    known = seeds.select("of", _bits_of("of"))
    found = ones.join(known, "tail").select("key", "of")
    if known.groupBy("tail").count().where("count > 1").head(1):
        found = found.join(_of_language(blocks, ones.select("key"), places), ["key", "of"], "left_semi")
    return found


def _of_language(blocks: DataFrame, wanted: DataFrame, places: int) -> DataFrame:
    """Rows (key, of): the hash of the language of each wanted word, and of words that share their places."""
    needed = np.zeros(places, dtype=np.uint8)
    needed[_places(wanted, places)] = 1
    shared = _sent(blocks.sparkSession, needed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = np.frombuffer(zstandard.ZstdDecompressor().decompress(shared.value), dtype=np.uint8)
        for batch in batches:
            for lang, raw in zip(*(c.to_pylist() for c in batch.columns)):
                hashes = np.frombuffer(raw, dtype=np.uint64)[2:]
                hashes = hashes[needed[place_of(hashes, places)] > 0]
                of = np.full(len(hashes), seed_of(lang), dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(of)], ["key", "of"])

    return blocks.select("lang", "hashes").mapInArrow(run, "key long, of long")


def _with_prefix(rows: DataFrame) -> DataFrame:
    """Adds to (key, last) of phrases the hash of all words but the last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, last = (batch.column(batch.schema.get_field_index(c)).to_numpy().view(np.uint64) for c in ("key", "last"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prefix_of(key, last).view(np.int64))], [*batch.schema.names, "prefix"])

    return rows.select("key", "last", "words", "n").mapInArrow(run, "key long, last long, words int, n long, prefix long")


def _places(rows: DataFrame, places: int) -> np.ndarray:
    """Places of these phrases in the array of rounds: never more than there are places."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.unique(place_of(batch.column(0).to_numpy().view(np.uint64), places))
            yield pa.RecordBatch.from_arrays([pa.array(found)], ["place"])

    found = rows.select("key").mapInArrow(run, "place long").distinct().toArrow()
    return found.column("place").to_numpy()


def _sent(spark: SparkSession, places: np.ndarray):
    """An array over all places for every task, compressed: it is nearly empty while phrases are few."""
    return spark.sparkContext.broadcast(zstandard.ZstdCompressor(level=1).compress(places.tobytes()))


def frequent_phrases(blocks: DataFrame, threshold: int, longest: int, shards: int, places: int = PLACES) -> DataFrame:
    """Rows (kind, key, tail, n): every phrase of at most ``longest`` words that occurs ``threshold``
    times or more, single words included.

    Each round's open counts are a stored table, so a lost executor costs one round.
    """
    spark = blocks.sparkSession
    folder = scratch_path(spark, "phrases")
    spark.createDataFrame([], _ROW).write.parquet(folder)
    bits = ((blocks.agg(F.sum("tokens")).first()[0] or 0) // DEALT).bit_length()
    reached = np.full(places, _NEVER, dtype=np.uint8)
    words, start = F.col("kind").bitwiseAND(F.lit(7)), F.shiftright("kind", 3)
    previous, open_, number, news = None, None, 0, -1
    # a phrase that shares its place opens one round after its parts did, without a change of the array
    while number <= news + shards + max(0, longest - 2) and number < _NEVER:
        rounds = _sent(spark, reached)
        counts = _scan(blocks.where(F.col("shard") == number % shards), rounds, number, shards, longest, bits)
        met = counts if open_ is None else open_.unionByName(counts)
        sums = stored(_added_up(met, number, shards, threshold), "open")
        often = _spread(sums.select("often"))
        often.where(start == number - shards + 1).write.mode("append").parquet(folder)
        new = _places(often.where(words < longest), places)
        new = new[reached[new] == _NEVER]
        if len(new):
            reached = reached.copy()
            reached[new] = number
            news = number
        if previous is not None:
            discard(previous)
        previous, open_ = sums, sums.select("part", "open")
        rounds.destroy()
        del counts, met, sums, often
        # Spark deletes shuffle files once the driver's collector has found their plans gone
        spark._jvm.java.lang.System.gc()
        number += 1
    discard(previous)
    if number == _NEVER:
        raise ValueError(f"{number} rounds are not enough: take fewer shards")
    return spark.read.schema(_ROW).parquet(folder)


def _spelled(blocks: DataFrame, wanted: DataFrame, places: int) -> DataFrame:
    """Rows (last, word) for the wanted hashes of words."""
    needed = np.zeros(places, dtype=np.uint8)
    needed[_places(wanted.select(F.col("last").alias("key")), places)] = 1
    shared = _sent(blocks.sparkSession, needed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = np.frombuffer(zstandard.ZstdDecompressor().decompress(shared.value), dtype=np.uint8)
        for batch in batches:
            for raw, words in zip(*(c.to_pylist() for c in batch.columns)):
                hashes = np.frombuffer(raw, dtype=np.uint64)[2:]
                at = np.flatnonzero(needed[place_of(hashes, places)])
                words = words.split(b"\n")
                spelled = pa.array([words[i].decode() for i in at], type=pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(hashes[at].view(np.int64)), spelled], ["last", "word"])

    found = blocks.select("hashes", "words").mapInArrow(run, "last long, word string")
    return found.join(wanted, "last", "left_semi").groupBy("last").agg(F.min("word").alias("word"))


def _cuts(phrases: DataFrame) -> DataFrame:
    """One row for each way to cut a phrase: its key, k, and the keys of both parts."""

    def fold(hashes: np.ndarray) -> np.ndarray:
        key = hashes[:, 0]
        for i in range(1, hashes.shape[1]):
            key = joined_key(key, hashes[:, i])
        return key

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = batch.column(0).to_numpy(), batch.column(1)
            sizes = np.asarray(lists.value_lengths())
            flat, starts = lists.flatten().to_numpy().view(np.uint64), np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                hashes = flat[starts[own][:, None] + np.arange(size)]
                for k in range(1, size):
                    columns = [keys[own], np.full(len(own), k, dtype=np.int32), fold(hashes[:, :k]).view(np.int64), fold(hashes[:, k:]).view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "k", "left", "right"])

    return phrases.select("key", "hashes").mapInArrow(run, "key long, k int, left long, right long")


def cut_score(a: str, n: str, left: str, right: str):
    """floor(1000 a n / (l r)) in whole numbers of up to 38 digits."""
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    return F.expr(f"CAST(({wide(a)} * {wide(n)} * CAST(1000 AS DECIMAL(4, 0))) DIV ({wide(left)} * {wide(right)}) AS BIGINT)")


def collocations(
    docs: DataFrame, threshold: int = 100, longest: int = 5, best: int = 2000, absorb: int = 100, shards: int = 4, places: int = PLACES
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's ``best`` phrases.

    Reads ``text`` and ``lang`` of ``docs``; other columns may have any names. A null text counts as
    empty and a null lang as ``und``. Texts are read whole, long ones in slices that end where a
    piece ends. Repeated rows count again; an empty table, or one without frequent phrases, gives no rows.
    A phrase is dropped if it lies in one a word longer that has ``absorb`` percent of its occurrences;
    phrases longer still cannot occur more often, so they need no look of their own. Equal scores are ordered by
    occurrences, then by the phrase's bytes. More ``shards`` let longer phrases start earlier; each round
    shuffles the open counts once.
    """
    if not 2 <= longest <= 7:
        raise ValueError("phrases have two to seven words")
    spark: SparkSession = docs.sparkSession
    path = scratch_path(spark, "blocks")
    coded_blocks(docs, shards).write.partitionBy("shard").parquet(path)
    blocks = spark.read.schema("lang string, tokens long, hashes binary, codes binary, words binary, shard int").parquet(path)
    totals = stored(blocks.groupBy("lang").agg(F.sum("tokens").alias("n")), "totals")
    found = frequent_phrases(blocks, threshold, longest, shards, places).withColumn("words", F.col("kind").bitwiseAND(F.lit(7)))
    seeds = _seeds(totals)
    ones = stored(_words(blocks, found.where("words = 1").select("key", "tail"), seeds, places), "words")
    # another word of the same tail leaves a prefix that no phrase has
    pairs = _with_prefix(found.where("words > 1").join(ones.select(_bits_of("key"), F.col("key").alias("last")), "tail"))
    pairs = stored(pairs, "frequent")

    level = ones.select("key", F.array("key").alias("hashes"), "of")
    counts, phrases = found.select("key", "n"), None
    for words in range(2, longest + 1):
        shorter = level.select(F.col("key").alias("prefix"), "hashes", "of")
        longer = pairs.where(F.col("words") == words).join(shorter, "prefix")
        longer = longer.select("key", "prefix", F.concat("hashes", F.array("last")).alias("hashes"), "of", F.col("n").alias("a"))
        level = stored(longer, "phrases")
        phrases = level if phrases is None else phrases.unionByName(level)
    cuts = _cuts(phrases)
    # of a phrase, all words but the last, and all but the first, as whole phrases of their own
    inner = phrases.select(F.col("prefix").alias("key"), "a").unionByName(
        cuts.where("k = 1").join(phrases.select("key", "a"), "key").select(F.col("right").alias("key"), "a")
    )
    most = inner.groupBy("key").agg(F.max("a").alias("longer"))
    kept = phrases.join(most, "key", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < absorb * F.col("a")))
    cut = cuts.join(counts.select(F.col("key").alias("left"), F.col("n").alias("l")), "left").join(
        counts.select(F.col("key").alias("right"), F.col("n").alias("r")), "right"
    )
    scored = kept.join(seeds, "of").join(cut, "key").withColumn("score", cut_score("a", "n", "l", "r"))
    lowest = scored.groupBy("key", "lang", "n", "a", "hashes").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    lowest = lowest.select("key", "lang", "n", "a", "hashes", "cut.score", "cut.l", "cut.r")
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # equal ones at the end stay in until their spelling can tell them apart
    top = stored(lowest.withColumn("at", F.rank().over(place)).where(F.col("at") <= best), "best")
    parts = top.select("key", F.posexplode("hashes").alias("i", "last"))
    spelled = parts.join(_spelled(blocks, parts.select("last").distinct(), places), "last")
    texts = spelled.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
    named = top.join(texts.select("key", F.array_join(F.col("w")["word"], " ").alias("phrase")), "key")
    place = place.orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(place).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _seeds(totals: DataFrame) -> DataFrame:
    """Rows (of, lang, n): the hash of each language beside its name and its number of words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.array([seed_of(x) for x in batch.column(0).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(of), *batch.columns], ["of", "lang", "n"])

    return totals.select("lang", "n").mapInArrow(run, "of long, lang string, n long")
