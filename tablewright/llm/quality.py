"""A quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model.

The model counts word trigrams of trusted documents, all of them; a word is a 64-bit number, and
every word of trusted text is known, however rare. A word never seen there has its shape's share of
the words seen once, divided by the number of different words of that shape. Counts and what
is made of them stay tables; buckets of documents and the model are dealt into shards by hash of the
n-gram, and each shard answers what every bucket asks of it. Documents above a quantile of
the perplexities of held-out trusted documents of their language are rejected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import discard, stored

#: One in so many trusted documents is held out of the counts to set the thresholds.
HELD_OUT = 5
#: Words of a language's median that a document's own are averaged with.
PRIOR = 20
#: Words after which a bucket of documents ends, words of the corpus to a shard, n-grams sent together.
BUCKET, SHARD, SENT = 1 << 20, 1 << 20, 1 << 20
#: The number before a text; no word has it.
BEGIN = 0
SHAPES = 8
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def shape(word: str) -> int:
    """The class of a word outside the vocabulary: by letters, case, end mark and other signs."""
    core = word.rstrip(",.;:!?")
    if not core.isalpha():
        return 7 if any(c.isdigit() for c in word) else 8
    kind = 2 if core.isupper() and len(core) > 1 else 1 if core[0].isupper() else 0
    return 1 + kind + 3 * (core != word)


def word_id(word: str) -> int:
    """64 bits: a hash of the word, and its shape in the lowest three."""
    return (xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) & ~7 | shape(word) - 1) or SHAPES


class Numbers(dict):
    """Numbers of words from 0 in the order they are met."""

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        return found


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def hashed(*columns: np.ndarray) -> np.ndarray:
    """What ``xxhash64`` gives for columns of long, as unsigned numbers."""
    out = np.full(len(columns[0]), 42, dtype=np.uint64)
    for column in columns:
        out = out + (_P5 + np.uint64(8)) ^ _turned(column.view(np.uint64) * _P2, 31) * _P1
        out = _turned(out, 27) * _P1 + _P4
        out = (out ^ out >> np.uint64(33)) * _P2
        out = (out ^ out >> np.uint64(29)) * _P3
        out = out ^ out >> np.uint64(32)
    return out


def _packed(ids: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def tokenized(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored rows (bucket, doc_id, digest, lang, lengths, words, ids, trusted, taught), one per bucket.

    A bucket is what one task reads, cut after BUCKET words: arrays with an entry per document, and
    its words once, by which the ids count. ``trusted`` and ``taught`` are places of documents: a document is
    trusted if all its labels say quality 1 and none says toxic, and taught unless held out.
    """
    names = ["bucket", "doc_id", "digest", "lang", "lengths", "words", "ids"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        table, held, total = Numbers(), [], 0

        def bucket() -> pa.RecordBatch:
            ids = np.concatenate([h[3] for h in held])
            known = np.fromiter(map(word_id, table), dtype=np.uint64, count=len(table))
            lengths = np.array([len(h[3]) for h in held], dtype="<u4")
            columns = [[task << 32 | number], *([[h[i] for h in held]] for i in range(3)), [lengths.tobytes()], [known.tobytes()], [_packed(ids)]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for doc, digest, text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or "").split()
                held.append((doc, digest, lang, np.fromiter(map(table.__getitem__, words), dtype=np.uint32, count=len(words))))
                total += len(words)
                if total >= BUCKET:
                    yield bucket()
                    table, held, total, number = Numbers(), [], 0, number + 1
        if held:
            yield bucket()

    schema = "bucket long, doc_id array<long>, digest array<long>, lang array<string>, lengths binary, words binary, ids binary"
    coded = stored(docs.select("doc_id", F.xxhash64("text").alias("digest"), "text", "lang").mapInArrow(run, schema), "coded")
    good = (F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)
    trust = labels.groupBy(F.col("doc_id").alias("_id")).agg(good.alias("good")).where("good").select("_id")
    places = coded.select("bucket", F.posexplode("doc_id").alias("at", "doc_id")).join(trust, F.col("doc_id") == F.col("_id"))
    marks = places.groupBy("bucket").agg(F.collect_list("at").alias("trusted"), F.collect_list(F.when(~_held_out(), F.col("at"))).alias("taught"))
    tokens = stored(coded.join(marks, "bucket", "left"), "tokens")
    discard(coded)
    return tokens


def _documents(row: dict) -> list[np.ndarray]:
    """The words of every document of a bucket, as numbers within it."""
    lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
    return np.split(_unpacked(row["ids"]).astype(np.int64), np.cumsum(lengths)[:-1])


def _flat(documents: list[np.ndarray], begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with two beginnings before each text, where words stand, and lengths."""
    lengths = np.array([len(d) for d in documents], dtype=np.int64)
    flat = np.full(int(lengths.sum()) + 2 * len(documents), begin, dtype=np.int64)
    word = np.ones(len(flat), dtype=bool)
    starts = np.cumsum(lengths + 2) - lengths - 2
    word[starts], word[starts + 1] = False, False
    flat[word] = np.concatenate(documents) if documents else begin
    return flat, np.flatnonzero(word), lengths


def trigram_counts(tokens: DataFrame) -> DataFrame:
    """Rows (u, v, w, n) over the documents that are trusted and not held out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                documents = _documents(row)
                flat, at, _ = _flat([documents[j] for j in sorted(row["taught"])], -1)
                known = np.append(np.frombuffer(row["words"], dtype=np.int64), BEGIN)
                near = flat + 1  # in the order words are met rows of one first word stay together
                keys = near[at - 2] << 42 | near[at - 1] << 21 | near[at] if len(known) <= 1 << 21 else hashed(near[at - 2], near[at - 1], near[at])
                _, one, n = np.unique(keys, return_index=True, return_counts=True)
                flat, at = known[flat], at[one]
                yield pa.RecordBatch.from_arrays([*(pa.array(flat[at - j]) for j in (2, 1, 0)), pa.array(n.astype(np.int64))], ["u", "v", "w", "n"])

    taught = tokens.where(F.size("taught") > 0).select("lengths", "words", "ids", "taught")
    return taught.mapInArrow(run, "u long, v long, w long, n long").groupBy("u", "v", "w").agg(F.sum("n").alias("n"))


def _held_out():
    return F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0


def _discounts(counts: DataFrame) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from how many n-grams have counts 1 to 4."""
    found = {r["n"]: r["k"] for r in counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}
    n1, n2, n3, n4 = (found.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return [min(max(d, 0.05), i) for i, d in enumerate(raw, 1)]


def _cut(counts: DataFrame) -> Column:
    d = _discounts(counts)
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def _orders(grams: DataFrame) -> list[DataFrame]:
    """Trigrams, bigrams and words as rows (its words, n, cut); lower orders count the different
    words before, and beginnings as often as they are."""
    grams = stored(grams, "trigrams")
    two = grams.groupBy("v", "w").agg(F.count("*").alias("_k"), F.sum("n").alias("_n"))
    two = stored(two.select("v", "w", F.when(F.col("v") == BEGIN, F.col("_n")).otherwise(F.col("_k")).alias("n")), "bigrams")
    one = stored(two.groupBy("w").agg(F.count("*").alias("n")), "unigrams")
    return [c.withColumn("cut", _cut(c)) for c in (grams, two, one)]


def _contexts(counts: DataFrame, *words: str) -> DataFrame:
    """How often each context is followed, and the share it hands down."""
    per = counts.groupBy(*words).agg(F.sum("n").alias("total"), F.sum("cut").alias("_cut"))
    return per.select(*words, "total", (F.col("_cut") / F.col("total")).alias("down"))


def open_model(grams: DataFrame) -> tuple[DataFrame, float, np.ndarray]:
    """Table (key, count, total, down) with discounted counts of n-grams, and apart from them totals and
    what is handed down of the contexts; the total of single words; and by shape the probability of a
    word without any count."""
    tri, two, one = _orders(grams)
    number = lambda c: F.col(c).cast("float")
    own = lambda df, *words: df.select(F.xxhash64(*words).alias("key"), (F.col("n") - F.col("cut")).cast("float").alias("count"), F.lit(0.0).cast("float").alias("total"), F.lit(0.0).cast("float").alias("down"))
    above = lambda df, *words: _contexts(df, *words).select(F.xxhash64(*words).alias("key"), F.lit(0.0).cast("float").alias("count"), number("total"), number("down"))
    parts = [own(tri, "u", "v", "w"), above(tri, "u", "v"), own(two, "v", "w"), above(two, "v"), own(one, "w")]
    shapes = one.groupBy(F.col("w").bitwiseAND(F.lit(SHAPES - 1)).alias("shape")).agg(
        F.count("*").alias("types"), F.sum((F.col("n") == 1).cast("long")).alias("once"), F.sum("n").alias("n"), F.sum("cut").alias("cut")
    )
    rows = {r["shape"]: r for r in shapes.collect()}  # one row for each shape
    total = sum(r["n"] for r in rows.values())
    once = np.array([1 + (rows[i]["once"] if i in rows else 0) for i in range(SHAPES)], dtype=float)
    types = np.array([1 + (rows[i]["types"] if i in rows else 0) for i in range(SHAPES)], dtype=float)
    down = sum(r["cut"] for r in rows.values()) / total if total else 1.0
    return reduce(DataFrame.unionByName, parts), max(total, 1), down * once / once.sum() / types


def _shards(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The parts of sorted keys that lie in each shard, by their highest bits."""
    if not bits:
        yield from [(0, slice(0, len(keys)))] if len(keys) else []
        return
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64)
    stops = np.flatnonzero(np.append(shard[1:] != shard[:-1], True)) + 1 if len(keys) else []
    start = 0
    for stop in stops:
        yield int(shard[start]), slice(start, int(stop))
        start = int(stop)


def _dense(values: np.ndarray) -> bytes:
    """Rows of numbers, four bytes each, by byte plane."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, dtype="<f4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _loose(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<f4").reshape(3, -1)


class Asked:
    """The n-grams of a bucket: of its trigrams, pairs and words each once, sorted by key."""

    def __init__(self, row: dict):
        self.flat, self.at, self.lengths = _flat(_documents(row), -1)
        words = np.append(np.frombuffer(row["words"], dtype=np.int64), BEGIN)
        self.shapes = words & SHAPES - 1
        whole = words[self.flat]
        at = self.at
        self.tri, self.tri_at = np.unique(hashed(whole[at - 2], whole[at - 1], whole[at]), return_inverse=True)
        self.pair, self.pair_at = np.unique(hashed(whole[:-1], whole[1:]), return_inverse=True)  # of a place and the next
        keys = np.concatenate([self.tri, self.pair, hashed(words)])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def logs(self, answers: np.ndarray, total: float, unseen: np.ndarray) -> np.ndarray:
        """Log probability of every word, of the answers (count, total, down) in order of keys."""
        found = np.empty((3, len(self.keys)))
        found[:, self.order] = answers
        tri, pair, word = np.split(found, [len(self.tri), len(self.tri) + len(self.pair)], axis=1)
        share = lambda count, of: count / np.maximum(of, 1)
        hand = lambda x: np.where(x[1] > 0, x[2], 1.0)
        single = word[0] / total + unseen[self.shapes]
        here, before = self.pair_at[self.at - 1], self.pair_at[self.at - 2]
        last, middle = self.flat[self.at], self.flat[self.at - 1]
        low = share(pair[0][here], word[1][middle]) + hand(word)[middle] * single[last]
        return np.log(share(tri[0][self.tri_at], pair[1][before]) + hand(pair)[before] * low)


def scored(tokens: DataFrame, model: DataFrame, total: float, unseen: np.ndarray) -> DataFrame:
    """Rows (doc_id, digest, lang, trusted, n_words, perplexity); null perplexity without words."""
    bits = (BUCKET * tokens.count() // SHARD).bit_length()
    ask_names, model_names = ["shard", "bucket", "keys"], ["shard", "keys", "numbers"]

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys = Asked(row).keys
                parts = [(s, keys[part].tobytes()) for s, part in _shards(keys, bits)]
                columns = [pa.array([s for s, _ in parts], type=pa.int64()), pa.array([row["bucket"]] * len(parts), type=pa.int64()), pa.array([k for _, k in parts], type=pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ask_names)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def dealt() -> pa.RecordBatch:
            columns = [np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(4)]
            keys = columns[0].view(np.uint64)
            order = np.argsort(keys)
            keys, numbers = keys[order], np.stack(columns[1:])[:, order]
            parts = [(s, keys[part].tobytes(), _dense(numbers[:, part])) for s, part in _shards(keys, bits)]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*parts), (pa.int64(), pa.binary(), pa.binary()))], model_names)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= SENT:
                yield dealt()
                held, n = [], 0
        if held:
            yield dealt()

    def answer(model: pa.Table, asked: pa.Table) -> pa.Table:
        keys = np.concatenate([np.zeros(0, dtype=np.uint64), *(np.frombuffer(k.as_buffer(), dtype=np.uint64) for k in model.column("keys"))])
        numbers = np.concatenate([np.zeros((3, 0), dtype="<f4"), *(_loose(x.as_py()) for x in model.column("numbers"))], axis=1)
        order = np.argsort(keys)
        keys, numbers = keys[order], numbers[:, order]
        if len(keys):  # an n-gram and the context it is have a row each
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys, numbers = keys[first], np.add.reduceat(numbers, first, axis=1)
        out = []
        for blob in asked.column("keys"):
            wanted = np.frombuffer(blob.as_buffer(), dtype=np.uint64)
            found = np.zeros((3, len(wanted)), dtype="<f4")
            if len(keys):
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                there = keys[at] == wanted
                found[:, there] = numbers[:, at[there]]
            out.append(_dense(found))
        return pa.Table.from_arrays([asked.column("shard"), asked.column("bucket"), pa.array(out, type=pa.binary())], ["shard", "bucket", "numbers"])

    coded = tokens.select("bucket", "lengths", "words", "ids")
    asked = coded.mapInArrow(ask, "shard long, bucket long, keys binary")
    dealt = model.mapInArrow(deal, "shard long, keys binary, numbers binary")
    answers = dealt.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(answer, "shard long, bucket long, numbers binary")
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("lang", pa.string()), ("trusted", pa.bool_()), ("n_words", pa.int64()), ("perplexity", pa.float64())])

    def score(documents: pa.Table, answers: pa.Table) -> pa.Table:
        row = documents.to_pylist()[0]
        asked = Asked(row)
        found = sorted(zip(answers.column("shard").to_pylist(), answers.column("numbers").to_pylist()))
        logs = asked.logs(np.concatenate([_loose(x) for _, x in found], axis=1), total, unseen)
        sums, stops, lengths = np.concatenate([[0.0], np.cumsum(logs)]), np.cumsum(asked.lengths), asked.lengths
        mean = (sums[stops] - sums[stops - lengths]) / np.maximum(lengths, 1)
        trusted = np.zeros(len(lengths), dtype=bool)
        trusted[np.array(row["trusted"] or [], dtype=np.int64)] = True
        columns = [row["doc_id"], row["digest"], row["lang"], trusted, lengths, pa.array(np.exp(-mean), mask=lengths == 0)]
        return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)

    spelled = "doc_id long, digest long, lang string, trusted boolean, n_words long, perplexity double"
    whole = tokens.select("bucket", "doc_id", "digest", "lang", "lengths", "words", "ids", "trusted")
    return whole.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(score, spelled)


def _by_language(held: DataFrame, rows: DataFrame, statistic, name: str, otherwise: float) -> DataFrame:
    """Adds a statistic of the held-out documents of each row's language; of all, if it has none."""
    per = held.groupBy(F.col("lang").alias("_lang")).agg(statistic.alias(name))
    whole = held.agg(statistic.alias("whole")).first()["whole"]
    rows = rows.join(per, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    return rows.withColumn(name, F.coalesce(name, F.lit(otherwise if whole is None else whole)))


def classified(docs: DataFrame, labels: DataFrame, quantile: float = 0.995) -> DataFrame:
    """Rows (doc_id, digest, lang, n_words, perplexity, score, threshold, keep), one per document.

    A few words say little, so the score is the perplexity after PRIOR further words of the
    language's median. The threshold of a language (null is one) is the ``quantile`` of the scores of its
    held-out trusted documents; a language without any takes that of all held-out documents, and without
    those everything with a word is kept. Documents without a word, null texts among them,
    have no perplexity and are rejected. ``digest`` tells apart texts of one doc_id. Labels
    may be null, repeat or contradict: then the document is not trusted.
    """
    tokens = tokenized(docs, labels)
    scores = stored(scored(tokens, *open_model(trigram_counts(tokens))), "scores")
    calm = lambda df: df.where(F.col("trusted") & _held_out() & F.col("perplexity").isNotNull())
    rows = _by_language(calm(scores), scores, F.percentile_approx("perplexity", 0.5, 10_000), "_usual", 1.0)
    logs = F.col("n_words") * F.log("perplexity") + PRIOR * F.log("_usual")
    rows = rows.withColumn("score", F.exp(logs / (F.col("n_words") + PRIOR)))
    cut = F.percentile_approx("score", quantile, 10_000)
    rows = _by_language(calm(rows), rows, cut, "threshold", float("inf"))
    keep = F.coalesce(F.col("score") <= F.col("threshold"), F.lit(False))
    return rows.select("doc_id", "digest", "lang", "n_words", "perplexity", "score", "threshold", keep.alias("keep"))
