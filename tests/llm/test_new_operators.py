"""Collocations, packing and resampling against brute force, on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tablewright.llm import collocations, packing, resampling
from tablewright.llm.common import tokenizer_path

lowered = lambda text: re.sub("[A-Z]", lambda m: m[0].lower(), text or "")

# --- collocations ------------------------------------------------------------------------------


def _phrases(rows, threshold, best, absorb=100):
    """Phrases of (lang, text) rows by plain counting of every run."""
    counts, n = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            own.update(tuple(w[i : i + m]) for m in range(1, 6) for i in range(len(w) - m + 1))
    out = []
    for lang, own in counts.items():
        often = {p: a for p, a in own.items() if len(p) > 1 and a >= threshold}
        inside = {p[i : i + m] for p, a in often.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= absorb * own[p[i : i + m]]}
        found = []
        for p, a in often.items():
            if p not in inside:
                score, k = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for i, (s, a, p, x, y) in enumerate(sorted(found)[:best], 1):
            out.append((lang, i, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out)


def _langs(docs):
    return [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]


@pytest.mark.parametrize("threshold, shards, places, best, absorb", [(3, 4, 1 << 16, 2000, 100), (5, 3, 64, 7, 80), (2, 1, 1 << 16, 2000, 100)])
def test_collocations(spark, docs, monkeypatch, threshold, shards, places, best, absorb):
    monkeypatch.setattr(collocations, "BLOCK", 3000)
    monkeypatch.setattr(collocations, "SLICE", 900)
    monkeypatch.setattr(collocations, "HELD", 500)
    got = collocations.collocations(docs, threshold=threshold, best=best, absorb=absorb, shards=shards, places=places)
    expected = _phrases(_langs(docs), threshold, best, absorb)
    assert sorted(tuple(r) for r in got.collect()) == expected and len(expected) > 5


def test_ties_at_the_last_rank(spark):
    rows = [("en", f"a{i:02d} b{i:02d}. " * 4) for i in range(30)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(frame, threshold=4, best=5, shards=2)
    assert sorted(tuple(r) for r in got.collect()) == _phrases(rows, 4, 5)


def test_counts_of_one_last_word_are_handed_on_together():
    """Equal bytes stand together for the shuffle's compression; counts are the same in any order."""
    rng = np.random.default_rng(4)
    counts, want = collocations._Counts(), Counter()
    for _ in range(3):
        prefix, last = rng.integers(1, 60, 2000).astype(np.uint64), rng.integers(1, 25, 2000).astype(np.uint64)
        counts.add(2, np.ones(2000, dtype=np.int32), prefix, last, collocations.joined_key(prefix, last))
        want.update(zip(prefix.tolist(), last.tolist()))
    (batch,) = counts.rows()
    rows = batch.to_pydict()
    assert rows["last"] == sorted(rows["last"])
    assert dict(zip(zip(rows["prefix"], rows["last"]), rows["n"])) == want


def test_open_counts_take_few_bytes():
    """A phrase is handed on as the gap to the next hash and 16 bits of its last word: what both hashes take is never sent."""
    rng = np.random.default_rng(6)
    counts, want, tails = collocations._Open(3), Counter(), {}
    words = rng.integers(0, 1 << 63, 2000).astype(np.uint64) * np.uint64(2)
    for _ in range(4):
        last = words[rng.integers(0, 2000, 50_000)]
        key = collocations.joined_key(rng.integers(1, 20_000, 50_000).astype(np.uint64), last)
        counts.add(2, (key % np.uint64(3)).astype(np.int32), key, last)
        want.update(key.tolist())
        tails.update(zip(key.tolist(), (last & np.uint64(0xFFFF)).tolist()))
    one = np.array([7], dtype=np.uint64)
    counts.add(1, 0, one, one, np.array([1 << 40]))
    want[7], tails[7] = 1 << 40, 7
    (batch,) = counts.rows()
    parts = [(p, *collocations._unpacked(x)) for p, x in zip(*batch.to_pydict().values())]
    assert [p for p, *_ in parts] == list(range(8))
    got = {k: (p, kind, tail, n) for p, *columns in parts for k, kind, tail, n in zip(*(c.tolist() for c in columns))}
    assert got == {k: (k >> 61, 1 if k == 7 else k % 3 * 8 + 2, tails[k], n) for k, n in want.items()}
    assert batch.get_total_buffer_size() < 10 * len(want)
    assert not list(counts.rows())


def test_hash_of_a_pair_is_undone():
    rng = np.random.default_rng(8)
    prefix, last = (rng.integers(0, 1 << 64, 5000, dtype=np.uint64) for _ in range(2))
    assert (collocations.prefix_of(collocations.joined_key(prefix, last), last) == prefix).all()


def test_last_words_that_share_their_bits(spark):
    """Of several frequent words with the same tail the right one is found."""
    met, words, seed = {}, [], collocations.seed_of("en")
    for i in range(20_000):
        other = met.setdefault(xxhash.xxh64_intdigest(b"w%d" % i, seed) & 0xFFFF, i)
        words += [f"w{other}", f"w{i}"] if other != i and len(words) < 8 else []
    rng = random.Random(3)
    rows = [("en", " ".join(rng.choice(words) for _ in range(60))) for _ in range(60)]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), threshold=5, best=500, shards=2)
    expected = _phrases(rows, 5, 500)
    assert sorted(tuple(r) for r in got.collect()) == expected and len(expected) > 100


def test_languages_that_share_their_bits(spark):
    """Words of languages with the same tail are told apart by the blocks."""
    met, langs = {}, []
    for i in range(2000):
        other = met.setdefault(collocations.seed_of(f"l{i}") & 0xFFFF, i)
        langs = langs or ([f"l{other}", f"l{i}"] if other != i else [])
    rng = random.Random(4)
    rows = [(langs[i % 2], " ".join(rng.choice("abcd" if i % 2 else "cdefg") for _ in range(60))) for i in range(40)]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), threshold=5, best=500, shards=2)
    expected = _phrases(rows, 5, 500)
    assert sorted(tuple(r) for r in got.collect()) == expected and {r[0] for r in expected} == set(langs)


def test_no_collocations(spark, nothing):
    assert collocations.collocations(nothing).count() == 0
    rare = spark.createDataFrame([(None, None), ("en", ""), ("en", "a b c")], "lang string, text string")
    assert collocations.collocations(rare).collect() == []


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**12, 10**13, 3 * 10**12, 7 * 10**12)], "a long, n long, l long, r long")
    assert row.select(collocations.cut_score("a", "n", "l", "r")).first()[0] == 1000 * 10**25 // (21 * 10**24)


# --- packing -----------------------------------------------------------------------------------


def _fewest(sizes, capacity):
    """Fewest sequences by trying all placements."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= sizes[i]:
                at = rooms.index(room)
                place(i + 1, [*rooms[:at], room - sizes[i], *rooms[at + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


def test_reduction_keeps_the_optimum():
    rng, solved = random.Random(4), 0
    for _ in range(600):
        capacity = rng.randint(4, 25)
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        counts = np.bincount(sizes, minlength=capacity + 1)
        fixed, left = packing.reduced(counts, capacity)
        assert all(sum(s * c for s, c in p) <= capacity for p, _ in fixed)
        rest = [s for s in range(capacity + 1) for _ in range(left[s])]
        assert sum(n for _, n in fixed) + _fewest(rest, capacity) == _fewest(sizes, capacity)
        solved += not rest
    assert solved > 400


def test_best_fit_places_one_after_the_other():
    rng = random.Random(9)
    for _ in range(200):
        capacity = rng.randint(5, 60)
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 60))), reverse=True)
        rooms = []
        for size in sizes:
            fits = [r for r in rooms if r >= size]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else capacity) - size)
        plan = packing.best_fit(np.bincount(sizes, minlength=capacity + 1), capacity)
        got = sorted(capacity - sum(s * c for s, c in p) for p, n in plan for _ in range(n))
        assert got == sorted(rooms)


def test_plans_of_many_copies_stay_short():
    sizes = np.minimum(2048, np.random.default_rng(3).lognormal(5.5, 1.2, 50_000).astype(int) + 1)
    counts = {int(s): int(n) * 10**6 for s, n in zip(*np.unique(sizes, return_counts=True))}
    plan = packing.planned(counts, 2048)
    whole = sum(s * n for s, n in counts.items())
    assert sum(n for _, n in plan) * 2048 < 1.001 * whole and len(packing.places(plan)) < 20_000


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, docs, rows, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    found = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), capacity).persist()
    expected = Counter()
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()), tuple(ids[a:b])] += 1
    got = found.collect()
    assert Counter((*r[:5], tuple(r["ids"])) for r in got) == expected
    inside = {}
    for r in got:
        inside.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["ids"]))
    for parts in inside.values():
        parts.sort()
        assert [a for a, _, _ in parts] == np.cumsum([0, *(n for _, n, _ in parts[:-1])]).tolist()
        assert sum(n for _, n, _ in parts) <= capacity
    assert len(inside) <= 1.05 * math.ceil(sum(r["length"] for r in got) / capacity) + 1
    made = {r["sequence_id"]: r["ids"] for r in packing.sequences(found).collect()}
    assert made == {s: [i for _, _, ids in parts for i in ids] for s, parts in inside.items()}
    found.unpersist()


def test_packing_of_nothing(spark, nothing):
    assert packing.pack(nothing, tokenizer_path("byte_bpe_50k.json")).count() == 0


# --- resampling --------------------------------------------------------------------------------


def _features(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def _draw(rows, target, percent=5):
    found = [(d, *_features(t)) for d, t in rows]
    raw, wanted = Counter(), Counter()
    for _, _, f in found:
        raw.update(f)
    for t in target:
        wanted.update(_features(t)[1])
    a, b = sum(raw.values()) + 10_000, sum(wanted.values()) + 10_000
    gain = {x: math.floor(1000 * math.log((wanted[x] + 1) * a / ((raw[x] + 1) * b))) for x in raw}
    out = []
    for d, n, f in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f)
        out.append((d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    last = percent * len(able) // 100
    ranks = {}
    for i, r in enumerate(able[:last], 1):
        ranks.setdefault(r, []).append(i)
    return sorted((r, ranks[r].pop(0) if ranks.get(r) else None) for r in out if r[0] is not None)


@pytest.mark.parametrize("words, widest, percent", [(1 << 19, 512, 5), (40, 9, 60), (7, 3, 100)])
def test_resampling(spark, docs, rows, texts, monkeypatch, words, widest, percent):
    monkeypatch.setattr(resampling, "WORDS", words)
    monkeypatch.setattr(resampling, "WIDEST", widest)
    monkeypatch.setattr(resampling, "CELLS", 1 << 12 if words < 100 else 1 << 22)
    target = [texts[7], None, "", "rain of rain", texts[20]]
    frame = spark.createDataFrame([(t, "?") for t in target], "text string, doc_id string")
    got = resampling.resample(docs, frame, percent=percent)
    found = sorted(((r["row"]["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"]), r["rank"]) for r in got.collect() if r["row"]["doc_id"] is not None)
    expected = _draw(rows, target, percent)
    key = lambda x: (x[0], x[1] or 0)
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert set(resampling.drawn(got).columns) == set(docs.columns)


def test_resampling_without_rows(spark, nothing, docs):
    one = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(nothing, one).count() == 0
    none = one.where("text = ''")
    assert resampling.resample(docs, none).count() == docs.count()
    assert resampling.resample(one.withColumn("doc_id", F.lit(1)), one).first()["rank"] is None


def test_checksums_of_every_length():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 256, 5000, dtype=np.uint8)
    length = rng.integers(0, 700, 300)
    start = rng.integers(0, 5000 - 700, 300)
    got = resampling.crc_of_slices(text, start, length)
    assert got.tolist() == [zlib.crc32(text[s : s + n].tobytes()) for s, n in zip(start.tolist(), length.tolist())]


# --- queries -----------------------------------------------------------------------------------


def test_new_queries_on_tables(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = entry.queries()["op13_resampling"](spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    key = lambda x: x[0]
    expected = [(r[0], *r[2:], n) for r, n in _draw(docs, target)]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected, key=key)
    packed = entry.queries()["op12_packing"](spark, sf)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
