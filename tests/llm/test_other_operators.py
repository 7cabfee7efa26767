"""Vectors, archives, mixing, quality and the pipeline, on awkward rows."""

import gzip
import math
from collections import Counter
from datetime import datetime, timedelta

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tablewright.llm import mixing, near_copies, quality, simhash, top_k, warc
from tablewright.session import scratch_path

# --- top-k -----------------------------------------------------------------------------------


def _vectors(seed, n=300, width=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).round(2)
    x[n // 3 : 2 * n // 3] = x[0]  # a third are copies
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def _best(vectors, k):
    whole = {i: [math.floor(1024 * v) for v in x] for i, x in vectors}
    out = set()
    for q in (i for i in whole if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("block", [16, 4096])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(top_k, "BLOCK", block)
    monkeypatch.setattr(top_k, "STEP", 7)
    vectors = _vectors(1)
    odd = [(1000, None), (1001, [1.0, None]), (1002, [float("nan")] * 12), (1003, [float("inf")]), (None, [1.0] * 12)]
    more = [(1100, [0.5]), (1200, []), (1300, [-3.0] * 20), vectors[0]]
    frame = spark.createDataFrame([(i, x, "?") for i, x in [*vectors, *odd, *more]], "vec_id long, embedding array<double>, rank string")
    got = top_k.top_k(frame, F.col("vec_id") % 100 == 0, k=10, head=3)
    assert {tuple(r) for r in got.collect()} == _best([*vectors, *more[:3]], 10)


def test_top_k_of_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (5, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_k.top_k(frame, F.col("vec_id") == 0).collect()] == [(0, 1, 5, 1024 * 2048)]
    assert top_k.top_k(frame.where("vec_id < 0"), F.col("vec_id") == 0).count() == 0


def test_top_k_of_huge_numbers(spark):
    frame = spark.createDataFrame([(0, [1e15, 1.0]), (1, [1e15, -1.0]), (2, [-1e15, 0.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in top_k.top_k(frame, F.col("vec_id") == 0).collect()]
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


# --- WARC ---------------------------------------------------------------------------------------

START = datetime(2024, 1, 1)


def _captures(spark, rows):
    full = [(r, k, u, None if t is None else START + timedelta(seconds=t), h, p, "?") for r, k, u, t, h, p in rows]
    return spark.createDataFrame(full, "record_id string, kind string, url string, time timestamp, headers map<string,string>, payload string, block string")


CRAWL = [
    ("r1", "response", "HTTP://Site.org:80/a?y=2&x=1#top", 10, {"etag": '"1"', "content-type": "text/html", "cache-control": "a"}, "body\r\n\r\none"),
    ("r2", "response", "http://site.org/a?x=1&y=2", 20, {"etag": '"2"', "last-modified": "Mon"}, "zwei ö"),
    ("r3", "response", "http://site.org/a?x=1&y=2", 30, {"etag": '"3"'}, None),
    ("v0", "revisit", "http://site.org/a?x=1&y=2", 10, {"etag": '"1"'}, None),
    ("v1", "revisit", "http://site.org/a?x=1&y=2", 15, {"etag": 'W/"1"', "content-type": "x", "cache-control": "b"}, None),
    ("v2", "revisit", "http://site.org/a?x=1&y=2", 25, {"etag": '"1"'}, None),
    ("v3", "revisit", "http://site.org/a?x=1&y=2", 29, {"last-modified": "Mon"}, None),
    ("v4", "revisit", "http://site.org/a?x=1&y=2", 99, {}, None),
    ("v5", "revisit", "http://other.org", 99, {"etag": '"1"'}, None),
    ("v6", "revisit", None, 99, {"etag": '"1"'}, None),
    ("v7", "revisit", "http://site.org/a?x=1&y=2", None, {"etag": '"3"'}, None),
]


def _outcomes(found):
    return {r["record_id"]: (r["response_id"], r["outcome"], r["headers"]) for r in found.collect()}


def test_archive_round_trip_and_revisits(spark):
    folder = scratch_path(spark, "warc")
    warc.write_warc(_captures(spark, CRAWL).repartition(3), folder)
    back = warc.read_warc(spark, folder)
    got = {r["record_id"]: r for r in back.collect()}
    assert len(got) == len(CRAWL)
    for record, kind, url, _, headers, payload in CRAWL:
        row = got[record]
        assert (row["kind"], row["url"], row["headers"], row["payload"]) == (kind, url, headers, (payload or "").encode())
    found = _outcomes(warc.resolve_revisits(back, carried=("payload",)))
    assert found["v0"][:2] == (None, "orphan")  # the response of the same second is not earlier
    assert found["v1"] == ("r1", "resolved", {"etag": 'W/"1"', "content-type": "text/html", "cache-control": "b"})
    assert found["v2"][:2] == ("r2", "mismatch")
    assert found["v3"] == ("r2", "resolved", {"etag": '"2"', "last-modified": "Mon"})
    assert found["v4"] == ("r3", "unvalidated", {"etag": '"3"'})
    assert {found[v][:2] for v in ("v5", "v6", "v7")} == {(None, "orphan")}


def test_damaged_archives_give_their_whole_records():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    broken = b"WARC/1.1\r\nContent-Length: x\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.records(broken + good + good[:-6])] == [b"abc"]
    assert list(warc.records(b"")) == []


def _record(block, name="x"):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{name}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("part", [1, 7, 1 << 20])
def test_compressed_archives_cut_or_damaged(monkeypatch, part):
    monkeypatch.setattr(warc, "PART", part)
    blocks = [bytes([i]) * (50 + 40 * i) + bytes(np.random.default_rng(i).integers(0, 256, 300, dtype=np.uint8)) for i in range(6)]
    members = [gzip.compress(_record(b)) for b in blocks]
    read = lambda data: [b for _, b in warc.records(data)]
    assert read(b"".join(members)) == read(gzip.compress(b"".join(map(_record, blocks)))) == blocks
    assert read(b"".join(members) + b"trailing junk") == blocks
    assert read(b"".join(members)[:-40]) == blocks[:5]
    assert read(gzip.compress(b"".join(map(_record, blocks)))[: len(b"".join(members[:4]))])[:3] == blocks[:3]
    torn = members[2][:30] + b"\xff" * 20 + members[2][50:]
    whole = read(b"".join([*members[:2], torn, *members[3:]]))
    assert whole[:2] == blocks[:2] and whole[-3:] == blocks[3:]
    short = read(b"".join([*members[:2], members[2][:100], *members[3:]]))
    assert short[:2] == blocks[:2] and short[-3:] == blocks[3:] and len(short) == 5
    assert read(b"\x1f\x8b") == read(b"\x1f\x8b\x08\x00junk") == []


def test_payloads_keep_their_bytes_and_damaged_files_the_rest(spark, tmp_path):
    image = bytes(range(256)) * 5
    block = b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n"
    whole = gzip.compress(_record(block + image, "a")) + gzip.compress(_record(block + image[::-1], "b"))
    (tmp_path / "1.warc.gz").write_bytes(whole)
    (tmp_path / "2.warc.gz").write_bytes(whole[:-30])
    (tmp_path / "3.warc.gz").write_bytes(b"")
    got = Counter((r["record_id"], bytes(r["payload"])) for r in warc.read_warc(spark, str(tmp_path)).collect())
    assert got == {("a", image): 2, ("b", image[::-1]): 1}
    back = scratch_path(spark, "warc")
    rows = [("i", "response", "http://a.b/", START, {"x": "y"}, image)]
    warc.write_warc(spark.createDataFrame(rows, "record_id string, kind string, url string, time timestamp, headers map<string,string>, payload binary"), back)
    assert bytes(warc.read_warc(spark, back).first()["payload"]) == image


def test_crowded_url_over_ranges_of_time(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i, t in enumerate(rng.permutation(400).tolist()):
        tag = {"etag": f'"{rng.integers(3)}"'}
        rows.append((f"x{i:03d}", "response" if rng.random() < 0.3 else "revisit", "http://hot.org/" if i % 3 else f"http://cold{i % 7}.org", t, tag, None))
    found = _outcomes(warc.resolve_revisits(_captures(spark, rows)))
    for record, kind, url, t, tag, _ in rows:
        if kind == "revisit":
            before = [r for r in rows if r[1] == "response" and warc_same(r[2], url) and r[3] < t]
            best = max(before, key=lambda r: r[3], default=None)
            expected = (None, "orphan") if best is None else (best[0], "resolved" if best[4] == tag else "mismatch")
            assert found[record][:2] == expected


def warc_same(a, b):
    return a.rstrip("/") == b.rstrip("/")


def test_no_revisits(spark):
    assert warc.resolve_revisits(_captures(spark, [])).count() == 0


# --- mixing ---------------------------------------------------------------------------------------


def _targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, sum(sizes.values())
    while True:
        rest = sum(weight[s] for s in sizes if s not in full)
        over = [s for s in sizes if s not in full and left * weight[s] / rest > most * sizes[s]]
        if not over:
            return {s: full.get(s, left * weight[s] / rest if rest else 0) for s in sizes}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


def test_targets_stop_and_reshare(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, "d": 3, None: 400, "é": 0}
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(_targets(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix_follows_targets_and_repeats(docs, nothing):
    size = F.coalesce(F.length("text"), F.lit(0))
    take = lambda: mixing.systematic_mix(docs, size, ties=("text",))
    first = [(r["row"]["doc_id"], r["row"]["source"], r["size"], r["target"], r["copies"]) for r in take().collect()]
    assert len(first) == docs.count()
    assert Counter(first) == Counter((r["row"]["doc_id"], r["row"]["source"], r["size"], r["target"], r["copies"]) for r in take().repartition(7).collect())
    for source in {r[1] for r in first}:
        mine = [r for r in first if r[1] == source]
        assert all(0 <= r[4] <= 3 for r in mine)
        assert abs(sum(r[2] * r[4] for r in mine) - mine[0][3]) <= 2 * max(r[2] for r in mine)
    emitted = mixing.emit(take())
    assert emitted.count() == sum(r[4] for r in first)
    assert emitted.columns == docs.columns
    assert mixing.systematic_mix(nothing, size).count() == 0


def test_ranks_of_one_crowded_size(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "'s' as source", "5L as size")
    mixed = mixing.systematic_mix(rows, F.col("size"), weights=(1,))
    assert mixed.agg(F.sum("copies")).first()[0] == 3000


# --- quality -------------------------------------------------------------------------------------


def _plain_model(texts):
    """Interpolated modified Kneser-Ney by dictionaries of words: the probability of w after u, v."""
    tri = Counter()
    for words in texts:
        padded = [None, None, *words]
        tri.update(zip(padded, padded[1:], padded[2:]))
    two, one = Counter(), Counter()
    for (_, v, w), n in tri.items():
        two[v, w] += n if v is None else 1
    for _, w in two:
        one[w] += 1

    def cut(counts):
        seen = Counter(counts.values())
        if not (seen[1] and seen[2]):
            return dict.fromkeys(counts, 0.5)
        y = seen[1] / (seen[1] + 2 * seen[2])
        raw = [1 - 2 * y * seen[2] / seen[1], 2 - 3 * y * seen[3] / seen[2], 3 - 4 * y * seen[4] / seen[3] if seen[3] else 0.5]
        d = [min(max(x, 0.05), i) for i, x in enumerate(raw, 1)]
        return {gram: d[min(n, 3) - 1] for gram, n in counts.items()}

    def interpolated(counts, context, lower):
        cuts, total, down = cut(counts), Counter(), Counter()
        for gram, n in counts.items():
            total[context(gram)] += n
            down[context(gram)] += cuts[gram]

        def probability(gram):
            c = context(gram)
            if not total[c]:
                return lower(gram)
            return (counts[gram] - cuts.get(gram, 0)) / total[c] + down[c] / total[c] * lower(gram)

        return probability

    once, types = Counter(range(1, 9)), Counter(range(1, 9))  # one more of each shape, for what is unknown
    for w, n in one.items():
        once[quality.shape(w)] += n == 1
        types[quality.shape(w)] += 1
    unseen = lambda w: once[quality.shape(w)] / once.total() / types[quality.shape(w)]
    single = interpolated(one, lambda w: (), unseen)
    pair = interpolated(two, lambda g: g[0], lambda g: single(g[1]))
    return interpolated(tri, lambda g: g[:2], lambda g: pair(g[1:])), list(one)


def test_scores_are_those_of_plain_kneser_ney(spark):
    rng = np.random.default_rng(6)
    vocabulary = ["a", "the", "Cat", "dog,", "NATO", "7", "x-y", "sat", "mat.", "Rome!", "UN;", "zeta", "ox", "ate", "rat"]
    vocabulary += [f"{w}{'e' * i}" for i in range(1, 9) for w in ("Ab", "no", "r2")]
    weights = 1 / np.arange(1, len(vocabulary) + 1) ** 2
    draw = lambda n: rng.choice(vocabulary, n, p=weights / weights.sum()).tolist()
    texts = [draw(int(n)) for n in rng.integers(0, 40, 60)] + [["wombat", "a", "Cat"], ["a", "unheard,", "Of", "99"], ["a"]]
    docs = spark.createDataFrame([(i, " ".join(t), "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    taught = {r["doc_id"] for r in docs.where(~quality._held_out()).where("doc_id < 50").collect()}
    probability, known = _plain_model([texts[i] for i in sorted(taught)])
    unknown = ["qq", "Qq", "QQ", "qq,", "Qq,", "QQ,", "q1", "q-q"]
    assert sorted(map(quality.shape, unknown)) == list(range(1, 9))
    for context in [(None, None), (None, "a"), ("a", "the"), ("the", "the"), ("qq", "a"), ("a", "qq")]:
        assert sum(probability((*context, w)) for w in [*known, *unknown]) == pytest.approx(1)
    tokens = quality.tokenized(docs.repartition(4), labels)
    got = {r["doc_id"]: r["perplexity"] for r in quality.scored(tokens, *quality.open_model(quality.trigram_counts(tokens))).collect()}
    for i, words in enumerate(texts):
        padded = [None, None, *words]
        logs = [math.log(probability(g)) for g in zip(padded, padded[1:], padded[2:])]
        assert got[i] == (pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-4) if logs else None)


def test_held_out_accuracy_on_labels(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classified(documents, labels)
    judged = found.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("double")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in judged}
    assert kept[1] > 0.97
    assert kept[0] < 0.3


def test_unknown_words_cost(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rng = np.random.default_rng(4)
    letters = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(3, 10)))) for _ in range(300))
    junk = spark.createDataFrame([(-1, letters, "en", "x", len(letters))], "doc_id long, text string, lang string, source string, n_chars long")
    found = quality.classified(documents.select(*junk.columns).unionByName(junk), labels)
    row = found.where("doc_id = -1").first()
    usual = found.where("lang = 'en'").agg(F.percentile_approx("perplexity", 0.5)).first()[0]
    assert not row["keep"]
    assert row["perplexity"] > 10 * usual


def test_rare_words_have_their_own_counts(spark):
    """Every word of trusted text counts as itself."""
    texts = ["the cat sat on the mat", "the cat ate the rat", "a dog sat on the cat", "the dog ate a rat on the mat", "one zebra ate the cat"] * 3
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*texts, "the zebra sat", "the wombat sat"])], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    tokens = quality.tokenized(docs.repartition(3), labels)
    grams = quality.trigram_counts(tokens).collect()
    taught = {r["doc_id"] for r in docs.where(~quality._held_out()).collect()}
    padded = [[0, 0, *(np.uint64(quality.word_id(w)).astype(np.int64).item() for w in t.split())] for i, t in enumerate(texts) if i in taught]
    assert {(r["u"], r["v"], r["w"]): r["n"] for r in grams} == Counter(x for p in padded for x in zip(p, p[1:], p[2:]))
    got = {r["doc_id"]: r["perplexity"] for r in quality.scored(tokens, *quality.open_model(quality.trigram_counts(tokens))).collect()}
    assert got[len(texts)] < got[len(texts) + 1]


def test_the_quantile_alone_decides(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classified(documents, labels).select("*", quality._held_out().alias("held")).join(labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("x")), "doc_id").collect()
    for lang in {r["lang"] for r in rows}:
        scores = [r["score"] for r in rows if r["lang"] == lang and r["held"] and r["q"] == 1 and not r["x"] and r["score"] is not None]
        cut = next((r["threshold"] for r in rows if r["lang"] == lang), None)
        assert not scores or cut <= max(scores)


def test_awkward_documents_have_a_decision(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(d, 1, None) for d, _ in rows[6:]] + [(3, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    got = quality.classified(docs, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    assert all((r["n_words"] == 0) == (r["perplexity"] is None) and r["keep"] is not None for r in got)
    assert not any(r["keep"] for r in got if not r["n_words"])
    assert quality.classified(nothing, labels.limit(0)).count() == 0
    assert quality.classified(docs, labels.limit(0)).where("keep").count() == sum(bool((t or "").split()) for _, t in rows)


# --- pipeline ------------------------------------------------------------------------------------


def test_stages_keep_the_columns_of_documents(spark, unique):
    given = unique.select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, given, "/root/testdata/sf0.001").columns == list(corpus_pipeline.COLUMNS), name


def test_near_copies_stage_keeps_one_of_each_group(spark, docs):
    kept = corpus_pipeline.without_near_copies(spark, docs, "").collect()
    texts = [r["text"] for r in kept]
    assert len([t for t in texts if t and not t.strip()]) + texts.count(None) + texts.count("") == 1
    assert len(set(texts)) == len(texts)
    assert "no id at all" in texts and "same id, other text" in texts


@pytest.mark.parametrize("crowd", [2, 32])
def test_near_copies_by_exact_likeness(spark, monkeypatch, crowd):
    monkeypatch.setattr(near_copies, "CROWD", crowd)
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(12):
        base = [f"w{i}" for i in rng.integers(0, 5000, 200)]
        texts.append(base)
        for changes in (1, 2, 3, 4, 5, 6, 8):
            other = list(base)
            for at in rng.choice(200, changes, replace=False):
                other[at] = f"new{rng.integers(1 << 40)}"
            texts.append(other)
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    likeness = [[len(a & b) / len(a | b) for b in sets] for a in sets]
    rows = [(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.without_near_copies(spark, frame, "").collect())
    assert not [(i, j) for i in kept for j in kept if i < j and likeness[i][j] >= 0.8]
    reached = set(kept)
    for _ in texts:
        reached |= {j for i in reached for j in range(len(texts)) if likeness[i][j] >= 0.8}
    assert len(reached) == len(texts)
    assert len(kept) > 12  # copies below 0.8 stay


def test_pipeline_runs(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert got and all(r["same"] for r in got)


def test_llm_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


def test_links_between_copies_of_a_crowd(spark, monkeypatch):
    """A is like B and B like C, A not like C, among many copies of A: B must keep its link to C."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(400)]
    changed = lambda words, spots, tag: [f"{tag}{i}" if i in spots else w for i, w in enumerate(words)]
    b = changed(base, set(range(0, 8 * 6, 6)), "b")
    c = changed(b, set(range(203, 203 + 8 * 6, 6)), "c")
    crowd = [changed(base, {int(rng.integers(300, 400))}, f"x{i}_") for i in range(110)]
    rows = [(i, " ".join(t)) for i, t in enumerate([base, b, c, *crowd])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [near_copies.shingles(t.encode(), 5) for _, t in rows]
    like = lambda x, y: len(np.intersect1d(sets[x], sets[y])) / len(np.union1d(sets[x], sets[y]))
    assert like(0, 1) >= 0.8 and like(1, 2) >= 0.8 > 0.75 > like(0, 2)
    for crowd, block in ((32, 128), (8, 16), (10**6, 128)):
        monkeypatch.setattr(near_copies, "CROWD", crowd)
        monkeypatch.setattr(near_copies, "BLOCK", block)
        assert len({r["component"] for r in near_copies.near_copies(frame).collect()}) == 1


def test_blocks_link_what_pairs_do():
    rng = np.random.default_rng(5)
    pool = np.unique(rng.integers(1 << 60, size=400).astype(np.uint64))
    sets = [np.sort(rng.choice(pool, size=rng.integers(1, 60), replace=False)) for _ in range(40)]
    sets += [np.sort(np.append(s[1:], s[:1])) if i % 2 else s[:-1] for i, s in enumerate(sets) if len(s) > 5]
    a, b = near_copies.alike_within(sets, 0.8)
    root = list(range(len(sets)))
    for x, y in [*zip(a, b)]:
        root = [root[x] if r == root[y] else r for r in root]
    whole = list(range(len(sets)))
    for x in range(len(sets)):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            if both >= 0.8 * (len(sets[x]) + len(sets[y]) - both):
                whole = [whole[x] if r == whole[y] else r for r in whole]
    groups = lambda r: sorted(sorted(i for i in range(len(r)) if r[i] == g) for g in set(r))
    assert groups(root) == groups(whole) and len(set(whole)) < len(whole)
    assert len(a) == len(sets) - len(set(whole))


def test_no_near_copies_of_nothing(spark, nothing):
    assert near_copies.near_copies(nothing).count() == 0


def test_near_copies_stage_runs_simhash_and_keeps_to_the_likeness(spark, monkeypatch):
    """Without any least hash in common, SimHash alone brings the copies together; the unlike ones stay."""
    monkeypatch.setattr(near_copies, "band_keys", lambda found: [])
    words = [f"w{i}" for i in range(400)]
    near = [*words[:200], "x", *words[201:]]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(reversed(words))), (4, ""), (5, None)]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    prints = {r["doc_id"]: int(r["fingerprint"]) for r in simhash.fingerprints(frame, 5).collect()}
    assert ((prints[1] ^ prints[2]) & (1 << 64) - 1).bit_count() <= 4
    kept = sorted(r["doc_id"] for r in corpus_pipeline.without_near_copies(spark, frame, "").collect())
    assert kept == [1, 3, 4]
