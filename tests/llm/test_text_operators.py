"""Operators on texts against brute force, on a table of awkward rows."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from tablewright.llm import sentence_pieces, simhash, suffix_dedup, token_count, token_files, winnow
from tablewright.llm.common import components, tokenizer_path
from tablewright.session import scratch_path

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
BPE, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def _tally(rows):
    return Counter(tuple(r) for r in rows)


# --- SimHash ---------------------------------------------------------------------------


def _simhash(text, k):
    words = WORD.findall((text or "").encode().lower())
    runs = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(prints, distance):
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def _same_groups(found, rows, words, distance):
    prints = [_simhash(t, words) for _, t in rows]
    roots = _groups(prints, distance)
    least = {}
    for root, (doc, _) in zip(roots, rows):
        if doc is not None:
            least[root] = min(doc, least.get(root, doc))
    expected = [(d, f, least.get(r)) for (d, _), f, r in zip(rows, prints, roots)]
    got = [(r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in found.collect()]
    assert _tally(got) == _tally(expected)


def test_simhash_groups(docs, rows):
    _same_groups(simhash.near_duplicates(docs), rows, 4, 4)


def test_simhash_of_nothing(nothing):
    assert simhash.near_duplicates(nothing).count() == 0


def test_crowded_keys_in_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    prints = {centre}
    for _ in range(150):
        bits = rng.choice(64, int(rng.integers(1, 7)), replace=False)
        prints.add(centre ^ sum(1 << int(b) for b in bits))
    prints = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.links(frame), "t").collect()}
    roots = _groups([p % 2**64 for p in prints], 4)
    for i, a in enumerate(prints):
        for j in range(i):
            assert (roots[i] == roots[j]) == (got.get(a, a) == got.get(prints[j], prints[j]))


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 10)
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3
    assert simhash.fingerprint(text.encode(), 4) == _simhash(text, 4)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges, "chain").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# --- token counts and files -------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BPE)


def test_token_counts(docs, rows, tokenizer):
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_count.token_counts(docs, BPE, 40).collect()]
    expected = []
    for doc, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc, len((text or "").encode()), n, n > 40))
    assert _tally(got) == _tally(expected)


def test_no_token_counts(nothing):
    assert token_count.token_counts(nothing, BPE).count() == 0


def test_merges_of_equal_pairs_go_left_first(tokenizer):
    counting = token_count.MergeCounter(BPE)
    words = ["a" * n for n in range(1, 40)] + ["ab" * 7, "aaab" * 5, "  " * 9]
    assert counting.tokens(words) == [len(e.ids) for e in tokenizer.encode_batch(words, add_special_tokens=False)]


def test_a_small_cache_changes_nothing(monkeypatch, texts, tokenizer):
    monkeypatch.setattr("tablewright.llm.units.CACHED", 5)
    monkeypatch.setattr("tablewright.llm.units.LONGEST", 3)
    counting = token_count.MergeCounter(BPE)
    given = [t or "" for t in texts]
    expected = [len(e.ids) for e in tokenizer.encode_batch(given, add_special_tokens=False)]
    assert [counting.tokens([t])[0] for t in given] == expected


def test_id_files(spark, unique, unique_rows, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 2000)
    folder = scratch_path(spark, "ids")
    token_files.write_ids(unique, BPE, folder)
    start = 0
    found = {r["doc_id"]: r for r in token_files.read_ids(spark, folder).collect()}
    assert len(found) == len(unique_rows)
    for doc, text in sorted(unique_rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        row = found[doc]
        assert (row["start"], row["n_tokens"], row["ids"]) == (start, len(ids), ids)
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_id_files_of_repeated_and_missing_ids(spark, docs, rows):
    folder = scratch_path(spark, "ids")
    token_files.write_ids(docs, BPE, folder)
    found = token_files.read_ids(spark, folder, ids=False).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(found, found[1:]))


def test_id_files_of_nothing(spark, nothing):
    folder = scratch_path(spark, "ids")
    token_files.write_ids(nothing, BPE, folder)
    assert token_files.read_ids(spark, folder).count() == 0


# --- winnowing -----------------------------------------------------------------------------


def _chained(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(v, seed)
    return seed


def _units(text):
    """Units by their definition, one character at a time."""
    out, unit = [], ""
    for c in text:
        unit += c
        if ord(c) > 127 or c in "\t\n\v\f\r #+3;CKS[cks{" or len(unit) == winnow.LONGEST:
            out.append(unit)
            unit = ""
    return out + [unit] * bool(unit)


def _marks(text, k=winnow.K, w=winnow.W):
    """(hash, position) of the marked runs."""
    units = [u.encode() for u in _units(text or "")]
    signed = lambda h: struct.unpack("<i", struct.pack("<I", h & 0xFFFFFFFF))[0]
    runs = [signed(_chained(units[i : i + k])) for i in range(max(1, len(units) - k + 1))] if units else []
    out = []
    for j in range(max(1, len(runs) - w + 1) if runs else 0):
        window = runs[j : j + w]
        at = j + max(i for i, h in enumerate(window) if h == min(window))
        if (runs[at], at) not in out[-1:]:
            out.append((runs[at], at))
    return out


def _spelled(marks):
    return "".join(f"{h & 0xFFFFFFFF:08X}{at:08X}" for h, at in marks)


def _likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_marks_and_positions(docs, rows):
    marked = winnow.with_marks(docs.select("doc_id", "text"), "text", "marks")
    marked = marked.select("doc_id", winnow.mark_positions(marked["marks"]).alias("at"))
    got = [(r["doc_id"], tuple(r["at"])) for r in marked.collect()]
    assert _tally(got) == _tally((d, tuple(p for _, p in _marks(t))) for d, t in rows)


def test_marks_of_short_and_unspaced_texts(spark):
    """Short texts and texts without white space are like their edited copies, and shifted text falls into step."""
    texts = ["a few words only, not that many of them today", "日本語の文章には空白がない。" * 9 + "終わり", "x" * 5, "", "é" * 40, "abcdefghij" * 30, "q" * 99]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = winnow.with_marks(frame, "text", "marks")
    got = {r["doc_id"]: r["m"] for r in marked.select("doc_id", winnow.spelled(marked["marks"]).alias("m")).collect()}
    assert got == {doc: _spelled(_marks(text)) for doc, text in enumerate(texts)}
    near = {r["doc_id"]: r["near_edited"] for r in winnow.fingerprints_of_edits(frame).collect()}
    assert near[0] > 0 and near[1] > 0 and near[5] > 0
    passage = "the quick brown fox jumps over the lazy dog while counting stacks of bricks"
    common = {h for h, _ in _marks("0" + passage)} & {h for h, _ in _marks("shifted by this: " + passage)}
    assert common


def test_common_runs_are_marked(spark):
    """The guarantee: texts that share w + k - 1 units share a mark."""
    rng = np.random.default_rng(5)
    shared = "".join(f"{w}k " for w in rng.integers(10, 99, winnow.K + winnow.W - 1))[:-1]
    shared = "".join(_units(shared)[: winnow.K + winnow.W - 1])
    texts = [" ".join(map(str, rng.integers(0, 10**6, n))) + " " + shared + " ".join(map(str, rng.integers(0, 10**6, n))) for n in range(1, 30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = winnow.with_marks(frame, "text", "marks")
    sets = [set(r[0]) for r in marked.select(winnow.mark_hashes(marked["marks"])).collect()]
    assert set.intersection(*sets)


def test_edited_texts(unique, unique_rows, monkeypatch):
    monkeypatch.setattr(winnow, "TOGETHER", 7)
    found = winnow.fingerprints_of_edits(unique)
    found = found.withColumn("fingerprint", winnow.spelled(found["marks"])).withColumn("edited_fingerprint", winnow.spelled(found["edited_marks"]))
    found = {r["doc_id"]: r for r in found.collect()}
    ordered = sorted(((d, t or "") for d, t in unique_rows), reverse=True)
    assert len(found) == len(ordered)
    for i, (doc, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        row, marks = found[doc], _marks(text)
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == _spelled(marks)
        assert row["edited_fingerprint"] == _spelled(_marks(edited))
        assert row["near_edited"] == pytest.approx(_likeness(marks, _marks(edited)))
        assert row["near_next"] == pytest.approx(_likeness(marks, _marks(following)))


def test_awkward_ids_keep_their_rows(docs, rows, nothing):
    got = winnow.fingerprints_of_edits(docs)
    assert _tally((r["doc_id"], r["n_chars"]) for r in got.collect()) == _tally((d, len(t or "")) for d, t in rows)
    assert winnow.fingerprints_of_edits(nothing).count() == 0


# --- suffix arrays -----------------------------------------------------------------------------


def _without_repeats(rows, length):
    """By every window's first place; rows in (doc_id, text) order, nulls first."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("batches", [1, 5])
def test_repeated_passages(docs, rows, batches, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 512)
    got = suffix_dedup.removed(docs, length=100, batches=batches)
    assert _tally(got.collect()) == _tally(_without_repeats(rows, 100))


def test_crowded_anchors_by_join(unique, unique_rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 2)
    got = suffix_dedup.removed(unique, length=60, batches=3)
    assert _tally(got.collect()) == _tally(_without_repeats(unique_rows, 60))


def test_levels_grow_geometrically(spark, unique):
    index = suffix_dedup.SuffixLevels(spark, 100)
    sizes = []
    for _ in range(5):
        index.add(unique.selectExpr("doc_id as doc", "text"))
        sizes.append([size for size, *_ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    assert suffix_dedup.batches_of(unique) == 4  # the registered run merges levels too


def test_kept_text_is_whole_characters(spark):
    text = "ö" * 80
    rows = spark.createDataFrame([(1, text + "x"), (2, "a" + text)], "doc_id long, text string")
    kept = {r["doc_id"]: r["kept"] for r in suffix_dedup.removed(rows, length=101, batches=1, keep_rows=True).collect()}
    assert kept[1].endswith("x") and set(kept[2]) <= {"a", "ö"}


def test_no_repeats_of_nothing(nothing):
    assert suffix_dedup.removed(nothing).count() == 0


# --- sentence pieces ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.mark.parametrize("chunk", [64, 1 << 16])
def test_pieces_of_texts(docs, rows, library, chunk, monkeypatch):
    short = [r for r in rows if len(r[1] or "") < 4000]
    monkeypatch.setattr(sentence_pieces, "CHUNK", chunk)
    small = docs.where("length(text) < 4000 or text is null")
    got = [(r["row"]["doc_id"], tuple(r["ids"]), r["decoded"]) for r in sentence_pieces.decode(sentence_pieces.encode(small, PIECES), PIECES).collect()]
    ids = [tuple(library.encode(t or "")) for _, t in short]
    assert _tally(got) == _tally((d, i, library.decode(list(i))) for (d, _), i in zip(short, ids))


def test_long_text_round_trip(docs, rows, library):
    got = {(r["row"]["doc_id"], r["n_pieces"], r["same"]) for r in sentence_pieces.round_trip(docs.where("length(text) > 4000"), PIECES).collect()}
    assert got == {(d, len(library.encode(t)), True) for d, t in rows if t and len(t) > 4000}
    assert got


def test_no_pieces_of_nothing(nothing):
    assert sentence_pieces.round_trip(nothing, PIECES).count() == 0


def _unigram_model(pieces):
    """A model file with given pieces and scores; the first three are unknown and control pieces."""

    def field(number, kind, payload):
        size = len(payload).to_bytes(1, "big") if kind == 2 else b""
        return bytes([number << 3 | kind]) + size + payload

    out = b""
    for piece, score, kind in pieces:
        out += field(1, 2, field(1, 2, piece.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))
    trainer = field(3, 0, b"\1")
    normalizer = field(1, 2, b"identity") + field(3, 0, b"\1") + field(4, 0, b"\0") + field(5, 0, b"\1")
    return out + field(2, 2, trainer) + field(3, 2, normalizer)


def test_unigram_scan_equals_the_library(monkeypatch):
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)]
    words = ["▁", "a", "b", "c", "ab", "bc", "abc", "ca", "▁a", "▁ab", "cab", "bcab", "aa", "▁c"]
    pieces += [(w, -1.0 - 0.37 * i - 0.01 * i * i, 1) for i, w in enumerate(words)]
    data = _unigram_model(pieces)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = sentence_pieces.PieceModel(data)
    monkeypatch.setattr(sentence_pieces, "BLOCK", 8)
    rng = np.random.default_rng(1)
    for _ in range(60):
        text = "".join(rng.choice(list("abc abc"), int(rng.integers(1, 80))))
        assert model.encode([text])[0].tolist() == library.encode(text)
        marked = model.marked(text)
        cut = [(marked[max(0, a - model.longest) : a], marked[a : a + 11], marked[a + 11 : a + 11 + model.longest]) for a in range(0, len(marked), 11)]
        states = sentence_pieces.scanned([model.transfer(*c) for c in cut], sentence_pieces.FREE, sentence_pieces.FREE)
        ids = np.concatenate([model.traced(*c, a, b) for c, a, b in zip(cut, states, states[1:])])
        assert ids.tolist() == library.encode(text)


def test_matrix_product_is_associative():
    rng = np.random.default_rng(2)
    states = [(i, i) for i in range(4)]
    some = [{a: {b: float(rng.normal()) for b in states if rng.random() < 0.7} for a in states} for _ in range(3)]
    left = sentence_pieces.combined(sentence_pieces.combined(some[0], some[1]), some[2])
    right = sentence_pieces.combined(some[0], sentence_pieces.combined(some[1], some[2]))
    assert left.keys() == right.keys()
    for a in left:
        assert left[a] == pytest.approx(right[a])
