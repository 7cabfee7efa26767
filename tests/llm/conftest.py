import random

import pytest

#: Names that operators use inside, as extra columns of the input.
CLASHES = ("row", "size", "doc", "spans", "ids", "key", "digest", "bucket", "fp", "component", "label", "copies", "_rank")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


@pytest.fixture(scope="session")
def texts():
    """Documents with nulls, blanks, ties, repeated rows, shared passages and long texts."""
    rng = random.Random(5)
    words = ["the", "of", "and", "rain", "Wien,", "größe", "1815", "日本", "x", "ein.", "mais", "!!", "<|endoftext|>"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = line(60), line(120)
    near = base.split(" ")
    near[60] = "other"
    out = [None, "", " ", " \n\t ", "one", "two words", "A b  c\n d", base, base, " ".join(near), base.upper()]
    out += [line(30) + " " + passage + " " + line(25) for _ in range(6)]
    out += [line(rng.randint(1, 60)) for _ in range(20)] + ["a" * 3000, "ab" * 900 + passage, line(15_000)]
    out += ["🙂é" * 400, passage, "<|endoftext|>", " lead", "trail ", "a▁b", "x\r\ny\x0bz\x1c"]
    return out


@pytest.fixture(scope="session")
def rows(texts):
    """(doc_id, text) with one repeated row, one doc_id of two texts and one null doc_id."""
    found = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    return [*found, found[7], (found[12][0], "same id, other text"), (None, "no id at all"), (None, texts[7])]


def frame(spark, rows):
    n = len(CLASHES)
    full = [(d, t, ("en", None, "de")[i % 3], ("b", "a", None, "é", "src0")[i % 5 if i % 2 else 4], 0, *["?"] * n) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(4).cache()


@pytest.fixture(scope="session")
def unique_rows(texts):
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def unique(spark, unique_rows):
    return frame(spark, unique_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
