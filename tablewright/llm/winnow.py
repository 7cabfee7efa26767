"""Document fingerprints by winnowing, in DataFrame functions throughout.

A text is cut into units of at most ``LONGEST`` characters, each ending early at white space, at any
character beyond ASCII and at a few others. What the cut depends on lies in the text itself, so
after an insertion the units fall into step again at the next such character. Of the
hashes of all runs of ``k`` units, each window of ``w`` neighbours marks its smallest, the rightmost
if several are. Any common run of ``w + k - 1`` units is therefore marked at the same place in both
texts; positions are kept so that it can be found there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cuts, range_of, stored

#: Units of a run, runs of a window, characters of a unit.
K, W, LONGEST = 4, 3, 8
#: Characters that end a unit: white space, those beyond ASCII, and some that most texts hold.
ENDS = r"\x09-\x0D\x20\x80-\x{10FFFF}#+3;CKS\[cks{"
UNIT = rf"(?s)[^{ENDS}]{{0,{LONGEST - 1}}}."
#: Documents sorted together to find the next of each, and ranges at most.
TOGETHER, RANGES = 8192, 4096
_LAST = (1 << 31) - 1


def with_marks(df: DataFrame, text: str, marks: str, k: int = K, w: int = W) -> DataFrame:
    """Adds the marks of a text column: an array of long, in order of position.

    The upper half of a mark is a hash, the lower half counts down with the position, so the
    least mark of a window is the one wanted. A text of fewer than ``k`` units has one mark for
    all of them, an empty or null one has none.
    Every step but the last is read at several places and thus computed once.
    """
    df = df.withColumn("_units", F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(UNIT), 0))
    n = F.size("_units")

    def run(i: Column) -> Column:
        # past the end there is nothing to hash, so the one run of a short text is all of it
        hashed = F.xxhash64(*(F.get("_units", i + j) for j in range(k)))
        return F.shiftleft(hashed, 32).bitwiseOR((F.lit(_LAST) - i).cast("long"))

    runs = F.when(n == 0, F.array().cast("array<long>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), run))
    df = df.withColumn("_runs", runs).withColumn("_least", F.col("_runs"))
    span = 1
    while span < w:  # the least of so many neighbours; beyond the end there are none
        step = min(span, w - span)
        later = F.slice("_least", step + 1, F.greatest(F.size("_least"), F.lit(1)))
        df = df.withColumn("_least", F.zip_with("_least", later, lambda x, y: F.least(x, y)))
        span += step
    m = F.size("_runs")
    least = F.slice("_least", 1, F.greatest(m - w + 1, F.lit(1)))
    return df.withColumn(marks, F.array_distinct(least)).drop("_units", "_runs", "_least")


def mark_hashes(marks: Column) -> Column:
    """The distinct hashes of marks, 32 bits each."""
    return F.array_distinct(F.transform(marks, lambda x: F.shiftright(x, 32).cast("int")))


def mark_positions(marks: Column) -> Column:
    """The unit at which the run of each mark starts, from 0."""
    return F.transform(marks, lambda x: F.lit(_LAST) - x.bitwiseAND(F.lit((1 << 32) - 1)))


def likeness(a: Column, b: Column) -> Column:
    """Shared part of two sets of hashes: intersection over union, 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def spelled(marks: Column) -> Column:
    """Marks as one string, 16 hex digits each: the hash, then the unit where its run starts."""
    return F.array_join(F.transform(marks, lambda x: F.lpad(F.hex(x.bitwiseXOR(F.lit(_LAST))), 16, "0")), "")


def followed(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, range, guest): documents in ranges of doc_id, each range with the first
    document of the range below as a guest, that of the lowest with the very first.

    Sorted by falling doc_id (then text, nulls last, guests after all), the row after a
    document is the one that follows it. Ranges are cut evenly, and none waits for another.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = docs.count()
    at = cuts(docs, "doc_id", min(RANGES, -(-n // TOGETHER)))
    placed = docs.withColumn("range", range_of(F.col("doc_id"), at))
    top = placed.groupBy("range").agg(F.max("doc_id").alias("top")).withColumnRenamed("range", "_range")
    here = (F.col("range") == F.col("_range")) & F.col("doc_id").eqNullSafe(F.col("top"))
    # at most RANGES rows; of several texts of one doc_id the last by code point comes first
    heads = placed.join(F.broadcast(top), here).groupBy("range", "doc_id").agg(F.max("text").alias("text"))
    turn = Window.orderBy(F.desc("range"))
    above = F.coalesce(F.lag("range").over(turn), F.min("range").over(Window.partitionBy()))
    guests = stored(heads.select(above.alias("range"), "doc_id", "text"), "guests")
    return placed.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))


def fingerprints_of_edits(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, marks, edited_marks, near_edited, near_next).

    The edited text has its last third of code points replaced by the first as many of the next
    document in falling doc_id order (all, if it has fewer); the last one is followed by the first. Null
    texts are empty; documents of one doc_id follow each other by falling text, null ids come last;
    a lone document follows itself. Equal texts have equal marks; likeness compares the hashes. Extra
    columns are left out.
    """
    by = ["guest", F.desc_nulls_last("doc_id"), F.desc("text")]
    order = Window.partitionBy("range").orderBy(*by)
    # texts alone are shuffled: marks are made once the rows are in the window's order
    rows = with_marks(followed(docs).repartition("range").sortWithinPartitions("range", *by), "text", "marks", k, w)
    rows = rows.withColumns({"next": F.lead("text").over(order), "next_marks": F.lead("marks").over(order)}).where("not guest")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next"), F.lit(1), third))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "marks", "next_marks")
    rows = with_marks(rows, "edited", "edited_marks", k, w)
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    rows = rows.withColumns({f"_{c}": mark_hashes(F.col(c)) for c in ("marks", "edited_marks", "next_marks")})
    near = [likeness(F.col("_marks"), F.col(other)).alias(name) for other, name in (("_edited_marks", "near_edited"), ("_next_marks", "near_next"))]
    return rows.select("doc_id", "n_chars", "edited_sha256", "marks", "edited_marks", *near)
