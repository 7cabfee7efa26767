"""A training corpus from raw documents, stage by stage.

Every stage reads what its predecessor kept, and calls one operator of ``tablewright.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import mixing, near_copies, quality, sentence_pieces, simhash, suffix_dedup
from tablewright.llm.common import stored, table, tokenizer_path, words_in

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier keeps; those of one doc_id and text share a decision."""
    kept = quality.classified(docs, table(spark, sf_dir, "labels")).where("keep").select(F.col("doc_id").alias("_id"), "digest").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("digest"))
    return docs.join(kept, same, "left_semi").select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, likeness 0.8 or more) the document of smallest doc_id (then of smallest digest;
    one without doc_id only if all are); of repeated rows one. Candidates are the groups of SimHash and, beyond its four
    bits, shared least hashes; the exact likeness decides."""
    texts = docs.select("doc_id", "text")
    groups = near_copies.near_copies(texts, words=5, likeness=0.8, groups=simhash.near_duplicates(texts, words=5))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    first = groups.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first.doc_id").alias("_id"), F.col("first.digest").alias("_digest"))
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("_own"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest"))
    return rows.join(first, same, "left_semi").dropDuplicates(["doc_id", "_own"]).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages of 100 bytes or more that came before. None is dropped."""
    found = suffix_dedup.removed(docs.select(*COLUMNS), length=100, keep_rows=True)
    text = F.col("kept")
    return found.select("row.doc_id", text.alias("text"), "row.lang", "row.source", F.length(text).cast("long").alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    rows = stored(docs.select(*COLUMNS, words_in(F.col("text")).alias("_size")), "sized")
    return mixing.emit(mixing.systematic_mix(rows, F.col("_size"), ties=("text",))).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document of the mix, and whether they decode to its text."""
    found = sentence_pieces.round_trip(docs.select(*COLUMNS), tokenizer_path("piece_bpe_32k.model"))
    return found.select("row.doc_id", "row.source", "row.n_chars", "n_pieces", "ids_crc32", "same")


STAGES = [
    ("quality", good_quality),
    ("near_copies", without_near_copies),
    ("repeats", without_repeats),
    ("mix", mixed),
    ("pieces", encoded),
]
#: The language model, near copies and pieces have no SQL; tests hold stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
