"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words. Within a source, every document is expected to
appear ``target / source size`` times. Documents are ranked by size, their expected copies
are summed along the ranks, a random offset of the source is added, and a document is
taken once for each whole number its share of the sum crosses. Neighbours in rank have
near sizes, so the words taken follow the target closely, whatever the sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import ranks

#: Rows of one source and one size are dealt out over so many groups for ranking.
SPREAD = 1024


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Target of each source: rows (source, source_size, target) from rows (source, size).

    Sources in code point order, null last, get the weights in turn and share the sum of all
    sizes by weight. A target stops at ``most`` times its source's size; what is above goes to
    the others by weight, until no target is above. Sorted by the share at which they fill up,
    the full sources come first, and the level of the others is the highest level found along
    that order. Windows here see one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.array(*(F.lit(w) for w in weights))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.get(weight, turn % len(weights)))
    full = F.col("source_size") * most
    by_share = Window.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, everyone = by_share.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left_words = F.sum("source_size").over(everyone) - F.coalesce(F.sum(full).over(earlier), F.lit(0))
    left_weight = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    per = per.withColumn("level", left_words / left_weight)
    level = F.max("level").over(everyone)
    return per.select("source", "source_size", F.least(full.cast("double"), F.col("weight") * level).alias("target"))


def systematic_mix(
    docs: DataFrame,
    size: Column,
    weights: Sequence[int] = (1, 2, 3),
    most: int = 3,
    seed: str = "mix",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Rows (row, size, source_size, target, copies): how often the mix takes each document.

    ``row`` holds the document with all its columns, so no name can clash. Documents of equal
    size are ranked by ``doc_id`` and then by ``ties``. A null source is a source of its own; a
    null size counts 0; documents of a source without any word are taken once. An empty table
    gives an empty mix. Reruns agree: the offset is a digest of seed and source.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(size, F.lit(0)).cast("long").alias("size"))
    rows = rows.select("row", "size", F.col("row.source").alias("source"), F.col("row.doc_id").alias("_id"))
    targets = source_targets(rows, weights, most).withColumnRenamed("source", "_source")
    spread = F.coalesce(F.pmod(F.col("_id"), F.lit(SPREAD)), F.lit(-1))
    order = [F.col("_id"), *(F.col(f"row.{t}") for t in ties)]
    ranked = ranks(rows, "source", "size", spread, order, "_rank")
    ranked = ranked.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0))
    digest = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("source"), F.lit("")))), 1, 8)
    offset = F.conv(digest, 16, 10).cast("double") / F.lit(2.0**32)
    crossed = F.floor(F.col("_rank") * rate + offset) - F.floor((F.col("_rank") - 1) * rate + offset)
    return ranked.select("row", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")
    return mixed.where("copies > 0").select("row", times).select("row.*")
