"""What several operators share: stored steps, ranks, ordered neighbours, components."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.session import scratch_path

#: Words are runs of anything but these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read from there: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes a table that ``stored`` wrote and that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        delete(spark, file.rpartition("/")[0])


def delete(spark: SparkSession, folder: str) -> None:
    """Deletes a folder and all in it, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words_in(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cuts(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most ``parts - 1`` values of a whole-number key that split the rows about evenly."""
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, at, 20 * parts).alias("at")).first()["at"]
    return sorted(set(found or []))


def range_of(key: Column, at: Sequence[int]) -> Column:
    """Which range between the cuts a key lies in, from 0 up; a null key lies in the first."""
    if not at:
        return F.lit(0)
    above = F.filter(F.lit(list(at)), lambda cut: cut < key)
    return F.coalesce(F.size(above), F.lit(0))


def ranks(rows: DataFrame, group: str, order: str, spread: Column, ties: Sequence[str | Column], name: str) -> DataFrame:
    """Adds the rank (from 1) within ``group`` by ``order``, then by ``spread``, then ``ties``.

    ``spread`` is a number of a bounded range that deals out rows of equal order. Only counts
    meet in one place: per group one row for each order, per order one row for each spread.
    No task sorts a whole group, so a group with a third of all rows stays divided.
    """
    rows = rows.withColumn("_spread", spread)
    fine = rows.groupBy(group, order, "_spread").agg(F.count("*").alias("_n"))
    coarse = fine.groupBy(group, order).agg(F.sum("_n").alias("_n"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    coarse = coarse.select(F.col(group).alias("_g"), F.col(order).alias("_o"), before(Window.partitionBy(group).orderBy(order)).alias("_above"))
    inner = before(Window.partitionBy(group, order).orderBy("_spread")).alias("_inner")
    fine = fine.select(F.col(group).alias("_g1"), F.col(order).alias("_o1"), F.col("_spread").alias("_s1"), inner)
    same = F.col("_g").eqNullSafe(F.col("_g1")) & F.col("_o").eqNullSafe(F.col("_o1"))
    starts = fine.join(coarse, same).select("_g1", "_o1", "_s1", (F.col("_above") + F.col("_inner")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_g1", "_o1", "_s1").orderBy(*ties))
    same = F.col(group).eqNullSafe(F.col("_g1")) & F.col(order).eqNullSafe(F.col("_o1")) & (F.col("_spread") == F.col("_s1"))
    joined = rows.join(starts, same)
    return joined.withColumn(name, F.col("_start") + place).drop("_spread", "_g1", "_o1", "_s1", "_start")


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of edges (a, b): one row (node, root) per node, root its smallest.

    Large-star and small-star turns until the edges no longer change; each turn is stored, so
    a lost executor costs one turn. Minima are pre-aggregated, stars of any size are joined.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        turned = small.unionByName(least.withColumnRenamed("m", "b")).distinct()
        turned = stored(turned, label)
        discard(now)
        now = turned
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


@functools.cache
def tokenizer_path(name: str) -> str:
    """Where a vocabulary file of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)
