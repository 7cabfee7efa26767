"""Repeatable hold-out splits and folds that never move the rows.

Rows are ordered by a seeded digest of their key, so membership depends on the row
alone and not on partitioning. Exact sizes need the digest at a given rank: digests
are counted per four-hex-digit prefix (65,536 counts per class at most), the prefix
holding the wanted rank is found in that table, and only the rows of that prefix are
sorted. Assigning a row is then a comparison with a few cut digests.

A key that repeats keeps all its rows on one side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import SEED, col, row_hash
from ..functions.order_stats import exact_quantiles
from ..session import local_table

TEST_SIZE = 0.20
FOLDS = 5
_PREFIX = 4
#: Buckets of rows that are compared by sums before rows are.
_BUCKETS = 4096


def _sizes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """(class columns..., _prefix, _count): the only full aggregate of a split."""
    return df.groupBy(*[col(b) for b in by], F.substring("_digest", 1, _PREFIX).alias("_prefix")).agg(
        F.count("*").alias("_count")
    )


def _same(by: Sequence[str], left: str, right: str) -> Column:
    cond = F.lit(True)
    for b in by:
        cond = cond & F.col(f"{left}.{b}").eqNullSafe(F.col(f"{right}.{b}"))
    return cond


def _cut_digests(df: DataFrame, by: Sequence[str], ranks: DataFrame, sizes: DataFrame) -> DataFrame:
    """(class columns..., _cuts): the digest at each wanted rank, in rank order.

    ``ranks`` holds (class columns..., _cut, _rank). Rank 0 yields the empty string.
    """
    by = list(by)
    upto = Window.partitionBy(*by).orderBy("_prefix")
    counted = sizes.withColumn("_upto", F.sum("_count").over(upto)).withColumn(
        "_before", F.col("_upto") - F.col("_count")
    )
    holds = (F.col("c._before") < F.col("r._rank")) & (F.col("r._rank") <= F.col("c._upto"))
    edge = (
        counted.alias("c")
        .join(F.broadcast(ranks.alias("r")), holds & _same(by, "c", "r"))
        .select(
            *[F.col(f"c.{b}").alias(b) for b in by],
            F.col("r._cut").alias("_cut"),
            F.col("c._prefix").alias("_prefix"),
            (F.col("r._rank") - F.col("c._before")).alias("_within"),
        )
    )
    near = (
        df.select(*[col(b) for b in by], "_digest", F.substring("_digest", 1, _PREFIX).alias("_prefix"))
        .alias("d")
        .join(
            F.broadcast(edge.alias("e")),
            (F.col("d._prefix") == F.col("e._prefix")) & _same(by, "d", "e"),
        )
        .select(*[F.col(f"d.{b}").alias(b) for b in by], "_digest", "_cut", "_within")
    )
    order = Window.partitionBy(*by, "_cut").orderBy("_digest")
    found = (
        near.withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") == F.col("_within"))
        .select(*by, "_cut", "_digest")
    )
    return (
        ranks.alias("r")
        .join(
            F.broadcast(found.alias("f")),
            (F.col("r._cut") == F.col("f._cut")) & _same(by, "r", "f"),
            "left",
        )
        .groupBy(*[F.col(f"r.{b}").alias(b) for b in by])
        .agg(
            F.transform(
                F.array_sort(
                    F.collect_list(
                        F.struct(
                            F.col("r._cut").alias("i"),
                            F.coalesce(F.col("f._digest"), F.lit("")).alias("d"),
                        )
                    )
                ),
                lambda s: s["d"],
            ).alias("_cuts")
        )
    )


def _assign(df: DataFrame, by: Sequence[str], cuts: DataFrame, eager: bool) -> DataFrame:
    """Adds ``_slot``: how many cut digests lie before the row's digest."""
    by = list(by)
    if eager:
        cuts = local_table(df.sparkSession, cuts.collect(), cuts.schema)
    if not by:
        out = df.withColumn("_cuts", cuts.select("_cuts").scalar())
    else:
        side = cuts.select(*[col(b).alias(f"_k{i}") for i, b in enumerate(by)], "_cuts")
        cond = F.lit(True)
        for i, b in enumerate(by):
            cond = cond & col(b).eqNullSafe(F.col(f"_k{i}"))
        out = df.join(F.broadcast(side), cond, "left").drop(*[f"_k{i}" for i in range(len(by))])
    digest = F.col("_digest")
    return out.withColumn("_slot", F.size(F.filter("_cuts", lambda c: c < digest))).drop("_cuts")


def _test_ranks(sizes: DataFrame, by: Sequence[str], test_size: float) -> DataFrame:
    """Test rows per class: ceil(test_size * n) in all, spread by largest remainder."""
    by = list(by)
    per_class = sizes.groupBy(*by).agg(F.sum("_count").alias("_n"))
    # One row per class, so the unpartitioned windows below see a handful of rows.
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("_n").over(everything)
    quota = per_class.withColumn("_all", total).withColumn(
        "_test", F.ceil(F.round(F.col("_all") * F.lit(test_size), 6)).cast("long")
    )
    quota = quota.withColumn(
        "_base", F.expr("_n * _test div _all")
    ).withColumn("_rest", F.col("_n") * F.col("_test") - F.col("_base") * F.col("_all"))
    spare = F.col("_test") - F.sum("_base").over(everything)
    turn = F.row_number().over(
        Window.partitionBy(F.lit(1)).orderBy(F.col("_rest").desc(), *[col(b) for b in by])
    )
    return quota.withColumn("_spare", spare).withColumn("_turn", turn).select(
        *by,
        F.lit(0).alias("_cut"),
        (F.col("_base") + F.when(F.col("_turn") <= F.col("_spare"), 1).otherwise(0)).alias("_rank"),
    )


def _fold_ranks(sizes: DataFrame, by: Sequence[str], folds: int) -> DataFrame:
    """Upper rank of each fold but the last; the first n mod k folds hold one row more."""
    per_class = sizes.groupBy(*by).agg(F.sum("_count").alias("_n"))
    cut = F.col("_cut")
    return (
        per_class.withColumn("_cut", F.explode(F.sequence(F.lit(0), F.lit(folds - 2))))
        .withColumn("_size", F.expr(f"_n div {folds}"))
        .withColumn("_more", F.col("_n") % folds)
        .select(*by, "_cut", ((cut + 1) * F.col("_size") + F.least(cut + 1, F.col("_more"))).alias("_rank"))
    )


def hold_out(
    df: DataFrame,
    key: Sequence[str],
    test_size: float = TEST_SIZE,
    stratify: str | None = None,
    seed: int = SEED,
    eager: bool = False,
) -> DataFrame:
    """Adds ``split`` ('train' or 'test') with exactly ceil(test_size * n) test rows.

    With ``stratify`` every class gets its share of the test rows. ``eager`` fetches
    the cut digests (one per class) so that later plans carry constants only.
    """
    by = [stratify] if stratify else []
    hashed = df.withColumn("_digest", row_hash(*key, seed=seed))
    # two scans look for the cut digests: when that is done now, they share one computation of the digests
    digests = hashed.select(*[col(b) for b in by], "_digest")
    if eager:
        digests = digests.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = _sizes(digests, by)
    cuts = _cut_digests(digests, by, _test_ranks(sizes, by, test_size), sizes)
    try:
        assigned = _assign(hashed, by, cuts, eager)
    finally:
        if eager:
            digests.unpersist()
    return (
        assigned
        .withColumn("split", F.when(F.col("_slot") == 0, "test").otherwise("train"))
        .drop("_digest", "_slot")
    )


def hold_out_binned(
    df: DataFrame,
    key: Sequence[str],
    target: str,
    bins: int,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    eager: bool = False,
) -> DataFrame:
    """Stratified on quantile bins of a continuous target; adds ``bin`` and ``split``."""
    return hold_out(quantile_bins(df, target, bins), key, test_size, "bin", seed, eager)


def quantile_bins(df: DataFrame, target: str, bins: int) -> DataFrame:
    """Adds ``bin``: right-closed quantile intervals, equal edges merged."""
    edges = exact_quantiles(df, [target], [i / bins for i in range(bins + 1)]).agg(
        F.array_sort(F.collect_set("value")).alias("_edges")
    )
    inner = F.slice("_edges", F.lit(2), F.greatest(F.size("_edges") - 2, F.lit(0)))
    value = col(target).cast("double")
    return (
        df.withColumn("_edges", edges.scalar())
        .withColumn("bin", F.size(F.filter(inner, lambda e: e < value)))
        .drop("_edges")
    )


def hash_split(df: DataFrame, key: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """Adds ``split`` by the digest alone: one map, sizes right only on average."""
    cut = format(int(test_size * 16**8), "08x")
    return df.withColumn(
        "split", F.when(F.substring(row_hash(*key, seed=seed), 1, 8) < cut, "test").otherwise("train")
    )


def k_folds(
    df: DataFrame,
    key: Sequence[str],
    folds: int = FOLDS,
    stratify: str | None = None,
    seed: int = SEED,
    eager: bool = False,
) -> DataFrame:
    """Adds ``fold`` in 0..folds-1 with sizes differing by one row at most.

    With ``stratify`` that holds within every class.
    """
    by = [stratify] if stratify else []
    hashed = df.withColumn("_digest", row_hash(*key, seed=seed))
    sizes = _sizes(hashed, by)
    cuts = _cut_digests(hashed, by, _fold_ranks(sizes, by, folds), sizes)
    return (
        _assign(hashed, by, cuts, eager).withColumnRenamed("_slot", "fold").drop("_digest")
    )


def row_overlap(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Test rows whose whole feature tuple also occurs in train: one report row.

    Each side is reduced to distinct tuples before anything is compared, so a tuple
    repeated by a third of all rows is one row by then.
    """
    tuples = df.groupBy(*[col(f) for f in features]).agg(
        F.count_if(F.col("split") == "test").alias("_test"),
        F.count_if(F.col("split") == "train").alias("_train"),
    )
    shared = F.sum(F.when(F.col("_train") > 0, F.col("_test")).otherwise(0))
    total = F.sum("_test")
    return tuples.agg(
        total.alias("test_rows"),
        shared.alias("test_rows_also_in_train"),
        F.round(100 * shared / F.greatest(total, F.lit(1)), 3).alias("pct"),
    )


def positive_rate(df: DataFrame, target: str, positive=1) -> DataFrame:
    return df.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.avg((col(target) == F.lit(positive)).cast("double")).alias("positive_rate"),
    )


def rows_in_one_only(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many rows each of two equally shaped tables holds beyond the other.

    Rows are dealt into ``_BUCKETS`` buckets by a hash, and of each bucket the signed number of rows and signed sums of
    two further 64-bit hashes are taken, added up before the shuffle. A bucket whose sums are all zero holds the same rows
    on both sides; the rows of the others alone are counted whole: signed counts per distinct row, so one
    shuffle serves both directions and a row repeated many times is one group counted map-side first.
    """
    both = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(-1)))
    # a null takes no part in the hash, so which cells are null is a cell of its own; equal rows of unequal
    # hash (0.0 and -0.0) leave sums in both their buckets and are counted whole
    cells = [*[col(c) for c in a.columns], F.concat(*[col(c).isNull().cast("string") for c in a.columns])]
    one, two = (F.xxhash64(F.lit(seed), *cells) for seed in (1, 2))
    halves = [half for h in (one, two) for half in (F.shiftright(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1)))]
    bucket = F.pmod(F.xxhash64(F.lit(3), *cells), F.lit(_BUCKETS))
    sums = both.groupBy(bucket.alias("_bucket")).agg(
        F.sum("_side").alias("_n"), *[F.sum(F.col("_side") * half).alias(f"_h{i}") for i, half in enumerate(halves)]
    )
    differs = sums.where(" OR ".join(f"{c} <> 0" for c in sums.columns[1:])).select("_bucket")
    # found now, _BUCKETS numbers at most: without any, no plan reads the rows again
    odd = both.where(bucket.isin([r["_bucket"] for r in differs.collect()]))
    diff = odd.groupBy(*[col(c) for c in a.columns]).agg(F.sum("_side").alias("_d"))
    return diff.agg(
        F.coalesce(F.sum(F.greatest(F.col("_d"), F.lit(0))), F.lit(0)).alias("only_in_first"),
        F.coalesce(F.sum(F.greatest(-F.col("_d"), F.lit(0))), F.lit(0)).alias("only_in_second"),
    )
