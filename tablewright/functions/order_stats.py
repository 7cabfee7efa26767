"""Exact quantiles without sorting a column in one task.

A sketch first brackets each wanted rank. A second scan counts what lies below
the bracket and keeps the frequency of the few values inside it, so only a sliver
of the column is ever shuffled or sorted. A bracket that misses its rank raises an
error instead of returning a wrong value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .exprs import col, melt

# The sketch's rank error is 1 / ACCURACY of the row count; brackets are three
# times as wide on each side.
ACCURACY = 20_000
SLACK = 3.0 / ACCURACY


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Rows (by..., column, prob, value), interpolated linearly between ranks.

    NULLs are left out. ``by`` is meant for class columns: one bracket row per
    group, column and probability is broadcast, so their number must stay small.
    """
    by = list(by)
    probs = sorted(set(probs))
    cells = melt(df, columns, keep=by).where(F.col("value").isNotNull())
    points = [max(0.0, p - SLACK) for p in probs] + [min(1.0, p + SLACK) for p in probs]
    sketch = cells.groupBy(*by, "column").agg(
        F.count("*").alias("_n"),
        F.min("value").alias("_min"),
        F.max("value").alias("_max"),
        F.percentile_approx("value", points, ACCURACY).alias("_cuts"),
    )
    # with few rows the slack is less than a rank: take the whole column then
    few = F.col("_n") * F.lit(SLACK) < 4
    k = len(probs)
    wanted = F.array(
        *[
            F.struct(
                F.lit(p).alias("prob"),
                F.when(few, F.col("_min")).otherwise(F.col("_cuts")[i]).alias("lo"),
                F.when(few, F.col("_max")).otherwise(F.col("_cuts")[k + i]).alias("hi"),
            )
            for i, p in enumerate(probs)
        ]
    )
    brackets = sketch.select(
        *[col(b).alias(f"_by{i}") for i, b in enumerate(by)],
        F.col("column").alias("_column"),
        ((F.col("_n") - 1)).alias("_last"),
        F.explode(wanted).alias("_w"),
    )
    same = F.col("column") == F.col("_column")
    for i, b in enumerate(by):
        same = same & col(b).eqNullSafe(F.col(f"_by{i}"))
    inside = (
        cells.join(F.broadcast(brackets), same)
        .where(F.col("value") <= F.col("_w.hi"))
        .select(
            *[col(b) for b in by],
            "column",
            F.col("_w.prob").alias("prob"),
            (F.col("_last") * F.col("_w.prob")).alias("_rank"),
            F.when(F.col("value") >= F.col("_w.lo"), F.col("value")).alias("_key"),
        )
    )
    counted = inside.groupBy(*by, "column", "prob", "_rank", "_key").agg(
        F.count("*").alias("_c")
    )
    upto = Window.partitionBy(*by, "column", "prob").orderBy(F.col("_key").asc_nulls_first())
    ranked = counted.withColumn("_upto", F.sum("_c").over(upto))
    low, high = F.floor("_rank"), F.ceil("_rank")
    found = ranked.groupBy(*by, "column", "prob", "_rank").agg(
        F.max(F.when(F.col("_key").isNull(), F.col("_upto"))).alias("_below"),
        F.min(F.when(F.col("_upto") > low, F.col("_key"))).alias("_v0"),
        F.min(F.when(F.col("_upto") > high, F.col("_key"))).alias("_v1"),
    )
    missed = (F.coalesce(F.col("_below"), F.lit(0)) > low) | F.col("_v1").isNull()
    value = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col("_rank") - low)
    return found.select(
        *[col(b) for b in by],
        "column",
        "prob",
        F.when(missed, F.raise_error(F.lit("quantile bracket missed its rank")).cast("double"))
        .otherwise(value)
        .alias("value"),
    )


def quantile_columns(
    df: DataFrame, columns: Sequence[str], probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Rows (by..., column, <one column per named probability>)."""
    long = exact_quantiles(df, columns, list(probs.values()), by)
    return long.groupBy(*by, "column").agg(
        *[
            F.max(F.when(F.col("prob") == F.lit(p), F.col("value"))).alias(name)
            for name, p in probs.items()
        ]
    )
