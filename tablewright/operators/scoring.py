"""Scoring new rows: clipping, error bands, verdicts, comparison of models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import col
from .explore import class_names

# Fixed value: a prediction moved by more than this counts as clipped.
CLIP_NOTICE = 0.05


def clip(df: DataFrame, low: float, high: float, column: str = "prediction") -> DataFrame:
    """Holds the prediction within the training range and flags what was moved."""
    held = F.greatest(F.lit(low), F.least(F.lit(high), col(column)))
    return df.withColumn("_held", held).select(
        *[F.col("_held").alias(c) if c == column else col(c) for c in df.columns],
        (F.abs(col(column) - F.col("_held")) > CLIP_NOTICE).alias("clipped"),
    )


def error_band(df: DataFrame, index: DataFrame, column: str = "prediction") -> DataFrame:
    """Adds low and high = prediction -+ the model's held-out RMSE.

    ``index`` has one row per model.
    """
    error = index.select("model", F.col("RMSE").alias("_rmse"))
    return (
        df.join(F.broadcast(error), "model", "left")
        .withColumn("low", col(column) - F.col("_rmse"))
        .withColumn("high", col(column) + F.col("_rmse"))
        .drop("_rmse")
    )


def compare(predictions: DataFrame, index: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row per (input, model) with the model's rank and held-out metrics."""
    return predictions.join(F.broadcast(index.select("model", "rank", *metrics)), "model")


def verdict(df: DataFrame, classes: Mapping, score: str = "score") -> DataFrame:
    """Adds the class name and the probability as a percentage, at most 100."""
    share = F.least(col(score).cast("double"), F.lit(1.0))
    return df.withColumn("verdict", class_names(F.col("prediction"), classes)).withColumn(
        "probability_pct", F.round(share * 100, 1)
    )


def training_ranges(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the smallest and largest training value per column."""
    aggs = []
    for c in columns:
        aggs += [F.min(col(c)).alias(f"{c}|min"), F.max(col(c)).alias(f"{c}|max")]
    return train.agg(*aggs)


def flag_extrapolation(
    df: DataFrame, ranges: DataFrame, columns: Sequence[str], rules: Mapping[str, str] | None = None
) -> DataFrame:
    """Adds ``outside_training_range`` and one flag per named SQL rule."""
    bounds = ranges.select(F.struct("*").alias("_b")).scalar()
    out = df.withColumn("_b", bounds)
    outside = F.lit(False)
    for c in columns:
        outside = outside | ~col(c).between(F.col("_b")[f"{c}|min"], F.col("_b")[f"{c}|max"])
    out = out.withColumn("outside_training_range", outside).drop("_b")
    for name, rule in (rules or {}).items():
        out = out.withColumn(name, F.expr(rule))
    return out
