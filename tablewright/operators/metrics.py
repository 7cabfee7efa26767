"""Scores of predictions, for any number of models in one pass.

Input is long: one row per (model, row) with the true value ``y``, the prediction
``p`` and, for ranking, ``score``. ``by`` names the grouping columns, a short list
such as models, splits or folds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import col, ratio
from ..functions.running import running_totals


def regression_metrics(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(by..., n, R2, RMSE, MAE) in the units of the target: one partial aggregate."""
    err = F.col("y") - F.col("p")
    sums = df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(err * err).alias("_mse"),
        F.avg(F.abs(err)).alias("MAE"),
        F.var_pop("y").alias("_var"),
    )
    flat = F.when(F.col("_mse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("_var") == 0, flat).otherwise(
        1 - F.try_divide(F.col("_mse"), F.col("_var"))
    )
    return sums.select(*by, "n", r2.alias("R2"), F.sqrt("_mse").alias("RMSE"), "MAE")


def confusion(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(by..., y, p, count) with a zero for every missing pair of known classes."""
    by = list(by)
    seen = df.groupBy(*by, "y", "p").agg(F.count("*").alias("count"))
    classes = seen.select(F.explode(F.array("y", "p")).alias("_class")).agg(
        F.collect_set("_class").alias("_classes")
    )
    # classes x classes rows per group, built from the already counted pairs
    grid = (
        seen.select(*by)
        .distinct()
        .withColumn("_classes", classes.scalar())
        .withColumn("y", F.explode("_classes"))
        .withColumn("p", F.explode("_classes"))
        .drop("_classes")
    )
    return grid.join(seen, [*by, "y", "p"], "left").select(
        *by, "y", "p", F.coalesce("count", F.lit(0)).alias("count")
    )


def class_scores(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(by..., class, support, predicted, hits, precision, recall, f1), 0 where undefined."""
    by = list(by)
    pairs = df.groupBy(*by, "y", "p").agg(F.count("*").alias("_c"))
    hit = F.when(F.col("y") == F.col("p"), F.col("_c")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("y").alias("class"),
            F.col("_c").alias("support"),
            zero.alias("predicted"),
            hit.cast("long").alias("hits"),
        ),
        F.struct(
            F.col("p").alias("class"),
            zero.alias("support"),
            F.col("_c").alias("predicted"),
            zero.alias("hits"),
        ),
    )
    per_class = (
        pairs.select(*by, F.explode(sides).alias("_s"))
        .select(*by, "_s.*")
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    return per_class.select(
        "*",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
    )


def label_metrics(df: DataFrame, by: Sequence[str] = ("model",), positive=1) -> DataFrame:
    """Accuracy, binary precision / recall / F1 of ``positive`` and support-weighted F1."""
    own = F.col("class") == F.lit(positive)

    def of_positive(name: str):
        return F.coalesce(F.max(F.when(own, F.col(name))), F.lit(0.0))

    return class_scores(df, by).groupBy(*by).agg(
        F.sum("support").alias("n"),
        ratio(F.sum("hits"), F.sum("support")).alias("Accuracy"),
        of_positive("precision").alias("Precision_failure"),
        of_positive("recall").alias("Recall_failure"),
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("F1_weighted"),
        of_positive("f1").alias("F1_failure"),
    )


def _by_score(df: DataFrame, by: Sequence[str], positive) -> DataFrame:
    is_pos = F.col("y") == F.lit(positive)
    return df.where(F.col("score").isNotNull()).groupBy(*by, "score").agg(
        F.count_if(is_pos).alias("pos"), F.count_if(~is_pos).alias("neg")
    )


def roc_auc(df: DataFrame, by: Sequence[str] = ("model",), positive=1) -> DataFrame:
    """(by..., ROC_AUC): exact, ties at half weight; NULL with one class or no score.

    Scores are counted first, so equal scores are one row before anything is ordered.
    """
    by = list(by)
    ranked = running_totals(_by_score(df, by, positive), by, "score", ["neg"])
    area = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    scored = ranked.groupBy(*by).agg(F.try_divide(area, pairs).alias("ROC_AUC"))
    return df.select(*by).distinct().join(F.broadcast(scored), by, "left")


def roc_points(df: DataFrame, by: Sequence[str] = ("model",), positive=1) -> DataFrame:
    """(by..., threshold, fpr, tpr): one point per distinct score, from the highest down.

    The start (0, 0) has a NULL threshold. The chance line is fpr = tpr.
    """
    by = list(by)
    counts = _by_score(df, by, positive)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    ranked = running_totals(counts, by, "score", ["pos", "neg"], descending=True)
    curve = ranked.join(F.broadcast(totals), by).select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide((F.col("neg_before") + F.col("neg")).cast("double"), F.col("_n")).alias("fpr"),
        F.try_divide((F.col("pos_before") + F.col("pos")).cast("double"), F.col("_p")).alias("tpr"),
    )
    start = totals.select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.withColumn("threshold", F.col("threshold").cast("double")).unionByName(start)


def classification_metrics(df: DataFrame, by: Sequence[str] = ("model",), positive=1) -> DataFrame:
    """All six scores; needs a ``score`` column (NULL where a model gives none)."""
    return label_metrics(df, by, positive).join(
        F.broadcast(roc_auc(df, by, positive)), list(by), "left"
    )


def majority_baseline(df: DataFrame, target: str) -> DataFrame:
    """(majority_class, baseline_accuracy, baseline_f1_weighted) of always guessing the
    most frequent training class (smallest on ties) on the test rows.

    Only the (split, class) counts are looked at.
    """
    counts = df.groupBy("split", col(target).alias("_y")).agg(F.count("*").alias("_c"))
    top = counts.where(F.col("split") == "train").agg(
        F.min(F.struct((-F.col("_c")).alias("k"), F.col("_y").alias("v")))["v"].alias("v")
    )
    tested = counts.where(F.col("split") == "test").withColumn("_top", top.scalar())
    hits = F.sum(F.when(F.col("_y") == F.col("_top"), F.col("_c")).otherwise(0))
    share = hits / F.sum("_c")
    return tested.agg(
        F.max("_top").alias("majority_class"),
        share.alias("baseline_accuracy"),
        (share * 2 * share / (1 + share)).alias("baseline_f1_weighted"),
        F.sum("_c").alias("test_rows"),
    )


def residuals(df: DataFrame) -> DataFrame:
    """Adds ``residual`` = actual - predicted."""
    return df.withColumn("residual", F.col("y") - F.col("p"))


def identity_span(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(by..., lo, hi): the ends of the y = x line over actual and predicted values."""
    return df.groupBy(*by).agg(
        F.least(F.min("y"), F.min("p")).alias("lo"),
        F.greatest(F.max("y"), F.max("p")).alias("hi"),
    )


def ranked(table: DataFrame, metric: str, name: str = "model", alias: str = "rank") -> DataFrame:
    """Adds the rank by ``metric``, best first; NULLs last, names break ties.

    For result tables: one row per model, so the single-task window is tiny.
    """
    order = Window.partitionBy(F.lit(1)).orderBy(F.col(metric).desc_nulls_last(), col(name))
    return table.withColumn(alias, F.row_number().over(order))
