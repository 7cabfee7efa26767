"""What fitted models learned: coefficients, odds, importances, tree structure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fetched, local_table
from .features import feature_names
from .knn import METRICS
from .metrics import classification_metrics, regression_metrics
from .models import FittingRoom, Inputs, ModelSpec, polynomial, predictions


def _spark() -> SparkSession:
    return SparkSession.active()


def coefficients(model: PipelineModel) -> DataFrame:
    """(feature, coefficient, intercept), largest absolute coefficient first."""
    fit = model.stages[-1]
    rows = [
        (n, float(c), float(fit.intercept)) for n, c in zip(feature_names(model), fit.coefficients.toArray())
    ]
    return (
        local_table(_spark(), rows, "feature string, coefficient double, intercept double")
        .orderBy(F.abs("coefficient").desc(), "feature")
    )


def odds_ratios(model: PipelineModel) -> DataFrame:
    """(feature, coefficient_log_odds, odds_ratio, intercept) per one standard deviation."""
    table = coefficients(model)
    return table.select(
        "feature",
        F.col("coefficient").alias("coefficient_log_odds"),
        F.exp("coefficient").alias("odds_ratio"),
        "intercept",
    ).orderBy(F.abs("coefficient_log_odds").desc(), "feature")


def sparsity(model: PipelineModel, tol: float = 1e-8) -> DataFrame:
    """One row: coefficients, how many are zero, which, and their share."""
    zero = F.abs("coefficient") <= tol
    return (
        coefficients(model)
        .agg(
            F.count("*").alias("n_features"),
            F.count_if(zero).alias("n_zero_coefficients"),
            F.array_sort(F.collect_list(F.when(zero, F.col("feature")))).alias("zeroed_features"),
        )
        .withColumn(
            "pct_zero",
            F.round(100 * F.col("n_zero_coefficients") / F.greatest(F.col("n_features"), F.lit(1)), 2),
        )
    )


def importances(model: PipelineModel) -> DataFrame:
    """(feature, importance) of a tree or a forest, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(feature_names(model), values)]
    return (
        local_table(_spark(), rows, "feature string, importance double")
        .orderBy(F.col("importance").desc(), "feature")
    )


def top_effects(table: DataFrame, value: str, k: int = 20) -> DataFrame:
    """The k rows with the largest absolute value, signs kept."""
    return table.orderBy(F.abs(value).desc(), "feature").limit(k)


def polynomial_degrees(rows: DataFrame, inputs: Inputs, degrees: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """(degree, n_expanded_terms, train_R2, test_R2, test_RMSE, test_MAE)."""
    fitted, terms = {}, []
    with FittingRoom(rows.where(F.col("split") == "train"), inputs) as room:
        for d in degrees:
            model = room.fit(polynomial(d))
            fitted[str(d)] = model
            terms.append((str(d), len(feature_names(model))))
        scored = fetched(
            regression_metrics(predictions(fitted, rows, inputs, keep=["split"]), ["model", "split"])
        )
        test = F.col("split") == "test"
        wide = scored.groupBy("model").agg(
            F.max(F.when(~test, F.col("R2"))).alias("train_R2"),
            F.max(F.when(test, F.col("R2"))).alias("test_R2"),
            F.max(F.when(test, F.col("RMSE"))).alias("test_RMSE"),
            F.max(F.when(test, F.col("MAE"))).alias("test_MAE"),
        )
    names = local_table(rows.sparkSession, terms, "model string, n_expanded_terms int")
    return wide.join(F.broadcast(names), "model").select(
        F.col("model").cast("int").alias("degree"), "n_expanded_terms",
        "train_R2", "test_R2", "test_RMSE", "test_MAE",
    )


def distance_comparison(
    spec: ModelSpec, rows: DataFrame, inputs: Inputs, metrics: Sequence[str] = METRICS, positive: int = 1
) -> DataFrame:
    """Classification scores of the same neighbour model under each distance."""
    fitted = {}
    with FittingRoom(rows.where(F.col("split") == "train"), inputs) as room:
        for m in metrics:
            fitted[m] = room.fit(spec.with_params(metric=m))
        scored = predictions(fitted, rows.where(F.col("split") == "test"), inputs).persist(
            StorageLevel.MEMORY_AND_DISK
        )
        table = fetched(classification_metrics(scored, ["model"], positive))
        scored.unpersist()
    return table.select(
        F.col("model").alias("distance_metric"),
        "Accuracy", "Precision_failure", "Recall_failure", "F1_weighted", "ROC_AUC",
    )


def tree_structure(model: PipelineModel, classes: Mapping[int, str] | None = None, depth: int = 3) -> DataFrame:
    """(node, level, is_leaf, feature, threshold, prediction, rows, <share per class>) down to ``depth``.

    Left children hold values at most the threshold. Node numbers count the root as 1 and
    children as 2i and 2i + 1. A tree has at most 2^depth - 1 nodes to show.
    """
    names = feature_names(model)
    fit = model.stages[-1]
    labels = classes or {}
    rows = []

    def visit(node, number: int, level: int) -> None:
        leaf = node.numDescendants() == 0
        stats = list(node.impurityStats().stats()) if labels else []
        total = sum(stats) or 1.0
        split = None if leaf else node.split()
        rows.append(
            (
                number, level, leaf,
                None if leaf else names[split.featureIndex()],
                None if leaf or not hasattr(split, "threshold") else float(split.threshold()),
                float(node.prediction()),
                float(node.impurityStats().count()),
                [stats[i] / total for i in range(len(labels))] if stats else [],
            )
        )
        if not leaf and level < depth:
            visit(node.leftChild(), 2 * number, level + 1)
            visit(node.rightChild(), 2 * number + 1, level + 1)

    visit(fit._java_obj.rootNode(), 1, 0)
    schema = (
        "node long, level int, is_leaf boolean, feature string, threshold double, "
        "prediction double, rows double, shares array<double>"
    )
    table = local_table(_spark(), rows, schema)
    shares = [F.try_element_at("shares", F.lit(i + 1)).alias(f"share_{labels[c]}") for i, c in enumerate(sorted(labels))]
    return table.select("node", "level", "is_leaf", "feature", "threshold", "prediction", "rows", *shares)
