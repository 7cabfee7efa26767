"""Comparison tables, cross-validation, grid search and the choice of a model."""

from __future__ import annotations

import itertools
import json
import time
from collections.abc import Iterator, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import col
from ..session import fetched, local_table
from . import gram
from .knn import NearestNeighboursModel
from .knn import _discard as discard
from .knn import _written as written
from .metrics import classification_metrics, label_metrics, ranked, regression_metrics
from .models import FittingRoom, Inputs, ModelSpec, fit_all, predictions, score_sources

R2, F1W = "r2", "f1_weighted"


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return local_table(spark, rows, schema)


# ---------------------------------------------------------------------- comparison


def compare_regressors(
    specs: Mapping[str, ModelSpec], rows: DataFrame, inputs: Inputs
) -> tuple[DataFrame, dict]:
    """Rank table (rank, model, R2, RMSE, MAE, Train_R2, Fit_seconds) and the fits.

    ``rows`` carries ``split``. All models and both splits are scored in one aggregate.
    """
    fitted, seconds = fit_all(specs, rows.where(F.col("split") == "train"), inputs)
    return regression_table(predictions(fitted, rows, inputs, keep=["split"]), seconds), fitted


def regression_table(scored: DataFrame, seconds: Mapping[str, float] | None = None) -> DataFrame:
    by_split = regression_metrics(scored, ["model", "split"])
    test = F.col("split") == "test"
    wide = by_split.groupBy("model").agg(
        *[F.max(F.when(test, F.col(m))).alias(m) for m in ("R2", "RMSE", "MAE")],
        F.max(F.when(~test, F.col("R2"))).alias("Train_R2"),
    )
    wide = wide if seconds is None else fetched(wide)
    return ranked(_with_seconds(wide, seconds), "R2")


def compare_classifiers(
    specs: Mapping[str, ModelSpec], rows: DataFrame, inputs: Inputs, positive: int = 1
) -> tuple[DataFrame, dict]:
    fitted, seconds = fit_all(specs, rows.where(F.col("split") == "train"), inputs)
    test = rows.where(F.col("split") == "test")
    # several aggregates read the scores: score once
    scored = predictions(fitted, test, inputs).persist(StorageLevel.MEMORY_AND_DISK)
    table = fetched(classification_metrics(scored, ["model"], positive))
    scored.unpersist()
    sources = _small(
        rows.sparkSession, list(score_sources(fitted, test).items()), "model string, AUC_source string"
    )
    table = table.join(F.broadcast(sources), "model").drop("n")
    return ranked(_with_seconds(table, seconds), "F1_weighted"), fitted


def _with_seconds(table: DataFrame, seconds: Mapping[str, float] | None) -> DataFrame:
    if seconds is None:
        return table
    times = _small(table.sparkSession, list(seconds.items()), "model string, Fit_seconds double")
    return table.join(F.broadcast(times), "model", "left")


def overfitting_gap(table: DataFrame) -> DataFrame:
    return table.select("model", "Train_R2", "R2", (F.col("Train_R2") - F.col("R2")).alias("gap"))


# ------------------------------------------------------------------ cross-validation


def _fold_metric(scored: DataFrame, scoring: str, by: Sequence[str]) -> DataFrame:
    if scoring == R2:
        return regression_metrics(scored, by).select(*by, F.col("R2").alias("score"))
    return label_metrics(scored, by).select(*by, F.col("F1_weighted").alias("score"))


def fold_scores(
    specs: Mapping[str, ModelSpec], rows: DataFrame, inputs: Inputs, scoring: str, folds: int
) -> DataFrame:
    """(model, fold, score): every model refitted, preparation included, without each fold.

    Least squares of all folds and penalties come from one scan's sums of products; other models
    are fitted fold by fold.
    """
    linear = [s for s in specs.values() if scoring == R2 and gram.supported(s)]
    found = gram.scores(linear, rows, inputs, folds) if linear else None
    done = None
    if found is not None:
        held = [(linear[i].name, k, score) for i, k, part, score, _ in found if part == "test"]
        done = _small(rows.sparkSession, held, "model string, fold int, score double")
        specs = {n: s for n, s in specs.items() if not gram.supported(s)}
        if not specs:
            return done
    parts = []
    for k in range(folds):
        held = rows.where(F.col("fold") == k)
        fitted, _ = fit_all(specs, rows.where(F.col("fold") != k), inputs)
        parts.append(predictions(fitted, held, inputs, keep=["fold"]))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    scores = _fold_metric(scored, scoring, ["model", "fold"])
    return scores if done is None else scores.unionByName(done)


def cross_validation_table(scores: DataFrame, scoring: str) -> DataFrame:
    """(model, scoring, folds, CV_mean, CV_std, fold_scores) with the population deviation."""
    in_order = F.array_sort(F.collect_list(F.struct("fold", "score")))
    return scores.groupBy("model").agg(
        F.lit(scoring).alias("scoring"),
        F.count("*").alias("folds"),
        F.avg("score").alias("CV_mean"),
        F.stddev_pop("score").alias("CV_std"),
        F.transform(in_order, lambda s: F.round(s["score"], 5)).alias("fold_scores"),
    )


def cross_validate(
    specs: Mapping[str, ModelSpec], rows: DataFrame, inputs: Inputs, scoring: str, folds: int = 5
) -> DataFrame:
    return cross_validation_table(fold_scores(specs, rows, inputs, scoring, folds), scoring)


def leaders(table: DataFrame, k: int = 2) -> DataFrame:
    """The k models with the best cross-validated mean."""
    return table.orderBy(F.col("CV_mean").desc(), "model").limit(k).select("model")


def leader_rows(table: DataFrame, best: DataFrame) -> DataFrame:
    return table.join(F.broadcast(best), "model", "left_semi")


def to_tune(best: DataFrame, grids: Sequence[str], k: int = 2) -> DataFrame:
    """Leaders that have a grid, filled up in grid order to k models; all leaders with a
    grid are kept."""
    order = _small(best.sparkSession, list(enumerate(grids)), "position int, model string")
    own = best.withColumn("_lead", F.lit(True))
    lead = F.coalesce(F.col("_lead"), F.lit(False))
    turn = Window.partitionBy(F.lit(1)).orderBy(lead.desc(), "position")
    return (
        order.join(F.broadcast(own), "model", "left")
        .withColumn("turn", F.row_number().over(turn))
        .where((F.col("turn") <= k) | lead)
        .select("model", "turn")
    )


# ----------------------------------------------------------------------- grid search


def grid_points(spec: ModelSpec) -> list[dict]:
    """All combinations, parameters in name order, the last one varying fastest."""
    names = sorted(spec.grid)
    return [dict(zip(names, values)) for values in itertools.product(*[spec.grid[n] for n in names])]


def _point_predictions(
    spec: ModelSpec, points: list[dict], room: FittingRoom, rows: DataFrame, inputs: Inputs, stored: list[DataFrame]
) -> Iterator[tuple[int, DataFrame, float]]:
    """(point, scored rows (part, y, p), fit seconds) of rows that carry their ``part``.

    Neighbour searches do not depend on how votes are counted, so one search with the
    largest k over both parts serves every point of a neighbour grid. What it found is a table, put in ``stored``, so
    that the plan of no point holds the search again.
    """
    if set(spec.grid) == {"n_neighbors", "weights"}:
        start = time.perf_counter()
        widest = max(p["n_neighbors"] for p in points)
        model = room.fit(spec.with_params(n_neighbors=widest))
        fit_s = time.perf_counter() - start
        search: NearestNeighboursModel = model.stages[-1]
        ready = rows
        for stage in model.stages[:-1]:
            ready = stage.transform(ready)
        votes = F.struct("neighbours.labels", "neighbours.distances").alias("neighbours")
        found = search.neighbours(ready, widest).select("part", col(inputs.label).cast("double").alias("y"), votes)
        stored.append(found := written(found, "votes"))
        for i, p in enumerate(points):
            voted = search.vote(found, p["n_neighbors"], p["weights"])
            yield i, voted.select("part", "y", F.col("prediction").alias("p")), fit_s
        return
    for i, p in enumerate(points):
        start = time.perf_counter()
        model = room.fit(spec.with_params(**p))
        fit_s = time.perf_counter() - start
        yield i, predictions({spec.name: model}, rows, inputs, keep=["part"]).select("part", "y", "p"), fit_s


def grid_search(
    spec: ModelSpec, rows: DataFrame, inputs: Inputs, scoring: str, folds: int = 5,
    points: list[dict] | None = None,
) -> tuple[DataFrame, dict]:
    """Trace (point, params, fold, part, score, fit_seconds) and the best parameters.

    ``part`` is 'test' for the held fold and 'train' for the rows fitted on. The best
    point has the highest mean test score, the first on ties.
    """
    points = points or grid_points(spec)
    spark = rows.sparkSession
    scored, times = [], []
    found = None
    if scoring == R2 and gram.supported(spec):
        found = gram.scores([spec.with_params(**p) for p in points], rows, inputs, folds)
    if found is not None:
        scored = [r[:4] for r in found]
        times = [(i, k, round(s, 6)) for i, k, part, _, s in found if part == "test"]
    for k in range(folds if found is None else 0):
        own = F.col("fold") == k
        # a row of no fold takes no part
        both = rows.where(own.isNotNull()).withColumn("part", F.when(own, "test").otherwise("train"))
        stored: list[DataFrame] = []
        with FittingRoom(rows.where(F.col("fold") != k), inputs) as room:
            fold_rows = None
            for i, frame, fit_s in _point_predictions(spec, points, room, both, inputs, stored):
                tagged = frame.select(F.lit(i).alias("point"), F.lit(k).alias("fold"), "part", "y", "p")
                fold_rows = tagged if fold_rows is None else fold_rows.unionByName(tagged)
                times.append((i, k, round(fit_s, 3)))
            # one job scores all points of the fold; its few result rows are kept
            result = _fold_metric(fold_rows, scoring, ["point", "fold", "part"]).collect()
        for table in stored:
            discard(table)
        scored = [*scored, *[(r["point"], r["fold"], r["part"], r["score"]) for r in result]]
    trace = _small(spark, scored, "point int, fold int, part string, score double")
    names = _small(spark, [(i, json.dumps(p)) for i, p in enumerate(points)], "point int, params string")
    seconds = _small(spark, times, "point int, fold int, fit_seconds double")
    trace = trace.join(F.broadcast(names), "point").join(F.broadcast(seconds), ["point", "fold"])
    top = grid_summary(trace).orderBy("rank_test_score", "point").first()
    return trace, points[top["point"]]


def grid_summary(trace: DataFrame) -> DataFrame:
    """One row per point: fold scores, means, deviations and the min-rank of the mean."""
    folds = sorted(r["fold"] for r in trace.select("fold").distinct().collect())

    def cell(part: str, k: int):
        hit = (F.col("part") == part) & (F.col("fold") == k)
        return F.max(F.when(hit, F.col("score"))).alias(f"split{k}_{part}_score")

    def own(part: str):
        return F.when(F.col("part") == part, F.col("score"))

    wide = trace.groupBy("point", "params").agg(
        F.avg(F.when(F.col("part") == "test", F.col("fit_seconds"))).alias("mean_fit_time"),
        *[cell(p, k) for p in ("test", "train") for k in folds],
        F.avg(own("test")).alias("mean_test_score"),
        F.stddev_pop(own("test")).alias("std_test_score"),
        F.avg(own("train")).alias("mean_train_score"),
        F.stddev_pop(own("train")).alias("std_train_score"),
    )
    order = Window.partitionBy(F.lit(1)).orderBy(F.col("mean_test_score").desc_nulls_last())
    return wide.withColumn("rank_test_score", F.rank().over(order))


# Per scoring, the tag of its columns, its metric, and metrics shown beside it.
_SHOWN = {R2: ("R2", "R2", ("RMSE",)), F1W: ("F1w", "F1_weighted", ("Recall_failure", "ROC_AUC"))}


def tuning_table(
    spark: SparkSession, entries: Sequence[Mapping[str, object]], scoring: str
) -> DataFrame:
    """Before and after tuning. Each entry: model, best_params, cv_before, cv_after, and
    held-out metric dicts ``before`` and ``after``. Deltas are rounded, the verdict is not."""
    tag, metric, beside = _SHOWN[scoring]
    pairs = {f"CV_{tag}": lambda e, when: e[f"cv_{when}"]}
    for name, held in [(tag, metric), *((m, m) for m in beside)]:
        pairs[f"HeldOut_{name}"] = lambda e, when, m=held: e[when].get(m)
    cells = [(p, when) for p in pairs for when in ("before", "after")]
    raw = [
        (e["model"], json.dumps(e["best_params"]), *(None if (v := pairs[p](e, w)) is None else float(v) for p, w in cells))
        for e in entries
    ]
    measured = "".join(f", `{p}_{w}` double" for p, w in cells)
    table = local_table(spark, raw, f"model string, best_params string{measured}")
    gain = lambda p: F.col(f"{p}_after") - F.col(f"{p}_before")
    # a metric that no model had before tuning has no such column
    empty = {f"{p}_{w}" for i, (p, w) in enumerate(cells, 2) if w == "before" and all(r[i] is None for r in raw)}
    kept = [F.round(f"{p}_{w}", 5).alias(f"{p}_{w}") for p, w in cells if f"{p}_{w}" not in empty]
    cv, held = f"CV_{tag}", f"HeldOut_{tag}"
    return table.select(
        "model",
        "best_params",
        *kept,
        F.round(gain(cv), 5).alias("CV_delta"),
        F.round(gain(held), 5).alias("HeldOut_delta"),
        (gain(cv) > 0).alias("improved_on_CV"),
    )


def final_pick(cv: DataFrame, held_out: DataFrame, metric: str) -> DataFrame:
    """(by_cross_validation, by_held_out): the first is the default choice, because the
    held-out rows should play no part in selection."""
    best = cv.agg(F.min(F.struct((-F.col("CV_mean")).alias("k"), "model"))["model"].alias("m"))
    top = held_out.agg(F.min(F.struct((-F.col(metric)).alias("k"), "model"))["model"].alias("m"))
    return best.select(F.col("m").alias("by_cross_validation")).withColumn("by_held_out", top.scalar())
