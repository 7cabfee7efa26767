"""The two tracks end to end: audit, split, fit, compare, select, tune, explain, store."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import SEED, numeric_columns
from ..operators import explain, explore, features, metrics, models, profiling, selection, split
from ..operators.models import Inputs, ModelSpec
from ..session import fetched, local_table, spread_out
from ..sources import contracts, sinks, store

FOLDS = 5


def tune_models(
    specs: Mapping[str, ModelSpec],
    rows: DataFrame,
    inputs: Inputs,
    scoring: str,
    cv: DataFrame | None = None,
    folds: int = FOLDS,
    stratify: str | None = None,
) -> tuple[DataFrame, dict[str, PipelineModel], dict[str, DataFrame]]:
    """Grid search on the train rows: (before/after table, tuned fits, traces).

    ``rows`` carries ``split``; the held-out rows are only scored at the end.
    """
    train = rows.where(F.col("split") == "train")
    test = rows.where(F.col("split") == "test")
    folded = split.k_folds(train, [inputs.key], folds, stratify, eager=True).persist(StorageLevel.MEMORY_AND_DISK)
    if cv is None:
        cv = fetched(selection.cross_validate(specs, folded, inputs, scoring, folds))
    before_cv = {r["model"]: r["CV_mean"] for r in cv.collect()}
    score = metrics.regression_metrics if scoring == selection.R2 else metrics.classification_metrics
    entries, tuned, traces = [], {}, {}
    for name, spec in specs.items():
        trace, best = selection.grid_search(spec, folded, inputs, scoring, folds)
        top = selection.grid_summary(trace).orderBy("rank_test_score", "point").first()
        with models.FittingRoom(train, inputs) as room:
            pair = {"before": room.fit(spec), "after": room.fit(spec.with_params(**best))}
            scored = models.predictions(pair, test, inputs).persist(StorageLevel.MEMORY_AND_DISK)
            held = {r["model"]: r.asDict() for r in score(scored).collect()}
            scored.unpersist()
        entries.append(
            {
                "model": name,
                "best_params": best,
                "cv_before": before_cv[name],
                "cv_after": top["mean_test_score"],
                **held,
            }
        )
        tuned[name], traces[name] = pair["after"], trace
    folded.unpersist()
    return selection.tuning_table(rows.sparkSession, entries, scoring), tuned, traces


def _inputs(spec: contracts.DatasetSpec, key: str, feature) -> Inputs:
    return Inputs(spec.numeric, spec.categorical, spec.target, key, feature)


class _Track:
    """What both tracks share: the output folder, the log and the prepared rows."""

    def __init__(self, raw: DataFrame, spec: contracts.DatasetSpec, key: str, out: str, mode: str):
        self.spark, self.raw, self.spec, self.key = raw.sparkSession, raw, spec, key
        self.out, self.end = out, sinks.suffix(mode)
        self.log = sinks.RunLog(self.spark, spec.track, mode)
        self.summary: list[tuple[str, str]] = [("mode", mode)]

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a result table and returns it as the few rows it is."""
        result = fetched(df)
        sinks.save_table(result, self.out, f"{self.spec.track}_{name}{self.end}", markdown=True)
        return result

    def rows(self, df: DataFrame, name: str) -> None:
        """Writes a table that grows with the data, one row per value or bin, past the driver."""
        sinks.save_table(df, self.out, f"{self.spec.track}_{name}{self.end}")

    def note(self, what: str, value: object) -> None:
        self.summary.append((what, json.dumps(value, default=str)))

    def audit(self) -> DataFrame:
        spec = self.spec
        columns = [c for c in self.raw.columns if c != self.key]
        self.table(profiling.audit(self.raw, self.key, columns), "audit_raw")
        facts = self.table(profiling.summary(self.raw, spec.target, columns), "summary").first()
        self.note("raw_shape", [facts["rows"], facts["cols"]])
        self.note("n_duplicate_rows", facts["duplicate_rows"])
        self.log.add("audit", f"rows={facts['rows']} duplicates={facts['duplicate_rows']}")
        prepared = contracts.prepare(self.raw, spec, self.key)
        self.table(profiling.duplicate_policy(prepared, spec.kept), "duplicate_policy")
        self.rows(explore.distributions(prepared, spec.features), "distributions")
        numbers = [c for c in numeric_columns(prepared) if c != self.key]
        self.table(explore.correlation_matrix(prepared, numbers), "correlations")
        inputs = [c for c in numbers if c != spec.target]
        best = self.table(
            explore.top_inputs(explore.target_correlation(prepared, inputs, spec.target)), "top_inputs"
        )
        self.log.add("eda", f"strongest inputs {[r['column'] for r in best.collect()]}")
        return prepared

    def choose(self, cv: DataFrame, specs: Mapping[str, ModelSpec]) -> list[str]:
        best = selection.leaders(cv)
        self.table(selection.leader_rows(cv, best), "cv_top2")
        grids = [n for n, s in specs.items() if s.grid]
        turn = selection.to_tune(best, grids).orderBy("turn").collect()
        return [r["model"] for r in turn]

    def finish(self) -> dict[str, str]:
        rows = [*self.summary]
        sinks.save_json(
            local_table(self.spark, rows, "key string, value string"), self.out, f"{self.spec.track}_run_summary{self.end}"
        )
        self.log.add("done")
        self.log.save(self.out)
        return dict(rows)


def run_regression(
    raw: DataFrame,
    spec: contracts.DatasetSpec,
    out: str,
    key: str = "row_id",
    mode: str = "full",
    settings: Mapping[str, Mapping] | None = None,
    feature: features.AddedColumns | None = None,
    only: Sequence[str] | None = None,
) -> dict[str, str]:
    """Every stage of the regression track; tables and models are written under ``out``.

    ``settings`` bounds expensive models, ``only`` restricts which are run.
    """
    t = _Track(raw, spec, key, out, mode)
    prepared, inputs = t.audit(), _inputs(spec, key, feature)
    rows = split.hold_out(spread_out(prepared, key), [key], eager=True).persist(StorageLevel.MEMORY_AND_DISK)
    t.table(split.row_overlap(rows, spec.features), "row_overlap")
    specs = models.regressors(**(settings or {}))
    specs = {n: s for n, s in specs.items() if only is None or n in only}
    table, fitted = selection.compare_regressors(specs, rows, inputs)
    table = t.table(table, "comparison")
    t.log.add("models", f"{len(fitted)} models fitted")

    folded = split.k_folds(rows.where(F.col("split") == "train"), [key], FOLDS, eager=True).persist()
    cv = t.table(selection.cross_validate(specs, folded, inputs, selection.R2, FOLDS), "cv_all")
    folded.unpersist()
    tunable = {n: specs[n] for n in t.choose(cv, specs)}
    tuned, traces = {}, {}
    if tunable:
        tuning, tuned, traces = tune_models(tunable, rows, inputs, selection.R2, cv)
        t.table(tuning, "tuning")
    for name, trace in traces.items():
        t.table(selection.grid_summary(trace), f"grid_{name.split('.')[0]}")
    t.log.add("tuning", f"{len(tuned)} models tuned")

    if models.LINEAR in fitted:
        t.table(explain.coefficients(fitted[models.LINEAR]), "linear_coefficients")
    if models.LASSO in fitted:
        t.table(explain.sparsity(fitted[models.LASSO]), "lasso_sparsity")
    for name in (models.TREE, models.FOREST):
        if name in fitted:
            t.table(explain.importances(fitted[name]), f"importances_{name.split('.')[0]}")
    degrees = (1, 2, 3) if mode == "full" else (1, 2)
    t.table(explain.polynomial_degrees(rows, inputs, degrees), "polynomial_degrees")

    pick = t.table(selection.final_pick(cv, table, "R2"), "final_pick").first()
    best = pick["by_cross_validation"]
    t.note("best_model", best)
    t.note("best_model_heldout", pick["by_held_out"])
    model = tuned.get(best, fitted[best])
    test = rows.where(F.col("split") == "test")
    scored = models.predictions({best: model}, test, inputs).persist(StorageLevel.MEMORY_AND_DISK)
    t.rows(explore.histogram(metrics.residuals(scored), ["residual"]), "residual_histogram")
    t.table(metrics.identity_span(scored), "identity_span")
    if mode == "full":
        index = fetched(store.model_index(table, spec.track, "R2", ["RMSE", "MAE", "Train_R2"], list(tuned)))
        store.save_models(fitted, index, out)
        scores = {k: v for k, v in metrics.regression_metrics(scored).first().asDict().items() if k != "model"}
        store.save_best(model, out, spec.track, best, spec.features, spec.target, SEED, scores=scores)
        t.log.add("persist", f"{len(fitted)} pipelines")
    scored.unpersist()
    rows.unpersist()
    return t.finish()


def run_classification(
    raw: DataFrame,
    spec: contracts.DatasetSpec,
    out: str,
    key: str = "row_id",
    mode: str = "full",
    settings: Mapping[str, Mapping] | None = None,
    feature: features.AddedColumns | None = None,
    only: Sequence[str] | None = None,
) -> dict[str, str]:
    """Every stage of the classification track, stratified on the target."""
    t = _Track(raw, spec, key, out, mode)
    prepared, inputs = t.audit(), _inputs(spec, key, feature)
    positive = spec.positive_class if spec.positive_class is not None else 1
    t.table(explore.class_distribution(prepared, spec.target, spec.classes), "class_distribution")
    t.table(explore.box_statistics(prepared, list(spec.numeric), spec.target), "box_statistics")
    rows = split.hold_out(spread_out(prepared, key), [key], stratify=spec.target, eager=True).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    t.table(split.row_overlap(rows, spec.features), "row_overlap")
    t.table(metrics.majority_baseline(rows, spec.target), "majority_baseline")
    specs = models.classifiers(**(settings or {}))
    specs = {n: s for n, s in specs.items() if only is None or n in only}
    table, fitted = selection.compare_classifiers(specs, rows, inputs, positive)
    table = t.table(table, "comparison")
    test = rows.where(F.col("split") == "test")
    scored = models.predictions(fitted, test, inputs).persist(StorageLevel.MEMORY_AND_DISK)
    t.table(metrics.confusion(scored), "confusion")
    # one point per distinct score: written, never fetched
    sinks.save_table(metrics.roc_points(scored, positive=positive), out, f"{spec.track}_roc{t.end}", markdown=False)
    scored.unpersist()
    t.log.add("models", f"{len(fitted)} models fitted")

    folded = split.k_folds(
        rows.where(F.col("split") == "train"), [key], FOLDS, spec.target, eager=True
    ).persist(StorageLevel.MEMORY_AND_DISK)
    cv = t.table(selection.cross_validate(specs, folded, inputs, selection.F1W, FOLDS), "cv_all")
    folded.unpersist()
    tunable = {n: specs[n] for n in t.choose(cv, specs)}
    tuned, traces = {}, {}
    if tunable:
        tuning, tuned, traces = tune_models(tunable, rows, inputs, selection.F1W, cv, stratify=spec.target)
        t.table(tuning, "tuning")
    for name, trace in traces.items():
        t.table(selection.grid_summary(trace), f"grid_{name.split('.')[0]}")
    t.log.add("tuning", f"{len(tuned)} models tuned")

    if models.LOGISTIC in fitted:
        t.table(explain.odds_ratios(fitted[models.LOGISTIC]), "logreg_odds")
    if models.TREE_C in fitted:
        t.table(explain.importances(fitted[models.TREE_C]), "importances")
        t.table(explain.tree_structure(fitted[models.TREE_C], spec.classes), "tree")
    if models.KNN_C in fitted:
        t.table(explain.distance_comparison(specs[models.KNN_C], rows, inputs, positive=positive), "knn_distances")
    pick = t.table(selection.final_pick(cv, table, "F1_weighted"), "final_pick").first()
    best = pick["by_cross_validation"]
    t.note("best_model", best)
    t.note("best_model_heldout", pick["by_held_out"])
    if mode == "full":
        extra = ["Accuracy", "Precision_failure", "Recall_failure", "ROC_AUC"]
        index = fetched(store.model_index(table, spec.track, "F1_weighted", extra, list(tuned)))
        store.save_models(fitted, index, out)
        store.save_best(
            tuned.get(best, fitted[best]), out, spec.track, best, spec.features, spec.target, SEED, spec.classes
        )
        t.log.add("persist", f"{len(fitted)} pipelines")
    rows.unpersist()
    return t.finish()
