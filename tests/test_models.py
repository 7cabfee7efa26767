import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablewright.operators import explain, features, metrics, models, selection, split
from tablewright.operators.kernel import SupportVectorClassifier, SupportVectorRegressor
from tablewright.operators.models import Inputs
from tablewright.plans import tracks
from tablewright.plans.fits import CLF, REG_K, SMALL, SMALL_C, clf_rows, reg_rows
from tablewright.session import local_table
from tablewright.sources import store


def test_the_registry_of_the_survey(spark):
    numbers = [int(n.split(".")[0]) for n in models.regressors()]
    assert numbers == list(range(1, 11))
    assert [n[:3] for n in models.classifiers()] == [f"A{i}." for i in range(1, 6)]
    grids = {n: len(selection.grid_points(s)) for n, s in models.regressors().items() if s.grid}
    assert grids[models.RIDGE] == 5 and grids[models.LASSO] == 4 and grids[models.ELASTIC] == 12
    bayes = Inputs(("a",), (), "y").estimator(models.classifiers()[models.BAYES])
    assert isinstance(bayes, NaiveBayes) and bayes.getModelType() == "gaussian"


def test_preparation_is_fitted_on_the_rows_of_its_own_fold(spark, sf):
    """The design matrix of each fold's rows has mean 0 there, and not on the rows left out."""
    rows = split.k_folds(reg_rows(spark, sf).where("l_quantity < 10 OR row_id > 'b'"), ["row_id"], 3).persist()
    shifted = rows.withColumn("l_quantity", F.col("l_quantity") + 100 * F.col("fold"))
    inputs = Inputs(("l_quantity", "l_tax"), (), "net_k")
    for k in range(3):
        with models.FittingRoom(shifted.where(F.col("fold") != k), inputs) as room:
            model, _ = room.prepared(True, None)
        own, left = (features.vector_moments(model.transform(shifted.where(w)), ["q", "t"]).where("feature = 'q'").first()["mean"] for w in (F.col("fold") != k, F.col("fold") == k))
        assert own == pytest.approx(0, abs=1e-8) and abs(left) > 0.5 or k == 1
    rows.unpersist()


def test_nulls_unseen_and_constant_columns(spark):
    train = spark.createDataFrame(
        [(1.0, 5.0, "b"), (2.0, 5.0, "a"), (None, 5.0, "b"), (3.0, 5.0, None), (10.0, 5.0, "a")], "n double, c double, t string"
    )
    model = features.TabularFeatures(numeric=["n", "c"], categorical=["t"], scale=False).fit(train)
    rows = spark.createDataFrame([(None, None, None), (0.0, 1.0, "zz"), (0.0, 1.0, "b")], "n double, c double, t string")
    got = [list(r[0]) for r in model.transform(rows).select(vector_to_array("features")).collect()]
    assert got == [[2.5, 5.0, 0.0], [0.0, 1.0, 0.0], [0.0, 1.0, 1.0]]
    scaled = features.TabularFeatures(numeric=["c"]).fit(train).transform(train).select(vector_to_array("features")[0])
    assert {r[0] for r in scaled.collect()} == {0.0}


def test_names_with_spaces_brackets_and_quotes(spark):
    df = spark.createDataFrame([(1.0, "it's"), (2.0, "b")], "`Torque [Nm]` double, `Product.Type` string")
    model = features.TabularFeatures(numeric=["Torque [Nm]"], categorical=["Product.Type"]).fit(df)
    assert features.feature_names(model) == ["Torque [Nm]", "Product.Type_it's"]
    assert model.transform(df).count() == 2


def test_status_of_added_columns(spark):
    sql = features.AddedColumns.by_sql
    found = {"r": sql("twice a", "me", b=("int", "a * 2")), "c": sql("  ", b=("int", "a * 2")), "d": sql("no column")}
    states = features.hook_status(spark, found, ["d", "c", "r", "other"]).collect()
    assert [r["state"] for r in states] == ["INCOMPLETE", "INCOMPLETE", "COMPLETE", "AWAITING INPUT"]
    assert states[2]["detail"] == "adds b, by me"


def test_engineered_column_reaches_the_model(spark, sf):
    rows = reg_rows(spark, sf)
    added = features.AddedColumns.by_sql("the target itself", net=("double", "l_extendedprice * (1 - l_discount) * (1 + l_tax)"))
    inputs = Inputs(REG_K.numeric, REG_K.categorical, "net_k", feature=added)
    with models.FittingRoom(rows, inputs) as room:
        fit = room.fit(models.regressors()[models.LINEAR])
    assert "net" in features.feature_names(fit)
    assert metrics.regression_metrics(models.predictions({"m": fit}, rows, inputs)).first()["R2"] > 0.999999


def test_scores_rank_all_thresholds_where_labels_know_one(spark, sf):
    """The area under the label's single step is the mean of both rates; under the scores it is the ROC curve's."""
    rows = clf_rows(spark, sf)
    with models.FittingRoom(rows.where("split = 'train'"), CLF) as room:
        scored = models.predictions({"m": room.fit(models.classifiers()[models.LOGISTIC])}, rows.where("split = 'test'"), CLF).persist()
    rates = {r["y"]: r["hit"] for r in scored.groupBy("y").agg(F.avg((F.col("p") == F.col("y")).cast("double")).alias("hit")).collect()}
    step = metrics.roc_auc(scored.withColumn("score", F.col("p"))).first()["ROC_AUC"]
    assert step == pytest.approx((rates[0.0] + rates[1.0]) / 2, abs=1e-9)
    curve = metrics.roc_points(scored).orderBy("fpr", "tpr").toPandas()
    assert metrics.roc_auc(scored).first()["ROC_AUC"] == pytest.approx(np.trapezoid(curve["tpr"], curve["fpr"]), abs=1e-9)
    scored.unpersist()


def test_all_regressors_learn_the_price(spark, sf):
    table, fitted = selection.compare_regressors(models.regressors(**SMALL), reg_rows(spark, sf), REG_K)
    scores = {r["model"]: r["R2"] for r in table.collect()}
    assert len(scores) == 10
    assert min(scores[m] for m in (models.LINEAR, models.RIDGE, models.LASSO)) > 0.998
    assert scores[models.polynomial_name()] > 0.9999
    assert min(scores.values()) > 0.95, scores


def test_all_classifiers_and_the_planted_threshold(spark, sf):
    table, fitted = selection.compare_classifiers(models.classifiers(**SMALL_C), clf_rows(spark, sf), CLF)
    rows = {r["model"]: r for r in table.collect()}
    assert len(rows) == 5 and all(r["ROC_AUC"] > 0.9 for r in rows.values())
    assert rows[models.TREE_C]["Accuracy"] > 0.99
    top = explain.tree_structure(fitted[models.TREE_C], {0: "no", 1: "yes"}).where("node = 1").first()
    assert top["feature"] in ("l_extendedprice", "l_quantity")


def test_support_vector_objective_beats_least_squares(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=600)
    y = 3 * x + 1
    y[:60] += 40  # outliers pull least squares, not absolute errors
    rows = local_table(spark, [(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    rows = features.TabularFeatures(numeric=["x"], scale=False).fit(rows).transform(rows)
    fit = SupportVectorRegressor(kernel="linear", labelCol="y", maxIter=40, tol=1e-6).fit(rows).stages[-1]
    assert fit.coefficients[0] == pytest.approx(3, abs=0.1) and fit.intercept == pytest.approx(1, abs=0.2)


def test_rbf_classifier_separates_a_ring(spark):
    rng = np.random.default_rng(9)
    p = rng.normal(size=(800, 2))
    rows = local_table(spark, [(*map(float, r), float((r**2).sum() < 1.2)) for r in p], "a double, b double, label double")
    rows = features.TabularFeatures(numeric=["a", "b"]).fit(rows).transform(rows)
    ring = SupportVectorClassifier(C=10.0, components=64, maxIter=15).fit(rows).transform(rows)
    line = SupportVectorClassifier(kernel="linear", maxIter=5).fit(rows).transform(rows)
    accuracy = lambda df: df.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert accuracy(ring) > 0.93 > 0.8 > accuracy(line)
    chance = ring.select(vector_to_array("probability")[1].alias("p"), "label").groupBy("label").avg("p").collect()
    by = {r["label"]: r["avg(p)"] for r in chance}
    assert by[1.0] > 0.7 > 0.3 > by[0.0]


def test_unfitted_and_fitted_pipelines_round_trip(spark, sf, tmp_path):
    rows = reg_rows(spark, sf)
    for name in (models.RIDGE, models.SVR, models.KNN):
        pipe = REG_K.pipeline(models.regressors(**SMALL)[name])
        pipe.write().overwrite().save(str(tmp_path / "unfitted"))
        Pipeline.load(str(tmp_path / "unfitted"))
        fit = pipe.fit(rows.where("split = 'train'"))
        fit.write().overwrite().save(str(tmp_path / "fitted"))
        head = rows.orderBy("row_id").limit(20)
        a = [r["prediction"] for r in fit.transform(head).orderBy("row_id").collect()]
        b = [r["prediction"] for r in PipelineModel.load(str(tmp_path / "fitted")).transform(head).orderBy("row_id").collect()]
        assert a == b


def test_grid_order_and_shared_neighbour_search(spark, sf):
    spec = models.regressors()[models.KNN]
    points = selection.grid_points(spec)
    assert points[:2] == [{"n_neighbors": 3, "weights": "uniform"}, {"n_neighbors": 3, "weights": "distance"}]
    rows = split.k_folds(reg_rows(spark, sf), ["row_id"], 2).persist()
    trace, best = selection.grid_search(spec, rows, REG_K, selection.R2, folds=2, points=points[:3])
    direct = selection.fold_scores({"m": spec.with_params(n_neighbors=3)}, rows, REG_K, selection.R2, 2)
    want = {r["fold"]: r["score"] for r in direct.collect()}
    got = {r["fold"]: r["score"] for r in trace.where("point = 0 AND part = 'test'").collect()}
    assert got == pytest.approx(want)
    assert best in points


def test_regression_track_end_to_end(spark, sf, tmp_path):
    from tablewright.plans.fixtures import view
    from tablewright.sources.contracts import NET_PRICE

    out = str(tmp_path / "run")
    only = [models.LINEAR, models.RIDGE]
    summary = tracks.run_regression(view(spark, sf, "reg_view"), NET_PRICE, out, only=only)
    assert summary["best_model"].strip('"') in only
    index = store.load_index(spark, out, "regression").orderBy("rank").collect()
    assert [r["rank"] for r in index] == [1, 2]
    model, about = store.load_best(spark, out, "regression")
    assert about.first()["model_name"] in only
    assert model.transform(view(spark, sf, "reg_view")).select("prediction").count() == 6000
    tuning = spark.read.option("header", True).csv(f"{out}/regression_tuning").collect()
    assert [r["model"] for r in tuning] == [models.RIDGE]


def test_classification_track_in_development_mode(spark, sf, tmp_path):
    from tablewright.plans.fixtures import view
    from tablewright.sources.contracts import OVERLOAD

    out = str(tmp_path / "run")
    only = [models.BAYES]
    tracks.run_classification(view(spark, sf, "clf_view"), OVERLOAD, out, mode="dev", only=only)
    table = spark.read.option("header", True).csv(f"{out}/classification_comparison_dev")
    assert table.count() == 1
    assert spark.read.json(f"{out}/run_log_classification_dev").count() >= 3


def test_support_vector_regression_keeps_no_mapped_rows(spark, monkeypatch):
    """Rounds scan the inputs; what is held meanwhile has as many cells as there are inputs, and is let go."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 2))
    rows = local_table(spark, [(float(a), float(b), float(np.sin(a) + b)) for a, b in x], "a double, b double, y double")
    rows = features.TabularFeatures(numeric=["a", "b"]).fit(rows).transform(rows)
    held, original = [], type(rows).persist
    monkeypatch.setattr(type(rows), "persist", lambda df, *level: held.append(df.columns) or original(df, *level))
    fit = SupportVectorRegressor(labelCol="y", C=10.0, components=64).fit(rows)
    assert held == [["features", "_y"]]
    error = fit.transform(rows).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert error < 0.2


def test_support_vector_classifier_holds_inputs_alone(spark, monkeypatch):
    rng = np.random.default_rng(12)
    rows = local_table(spark, [(*map(float, r), float((r**2).sum() < 1.2)) for r in rng.normal(size=(300, 2))], "a double, b double, label double")
    rows = features.TabularFeatures(numeric=["a", "b"]).fit(rows).transform(rows)
    held, original = [], type(rows).persist
    monkeypatch.setattr(type(rows), "persist", lambda df, *level: held.append(df.columns) or original(df, *level))
    SupportVectorClassifier(components=16, maxIter=3).fit(rows)
    assert held == [["features", "label"]]


def test_boosting_query_runs_all_rounds_of_the_registry(monkeypatch):
    from tablewright.plans import fits

    monkeypatch.setattr(fits, "_reg_scores", lambda spark, sf, name, *inputs, **changes: models.regressors(**changes)[name].defaults)
    assert fits.gradient_boosting(None, None) == models.regressors()[models.BOOSTING].defaults == {"learning_rate": 0.1, "n_estimators": 200}


@pytest.mark.parametrize("kernel", ["rbf", "linear"])
def test_support_vector_regression_scans_once_per_round(spark, monkeypatch, kernel):
    """The last round's sums of products are the fit: MLlib, which maps and reads all rows twice more, is not asked."""
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(13)
    x = rng.normal(size=(400, 2))
    rows = local_table(spark, [(float(a), float(b), float(a + 2 * b + 1)) for a, b in x], "a double, b double, y double")
    rows = features.TabularFeatures(numeric=["a", "b"], scale=False).fit(rows).transform(rows)
    monkeypatch.setattr(LinearRegression, "_fit", lambda self, df: pytest.fail("a further fit"))
    fit = SupportVectorRegressor(kernel=kernel, labelCol="y", C=10.0, components=64).fit(rows)
    error = fit.transform(rows).agg(F.avg(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert error < 0.2
    if kernel == "linear":
        assert list(fit.stages[-1].coefficients) == pytest.approx([1, 2], abs=0.05)


def test_neighbour_grid_searches_once_per_fold(spark, sf, monkeypatch):
    """Held and training rows are searched together, and what was found is read, not searched again, by every point."""
    from tablewright.operators import knn

    spec = models.regressors()[models.KNN]
    points = selection.grid_points(spec)[:4]
    rows = split.k_folds(reg_rows(spark, sf).where("l_quantity < 8"), ["row_id"], 2).persist()
    searches, original = [], knn.with_neighbours
    monkeypatch.setattr(knn, "with_neighbours", lambda queries, *a: searches.append(1) or original(queries, *a))
    trace, _ = selection.grid_search(spec, rows, REG_K, selection.R2, folds=2, points=points)
    assert len(searches) == 2
    got = {(r["point"], r["fold"], r["part"]): r["score"] for r in trace.collect()}
    assert len(got) == 16 and all(got[1, k, "train"] == 1.0 for k in range(2))
    direct = selection.fold_scores({"m": spec.with_params(**points[3])}, rows, REG_K, selection.R2, 2)
    assert {r["fold"]: r["score"] for r in direct.collect()} == pytest.approx({k: got[3, k, "test"] for k in range(2)})
    rows.unpersist()
