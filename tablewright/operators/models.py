"""The ten regressors and five classifiers as pipelines from raw-shaped rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import SEED, col
from ..session import checkpoints_ready
from . import features as fe
from .kernel import SupportVectorClassifier, SupportVectorRegressor
from .knn import BROADCAST_BYTES, NearestNeighbours
from .linear import WEIGHT, PenalisedLogistic, PenalisedRegression, balanced_weight

# MLlib trees stop at this depth; "unlimited" means this.
DEEPEST = 30
EXPANDED = "expanded"
Params = Mapping[str, object]


@dataclass(frozen=True)
class ModelSpec:
    """A named model: how its inputs are prepared and how its estimator is made.

    ``make`` takes (params, label, features column); ``defaults`` are the baseline
    settings, ``grid`` the values tried by tuning.
    """

    name: str
    make: Callable[[Params, str, str], Estimator]
    defaults: Params = field(default_factory=dict)
    grid: Mapping[str, Sequence] = field(default_factory=dict)
    scale: bool = True
    degree: int | None = None
    # of least squares: params -> ridge penalty of the sum, l1 and l2 penalties of the mean of squares
    penalty: Callable[[Params], Mapping[str, float]] | None = None

    def with_params(self, **changes) -> "ModelSpec":
        return replace(self, defaults={**self.defaults, **changes})

    @property
    def preparation(self) -> tuple[bool, int | None]:
        return (self.scale, self.degree)


@dataclass(frozen=True)
class Inputs:
    """What every pipeline of one data set shares."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    label: str
    key: str = "row_id"
    feature: fe.AddedColumns | None = None

    def preparation(self, scale: bool, degree: int | None) -> list:
        numeric, categorical = fe.with_feature(self.numeric, self.categorical, self.feature)
        stages = [
            *fe.hook_stages(self.feature),
            fe.TabularFeatures(numeric=numeric, categorical=categorical, scale=scale),
        ]
        if degree:
            stages.append(PolynomialExpansion(degree=degree, inputCol=fe.FEATURES, outputCol=EXPANDED))
        return stages

    def estimator(self, spec: ModelSpec) -> Estimator:
        return spec.make(spec.defaults, self.label, EXPANDED if spec.degree else fe.FEATURES)

    def pipeline(self, spec: ModelSpec) -> Pipeline:
        """Hook, preparation, expansion and estimator, refitted as a whole."""
        return Pipeline(stages=[*self.preparation(spec.scale, spec.degree), self.estimator(spec)])


def _depth(p: Params) -> int:
    return DEEPEST if p["max_depth"] is None else int(p["max_depth"])


def _tree_columns(label: str, features: str) -> dict:
    return {"featuresCol": features, "labelCol": label, "maxBins": 256, "seed": SEED}


class WeightedTree(DecisionTreeClassifier):
    """A Gini tree that can weigh the classes against their frequency."""

    balanced = False

    def _fit(self, df: DataFrame):
        if self.balanced:
            df = df.withColumn(WEIGHT, balanced_weight(df, self.getLabelCol()))
            self.setWeightCol(WEIGHT)
        return super()._fit(df)


def _tree_classifier(p: Params, label: str, features: str) -> Estimator:
    tree = WeightedTree(
        maxDepth=_depth(p), minInstancesPerNode=p["min_samples_leaf"], impurity="gini",
        **_tree_columns(label, features),
    )
    tree.balanced = p["class_weight"] == "balanced"
    return tree


# Model names, baseline settings and tuning grids of both tracks.
_ALPHAS = [0.001, 0.01, 0.1, 1.0]
_DEPTHS = [3, 5, 8, 12, None]
_LEAVES = [1, 5, 20]
_CS = [0.1, 1.0, 10.0]
_KERNELS = ["rbf", "linear"]
_NEIGHBOUR_GRID = {"n_neighbors": [3, 5, 9, 15, 25], "weights": ["uniform", "distance"]}

LINEAR = "1. Linear Regression"
RIDGE = "2. Ridge Regression"
LASSO = "3. Lasso Regression"
ELASTIC = "4. ElasticNet Regression"
TREE = "6. Decision Tree Regressor"
FOREST = "7. Random Forest Regressor"
BOOSTING = "8. Gradient Boosting Regressor"
SVR = "9. Support Vector Regressor"
KNN = "10. K-Nearest Neighbors Regressor"
LOGISTIC = "A1. Logistic Regression"
KNN_C = "A2. K-Nearest Neighbors"
BAYES = "A3. Gaussian Naive Bayes"
TREE_C = "A4. Decision Tree Classifier"
SVC = "A5. Support Vector Classifier"


def polynomial_name(degree: int = 2) -> str:
    return f"5. Polynomial (deg {degree}) + Linear"


def _least_squares(p: Params, label: str, features: str) -> Estimator:
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, solver="auto")


def polynomial(degree: int) -> ModelSpec:
    return ModelSpec(polynomial_name(degree), _least_squares, degree=degree, penalty=lambda p: {})


def regressors(degree: int = 2, **changes: Params) -> dict[str, ModelSpec]:
    """All ten by name. ``changes`` maps a model family to other settings, such as
    ``forest={'n_estimators': 20, 'max_depth': 10}`` for a bounded run."""
    specs = {
        "linear": ModelSpec(LINEAR, _least_squares, penalty=lambda p: {}),
        "ridge": ModelSpec(
            RIDGE,
            lambda p, y, x: PenalisedRegression(penalty="ridge", alpha=p["alpha"], featuresCol=x, labelCol=y),
            {"alpha": 1.0},
            {"alpha": [0.01, 0.1, 1.0, 10.0, 100.0]},
            penalty=lambda p: {"ridge": p["alpha"]},
        ),
        "lasso": ModelSpec(
            LASSO,
            lambda p, y, x: PenalisedRegression(
                penalty="elastic", alpha=p["alpha"], l1Ratio=1.0, featuresCol=x, labelCol=y
            ),
            {"alpha": 0.01},
            {"alpha": _ALPHAS},
            penalty=lambda p: {"l1": p["alpha"]},
        ),
        "elastic": ModelSpec(
            ELASTIC,
            lambda p, y, x: PenalisedRegression(
                penalty="elastic", alpha=p["alpha"], l1Ratio=p["l1_ratio"], featuresCol=x, labelCol=y
            ),
            {"alpha": 0.01, "l1_ratio": 0.5},
            {"alpha": _ALPHAS, "l1_ratio": [0.1, 0.5, 0.9]},
            penalty=lambda p: {"l1": p["alpha"] * p["l1_ratio"], "l2": p["alpha"] * (1 - p["l1_ratio"])},
        ),
        "polynomial": polynomial(degree),
        "tree": ModelSpec(
            TREE,
            lambda p, y, x: DecisionTreeRegressor(
                maxDepth=_depth(p), minInstancesPerNode=p["min_samples_leaf"], **_tree_columns(y, x)
            ),
            {"max_depth": 8, "min_samples_leaf": 1},
            {"max_depth": _DEPTHS, "min_samples_leaf": _LEAVES},
            scale=False,
        ),
        "forest": ModelSpec(
            FOREST,
            lambda p, y, x: RandomForestRegressor(
                numTrees=p["n_estimators"], maxDepth=_depth(p), featureSubsetStrategy="all",
                subsamplingRate=1.0, maxMemoryInMB=1024, **_tree_columns(y, x),
            ),
            {"n_estimators": 300, "max_depth": None},
            {"n_estimators": [100, 300, 500], "max_depth": [None, 10, 20]},
            scale=False,
        ),
        "boosting": ModelSpec(
            BOOSTING,
            lambda p, y, x: GBTRegressor(
                stepSize=p["learning_rate"], maxIter=p["n_estimators"], maxDepth=3,
                checkpointInterval=10, **_tree_columns(y, x),
            ),
            {"learning_rate": 0.1, "n_estimators": 200},
            {"learning_rate": [0.03, 0.1, 0.2], "n_estimators": [100, 200, 400]},
            scale=False,
        ),
        "svr": ModelSpec(
            SVR,
            lambda p, y, x: SupportVectorRegressor(
                C=p["C"], kernel=p["kernel"], components=p["components"], featuresCol=x, labelCol=y
            ),
            {"C": 1.0, "kernel": "rbf", "components": 128},
            {"C": _CS, "kernel": _KERNELS},
        ),
        "knn": ModelSpec(
            KNN,
            lambda p, y, x: NearestNeighbours(
                k=p["n_neighbors"], weights=p["weights"], metric=p["metric"], broadcastBytes=p.get("broadcast_bytes", BROADCAST_BYTES), featuresCol=x, labelCol=y
            ),
            {"n_neighbors": 5, "weights": "uniform", "metric": "euclidean"},
            _NEIGHBOUR_GRID,
        ),
    }
    return _named(specs, changes)


def classifiers(**changes: Params) -> dict[str, ModelSpec]:
    """All five by name."""
    specs = {
        "logistic": ModelSpec(
            LOGISTIC,
            lambda p, y, x: PenalisedLogistic(
                C=p["C"], balanced=p["class_weight"] == "balanced", featuresCol=x, labelCol=y
            ),
            {"C": 1.0, "class_weight": None},
            {"C": [0.01, 0.1, 1.0, 10.0], "class_weight": [None, "balanced"]},
        ),
        "knn": ModelSpec(
            KNN_C,
            lambda p, y, x: NearestNeighbours(
                k=p["n_neighbors"], weights=p["weights"], metric=p["metric"], broadcastBytes=p.get("broadcast_bytes", BROADCAST_BYTES), classify=True,
                featuresCol=x, labelCol=y,
            ),
            {"n_neighbors": 5, "weights": "uniform", "metric": "euclidean"},
            _NEIGHBOUR_GRID,
        ),
        "bayes": ModelSpec(
            BAYES, lambda p, y, x: NaiveBayes(modelType="gaussian", featuresCol=x, labelCol=y)
        ),
        "tree": ModelSpec(
            TREE_C,
            _tree_classifier,
            {"max_depth": 6, "min_samples_leaf": 1, "class_weight": None},
            {"max_depth": _DEPTHS, "min_samples_leaf": _LEAVES, "class_weight": [None, "balanced"]},
            scale=False,
        ),
        "svc": ModelSpec(
            SVC,
            lambda p, y, x: SupportVectorClassifier(
                C=p["C"], kernel=p["kernel"], components=p["components"], maxIter=p["max_iter"],
                plattFolds=p["platt_folds"], featuresCol=x, labelCol=y,
            ),
            {"C": 1.0, "kernel": "rbf", "components": 64, "max_iter": 40, "platt_folds": 2},
            {"C": _CS, "kernel": _KERNELS},
        ),
    }
    return _named(specs, changes)


def _named(specs: dict[str, ModelSpec], changes: Mapping[str, Params]) -> dict[str, ModelSpec]:
    unknown = set(changes) - set(specs)
    if unknown:
        raise ValueError(f"unknown model families: {sorted(unknown)}")
    out = {}
    for family, spec in specs.items():
        spec = spec.with_params(**changes.get(family, {}))
        out[spec.name] = spec
    return out


# ------------------------------------------------------------------ fitting many models


class FittingRoom:
    """Fits models on one set of training rows, preparing the inputs once per need.

    Models that want the same preparation share one fitted preparation and one cached
    design matrix; a returned pipeline is the same as refitting everything per model.
    """

    def __init__(self, train: DataFrame, inputs: Inputs):
        self.train, self.inputs = train, inputs
        checkpoints_ready(train.sparkSession)  # long boosting runs cut their lineage there
        self._prepared: dict[tuple, tuple[PipelineModel, DataFrame]] = {}

    def __enter__(self) -> "FittingRoom":
        return self

    def __exit__(self, *exc) -> None:
        for _, cached in self._prepared.values():
            cached.unpersist()

    def prepared(self, scale: bool, degree: int | None) -> tuple[PipelineModel, DataFrame]:
        want = (scale, degree)
        if want not in self._prepared:
            if degree:
                base, rows = self.prepared(scale, None)
                expand = PolynomialExpansion(degree=degree, inputCol=fe.FEATURES, outputCol=EXPANDED)
                # the expansion is cheap next to storing it
                self._prepared[want] = (PipelineModel([*base.stages, expand]), expand.transform(rows))
            else:
                model = Pipeline(stages=self.inputs.preparation(scale, None)).fit(self.train)
                label = col(self.inputs.label).cast("double").alias(self.inputs.label)
                rows = model.transform(self.train).select(
                    *([col(self.inputs.key)] if self.inputs.key in self.train.columns else []),
                    label,
                    fe.FEATURES,
                )
                self._prepared[want] = (model, rows.persist(StorageLevel.MEMORY_AND_DISK))
        return self._prepared[want]

    def fit(self, spec: ModelSpec) -> PipelineModel:
        model, rows = self.prepared(*spec.preparation)
        return PipelineModel([*model.stages, self.inputs.estimator(spec).fit(rows)])


def fit_all(
    specs: Mapping[str, ModelSpec], train: DataFrame, inputs: Inputs
) -> tuple[dict[str, PipelineModel], dict[str, float]]:
    """(fitted pipelines, seconds) by name."""
    fitted, seconds = {}, {}
    with FittingRoom(train, inputs) as room:
        for name, spec in specs.items():
            room.prepared(*spec.preparation)
            start = time.perf_counter()
            fitted[name] = room.fit(spec)
            seconds[name] = round(time.perf_counter() - start, 3)
    return fitted, seconds


def score_column(scored: DataFrame):
    """(score of class 1, its source): probability, else decision value, else nothing."""
    if "probability" in scored.columns:
        return vector_to_array("probability")[1], "predict_proba"
    if "rawPrediction" in scored.columns:
        return vector_to_array("rawPrediction")[1], "decision_function"
    return F.lit(None).cast("double"), "unavailable"


def predictions(
    fitted: Mapping[str, PipelineModel], rows: DataFrame, inputs: Inputs, keep: Sequence[str] = ()
) -> DataFrame:
    """(model, keep..., y, p, score) of every model on the same rows, in one plan."""
    out = None
    for name, model in fitted.items():
        scored = model.transform(rows)
        score, _ = score_column(scored)
        part = scored.select(
            F.lit(name).alias("model"),
            *[col(k) for k in keep],
            col(inputs.label).cast("double").alias("y"),
            F.col("prediction").alias("p"),
            score.alias("score"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def score_sources(fitted: Mapping[str, PipelineModel], rows: DataFrame) -> dict[str, str]:
    return {name: score_column(m.transform(rows.limit(0)))[1] for name, m in fitted.items()}
