"""Support vector machines at scale: an explicit random feature map and linear fits.

The RBF kernel is approximated by random Fourier features (Rahimi and Recht, 2007), so
a fit costs one pass per iteration instead of a kernel matrix over all pairs of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import SEED, col

KERNEL = "kernel_features"


class FourierFeaturesModel(
    Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """z = sqrt(2/D) cos(Wx + b) with W and b drawn from a fixed seed."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "features to draw", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "inputs", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, gamma=1.0, components=128, width=1, seed=SEED, inputCol="features", outputCol=KERNEL):
        super().__init__()
        self._setDefault(gamma=1.0, components=128, width=1, seed=SEED, inputCol="features", outputCol=KERNEL)
        self._set(**self._input_kwargs)

    def drawn(self) -> tuple[np.ndarray, np.ndarray, float]:
        """(W, b, scale) of the map."""
        d = self.getOrDefault("components")
        rng = np.random.default_rng(self.getOrDefault("seed"))
        w = rng.normal(scale=math.sqrt(2 * self.getOrDefault("gamma")), size=(self.getOrDefault("width"), d))
        return w, rng.uniform(0, 2 * math.pi, size=d), math.sqrt(2.0 / d)

    def _transform(self, df: DataFrame) -> DataFrame:
        w, b, scale = self.drawn()

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def project(x: pd.Series) -> pd.Series:
            z = scale * np.cos(np.stack(x.to_numpy()) @ w + b)
            return pd.Series(list(z))

        return df.withColumn(
            self.getOutputCol(), array_to_vector(project(vector_to_array(self.getInputCol())))
        )


class FourierFeatures(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns gamma = 1 / (inputs * variance of all input cells) from the rows."""

    components = Param(Params._dummy(), "components", "features to draw", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, components=128, seed=SEED, inputCol="features", outputCol=KERNEL):
        super().__init__()
        self._setDefault(components=128, seed=SEED, inputCol="features", outputCol=KERNEL)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FourierFeaturesModel:
        x = vector_to_array(self.getInputCol())
        add = lambda a, v: a + v
        row = df.agg(
            F.max(F.size(x)).alias("p"),
            F.avg(F.aggregate(x, F.lit(0.0), add)).alias("s"),
            F.avg(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)).alias("q"),
        ).first()
        variance = row["q"] / row["p"] - (row["s"] / row["p"]) ** 2
        return FourierFeaturesModel(
            gamma=1.0 / (row["p"] * variance) if variance > 0 else 1.0,
            components=self.getOrDefault("components"), width=row["p"],
            seed=self.getOrDefault("seed"), inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
        )


class _MachineParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    C = Param(Params._dummy(), "C", "inverse penalty", TypeConverters.toFloat)
    kernel = Param(Params._dummy(), "kernel", "rbf or linear", TypeConverters.toString)
    components = Param(Params._dummy(), "components", "random features", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)

    def _mapped(self, df: DataFrame) -> tuple[list, DataFrame, str]:
        if self.getOrDefault("kernel") == "linear":
            return [], df, self.getFeaturesCol()
        mapping = FourierFeatures(
            components=self.getOrDefault("components"), inputCol=self.getFeaturesCol(), outputCol=KERNEL
        ).fit(df)
        return [mapping], mapping.transform(df), KERNEL


class SupportVectorRegressor(Estimator, _MachineParams, DefaultParamsReadable, DefaultParamsWritable):
    """Minimises |w|^2 / 2 + C * sum max(0, |y - f(x)| - epsilon).

    The loss is half the absolute errors against y - epsilon and y + epsilon (less a
    constant), so it is fitted by iteratively reweighted ridge regression, and the objective
    never rises. Every round is one scan of the unmapped inputs, which maps them a batch at a time
    and returns weighted sums of products, which give the next line; mapped rows are never kept.
    """

    epsilon = Param(Params._dummy(), "epsilon", "tube half width", TypeConverters.toFloat)
    tol = Param(Params._dummy(), "tol", "relative gain to go on", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, C=1.0, kernel="rbf", epsilon=0.1, components=128, maxIter=12, tol=1e-3,
                 featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(C=1.0, kernel="rbf", epsilon=0.1, components=128, maxIter=12, tol=1e-3)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        with _kept(df.select(self.getFeaturesCol(), col(self.getLabelCol()).cast("double").alias("_y")), df) as rows:
            stages, _, _ = self._mapped(rows)
            facts = rows.agg(
                F.stddev_pop("_y").alias("s"), F.avg("_y").alias("m"), F.count("*").alias("n"), F.count(F.when(~F.isnan("_y"), 1)).alias("yn")
            ).first()
            if facts["yn"] < facts["n"]:
                raise ValueError(f"rows without {self.getLabelCol()}")
            floor = 1e-4 * (facts["s"] or 1.0)
            drawn = stages[0].drawn() if stages else None
            line, objective = (None, facts["m"]), None
            for _ in range(self.getOrDefault("maxIter")):
                norm = 0.0 if line[0] is None else float(line[0] @ line[0])
                loss, following = self._round(rows, drawn, line, floor)
                value = norm / 2 + self.getOrDefault("C") * loss
                if objective is not None and objective - value < self.getOrDefault("tol") * abs(objective):
                    break
                objective, line = value, following
        coefficients, intercept = line
        fit = LineModel(
            weights=[float(c) for c in coefficients], constant=intercept,
            featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(),
        )
        return PipelineModel([*stages, fit.under(stages[0]) if stages else fit])

    def _weights(self, err: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the two absolute errors, below and above the tube."""
        eps, c = self.getOrDefault("epsilon"), self.getOrDefault("C")
        return c / (2 * np.maximum(np.abs(err + eps), floor)), c / (2 * np.maximum(np.abs(err - eps), floor))

    def _round(self, rows: DataFrame, drawn, line, floor: float) -> tuple[float, tuple[np.ndarray, float]]:
        """(loss of a line, the line of the next round), from one scan."""
        eps, weights = self.getOrDefault("epsilon"), self._weights

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, loss = 0.0, 0.0
            for batch in batches:
                if not batch.num_rows:
                    continue
                z = _mapped_cells(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1), drawn)
                y = batch.column(1).to_numpy()
                err = y - line[1] - (0.0 if line[0] is None else z @ line[0])
                low, high = weights(err, floor)
                t = (high * (y - eps) + low * (y + eps)) / (low + high)
                x = np.column_stack([z, np.ones(len(z)), t])
                sums = sums + (x * (low + high)[:, None]).T @ x
                loss += float(np.maximum(np.abs(err) - eps, 0.0).sum())
            if np.ndim(sums):
                cells = np.append(sums[np.triu_indices(len(sums))], loss)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["cell", "sum"])

        inputs = rows.select(vector_to_array(self.getFeaturesCol()).alias("x"), "_y")
        found = inputs.mapInArrow(run, "cell int, sum double").groupBy("cell").agg(F.sum("sum").alias("sum")).toArrow()
        cells = found.column("sum").to_numpy()[np.argsort(found.column("cell").to_numpy())]
        size = (math.isqrt(8 * (len(cells) - 1) + 1) - 1) // 2
        full = np.zeros((size, size))
        full[np.triu_indices(size)] = cells[:-1]
        full += np.triu(full, 1).T
        total, d = full[-2, -2], size - 2
        mean = full[-2] / total
        spread = full / total - np.outer(mean, mean)
        coefficients = np.linalg.solve(spread[:d, :d] + np.eye(d) / total, spread[:d, -1])
        intercept = float(mean[-1] - mean[:d] @ coefficients)
        return float(cells[-1]), (coefficients, intercept)


def _mapped_cells(x: np.ndarray, drawn) -> np.ndarray:
    """A batch of inputs under the map; without one the inputs themselves."""
    if drawn is None:
        return x
    w, b, scale = drawn
    return scale * np.cos(x @ w + b)


class LineModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted line: the prediction is the product of its coefficients with the features, plus its intercept.

    ``under`` a map of the features it takes the unmapped ones and maps a batch at a time, so that a prediction is one
    number from Python and no mapped row.
    """

    weights = Param(Params._dummy(), "weights", "coefficients", TypeConverters.toListFloat)
    constant = Param(Params._dummy(), "constant", "intercept", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "kernel width of the map; 0 without one", TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "inputs of the map", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the map", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, weights=None, constant=0.0, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._setDefault(weights=[], constant=0.0, gamma=0.0, width=1, seed=SEED)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def under(self, mapping: FourierFeaturesModel) -> "LineModel":
        return self._set(**{p: mapping.getOrDefault(p) for p in ("gamma", "width", "seed")})

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault("weights"))

    @property
    def intercept(self) -> float:
        return self.getOrDefault("constant")

    def _transform(self, df: DataFrame) -> DataFrame:
        coefficients, intercept, drawn = np.array(self.getOrDefault("weights")), self.intercept, None
        if self.getOrDefault("gamma"):
            own = {p: self.getOrDefault(p) for p in ("gamma", "width", "seed")}
            drawn = FourierFeaturesModel(components=len(coefficients), **own).drawn()

        @F.pandas_udf("double")
        def value(x: pd.Series) -> pd.Series:
            return pd.Series(_mapped_cells(np.stack(x.to_numpy()), drawn) @ coefficients + intercept if len(x) else [], dtype="float64")

        return df.withColumn(self.getPredictionCol(), value(vector_to_array(self.getFeaturesCol())))


@contextmanager
def _kept(rows: DataFrame, source: DataFrame):
    """The rows, held meanwhile unless their source is: unmapped inputs, never mapped ones."""
    level = source.storageLevel
    held = not (level.useMemory or level.useDisk)
    if held:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        if held:
            rows.unpersist()


class SupportVectorClassifier(Estimator, _MachineParams, DefaultParamsReadable, DefaultParamsWritable):
    """Hinge loss on the mapped features; the side of the margin is the prediction.

    Probabilities come from a logistic curve fitted to margins of rows the scoring
    machine has not seen.
    """

    plattFolds = Param(Params._dummy(), "plattFolds", "folds for the probability curve", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, C=1.0, kernel="rbf", components=64, maxIter=40, plattFolds=2,
                 featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(C=1.0, kernel="rbf", components=64, maxIter=40, plattFolds=2)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        label = self.getLabelCol()
        folds = self.getOrDefault("plattFolds")
        fold = F.pmod(F.xxhash64(vector_to_array(self.getFeaturesCol())), F.lit(folds))
        own = df.select(self.getFeaturesCol(), col(label).cast("double").alias(label))
        # a fit holds its own blocks of mapped rows: what is held here is the inputs
        with _kept(own, df) as held:
            stages, mapped, source = self._mapped(held)
            rows = mapped.select(source, label, fold.alias("_fold"))
            inputs = held.select(fold.alias("_fold"))
            sizes = {r["_fold"]: r["n"] for r in inputs.groupBy("_fold").agg(F.count("*").alias("n")).collect()}
            total = sum(sizes.values())
            machine = self._machine(source, label, total).fit(rows)
            slicer = VectorSlicer(inputCol="rawPrediction", outputCol="margin", indices=[1])
            unseen = None
            for f, n in sorted(sizes.items()):
                rest = self._machine(source, label, total - n).fit(rows.where(F.col("_fold") != f))
                part = rest.transform(rows.where(F.col("_fold") == f)).select("rawPrediction", label)
                unseen = part if unseen is None else unseen.unionByName(part)
            curve = LogisticRegression(
                featuresCol="margin", labelCol=label, predictionCol="curve_side",
                rawPredictionCol="curve_raw", probabilityCol="probability",
                standardization=False, regParam=0.0,
            ).fit(slicer.transform(unseen).select("margin", label))
        machine = machine.setPredictionCol(self.getPredictionCol())
        return PipelineModel([*stages, machine, slicer, curve])

    def _machine(self, source: str, label: str, n: int) -> LinearSVC:
        return LinearSVC(
            featuresCol=source, labelCol=label, predictionCol="_side",
            regParam=1.0 / (self.getOrDefault("C") * n), maxIter=self.getOrDefault("maxIter"),
            tol=1e-5, standardization=False,
        )
