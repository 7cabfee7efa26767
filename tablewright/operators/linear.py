"""Linear estimators whose penalties are stated per data set, fitted by MLlib.

MLlib scales its penalties by row count and label deviation. These estimators take
the penalty of the usual objectives and work the mapping out from the rows they are
fitted on, so a penalty means the same in every fold.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import col

WEIGHT = "_weight"


def balanced_weight(df: DataFrame, label: str) -> Column:
    """n / (classes * n_c) per row: class counts are fetched, one number per class."""
    counts = {r["c"]: r["n"] for r in df.groupBy(col(label).alias("c")).agg(F.count("*").alias("n")).collect()}
    total, classes = sum(counts.values()), len(counts)
    out = F.lit(None).cast("double")
    for c, n in counts.items():
        out = F.when(col(label) == F.lit(c), total / (classes * n)).otherwise(out)
    return out


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(class, count, weight) of the balanced weighting."""
    counts = df.groupBy(col(label).alias("class")).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("t"), F.count("*").alias("k")).select(
        (F.col("t") / F.col("k")).alias("share")
    )
    return counts.withColumn("weight", total.scalar() / F.col("count"))


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    pass


class PenalisedRegression(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Least squares with a penalty.

    ``ridge``:   sum of squares + alpha |w|^2
    ``elastic``: sum of squares / 2n + alpha (l1Ratio |w|_1 + (1 - l1Ratio) |w|^2 / 2);
                 l1Ratio 1 is the lasso.
    """

    penalty = Param(Params._dummy(), "penalty", "ridge or elastic", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "penalty strength", TypeConverters.toFloat)
    l1Ratio = Param(Params._dummy(), "l1Ratio", "share of the L1 term", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, penalty="ridge", alpha=1.0, l1Ratio=1.0, featuresCol="features",
                 labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(penalty="ridge", alpha=1.0, l1Ratio=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        y = col(self.getLabelCol()).cast("double")
        n, s = df.agg(F.count("*"), F.stddev_pop(y)).first()
        alpha, ratio = self.getOrDefault("alpha"), self.getOrDefault("l1Ratio")
        if self.getOrDefault("penalty") == "ridge":
            reg, mix = alpha / n * s, 0.0
        else:
            blend = ratio + (1 - ratio) * s
            reg, mix = alpha * blend, ratio / blend if blend else 0.0
        return LinearRegression(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(), regParam=reg, elasticNetParam=mix,
            standardization=False, solver="auto", maxIter=10000, tol=1e-12,
        ).fit(df)


class PenalisedLogistic(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Logistic regression minimising C * sum of weighted losses + |w|^2 / 2."""

    C = Param(Params._dummy(), "C", "inverse penalty", TypeConverters.toFloat)
    balanced = Param(Params._dummy(), "balanced", "balanced class weights", TypeConverters.toBoolean)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, C=1.0, balanced=False, maxIter=2000, featuresCol="features",
                 labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(C=1.0, balanced=False, maxIter=2000)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        # balanced weights sum to the row count, so n serves both cases
        n = df.count()
        model = LogisticRegression(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(), regParam=1.0 / (self.getOrDefault("C") * n),
            elasticNetParam=0.0, standardization=False, maxIter=self.getOrDefault("maxIter"), tol=1e-10,
        )
        if self.getOrDefault("balanced"):
            df = df.withColumn(WEIGHT, balanced_weight(df, self.getLabelCol()))
            model = model.setWeightCol(WEIGHT)
        return model.fit(df)
