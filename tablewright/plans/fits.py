"""Queries that fit models: preparation, regressors, classifiers, explanation.

Linear, penalised, polynomial, Bayes and neighbour models are refitted in SQL and must
agree; trees, ensembles and kernel machines are checked by the test suite.
"""

from __future__ import annotations

import itertools
from collections import Counter

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions.exprs import rounded
from ..operators import explain, features, linear, metrics, models, selection, split
from ..operators.knn import NearestNeighbours, neighbour_rows
from ..session import fetched
from . import checking
from .fixtures import CLF_CATEGORICAL, CLF_TARGET, NUMERIC, REG_CATEGORICAL, REG_TARGET, cte, table, view
from .registry import query
from .scores import _round_scores
from .tables import CLF_SPLIT_SQL, REG_SPLIT_SQL, fold_sql

REG = models.Inputs(tuple(NUMERIC), tuple(REG_CATEGORICAL), REG_TARGET)
CLF = models.Inputs(tuple(NUMERIC), tuple(CLF_CATEGORICAL), CLF_TARGET)
# The support vector regressor states C and epsilon in target units: thousands here.
REG_K = models.Inputs(tuple(NUMERIC), tuple(REG_CATEGORICAL), "net_k")

# Bounded settings for runs on one machine; the registry's own defaults are larger.
SMALL = {
    "forest": {"n_estimators": 20, "max_depth": 8},
    "boosting": {"n_estimators": 15},
    "svr": {"components": 64},
}
SMALL_C = {"svc": {"max_iter": 25}}


def reg_rows(spark, sf):
    """Regression rows with their split, cached."""
    rows = view(spark, sf, "reg_view").withColumn("net_k", F.col("net_price") / 1000)
    return split.hold_out(rows, ["row_id"], eager=True).persist()


def clf_rows(spark, sf):
    rows = view(spark, sf, "clf_view")
    return split.hold_out(rows, ["row_id"], stratify=CLF_TARGET, eager=True).persist()


def _train(rows):
    return rows.where(F.col("split") == "train")


def _test(rows):
    return rows.where(F.col("split") == "test")


# ------------------------------------------------------------------- SQL building blocks

_XREG = [("l_linestatus", "O")]
_XCLF = [("l_returnflag", v) for v in ("A", "N", "R")]
_REG_SRC = (
    cte("reg_view")
    + ", "
    + REG_SPLIT_SQL
    + ", src AS (SELECT *, 0 AS grp, split = 'train' AS is_train FROM reg_split), "
    + checking.prepared("d", "src", NUMERIC, _XREG, "net_price", ["row_id"])
)
_CLF_SRC = (
    cte("clf_view")
    + ", "
    + CLF_SPLIT_SQL
    + ", src AS (SELECT *, 0 AS grp, split = 'train' AS is_train FROM clf_split), "
    + checking.prepared("d", "src", NUMERIC, _XCLF, "overload", ["row_id"])
)
_X5 = [f"x{i}" for i in range(1, 6)]
_NAMES = [*NUMERIC, "l_linestatus_O"]
_CNAMES = [*NUMERIC, "l_returnflag_A", "l_returnflag_N", "l_returnflag_R"]


def _reg_fit_sql(fit: str) -> str:
    return f"{_REG_SRC}, {fit} {checking.regression_scores('f')}"


def _fit_reg(spark, sf, name, inputs=REG, **changes):
    rows = reg_rows(spark, sf)
    spec = models.regressors(**changes)[name]
    with models.FittingRoom(_train(rows), inputs) as room:
        fitted = {name: room.fit(spec)}
    return rows, fitted


def _reg_scores(spark, sf, name, inputs=REG, **changes):
    rows, fitted = _fit_reg(spark, sf, name, inputs, **changes)
    scored = models.predictions(fitted, _test(rows), inputs)
    out = fetched(metrics.regression_metrics(scored))
    rows.unpersist()
    return _round_scores(out).drop("model")


# --------------------------------------------------------------------------- regressors


@query("g1_linear_regression", _reg_fit_sql(checking.least_squares("f", "d", _X5)))
def linear_regression(spark, sf):
    return _reg_scores(spark, sf, models.LINEAR)


@query("g2_ridge", _reg_fit_sql(checking.least_squares("f", "d", _X5, ridge=1.0)))
def ridge(spark, sf):
    return _reg_scores(spark, sf, models.RIDGE)


@query("g2_ridge_strong", _reg_fit_sql(checking.least_squares("f", "d", _X5, ridge=5000.0)))
def ridge_strong(spark, sf):
    return _reg_scores(spark, sf, models.RIDGE, ridge={"alpha": 5000.0})


@query("g3_lasso", _reg_fit_sql(checking.elastic_net("f", "d", _X5, 0.01, 1.0)))
def lasso(spark, sf):
    return _reg_scores(spark, sf, models.LASSO)


@query("g3_lasso_strong", _reg_fit_sql(checking.elastic_net("f", "d", _X5, 1500.0, 1.0)))
def lasso_strong(spark, sf):
    return _reg_scores(spark, sf, models.LASSO, lasso={"alpha": 1500.0})


@query("g4_elastic_net", _reg_fit_sql(checking.elastic_net("f", "d", _X5, 0.01, 0.5)))
def elastic_net(spark, sf):
    return _reg_scores(spark, sf, models.ELASTIC)


@query("g5_polynomial", _reg_fit_sql(checking.least_squares("f", "d", checking.monomials(5, 2, [5]))))
def polynomial(spark, sf):
    return _reg_scores(spark, sf, models.polynomial_name(2))


@query("g6_decision_tree")
def decision_tree(spark, sf):
    return _reg_scores(spark, sf, models.TREE)


@query("g7_random_forest")
def random_forest(spark, sf):
    return _reg_scores(spark, sf, models.FOREST, **SMALL)


@query("g8_gradient_boosting")
def gradient_boosting(spark, sf):
    """The registry's full settings: 200 rounds."""
    return _reg_scores(spark, sf, models.BOOSTING)


@query("g9_support_vector_rbf")
def support_vector_rbf(spark, sf):
    return _reg_scores(spark, sf, models.SVR, REG_K, **SMALL)


@query("g9_support_vector_linear")
def support_vector_linear(spark, sf):
    return _reg_scores(spark, sf, models.SVR, REG_K, svr={"kernel": "linear"})


_NEAREST = """, nb AS (SELECT q.row_id, any_value(q.y) AS y, arg_min(t.y, {d}, 5) AS near
  FROM (SELECT * FROM d WHERE NOT is_train) q, (SELECT * FROM d WHERE is_train) t GROUP BY q.row_id)"""
_SQ5 = " + ".join(f"(q.x{i} - t.x{i}) ** 2" for i in range(1, 6))


_G10 = (
    _REG_SRC
    + _NEAREST.format(d=_SQ5)
    + ", f AS (SELECT y, list_avg(near) AS p, FALSE AS is_train FROM nb) "
    + checking.regression_scores("f")
)


@query("g10_nearest_neighbours", _G10)
def nearest_neighbours(spark, sf):
    return _reg_scores(spark, sf, models.KNN)


@query("g10_neighbours_in_cells", _G10)
def nearest_neighbours_in_cells(spark, sf):
    return _reg_scores(spark, sf, models.KNN, knn={"broadcast_bytes": 0})


# -------------------------------------------------------------------------- classifiers


def _fit_clf(spark, sf, name, **changes):
    rows = clf_rows(spark, sf)
    spec = models.classifiers(**changes)[name]
    with models.FittingRoom(_train(rows), CLF) as room:
        fitted = {name: room.fit(spec)}
    return rows, fitted


def _clf_scores(spark, sf, name, **changes):
    rows, fitted = _fit_clf(spark, sf, name, **changes)
    scored = models.predictions(fitted, _test(rows), CLF).persist()
    out = fetched(metrics.classification_metrics(scored))
    scored.unpersist()
    rows.unpersist()
    return _round_scores(out, 6).drop("model")


def _clf_sql(fit: str) -> str:
    return (
        f"{_CLF_SRC}, {fit}, m AS (SELECT 'm' AS model, y, p, score FROM f WHERE NOT is_train), s AS ("
        + checking.label_scores("m")
        + """) SELECT n, round("Accuracy", 6) AS "Accuracy", round("Precision_failure", 6) AS "Precision_failure",
        round("Recall_failure", 6) AS "Recall_failure", round("F1_weighted", 6) AS "F1_weighted",
        round("F1_failure", 6) AS "F1_failure", round("ROC_AUC", 6) AS "ROC_AUC" FROM s"""
    )


@query(
    "h1_logistic_regression",
    _clf_sql(
        checking.logistic("lr", "d", 7, 1.0)
        + ", f AS (SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS p FROM lr)"
    ),
)
def logistic_regression(spark, sf):
    return _clf_scores(spark, sf, models.LOGISTIC)


_X7 = [f"x{i}" for i in range(1, 8)]
_BAYES = (
    "c AS MATERIALIZED (SELECT y AS k, count(*)::DOUBLE / sum(count(*)) OVER () AS prior, "
    + ", ".join(f"avg({x}) AS m_{x}, var_pop({x}) AS v_{x}" for x in _X7)
    + " FROM d WHERE is_train GROUP BY y), e AS (SELECT 1e-9 * greatest("
    + ", ".join(f"var_pop({x})" for x in _X7)
    + ") AS eps FROM d WHERE is_train), ll AS MATERIALIZED (SELECT row_id, is_train, y, k, ln(prior) + "
    + " + ".join(
        f"(-0.5 * ln(2 * pi() * (v_{x} + eps)) - ({x} - m_{x}) ** 2 / (2 * (v_{x} + eps)))" for x in _X7
    )
    + " AS j FROM d, c, e), f AS (SELECT a.row_id, a.is_train, a.y, CASE WHEN b.j > a.j THEN 1 ELSE 0 END AS p,"
    + " 1 / (1 + exp(a.j - b.j)) AS score FROM ll a JOIN ll b USING (row_id) WHERE a.k = 0 AND b.k = 1)"
)


@query("h3_gaussian_bayes", _clf_sql(_BAYES))
def gaussian_bayes(spark, sf):
    return _clf_scores(spark, sf, models.BAYES)


@query("h4_decision_tree")
def tree_classifier(spark, sf):
    return _clf_scores(spark, sf, models.TREE_C)


@query("h4_balanced_decision_tree")
def balanced_tree(spark, sf):
    return _clf_scores(spark, sf, models.TREE_C, tree={"class_weight": "balanced", "max_depth": 3})


@query("h5_support_vector_rbf")
def support_vector_classifier(spark, sf):
    return _clf_scores(spark, sf, models.SVC, **SMALL_C)


@query(
    "h6_class_weights",
    cte("clf_view")
    + """ SELECT overload AS class, count(*) AS count, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9)::DOUBLE AS weight
    FROM clf_view GROUP BY 1""",
)
def class_weights(spark, sf):
    out = linear.class_weights(view(spark, sf, "clf_view"), CLF_TARGET)
    return out.select("class", "count", rounded(F.col("weight"), 9).alias("weight"))


# ------------------------------------------------------------------ neighbours of vectors

_VEC = """WITH v AS (SELECT vec_id, embedding, label, CASE WHEN row_number() OVER (ORDER BY md5('42|' || vec_id))
  <= ceil(round(0.2 * count(*) OVER (), 6)) THEN 'test' ELSE 'train' END AS split FROM embeddings)"""
_VEC_D = {
    "euclidean": "list_distance(q.embedding::DOUBLE[], t.embedding::DOUBLE[])",
    "manhattan": "(SELECT sum(abs(a - b)) FROM (SELECT unnest(q.embedding::DOUBLE[]) AS a, unnest(t.embedding::DOUBLE[]) AS b))",
    "chebyshev": "(SELECT max(abs(a - b)) FROM (SELECT unnest(q.embedding::DOUBLE[]) AS a, unnest(t.embedding::DOUBLE[]) AS b))",
}


def _vec_neighbours(metric: str, name: str) -> str:
    return f"""{name} AS MATERIALIZED (SELECT vec_id, split, y, neighbour, d, label, rank FROM (SELECT q.vec_id, q.split, q.label AS y, t.vec_id AS neighbour, t.label,
  {_VEC_D[metric]} AS d, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_VEC_D[metric]}, t.vec_id::VARCHAR) AS rank
  FROM (SELECT * FROM v WHERE split = 'test') q, (SELECT * FROM v WHERE split = 'train') t) WHERE rank <= 5)"""


def vectors(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    return split.hold_out(rows, ["vec_id"], eager=True).persist()


_NEIGHBOUR_ROWS = (
    _VEC
    + ", "
    + _vec_neighbours("euclidean", "nb")
    + " SELECT vec_id, rank::INTEGER AS rank, neighbour::VARCHAR AS neighbour, round(d, 8) AS distance, label::DOUBLE AS label FROM nb"
)


def _neighbour_rows(spark, sf, **search):
    rows = vectors(spark, sf)
    model = NearestNeighbours(k=5, classify=True, idCol="vec_id", **search).fit(_train(rows))
    out = neighbour_rows(model.neighbours(_test(rows)), ["vec_id"])
    return out.select("vec_id", "rank", "neighbour", "label", rounded(F.col("distance"), 8).alias("distance"))


@query("h2_neighbour_rows", _NEIGHBOUR_ROWS)
def vector_neighbours(spark, sf):
    return _neighbour_rows(spark, sf)


@query("h2_neighbours_in_cells", _NEIGHBOUR_ROWS)
def vector_neighbours_in_cells(spark, sf):
    return _neighbour_rows(spark, sf, broadcastBytes=0, blockRows=500)


_VEC_VOTE = """, vote AS (SELECT vec_id, y, label, count(*) AS n FROM {nb} GROUP BY ALL),
win AS (SELECT vec_id, any_value(y) AS y, arg_min(label, (-n, label)) AS p, max(n) / 5.0 AS share FROM vote GROUP BY 1)"""


@query(
    "h2_nearest_neighbours",
    _VEC
    + ", "
    + _vec_neighbours("euclidean", "nb")
    + _VEC_VOTE.format(nb="nb")
    + " SELECT vec_id, y::DOUBLE AS y, p::DOUBLE AS p, round(share, 8)::DOUBLE AS share FROM win",
)
def vector_classes(spark, sf):
    rows = vectors(spark, sf)
    model = NearestNeighbours(k=5, classify=True, idCol="vec_id").fit(_train(rows))
    return model.transform(_test(rows)).select(
        "vec_id",
        F.col("label").cast("double").alias("y"),
        F.col("prediction").alias("p"),
        rounded(F.array_max(vector_to_array("probability")), 8).alias("share"),
    )


@query(
    "h2_distance_weighted",
    _VEC
    + ", "
    + _vec_neighbours("euclidean", "nb")
    + """ SELECT vec_id, round(sum(label / d) / sum(1 / d), 8) AS p FROM nb GROUP BY 1""",
)
def vector_weighted(spark, sf):
    rows = vectors(spark, sf)
    model = NearestNeighbours(k=5, weights="distance", idCol="vec_id").fit(_train(rows))
    return model.transform(_test(rows)).select("vec_id", rounded(F.col("prediction"), 8).alias("p"))


@query(
    "l8_distance_metrics",
    _VEC
    + "".join(f", {_vec_neighbours(m, 'nb_' + m)}" for m in _VEC_D)
    + ", nb AS ("
    + " UNION ALL ".join(f"SELECT '{m}' AS metric, * FROM nb_{m}" for m in _VEC_D)
    + """), vote AS (SELECT metric, vec_id, y, label, count(*) AS n FROM nb GROUP BY ALL),
win AS (SELECT metric, vec_id, any_value(y) AS y, arg_min(label, (-n, label)) AS p,
  coalesce(max(n) FILTER (label = 1), 0) / 5.0 AS score FROM vote GROUP BY ALL),
k AS (SELECT metric, c, count(*) FILTER (y = c) AS s, 2.0 * count(*) FILTER (y = c AND p = c)
  / nullif(count(*) FILTER (y = c) + count(*) FILTER (p = c), 0) AS f1 FROM win, (SELECT unnest(range(0, 10)) AS c) GROUP BY ALL),
w AS (SELECT metric, round(sum(s * coalesce(f1, 0)) / sum(s), 8)::DOUBLE AS "F1_weighted" FROM k GROUP BY 1),
r AS (SELECT metric, y, (rank() OVER o + (count(*) OVER (PARTITION BY metric, score) - 1) / 2.0)::DOUBLE AS r FROM win
  WINDOW o AS (PARTITION BY metric ORDER BY score)),
a AS (SELECT metric, round((sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0)
  / (count(*) FILTER (y = 1) * count(*) FILTER (y <> 1)), 8)::DOUBLE AS "ROC_AUC" FROM r GROUP BY 1)
SELECT metric AS distance_metric, round(avg((y = p)::INTEGER), 8) AS "Accuracy",
round(coalesce(count(*) FILTER (y = 1 AND p = 1) / nullif(count(*) FILTER (p = 1), 0)::DOUBLE, 0), 8) AS "Precision_failure",
round(coalesce(count(*) FILTER (y = 1 AND p = 1) / nullif(count(*) FILTER (y = 1), 0)::DOUBLE, 0), 8) AS "Recall_failure",
any_value("F1_weighted") AS "F1_weighted", any_value("ROC_AUC") AS "ROC_AUC"
FROM win JOIN w USING (metric) JOIN a USING (metric) GROUP BY 1""",
)
def distance_metrics(spark, sf):
    rows = vectors(spark, sf)
    parts = None
    for m in ("euclidean", "manhattan", "chebyshev"):
        model = NearestNeighbours(k=5, metric=m, classify=True, idCol="vec_id").fit(_train(rows))
        at_one = model.getOrDefault("classes").index(1.0)
        part = model.transform(_test(rows)).select(
            F.lit(m).alias("model"),
            F.col("label").cast("double").alias("y"),
            F.col("prediction").alias("p"),
            vector_to_array("probability")[at_one].alias("score"),
        )
        parts = part if parts is None else parts.unionByName(part)
    scored = parts.persist()
    out = fetched(metrics.classification_metrics(scored))
    scored.unpersist()
    rows.unpersist()
    return _round_scores(out).select(
        F.col("model").alias("distance_metric"),
        "Accuracy", "Precision_failure", "Recall_failure", "F1_weighted", "ROC_AUC",
    )


# --------------------------------------------------------------------------- features


@query(
    "f1_median_imputation",
    cte("null_view")
    + """ SELECT row_id, coalesce(l_quantity, (SELECT median(l_quantity) FROM null_view)) AS l_quantity FROM null_view""",
)
def median_imputation(spark, sf):
    rows = view(spark, sf, "null_view")
    fill = features.medians(rows, ["l_quantity"])
    return rows.select("row_id", F.coalesce("l_quantity", F.lit(fill["l_quantity"])).alias("l_quantity"))


@query(
    "f3_mode_imputation",
    cte("null_view")
    + """, m AS (SELECT l_returnflag FROM null_view WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT n.row_id, coalesce(n.l_returnflag, m.l_returnflag) AS l_returnflag FROM null_view n, m""",
)
def mode_imputation(spark, sf):
    rows = view(spark, sf, "null_view")
    fill = features.most_frequent(rows, ["l_returnflag"])["l_returnflag"]
    return rows.select("row_id", F.coalesce("l_returnflag", F.lit(fill)).alias("l_returnflag"))


_NULL_STATS = """, s AS (SELECT median(l_quantity) AS mq, median(l_extendedprice) AS me FROM null_view),
t AS (SELECT l_returnflag AS fr FROM null_view WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
i AS (SELECT row_id, coalesce(l_quantity, mq) AS q, coalesce(l_extendedprice, me) AS e, coalesce(l_returnflag, fr) AS r,
  l_linestatus AS ls FROM null_view, s, t)"""


def _null_features(spark, sf, scale=True):
    rows = view(spark, sf, "null_view")
    model = features.TabularFeatures(
        numeric=["l_quantity", "l_extendedprice"], categorical=["l_returnflag", "l_linestatus"], scale=scale
    ).fit(rows)
    return model, model.transform(rows)


@query(
    "f2_f5_design_matrix",
    cte("null_view")
    + _NULL_STATS
    + """, m AS (SELECT avg(q) AS aq, stddev_pop(q) AS sq, avg(e) AS ae, stddev_pop(e) AS se FROM i)
    SELECT row_id, round((q - aq) / sq, 8) AS v0, round((e - ae) / se, 8) AS v1, (r = 'A')::INTEGER::DOUBLE AS v2,
    (r = 'N')::INTEGER::DOUBLE AS v3, (r = 'R')::INTEGER::DOUBLE AS v4, (ls = 'O')::INTEGER::DOUBLE AS v5 FROM i, m""",
)
def design_matrix(spark, sf):
    _, out = _null_features(spark, sf)
    x = vector_to_array("features")
    return out.select("row_id", *[rounded(x[i], 8).alias(f"v{i}") for i in range(6)])


@query(
    "f5_unscaled_matrix",
    cte("null_view")
    + _NULL_STATS
    + """ SELECT row_id, q AS v0, e AS v1, (r = 'A')::INTEGER::DOUBLE AS v2,
    (r = 'N')::INTEGER::DOUBLE AS v3, (r = 'R')::INTEGER::DOUBLE AS v4, (ls = 'O')::INTEGER::DOUBLE AS v5 FROM i""",
)
def unscaled_matrix(spark, sf):
    _, out = _null_features(spark, sf, scale=False)
    x = vector_to_array("features")
    return out.select("row_id", *[x[i].alias(f"v{i}") for i in range(6)])


@query(
    "f4_one_hot_unseen",
    cte("clf_view")
    + " SELECT l_returnflag, count(*) AS n, (l_returnflag = 'R')::INTEGER::DOUBLE AS v0 FROM clf_view GROUP BY 1",
)
def one_hot_unseen(spark, sf):
    """Fitted without 'N' rows: two categories keep the second only, 'N' becomes zeros."""
    rows = view(spark, sf, "clf_view")
    model = features.TabularFeatures(categorical=["l_returnflag"]).fit(rows.where("l_returnflag <> 'N'"))
    x = vector_to_array("features")
    return model.transform(rows).groupBy("l_returnflag", x[0].alias("v0")).agg(F.count("*").alias("n"))


@query(
    "f6_feature_names",
    """SELECT (row_number() OVER () - 1)::INTEGER AS position, name FROM (SELECT unnest(['l_quantity', 'l_extendedprice',
    'l_returnflag_A', 'l_returnflag_N', 'l_returnflag_R', 'l_linestatus_O']) AS name)""",
)
def feature_names(spark, sf):
    from ..session import local_table

    model, _ = _null_features(spark, sf)
    names = features.feature_names(model)
    return local_table(spark, list(enumerate(names)), "position int, name string")


# Products of the five inputs up to the second degree, in the order the expansion emits them: its name, and SQL.
_PAIRS = [
    (" ".join(_NAMES[i] if p == 1 else f"{_NAMES[i]}^{p}" for i, p in sorted(Counter(t).items())), " * ".join(f"x{i + 1}" for i in t))
    for n in (1, 2)
    for t in itertools.combinations_with_replacement(range(5), n)
]


@query(
    "f7_polynomial_terms",
    _REG_SRC + " SELECT row_id, " + ", ".join(f"round({e}, 6) AS t{i}" for i, (_, e) in enumerate(_PAIRS)) + " FROM d",
)
def polynomial_terms(spark, sf):
    """All twenty expanded terms of every row."""
    rows = reg_rows(spark, sf)
    with models.FittingRoom(_train(rows), REG) as room:
        model, _ = room.prepared(True, 2)
    names = features.feature_names(model)
    x = vector_to_array(models.EXPANDED)
    return model.transform(rows).select(
        "row_id", *[rounded(x[names.index(n)], 6).alias(f"t{i}") for i, (n, _) in enumerate(_PAIRS)]
    )


def rate() -> features.AddedColumns:
    return features.AddedColumns.by_sql("price changes multiply", rate=("double", "(1 - l_discount) * (1 + l_tax)"))


@query(
    "f8_engineered_feature",
    _reg_fit_sql("").replace(
        checking.prepared("d", "src", NUMERIC, _XREG, "net_price", ["row_id"]) + ", ",
        "src2 AS (SELECT *, (1 - l_discount) * (1 + l_tax) AS rate FROM src), "
        + checking.prepared("d", "src2", [*NUMERIC, "rate"], _XREG, "net_price", ["row_id"])
        + ", "
        + checking.least_squares("f", "d", [f"x{i}" for i in range(1, 7)]),
    ),
)
def engineered_feature(spark, sf):
    inputs = models.Inputs(tuple(NUMERIC), tuple(REG_CATEGORICAL), REG_TARGET, feature=rate())
    return _reg_scores(spark, sf, models.LINEAR, inputs)


@query(
    "f10_transformed_moments",
    _REG_SRC
    + " "
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS feature, is_train, round(avg(x{i}), 7) + 0.0 AS mean, round(stddev_pop(x{i}), 7) AS sd FROM d GROUP BY 2"""
        for i, n in enumerate(_NAMES, 1)
    ),
)
def transformed_moments(spark, sf):
    rows = reg_rows(spark, sf)
    with models.FittingRoom(_train(rows), REG) as room:
        model, _ = room.prepared(True, None)
    names = features.feature_names(model)
    parts = [
        features.vector_moments(model.transform(part), names).withColumn("is_train", F.lit(flag))
        for part, flag in ((_train(rows), True), (_test(rows), False))
    ]
    return parts[0].unionByName(parts[1]).select(
        "feature", "is_train",
        (rounded(F.col("mean"), 7) + 0.0).alias("mean"), rounded(F.col("sd"), 7).alias("sd"),
    )


@query("f11_whole_pipeline", _reg_fit_sql(checking.least_squares("f", "d", _X5)))
def whole_pipeline(spark, sf):
    rows = reg_rows(spark, sf)
    model = REG.pipeline(models.regressors()[models.LINEAR]).fit(_train(rows))
    scored = models.predictions({models.LINEAR: model}, _test(rows), REG)
    return _round_scores(fetched(metrics.regression_metrics(scored))).drop("model")


# ------------------------------------------------------------------------- explanation


def _coef_sql(rows: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(b{i}, 4) AS coefficient, round(b0, 4) AS intercept FROM {rows}"
        for i, n in enumerate(names, 1)
    )


@query(
    "l1_linear_coefficients",
    f"{_REG_SRC}, {checking.least_squares('f', 'd', _X5)} {_coef_sql('f_b', _NAMES)}",
)
def linear_coefficients(spark, sf):
    rows, fitted = _fit_reg(spark, sf, models.LINEAR)
    out = explain.coefficients(fitted[models.LINEAR])
    rows.unpersist()
    return out.select(
        "feature", rounded(F.col("coefficient"), 4).alias("coefficient"), rounded(F.col("intercept"), 4).alias("intercept")
    )


@query(
    "l2_odds_ratios",
    f"{_CLF_SRC}, {checking.logistic('lr', 'd', 7, 1.0)} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(w{i}, 3) AS coefficient_log_odds, round(exp(w{i}), 2) AS odds_ratio FROM lr_14" for i, n in enumerate(_CNAMES, 1)
    ),
)
def odds_ratios(spark, sf):
    rows, fitted = _fit_clf(spark, sf, models.LOGISTIC)
    out = explain.odds_ratios(fitted[models.LOGISTIC])
    rows.unpersist()
    return out.select(
        "feature",
        rounded(F.col("coefficient_log_odds"), 3).alias("coefficient_log_odds"),
        rounded(F.col("odds_ratio"), 2).alias("odds_ratio"),
    )


@query(
    "l3_lasso_sparsity",
    f"{_REG_SRC}, {checking.elastic_net('f', 'd', _X5, 1500.0, 1.0)}, c AS ({_coef_sql('f_b', _NAMES)})"
    + """ SELECT count(*) AS n_features, count(*) FILTER (abs(coefficient) <= 1e-8) AS n_zero_coefficients,
    string_agg(feature, ',' ORDER BY feature) FILTER (abs(coefficient) <= 1e-8) AS zeroed_features,
    round(100.0 * count(*) FILTER (abs(coefficient) <= 1e-8) / count(*), 2)::DOUBLE AS pct_zero FROM c""",
)
def lasso_sparsity(spark, sf):
    rows, fitted = _fit_reg(spark, sf, models.LASSO, lasso={"alpha": 1500.0})
    out = explain.sparsity(fitted[models.LASSO])
    rows.unpersist()
    return out.withColumn("zeroed_features", F.array_join("zeroed_features", ","))


@query("l4_tree_importances")
def tree_importances(spark, sf):
    rows, fitted = _fit_reg(spark, sf, models.TREE)
    return explain.importances(fitted[models.TREE])


@query("l4_forest_importances")
def forest_importances(spark, sf):
    rows, fitted = _fit_reg(spark, sf, models.FOREST, forest={"n_estimators": 10, "max_depth": 6})
    return explain.importances(fitted[models.FOREST])


@query("l5_classifier_importances")
def classifier_importances(spark, sf):
    rows, fitted = _fit_clf(spark, sf, models.TREE_C)
    return explain.importances(fitted[models.TREE_C])


@query(
    "l6_top_effects",
    f"{_REG_SRC}, {checking.least_squares('f', 'd', checking.monomials(5, 1, [5]))}, c AS ({_coef_sql('f_b', _NAMES)})"
    + " SELECT feature, coefficient FROM c ORDER BY abs(coefficient) DESC, feature LIMIT 3",
)
def top_effects(spark, sf):
    rows, fitted = _fit_reg(spark, sf, models.LINEAR)
    out = explain.top_effects(explain.coefficients(fitted[models.LINEAR]), "coefficient", 3)
    rows.unpersist()
    return out.select("feature", rounded(F.col("coefficient"), 4).alias("coefficient"))


def _degree_sql() -> str:
    fits = [
        checking.least_squares(f"p{d}", "d", checking.monomials(5, d, [5])) for d in (1, 2)
    ]
    rows = " UNION ALL ".join(
        f"""SELECT {d} AS degree, {n} AS n_expanded_terms,
        round(1 - sum((y - p) ** 2) FILTER (is_train) / (count(*) FILTER (is_train) * var_pop(y) FILTER (is_train)), 8) AS "train_R2",
        round(1 - sum((y - p) ** 2) FILTER (NOT is_train) / (count(*) FILTER (NOT is_train) * var_pop(y) FILTER (NOT is_train)), 8) AS "test_R2",
        round(sqrt(avg((y - p) ** 2) FILTER (NOT is_train)), 3) AS "test_RMSE", round(avg(abs(y - p)) FILTER (NOT is_train), 3) AS "test_MAE"
        FROM p{d}"""
        for d, n in ((1, 5), (2, 20))
    )
    return f"{_REG_SRC}, {', '.join(fits)} {rows}"


@query("l7_polynomial_degrees", _degree_sql())
def polynomial_degrees(spark, sf):
    rows = reg_rows(spark, sf)
    out = explain.polynomial_degrees(rows, REG, (1, 2))
    rows.unpersist()
    return out.select(
        "degree", "n_expanded_terms",
        rounded(F.col("train_R2"), 8).alias("train_R2"), rounded(F.col("test_R2"), 8).alias("test_R2"),
        rounded(F.col("test_RMSE"), 3).alias("test_RMSE"), rounded(F.col("test_MAE"), 3).alias("test_MAE"),
    )


@query("l7_three_degrees")
def three_degrees(spark, sf):
    rows = reg_rows(spark, sf)
    out = explain.polynomial_degrees(rows, REG)
    rows.unpersist()
    return out


@query("l9_tree_structure")
def tree_structure(spark, sf):
    rows, fitted = _fit_clf(spark, sf, models.TREE_C)
    return explain.tree_structure(fitted[models.TREE_C], {0: "no_failure", 1: "failure"})


# ------------------------------------------------------------ comparison and selection


@query("j16_regressor_comparison")
def regressor_comparison(spark, sf):
    rows = reg_rows(spark, sf)
    out, _ = selection.compare_regressors(models.regressors(**SMALL), rows, REG_K)
    rows.unpersist()
    return out


@query("j17_classifier_comparison")
def classifier_comparison(spark, sf):
    rows = clf_rows(spark, sf)
    out, _ = selection.compare_classifiers(models.classifiers(**SMALL_C), rows, CLF)
    rows.unpersist()
    return out


_CV_SRC = (
    cte("reg_view")
    + ", "
    + REG_SPLIT_SQL
    + ", tr AS (SELECT * EXCLUDE (split) FROM reg_split WHERE split = 'train'), "
    + fold_sql("tr", "fd")
    + ", src AS (SELECT fd.*, k AS grp, fold <> k AS is_train FROM fd, (SELECT unnest(range(0, 5)) AS k)), "
    + checking.prepared("d", "src", NUMERIC, _XREG, "net_price", ["row_id", "fold"])
)


def _cv_rows(spark, sf):
    rows = reg_rows(spark, sf)
    return split.k_folds(_train(rows), ["row_id"], eager=True).persist()


def _fold_r2(rows: str, model: str) -> str:
    return f"""SELECT '{model}' AS model, grp AS fold, 1 - sum((y - p) ** 2) / (count(*) * var_pop(y)) AS score
    FROM {rows} WHERE NOT is_train GROUP BY grp"""


# The least squares models of the registry as (model, point, ridge, l1, l2): baseline settings, and grids.
_LINEAR_FAMILY = (models.LINEAR, models.RIDGE, models.LASSO, models.ELASTIC, models.polynomial_name(2))
_TUNED = (models.RIDGE, models.LASSO, models.ELASTIC)


def _penalties(spec: models.ModelSpec, point: int) -> tuple:
    found = spec.penalty(spec.defaults)
    return (spec.name, point, *(float(found.get(k, 0.0)) for k in ("ridge", "l1", "l2")))


def _grid_points() -> list[tuple]:
    specs = models.regressors()
    return [
        _penalties(specs[n].with_params(**p), i) for n in _TUNED for i, p in enumerate(selection.grid_points(specs[n]))
    ]


@query(
    "k1_cross_validation",
    _CV_SRC
    + ", "
    + checking.penalty_points("lin", "d", _X5, [_penalties(models.regressors()[n], 0) for n in _LINEAR_FAMILY[:-1]])
    + ", "
    + checking.least_squares("pol", "d", checking.monomials(5, 2, [5]))
    + ", fs AS (SELECT model, grp AS fold, 1 - sum((y - p) ** 2) / (count(*) * var_pop(y)) AS score FROM lin"
    + " WHERE NOT is_train GROUP BY ALL UNION ALL "
    + _fold_r2("pol", models.polynomial_name(2))
    + """) SELECT model, 'r2' AS scoring, count(*) AS folds, round(avg(score), 8) AS "CV_mean", round(stddev_pop(score), 8) AS "CV_std" FROM fs GROUP BY 1""",
)
def cross_validation(spark, sf):
    rows = _cv_rows(spark, sf)
    specs = {n: s for n, s in models.regressors().items() if n in _LINEAR_FAMILY}
    out = fetched(selection.cross_validate(specs, rows, REG, selection.R2))
    rows.unpersist()
    return out.select(
        "model", "scoring", "folds", rounded(F.col("CV_mean"), 8).alias("CV_mean"), rounded(F.col("CV_std"), 8).alias("CV_std")
    )


def _grid_trace_sql() -> str:
    return f"""{_CV_SRC}, {checking.penalty_points("g", "d", _X5, _grid_points())}, trace AS (
    SELECT model, point, grp AS fold, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part,
    1 - sum((y - p) ** 2) / (count(*) * var_pop(y)) AS score FROM g GROUP BY ALL)"""


def _grids(spark, sf):
    """Traces of every grid of the least squares models: 21 points of the registry, five folds each."""
    rows = _cv_rows(spark, sf)
    out = [(n, selection.grid_search(models.regressors()[n], rows, REG, selection.R2)[0]) for n in _TUNED]
    rows.unpersist()
    return out


def _together(parts):
    out = None
    for name, part in parts:
        part = part.withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "a11_grid_trace",
    _grid_trace_sql() + " SELECT model, point, fold::INTEGER AS fold, part, round(score, 8) AS score FROM trace",
)
def grid_trace(spark, sf):
    trace = _together(_grids(spark, sf))
    return trace.select("model", "point", "fold", "part", rounded(F.col("score"), 8).alias("score"))


@query(
    "k5_k6_grid_summary",
    _grid_trace_sql()
    + """, s AS (SELECT model, point, avg(score) FILTER (part = 'test') AS mt, stddev_pop(score) FILTER (part = 'test') AS st,
    avg(score) FILTER (part = 'train') AS mr FROM trace GROUP BY 1, 2)
    SELECT model, point, round(mt, 8) AS mean_test_score, round(st, 8) AS std_test_score, round(mr, 8) AS mean_train_score,
    rank() OVER (PARTITION BY model ORDER BY mt DESC)::INTEGER AS rank_test_score FROM s""",
)
def grid_summary(spark, sf):
    out = _together((n, selection.grid_summary(t)) for n, t in _grids(spark, sf))
    return out.select(
        "model", "point", "rank_test_score",
        *[rounded(F.col(c), 8).alias(c) for c in ("mean_test_score", "std_test_score", "mean_train_score")],
    )


@query("k7_tuning_table")
def tuning_table(spark, sf):
    from . import tracks

    rows = reg_rows(spark, sf)
    out = tracks.tune_models(
        {models.RIDGE: models.regressors()[models.RIDGE]}, rows, REG, selection.R2
    )[0]
    rows.unpersist()
    return out


@query("k5_neighbour_grid")
def neighbour_grid(spark, sf):
    """Both neighbour parameters over the vectors: one search per fold serves all points."""
    cells = [f"e{i}" for i in range(64)]
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("row_id"), "label",
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cells)],
    )
    rows = split.k_folds(rows, ["row_id"], stratify="label", eager=True).persist()
    inputs = models.Inputs(tuple(cells), (), "label")
    trace, _ = selection.grid_search(models.classifiers()[models.KNN_C], rows, inputs, selection.F1W)
    rows.unpersist()
    return selection.grid_summary(trace).drop("mean_fit_time")
