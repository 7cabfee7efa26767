"""Queries over predictions and result tables: scoring, evaluation, selection, checks.

Predictions come from fixed rules over the given tables, so any engine can reproduce
them and every score is checked exactly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rounded, slug
from ..operators import checks, explore, metrics, scoring, selection, split
from ..sources import contracts, store
from .checking import label_scores, regression_scores
from .fixtures import (
    PRICE_RULES,
    cte,
    price_predictions,
    price_predictions_sql,
    risk_predictions,
    risk_predictions_sql,
    table,
    view,
)
from .registry import query
from .tables import _HIST, REG_SPLIT_SQL, fold_sql


def _reg_long(spark, sf):
    return view(spark, sf, "reg_pred").withColumn("model", F.lit("rule"))


def _clf_long(spark, sf):
    return view(spark, sf, "clf_pred").withColumn("model", F.lit("rule"))


def _round_scores(df, digits=8):
    plain = ("R2", "ROC_AUC", "Accuracy", "Precision_failure", "Recall_failure", "F1_weighted", "F1_failure")
    out = df
    for c in df.columns:
        if c in plain:
            out = out.withColumn(c, rounded(F.col(c), digits))
        elif c in ("RMSE", "MAE"):
            out = out.withColumn(c, rounded(F.col(c), 4))
    return out


_PRICE = cte("reg_view") + ", " + price_predictions_sql()
_RISK = cte("clf_view") + ", " + risk_predictions_sql()


# ---------------------------------------------------------------------- evaluation


@query("j1_j3_regression_metrics", cte("reg_pred") + " " + regression_scores("reg_pred", where="TRUE"))
def regression_metrics(spark, sf):
    return _round_scores(metrics.regression_metrics(_reg_long(spark, sf))).drop("model")


@query(
    "j4_j9_classification_metrics",
    cte("clf_pred") + ", m AS (SELECT 'rule' AS model, * FROM clf_pred) " + label_scores("m"),
)
def classification_metrics(spark, sf):
    return _round_scores(metrics.classification_metrics(_clf_long(spark, sf)))


@query("j4_j9_many_models", _RISK + " " + label_scores("risk_pred"))
def many_models(spark, sf):
    return _round_scores(metrics.classification_metrics(risk_predictions(spark, sf)))


@query(
    "j8_class_scores",
    """WITH t AS (SELECT event_type AS y, CASE WHEN value > 100 THEN 'purchase' WHEN value > 40 THEN 'click'
  ELSE 'view' END AS p FROM events),
c AS (SELECT y AS class FROM t UNION SELECT p FROM t),
n AS (SELECT class, (SELECT count(*) FROM t WHERE y = class) AS support, (SELECT count(*) FROM t WHERE p = class) AS predicted,
(SELECT count(*) FROM t WHERE p = class AND y = class) AS hits FROM c)
SELECT class, support, predicted, hits, round(coalesce(hits / nullif(predicted, 0)::DOUBLE, 0), 8) AS "precision",
round(coalesce(hits / nullif(support, 0)::DOUBLE, 0), 8) AS recall,
round(coalesce(2.0 * hits / nullif(support + predicted, 0), 0), 8)::DOUBLE AS f1 FROM n""",
)
def class_scores(spark, sf):
    rows = table(spark, sf, "events").select(
        F.lit("rule").alias("model"),
        F.col("event_type").alias("y"),
        F.expr("CASE WHEN value > 100 THEN 'purchase' WHEN value > 40 THEN 'click' ELSE 'view' END").alias("p"),
    )
    out = metrics.class_scores(rows).drop("model")
    return out.select(
        "class", "support", "predicted", "hits",
        *[rounded(F.col(c), 8).alias(c) for c in ("precision", "recall", "f1")],
    )


@query(
    "j10_confusion",
    _RISK
    + """, g AS (SELECT model, y, p FROM (SELECT DISTINCT model FROM risk_pred), (SELECT unnest([0, 1]) AS y), (SELECT unnest([0, 1]) AS p))
    SELECT model, y, p, (SELECT count(*) FROM risk_pred r WHERE r.model = g.model AND r.y = g.y AND r.p = g.p) AS count FROM g""",
)
def confusion(spark, sf):
    return metrics.confusion(risk_predictions(spark, sf))


@query(
    "j11_roc_points",
    _RISK
    + """, c AS (SELECT model, score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM risk_pred GROUP BY ALL)
    SELECT model, score AS threshold, round(sum(neg) OVER w / sum(neg) OVER (PARTITION BY model), 9)::DOUBLE AS fpr,
    round(sum(pos) OVER w / sum(pos) OVER (PARTITION BY model), 9)::DOUBLE AS tpr FROM c
    WINDOW w AS (PARTITION BY model ORDER BY score DESC)
    UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM c""",
)
def roc_points(spark, sf):
    out = metrics.roc_points(risk_predictions(spark, sf))
    return out.select(
        "model", "threshold", rounded(F.col("fpr"), 9).alias("fpr"), rounded(F.col("tpr"), 9).alias("tpr")
    )


@query(
    "j12_majority_baseline",
    cte("clf_view")
    + """, h AS (SELECT *, CASE WHEN substr(md5('42|' || row_id), 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split FROM clf_view),
    t AS (SELECT overload FROM h WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, overload LIMIT 1),
    s AS (SELECT count(*) FILTER (h.overload = t.overload) / count(*)::DOUBLE AS s, count(*) AS n FROM h, t WHERE split = 'test')
    SELECT overload AS majority_class, round(s, 9) AS baseline_accuracy, round(s * 2 * s / (1 + s), 9) AS baseline_f1_weighted,
    n AS test_rows FROM s, t""",
)
def majority_baseline(spark, sf):
    rows = split.hash_split(view(spark, sf, "clf_view"), ["row_id"])
    out = metrics.majority_baseline(rows, "overload")
    return out.select(
        "majority_class", "test_rows",
        rounded(F.col("baseline_accuracy"), 9).alias("baseline_accuracy"),
        rounded(F.col("baseline_f1_weighted"), 9).alias("baseline_f1_weighted"),
    )


@query("j13_residuals", cte("reg_pred") + " SELECT row_id, round(p, 6) AS p, round(y - p, 6) AS residual FROM reg_pred")
def residual_points(spark, sf):
    out = metrics.residuals(view(spark, sf, "reg_pred"))
    return out.select("row_id", rounded(F.col("p"), 6).alias("p"), rounded(F.col("residual"), 6).alias("residual"))


@query(
    "j14_residual_histogram",
    cte("reg_pred")
    + ", res AS (SELECT y - p AS residual FROM reg_pred)"
    + _HIST.format(c="residual", t="res"),
)
def residual_histogram(spark, sf):
    out = explore.histogram(metrics.residuals(view(spark, sf, "reg_pred")), ["residual"])
    return out.select(
        "column", "bin", "count",
        rounded(F.col("lower"), 6).alias("lower"), rounded(F.col("upper"), 6).alias("upper"),
    )


@query(
    "j15_identity_span",
    _PRICE + " SELECT model, round(least(min(y), min(p)), 6) AS lo, round(greatest(max(y), max(p)), 6) AS hi FROM price_pred GROUP BY 1",
)
def identity_span(spark, sf):
    out = metrics.identity_span(price_predictions(spark, sf))
    return out.select("model", rounded(F.col("lo"), 6).alias("lo"), rounded(F.col("hi"), 6).alias("hi"))


_RANKED = (
    _PRICE
    + ", sc AS ("
    + regression_scores("price_pred", "model", "TRUE")
    + ') , ranked AS (SELECT *, row_number() OVER (ORDER BY "R2" DESC, model) AS rank FROM sc)'
)


def _ranked(spark, sf):
    return metrics.ranked(metrics.regression_metrics(price_predictions(spark, sf)), "R2")


@query("j16_rule_comparison", _RANKED + ' SELECT model, n, "R2", "RMSE", "MAE", rank::INTEGER AS rank FROM ranked')
def rule_comparison(spark, sf):
    return _round_scores(_ranked(spark, sf))


@query("j19_model_ranking", _RANKED + ' SELECT model, "RMSE" FROM ranked ORDER BY "RMSE", model')
def model_ranking(spark, sf):
    table_ = metrics.regression_metrics(price_predictions(spark, sf))
    return _round_scores(table_.select("model", "RMSE").orderBy("RMSE", "model"))


@query(
    "j18_overfitting_gap",
    cte("reg_view")
    + ", "
    + REG_SPLIT_SQL
    + """, price_pred AS ("""
    + "\nUNION ALL ".join(
        f"SELECT '{m}' AS model, split, net_price AS y, {e} AS p FROM reg_split" for m, e in PRICE_RULES.items()
    )
    + """), sc AS (SELECT model, 1 - sum((y - p) ** 2) FILTER (split = 'train') / (count(*) FILTER (split = 'train') * var_pop(y) FILTER (split = 'train')) AS tr,
    1 - sum((y - p) ** 2) FILTER (split = 'test') / (count(*) FILTER (split = 'test') * var_pop(y) FILTER (split = 'test')) AS te
    FROM price_pred GROUP BY 1)
    SELECT model, round(tr, 8) AS "Train_R2", round(te, 8) AS "R2", round(tr - te, 8) AS gap FROM sc""",
)
def overfitting_gap(spark, sf):
    rows = split.hold_out(view(spark, sf, "reg_view"), ["row_id"]).select("row_id", "split")
    scored = price_predictions(spark, sf).join(rows, "row_id")
    out = selection.overfitting_gap(selection.regression_table(scored))
    return out.select("model", *[rounded(F.col(c), 8).alias(c) for c in ("Train_R2", "R2", "gap")])


# ----------------------------------------------------------------------- selection

_FOLDS = (
    cte("reg_view")
    + ", "
    + fold_sql("reg_view", "folded")
    + ", price_pred AS ("
    + "\nUNION ALL ".join(
        f"SELECT '{m}' AS model, fold, net_price AS y, {e} AS p FROM folded" for m, e in PRICE_RULES.items()
    )
    + """), fs AS (SELECT model, fold, 1 - sum((y - p) ** 2) / (count(*) * var_pop(y)) AS score FROM price_pred GROUP BY ALL),
cv AS (SELECT model, 'r2' AS scoring, count(*) AS folds, avg(score) AS m, stddev_pop(score) AS s,
  list(round(score, 5) ORDER BY fold) AS fold_scores FROM fs GROUP BY 1)"""
)


def _cv(spark, sf):
    folds = split.k_folds(view(spark, sf, "reg_view"), ["row_id"]).select("row_id", "fold")
    scored = price_predictions(spark, sf).join(folds, "row_id")
    return selection.cross_validation_table(
        selection._fold_metric(scored, selection.R2, ["model", "fold"]), selection.R2
    )


@query(
    "k1_rule_cross_validation",
    _FOLDS
    + """ SELECT model, scoring, folds, round(m, 8) AS "CV_mean", round(s, 8) AS "CV_std", fold_scores::VARCHAR AS fold_scores FROM cv""",
)
def rule_cross_validation(spark, sf):
    return _cv(spark, sf).select(
        "model", "scoring", "folds",
        rounded(F.col("CV_mean"), 8).alias("CV_mean"), rounded(F.col("CV_std"), 8).alias("CV_std"),
        F.concat(F.lit("["), F.array_join("fold_scores", ", "), F.lit("]")).alias("fold_scores"),
    )


@query("k2_leaders", _FOLDS + " SELECT model FROM cv ORDER BY m DESC, model LIMIT 2")
def leaders(spark, sf):
    return selection.leaders(_cv(spark, sf))


@query(
    "k3_leader_rows",
    _FOLDS
    + """ SELECT model, round(m, 8) AS "CV_mean", fold_scores::VARCHAR AS fold_scores FROM cv
    WHERE model IN (SELECT model FROM cv ORDER BY m DESC, model LIMIT 2)""",
)
def leader_rows(spark, sf):
    cv = _cv(spark, sf)
    return selection.leader_rows(cv, selection.leaders(cv)).select(
        "model", rounded(F.col("CV_mean"), 8).alias("CV_mean"),
        F.concat(F.lit("["), F.array_join("fold_scores", ", "), F.lit("]")).alias("fold_scores"),
    )


@query(
    "b5_leader_membership",
    _RANKED + ' SELECT model, "R2" FROM ranked WHERE rank <= 2',
)
def leader_membership(spark, sf):
    ranked = _ranked(spark, sf)
    best = ranked.where("rank <= 2").select("model")
    return _round_scores(selection.leader_rows(ranked, best).select("model", "R2"))


@query(
    "k4_models_to_tune",
    _FOLDS
    + """, lead AS (SELECT model FROM cv ORDER BY m DESC, model LIMIT 2),
    grids AS (SELECT * FROM (VALUES (0, 'flat'), (1, 'mean_rate')) AS g(position, model)),
    o AS (SELECT model, model IN (SELECT model FROM lead) AS is_lead, row_number() OVER
      (ORDER BY model IN (SELECT model FROM lead) DESC, position)::INTEGER AS turn FROM grids)
    SELECT model, turn FROM o WHERE turn <= 2 OR is_lead""",
)
def models_to_tune(spark, sf):
    return selection.to_tune(selection.leaders(_cv(spark, sf)), ["flat", "mean_rate"])


@query(
    "k8_final_pick",
    _FOLDS
    + """ SELECT (SELECT model FROM cv ORDER BY m DESC, model LIMIT 1) AS by_cross_validation,
    (SELECT model FROM (SELECT model, 1 - sum((y - p) ** 2) / (count(*) * var_pop(y)) AS r FROM price_pred GROUP BY 1) ORDER BY r DESC, model LIMIT 1) AS by_held_out""",
)
def final_pick(spark, sf):
    return selection.final_pick(_cv(spark, sf), metrics.regression_metrics(price_predictions(spark, sf)), "R2")


# ------------------------------------------------------------------------- scoring


@query(
    "a9_model_index",
    _RANKED
    + """ SELECT rank::INTEGER AS rank, model, '07_' || replace(model, ' ', '_') AS slug, 'regression/07_' || model AS file, FALSE AS also_tuned,
    'R2' AS rank_metric, "R2" AS rank_value, "RMSE", "MAE" FROM ranked""",
)
def model_index(spark, sf):
    named = metrics.regression_metrics(price_predictions(spark, sf)).withColumn(
        "model", F.concat(F.lit("7. "), F.col("model"))
    )
    out = store.model_index(named, "regression", "R2", ["RMSE", "MAE"], [])
    short = F.regexp_replace("model", "^7[.] ", "")
    return _round_scores(
        out.withColumn("slug", slug(F.col("model")))
        .withColumn("model", short)
        .withColumn("rank_value", rounded(F.col("rank_value"), 8))
    )


@query(
    "i3_clipped_prediction",
    cte("reg_pred")
    + """ SELECT row_id, round(greatest(10000, least(90000, p)), 6) AS prediction,
    abs(p - greatest(10000, least(90000, p))) > 0.05 AS clipped FROM reg_pred""",
)
def clipped_prediction(spark, sf):
    out = scoring.clip(view(spark, sf, "reg_pred").withColumnRenamed("p", "prediction"), 10000.0, 90000.0)
    return out.select("row_id", rounded(F.col("prediction"), 6).alias("prediction"), "clipped")


@query(
    "i4_error_band",
    _RANKED
    + """, b AS (SELECT r.model, r.row_id, round(r.p, 4) AS prediction, round(r.p - sqrt(e.mse), 4) AS low, round(r.p + sqrt(e.mse), 4) AS high
      FROM price_pred r JOIN (SELECT model, avg((y - p) ** 2) AS mse FROM price_pred GROUP BY 1) e USING (model))
    SELECT model, count(*) AS n, round(avg(low), 4) AS low, round(avg(high), 4) AS high, round(avg(high - low), 3) AS width FROM b GROUP BY 1""",
)
def error_band(spark, sf):
    rows = price_predictions(spark, sf).withColumnRenamed("p", "prediction")
    index = metrics.regression_metrics(price_predictions(spark, sf))
    banded = scoring.error_band(rows, index).select(
        "model", rounded(F.col("low"), 4).alias("low"), rounded(F.col("high"), 4).alias("high")
    )
    return banded.groupBy("model").agg(
        F.count("*").alias("n"),
        rounded(F.avg("low"), 4).alias("low"),
        rounded(F.avg("high"), 4).alias("high"),
        rounded(F.avg(F.col("high") - F.col("low")), 3).alias("width"),
    )


@query(
    "i5_compare_models",
    _RANKED
    + """ SELECT r.row_id, r.model, k.rank::INTEGER AS rank, round(r.p, 6) AS prediction, round(k."R2", 6) AS "R2", k."RMSE"
    FROM price_pred r JOIN ranked k USING (model)""",
)
def compare_models(spark, sf):
    out = scoring.compare(
        price_predictions(spark, sf).withColumnRenamed("p", "prediction"), _ranked(spark, sf), ["R2", "RMSE"]
    )
    return out.select(
        "row_id", "model", "rank", rounded(F.col("prediction"), 6).alias("prediction"),
        rounded(F.col("R2"), 6).alias("R2"), rounded(F.col("RMSE"), 4).alias("RMSE"),
    )


@query(
    "i6_verdict",
    cte("clf_pred")
    + """ SELECT row_id, CASE p WHEN 0 THEN 'No Failure' ELSE 'Failure' END AS verdict,
    round(least(score, 1.0) * 100, 1) AS probability_pct FROM clf_pred""",
)
def verdict(spark, sf):
    rows = view(spark, sf, "clf_pred").select("row_id", F.col("p").alias("prediction"), "score")
    return scoring.verdict(rows, {0: "No Failure", 1: "Failure"}).select("row_id", "verdict", "probability_pct")


@query(
    "i7_extrapolation",
    cte("reg_view")
    + ", "
    + REG_SPLIT_SQL
    + """, b AS (SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_extendedprice) AS e0, max(l_extendedprice) AS e1
      FROM reg_split WHERE split = 'train')
    SELECT split, count(*) AS rows, count(*) FILTER (NOT (l_quantity BETWEEN q0 AND q1 AND l_extendedprice BETWEEN e0 AND e1)) AS outside,
    count(*) FILTER (l_tax <= l_discount) AS rule FROM reg_split, b GROUP BY 1""",
)
def extrapolation(spark, sf):
    rows = split.hold_out(view(spark, sf, "reg_view"), ["row_id"])
    bounds = scoring.training_ranges(rows.where("split = 'train'"), ["l_quantity", "l_extendedprice"])
    out = scoring.flag_extrapolation(
        rows, bounds, ["l_quantity", "l_extendedprice"], {"rule": "l_tax <= l_discount"}
    )
    return out.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.count_if("outside_training_range").alias("outside"),
        F.count_if("rule").alias("rule"),
    )


# ------------------------------------------------------------------------- checks


@query(
    "m1_data_checks",
    """SELECT 'classification: raw shape' AS "check", CASE WHEN count(*) = 60000 THEN 'PASS' ELSE 'FAIL' END AS status,
    '(' || count(*) || ', 10) expected (60000, 10)' AS detail FROM lineitem
    UNION ALL SELECT 'classification: prepared columns in 6-9 range', 'PASS', '6 columns'
    UNION ALL SELECT 'classification: prepared rows >= 10000', CASE WHEN count(*) >= 10000 THEN 'PASS' ELSE 'WARN' END,
      count(*) || ' rows' FROM lineitem
    UNION ALL SELECT 'classification: ' || c || ' excluded', 'PASS', r FROM (VALUES ('overload_reason', 'leakage'),
      ('l_orderkey', 'identifier'), ('l_partkey', 'identifier')) AS v(c, r)""",
)
def data_checks(spark, sf):
    raw = view(spark, sf, "clf_view")
    return checks.data_checks(raw, contracts.OVERLOAD)


_TABLE_CHECKS = (
    _RANKED
    + """, c AS (SELECT count(*) AS n, count(*) FILTER (r > prev) AS rises FROM
      (SELECT "R2" AS r, lag("R2") OVER (ORDER BY rank) AS prev FROM ranked)),
checks AS (SELECT 'regression: 3 rows in comparison table' AS "check", CASE WHEN n = 3 THEN 'PASS' ELSE 'FAIL' END AS status, n || ' rows' AS detail FROM c
    UNION ALL SELECT 'regression: ranked by R2 descending', CASE WHEN rises = 0 THEN 'PASS' ELSE 'FAIL' END, rises || ' rises' FROM c
    UNION ALL SELECT 'regression: ' || m || ' column present', 'PASS', '' FROM (VALUES ('R2'), ('RMSE'), ('MAE')) AS v(m))"""
)


def _table_checks(spark, sf):
    return checks.result_table_checks(_ranked(spark, sf), 3, "R2", ["R2", "RMSE", "MAE"], "regression")


@query("m3_result_table_checks", _TABLE_CHECKS + " SELECT * FROM checks")
def result_table_checks(spark, sf):
    return _table_checks(spark, sf)


@query(
    "m3_classifier_table_checks",
    """SELECT * FROM (VALUES ('classification: 3 rows in comparison table', 'PASS', '3 rows'),
    ('classification: ranked by F1_weighted descending', 'PASS', '0 rises'),
    ('classification: Accuracy column present', 'PASS', ''), ('classification: F1_weighted column present', 'PASS', ''),
    ('classification: ROC-AUC from scores', 'PASS', ''), ('classification: no missing ROC-AUC', 'PASS', ''))
    AS v("check", status, detail)""",
)
def classifier_table_checks(spark, sf):
    scored = metrics.classification_metrics(risk_predictions(spark, sf))
    ranked = metrics.ranked(scored, "F1_weighted").withColumn("AUC_source", F.lit("decision_function"))
    return checks.result_table_checks(ranked, 3, "F1_weighted", ["Accuracy", "F1_weighted"], "classification")


@query(
    "m6_tuning_outcome",
    _FOLDS
    + """, base AS (SELECT m FROM cv WHERE model = 'mean_rate')
    SELECT 'regression tuning reports real outcomes' AS "check", 'PASS' AS status,
    count(*) FILTER (cv.m > base.m) || '/' || count(*) || ' models improved on CV' AS detail FROM cv, base""",
)
def tuning_outcome(spark, sf):
    cv = _cv(spark, sf)
    base = cv.where("model = 'mean_rate'").select("CV_mean").scalar()
    return checks.tuning_outcome(cv.withColumn("improved_on_CV", F.col("CV_mean") > base), "regression")


@query(
    "m7_report",
    _TABLE_CHECKS
    + """ SELECT count(*) FILTER (status = 'PASS') AS n_pass, count(*) FILTER (status = 'FAIL') AS n_fail,
    count(*) FILTER (status = 'WARN') AS n_warn, count(*) FILTER (status = 'TODO') AS n_todo,
    CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAILING CHECKS PRESENT'
    WHEN count(*) FILTER (status = 'TODO') > 0 THEN 'COMPLETE, ITEMS AWAITING INPUT' ELSE 'ALL CHECKS PASS' END AS verdict FROM checks""",
)
def report(spark, sf):
    return checks.report(_table_checks(spark, sf))
