"""Queries that write and read back: sources, sinks, stored models, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rounded
from ..operators import checks, metrics, models
from ..session import scratch_path
from ..sources import contracts, readers, sinks, store
from ..streaming.scoring import row_stream, score_stream
from . import checking
from .fits import _REG_SRC, _X5, _fit_reg, _test, _train
from .fixtures import cte, price_predictions, table, view
from .registry import query
from .scores import _RANKED, _ranked, _round_scores


@query(
    "a1_csv_scan",
    cte("reg_view")
    + """ SELECT l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS quantity, round(avg(l_extendedprice), 6) AS price
    FROM reg_view GROUP BY 1""",
)
def csv_scan(spark, sf):
    rows = contracts.prepare(view(spark, sf, "reg_view"), contracts.NET_PRICE)
    path = scratch_path(spark, "csv")
    rows.write.option("header", True).csv(f"{path}/{'rows.csv'}")
    spec = contracts.DatasetSpec(
        track="regression", name="copy", filename="rows.csv", target="net_price",
        numeric=contracts.NET_PRICE.numeric, categorical=contracts.NET_PRICE.categorical,
        expected_shape=(60000, 6), schema=rows.schema,
    )
    return readers.load_raw(spark, spec, path).groupBy("l_linestatus").agg(
        F.count("*").alias("n"),
        rounded(F.sum("l_quantity"), 4).alias("quantity"),
        rounded(F.avg("l_extendedprice"), 6).alias("price"),
    )


@query("a5_provenance")
def provenance(spark, sf):
    first = readers.provenance(spark, contracts.NET_PRICE, sf, table(spark, sf, "lineitem"))
    return readers.upsert(first, first).drop("retrieved_on")


@query("a6_table_sink", _RANKED + ' SELECT model, n, "R2", "RMSE", "MAE", rank::INTEGER AS rank FROM ranked')
def table_sink(spark, sf):
    ranked = _round_scores(_ranked(spark, sf))
    path = sinks.save_table(ranked, scratch_path(spark, "tables"), "comparison")
    return spark.read.schema(ranked.schema).option("header", True).csv(path)


@query("a7_json_sink", _RANKED + ' SELECT model, n, "R2", "RMSE", "MAE", rank::INTEGER AS rank FROM ranked')
def json_sink(spark, sf):
    ranked = _round_scores(_ranked(spark, sf))
    path = sinks.save_json(ranked, scratch_path(spark, "json"), "comparison")
    return spark.read.schema(ranked.schema).json(path)


@query("a10_run_log")
def run_log(spark, sf):
    log = sinks.RunLog(spark, "regression", "dev")
    facts = metrics.regression_metrics(price_predictions(spark, sf)).collect()
    for row in facts:
        log.add("metrics", f"{row['model']} n={row['n']}")
    path = log.save(scratch_path(spark, "log"))
    return spark.read.json(path).select("track", "mode", "step", "status", "detail")


def _stored_linear(spark, sf):
    rows, fitted = _fit_reg(spark, sf, models.LINEAR)
    scored = models.predictions(fitted, rows, models.Inputs((), (), "net_price"), keep=["split"])
    from ..operators.selection import regression_table

    index = store.model_index(regression_table(scored), "regression", "R2", ["RMSE", "MAE"], [])
    root = scratch_path(spark, "models")
    store.save_models(fitted, index, root)
    return rows, fitted[models.LINEAR], root


_SCORED = f"""{_REG_SRC}, {checking.least_squares('f', 'd', _X5)}
SELECT l_linestatus, count(*) AS n, round(avg(p), 4) AS mean_prediction, round(max(p), 3) AS highest
FROM f JOIN reg_view USING (row_id) GROUP BY 1"""


def _scored_summary(scored):
    return scored.groupBy("l_linestatus").agg(
        F.count("*").alias("n"),
        rounded(F.avg("prediction"), 4).alias("mean_prediction"),
        rounded(F.max("prediction"), 3).alias("highest"),
    )


@query("i1_score_raw_rows", _SCORED)
def score_raw_rows(spark, sf):
    """Raw order lines through a pipeline that was stored and read back."""
    rows, _, root = _stored_linear(spark, sf)
    rows.unpersist()
    file = store.load_index(spark, root, "regression").first()["file"]
    return _scored_summary(store.load_model(root, file).transform(table(spark, sf, "lineitem")))


@query(
    "a8_m5_stored_model",
    """SELECT 'regression: reloaded pipeline predicts identically' AS "check", 'PASS' AS status,
    count(*) || ' rows' AS detail FROM lineitem""",
)
def stored_model(spark, sf):
    rows, model, root = _stored_linear(spark, sf)
    file = store.load_index(spark, root, "regression").first()["file"]
    first = model.transform(rows).select("row_id", F.col("prediction").alias("a"))
    again = store.load_model(root, file).transform(rows).select("row_id", F.col("prediction").alias("b"))
    both = first.join(again, "row_id").agg(F.count("*").alias("n"), F.max(F.abs(F.col("a") - F.col("b"))).alias("d"))
    return checks.spread(
        both,
        [
            checks.verdict(
                "regression: reloaded pipeline predicts identically",
                F.col("d") == 0,
                checks.FAIL,
                F.concat(F.col("n").cast("string"), F.lit(" rows")),
            )
        ],
    )


@query(
    "m4_recomputed_metric",
    """SELECT 'regression: stored R2 reproduces' AS "check", 'PASS' AS status""",
)
def recomputed_metric(spark, sf):
    rows, fitted = _fit_reg(spark, sf, models.LINEAR)
    inputs = models.Inputs((), (), "net_price")
    stored = metrics.regression_metrics(models.predictions(fitted, _test(rows), inputs))
    path = scratch_path(spark, "stored")
    stored.write.parquet(path)
    with models.FittingRoom(_train(rows), models.Inputs(contracts.NET_PRICE.numeric, contracts.NET_PRICE.categorical, "net_price")) as room:
        fresh = {models.LINEAR: room.fit(models.regressors()[models.LINEAR])}
    again = metrics.regression_metrics(models.predictions(fresh, _test(rows), inputs)).select(
        "model", F.col("R2").alias("again")
    )
    both = spark.read.parquet(path).join(again, "model")
    ok = F.max(F.abs(F.col("R2") - F.col("again"))) < 1e-9
    return both.agg(ok.alias("ok")).select(
        F.lit("regression: stored R2 reproduces").alias("check"),
        F.when(F.col("ok"), checks.PASS).otherwise(checks.FAIL).alias("status"),
    )


@query("i8_stream_scoring", _SCORED)
def stream_scoring(spark, sf):
    """The same rows as a stream: read, scored by the stored pipeline, appended, read back."""
    rows, _, root = _stored_linear(spark, sf)
    rows.unpersist()
    file = store.load_index(spark, root, "regression").first()["file"]
    schema = table(spark, sf, "lineitem").schema
    feed = row_stream(spark, sf, schema, "lineitem.parquet")
    sink = scratch_path(spark, "scored")
    running = score_stream(
        feed, store.load_model(root, file), sink, scratch_path(spark, "stream"), ["l_orderkey", "l_linestatus"]
    )
    running.awaitTermination()
    return _scored_summary(spark.read.parquet(sink))
