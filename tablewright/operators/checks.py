"""Validation jobs: rules over tables and result tables, as (check, status, detail) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.contracts import DatasetSpec, exclusion_report, prepare

# The statuses of a check and the preferred size of a prepared table.
PASS, FAIL, WARN, TODO = "PASS", "FAIL", "WARN", "TODO"
COLUMN_RANGE = (6, 9)
PREFERRED_ROWS = 10_000
AUC_SOURCES = ("predict_proba", "decision_function")


def verdict(name: str, ok: Column, otherwise: str, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.when(ok, PASS).otherwise(otherwise).alias("status"),
        detail.cast("string").alias("detail"),
    )


def spread(one_row: DataFrame, verdicts: Sequence[Column]) -> DataFrame:
    """A one-row aggregate turned into one row per check."""
    return one_row.select(F.explode(F.array(*verdicts)).alias("_v")).select("_v.*")


def range_rules(prepared: DataFrame, prefix: str = "") -> DataFrame:
    width = len(prepared.columns)
    lo, hi = COLUMN_RANGE
    return spread(
        prepared.agg(F.count("*").alias("n")),
        [
            verdict(
                f"{prefix}prepared columns in {lo}-{hi} range",
                F.lit(lo <= width <= hi),
                WARN,
                F.lit(f"{width} columns"),
            ),
            verdict(
                f"{prefix}prepared rows >= {PREFERRED_ROWS}",
                F.col("n") >= PREFERRED_ROWS,
                WARN,
                F.concat(F.col("n").cast("string"), F.lit(" rows")),
            ),
        ],
    )


def data_checks(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Shape, size, leakage and identifier rules of one dataset."""
    rows, cols = spec.expected_shape
    width = len(raw.columns)
    shape = spread(
        raw.agg(F.count("*").alias("n")),
        [
            verdict(
                f"{spec.track}: raw shape",
                (F.col("n") == rows) & F.lit(width == cols),
                FAIL,
                F.format_string(f"(%d, {width}) expected ({rows}, {cols})", "n"),
            )
        ],
    )
    prepared = prepare(raw, spec)
    hidden = exclusion_report(raw, prepared, spec).select(
        F.concat(F.lit(f"{spec.track}: "), "column_name", F.lit(" excluded")).alias("check"),
        F.when(F.col("excluded"), PASS).otherwise(FAIL).alias("status"),
        F.col("reason").alias("detail"),
    )
    return shape.unionByName(range_rules(prepared, f"{spec.track}: ")).unionByName(hidden)


def result_table_checks(
    table: DataFrame, expected_rows: int, rank_metric: str, required: Sequence[str], label: str
) -> DataFrame:
    """Row count, rank order, required columns, score source and no missing AUC.

    A result table holds one row per model, so its ordering window is tiny.
    """
    order = Window.partitionBy(F.lit(1)).orderBy("rank")
    steps = table.withColumn("_prev", F.lag(rank_metric).over(order))
    aggs = [
        F.count("*").alias("n"),
        F.count_if(F.col(rank_metric) > F.col("_prev")).alias("rises"),
    ]
    has_auc = "ROC_AUC" in table.columns and "AUC_source" in table.columns
    if has_auc:
        aggs += [
            F.count_if(~F.coalesce(F.col("AUC_source").isin(*AUC_SOURCES), F.lit(False))).alias("bad_source"),
            F.count_if(F.col("ROC_AUC").isNull() | F.isnan("ROC_AUC")).alias("no_auc"),
        ]
    checks = [
        verdict(
            f"{label}: {expected_rows} rows in comparison table",
            F.col("n") == expected_rows,
            FAIL,
            F.concat(F.col("n").cast("string"), F.lit(" rows")),
        ),
        verdict(
            f"{label}: ranked by {rank_metric} descending",
            F.col("rises") == 0,
            FAIL,
            F.concat(F.col("rises").cast("string"), F.lit(" rises")),
        ),
        *[
            verdict(f"{label}: {c} column present", F.lit(c in table.columns), FAIL, F.lit(""))
            for c in required
        ],
    ]
    if has_auc:
        checks += [
            verdict(f"{label}: ROC-AUC from scores", F.col("bad_source") == 0, FAIL, F.lit("")),
            verdict(f"{label}: no missing ROC-AUC", F.col("no_auc") == 0, FAIL, F.lit("")),
        ]
    return spread(steps.agg(*aggs), checks)


def tuning_outcome(tuning: DataFrame, label: str) -> DataFrame:
    """How many tuned models improved on cross-validation: always reported as measured."""
    better = F.count_if(F.col("improved_on_CV"))
    return tuning.agg(better.alias("b"), F.count("*").alias("n")).select(
        F.lit(f"{label} tuning reports real outcomes").alias("check"),
        F.lit(PASS).alias("status"),
        F.format_string("%d/%d models improved on CV", "b", "n").alias("detail"),
    )


def report(checks: DataFrame) -> DataFrame:
    """One row: counts by status and the overall verdict."""
    counts = [
        F.count_if(F.col("status") == s).alias(n)
        for s, n in ((PASS, "n_pass"), (FAIL, "n_fail"), (WARN, "n_warn"), (TODO, "n_todo"))
    ]
    overall = (
        F.when(F.col("n_fail") > 0, "FAILING CHECKS PRESENT")
        .when(F.col("n_todo") > 0, "COMPLETE, ITEMS AWAITING INPUT")
        .otherwise("ALL CHECKS PASS")
    )
    return checks.agg(*counts).withColumn("verdict", overall)
