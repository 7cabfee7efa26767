"""Working tables derived from the given Parquet tables, as DataFrames and as SQL.

The SQL texts are common table expressions for the checking engine; the DataFrames
are what the queries run on. No numeric column of the given tables predicts another,
so both targets are derived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import row_hash
from ..session import spread_out

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
REG_CATEGORICAL = ["l_linestatus"]
REG_TARGET = "net_price"
CLF_CATEGORICAL = ["l_returnflag"]
CLF_TARGET = "overload"

_KEYS = """md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
    year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)))"""
_NET = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
_HEAVY = "(l_extendedprice > 90000 AND l_quantity >= 40)"
_REASON = f"""CASE WHEN NOT {_HEAVY} THEN 'none'
    WHEN l_quantity >= 48 THEN 'size' ELSE 'price' END"""
_SCORE = "l_extendedprice / 105000 * l_quantity / 50"

# Each working table: (source, projected expressions). The same text runs in both engines.
_SPECS: dict[str, tuple[str, list[str]]] = {
    "li_view": ("lineitem", ["*", f"{_KEYS} AS row_id"]),
    "reg_view": (
        "li_view",
        ["row_id", *NUMERIC, "l_linestatus", f"{_NET} AS net_price"],
    ),
    "clf_view": (
        "li_view",
        [
            "row_id",
            "l_orderkey",
            "l_partkey",
            *NUMERIC,
            "l_returnflag",
            f"CASE WHEN {_HEAVY} THEN 1 ELSE 0 END AS overload",
            f"{_REASON} AS overload_reason",
        ],
    ),
    "dup_view": (
        "lineitem",
        ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"],
    ),
    "dup_rows": (
        "li_view",
        ["row_id", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"],
    ),
    "null_view": (
        "li_view",
        [
            "row_id",
            "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS l_quantity",
            "l_extendedprice",
            "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag",
            "l_linestatus",
        ],
    ),
    "reg_pred": (
        "reg_view",
        ["row_id", "net_price AS y", "l_extendedprice * 0.95 + 10 * l_quantity AS p"],
    ),
    "clf_pred": (
        "clf_view",
        [
            "row_id",
            "overload AS y",
            f"round({_SCORE}, 3) AS score",
            f"CASE WHEN {_SCORE} > 0.75 THEN 1 ELSE 0 END AS p",
        ],
    ),
}

# Three fixed pricing rules and three fixed overload rules stand in for fitted
# models where a check needs predictions that any engine can reproduce.
PRICE_RULES = {
    "flat": "l_extendedprice",
    "mean_rate": "l_extendedprice * 0.9880",
    "discounted": "l_extendedprice * (1 - l_discount)",
}
RISK_RULES = {
    "price_only": "round(l_extendedprice / 105000, 3)",
    "quantity_only": "round(l_quantity / 50, 2)",
    "product": f"round({_SCORE}, 3)",
}
RISK_CUT = 0.75


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; one of few splits is spread over the cores by its key column."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_out(df, df.columns[0])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in _SPECS:
        return table(spark, sf_dir, name)
    source, exprs = _SPECS[name]
    return view(spark, sf_dir, source).selectExpr(*exprs)


def cte(*names: str) -> str:
    """``WITH ...`` text defining the named working tables and what they need."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in _SPECS and name not in order:
            need(_SPECS[name][0])
            order.append(name)

    for n in names:
        need(n)
    parts = [
        f"{n} AS (SELECT {', '.join(_SPECS[n][1])} FROM {_SPECS[n][0]})" for n in order
    ]
    return "WITH " + ",\n".join(parts)


def price_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, row_id, y, p) for every pricing rule."""
    rules = [
        F.struct(F.lit(m).alias("model"), F.expr(e).alias("p")) for m, e in PRICE_RULES.items()
    ]
    return (
        view(spark, sf_dir, "reg_view")
        .withColumn("_m", F.explode(F.array(*rules)))
        .select("_m.model", "row_id", F.col("net_price").alias("y"), "_m.p")
    )


def risk_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, row_id, y, p, score) for every overload rule."""
    rules = [
        F.struct(F.lit(m).alias("model"), F.expr(e).alias("score"))
        for m, e in RISK_RULES.items()
    ]
    return (
        view(spark, sf_dir, "clf_view")
        .withColumn("_m", F.explode(F.array(*rules)))
        .select(
            "_m.model",
            "row_id",
            F.col("overload").alias("y"),
            (F.col("_m.score") > RISK_CUT).cast("int").alias("p"),
            "_m.score",
        )
    )


def price_predictions_sql() -> str:
    parts = [
        f"SELECT '{m}' AS model, row_id, net_price AS y, {e} AS p FROM reg_view"
        for m, e in PRICE_RULES.items()
    ]
    return "price_pred AS (" + "\nUNION ALL ".join(parts) + ")"


def risk_predictions_sql() -> str:
    parts = [
        f"SELECT '{m}' AS model, row_id, overload AS y, {e} AS score FROM clf_view"
        for m, e in RISK_RULES.items()
    ]
    return (
        "risk_pred AS (SELECT *, CASE WHEN score > 0.75 THEN 1 ELSE 0 END AS p FROM ("
        + "\nUNION ALL ".join(parts)
        + "))"
    )


def split_hash():
    """The digest the hold-out split and the folds of the fixtures order rows by."""
    return row_hash("row_id")


SPLIT_HASH_SQL = "md5('42|' || row_id)"
