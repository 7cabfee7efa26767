"""Dataset contracts: what a table must look like and which columns a model may see."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col
from ..session import local_table


class MissingColumns(KeyError):
    """A table lacks columns its contract requires."""


@dataclass(frozen=True)
class DatasetSpec:
    track: str
    name: str
    filename: str
    target: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    expected_shape: tuple[int, int]
    schema: T.StructType | None = None
    url: str = ""
    identifiers: tuple[str, ...] = ()
    leakage: tuple[str, ...] = ()
    positive_class: int | None = None
    classes: Mapping[int, str] = field(default_factory=dict)
    synthetic: bool = True

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def kept(self) -> list[str]:
        return [*self.features, self.target]

    @property
    def excluded(self) -> list[str]:
        return [*self.identifiers, *self.leakage]


def _schema(**columns: str) -> T.StructType:
    kinds = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in columns.items()])


# The two published datasets a scored table must match.
STUDENT_PERFORMANCE = DatasetSpec(
    track="regression",
    name="Student Performance (Multiple Linear Regression)",
    filename="Student_Performance.csv",
    url="https://www.kaggle.com/datasets/nikhil7280/student-performance-multiple-linear-regression",
    target="Performance Index",
    numeric=("Hours Studied", "Previous Scores", "Sleep Hours", "Sample Question Papers Practiced"),
    categorical=("Extracurricular Activities",),
    expected_shape=(10000, 6),
    schema=_schema(
        **{
            "Hours Studied": "long",
            "Previous Scores": "long",
            "Extracurricular Activities": "string",
            "Sleep Hours": "long",
            "Sample Question Papers Practiced": "long",
            "Performance Index": "double",
        }
    ),
)

PREDICTIVE_MAINTENANCE = DatasetSpec(
    track="classification",
    name="Machine Predictive Maintenance Classification",
    filename="predictive_maintenance.csv",
    url="https://www.kaggle.com/datasets/shivamb/machine-predictive-maintenance-classification",
    target="Target",
    numeric=(
        "Air temperature [K]",
        "Process temperature [K]",
        "Rotational speed [rpm]",
        "Torque [Nm]",
        "Tool wear [min]",
    ),
    categorical=("Type",),
    expected_shape=(10000, 10),
    identifiers=("UDI", "Product ID"),
    leakage=("Failure Type",),
    positive_class=1,
    classes={0: "No Failure", 1: "Failure"},
    schema=_schema(
        **{
            "UDI": "long",
            "Product ID": "string",
            "Type": "string",
            "Air temperature [K]": "double",
            "Process temperature [K]": "double",
            "Rotational speed [rpm]": "long",
            "Torque [Nm]": "double",
            "Tool wear [min]": "long",
            "Target": "long",
            "Failure Type": "string",
        }
    ),
)

DATASETS: dict[str, DatasetSpec] = {
    s.track: s for s in (STUDENT_PERFORMANCE, PREDICTIVE_MAINTENANCE)
}

# The same two roles on the given order-line table.
NET_PRICE = DatasetSpec(
    track="regression",
    name="Net price of an order line",
    filename="lineitem.parquet",
    target="net_price",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_linestatus",),
    expected_shape=(60000, 7),
    identifiers=("row_id",),
)

OVERLOAD = DatasetSpec(
    track="classification",
    name="Overload of an order line",
    filename="lineitem.parquet",
    target="overload",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_returnflag",),
    expected_shape=(60000, 10),
    identifiers=("l_orderkey", "l_partkey"),
    leakage=("overload_reason",),
    positive_class=1,
    classes={0: "No Failure", 1: "Failure"},
)


def require_columns(df: DataFrame, needed: list[str], track: str = "") -> None:
    absent = [c for c in needed if c not in df.columns]
    if absent:
        raise MissingColumns(f"{track}: columns absent from the table: {absent}")


def prepare(df: DataFrame, spec: DatasetSpec, row_id: str | None = None) -> DataFrame:
    """Numeric, categorical and target columns in that order; duplicates are kept.

    ``row_id`` may ride along as the key of splits; it is never a feature.
    """
    require_columns(df, spec.kept, spec.track)
    carried = [row_id] if row_id else []
    return df.select(*[col(c) for c in [*carried, *spec.kept]])


def excluded_from(df: DataFrame, spec: DatasetSpec) -> list[str]:
    return [c for c in df.columns if c not in spec.kept]


def exclusion_report(raw: DataFrame, prepared: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(column_name, reason, excluded) for every leakage and identifier column of ``raw``."""
    reasons = [(c, "leakage") for c in spec.leakage] + [(c, "identifier") for c in spec.identifiers]
    rows = [(c, why, c not in prepared.columns) for c, why in reasons if c in raw.columns]
    return local_table(raw.sparkSession, rows, "column_name string, reason string, excluded boolean")


def exclusion_facts(raw: DataFrame, prepared: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The exclusion report with what the data says of each column: (..., present,
    distinct_values, decides_target). A column decides the target if no value of it goes
    with two targets. One aggregation by value for each excluded column."""
    target, parts = col(spec.target), []
    for row in exclusion_report(raw, prepared, spec).collect():  # one row per named column
        value = col(row["column_name"])
        single = (F.min(target) == F.max(target)).alias("single")
        per = raw.where(value.isNotNull()).groupBy(value).agg(F.count("*").alias("n"), single)
        parts.append(
            per.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("present"),
                F.count("*").alias("distinct_values"),
                F.coalesce(F.every("single"), F.lit(True)).alias("decides_target"),
            ).select(
                F.lit(row["column_name"]).alias("column_name"),
                F.lit(row["reason"]).alias("reason"),
                F.lit(row["excluded"]).alias("excluded"),
                "present",
                "distinct_values",
                "decides_target",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def shape_report(df: DataFrame, dataset: str, expected: tuple[int, int]) -> DataFrame:
    """Actual against expected shape: reported, never corrected."""
    cols = len(df.columns)
    same = (F.col("rows") == expected[0]) & F.lit(cols == expected[1])
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(dataset).alias("dataset"),
        "rows",
        F.lit(cols).alias("cols"),
        F.lit(expected[0]).alias("expected_rows"),
        F.lit(expected[1]).alias("expected_cols"),
        same.alias("matches"),
    )
