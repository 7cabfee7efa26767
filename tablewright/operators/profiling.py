"""Column audit, dataset summary, duplicates and description of a table.

Per-column statistics come from one frequency table, (column, value, count): values
are counted before the shuffle, and the distinct count, the most frequent value and
the non-null count are read from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import col, dtype_name, known, melt, numeric_columns
from ..functions.order_stats import quantile_columns
from ..session import local_table

# More distinct target values than this are described, not counted.
TARGET_VALUES = 20


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as string, n) over non-null cells."""
    cells = melt(df, columns, cast="string").where(F.col("value").isNotNull())
    return cells.groupBy("column", "value").agg(F.count("*").alias("n"))


def column_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, column, dtype): one row per column, from the schema."""
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = [(i, c, dtype_name(types[c])) for i, c in enumerate(columns)]
    return local_table(df.sparkSession, rows, "position int, column string, dtype string")


def audit(df: DataFrame, row_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(position, column, dtype, missing, missing_pct, n_unique, example).

    ``example`` is the first non-null value in ``row_id`` order.
    """
    columns = list(columns) if columns else [c for c in df.columns if c != row_id]
    # aggregates of the whole table, column by column: no cell is grouped, sorted or moved
    found = []
    for c in columns:
        value = known(df, c).cast("string")
        found.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count("*").alias("_n"),
                F.count_if(value.isNull()).alias("missing"),
                F.min_by(value, F.when(value.isNotNull(), col(row_id))).alias("example"),
            )
        )
    rows = df.agg(F.array(*found).alias("_found")).select(F.explode("_found").alias("_f")).select("_f.*").where("_n > 0")
    unique = frequencies(df, columns).groupBy("column").agg(F.count("*").alias("n_unique"))
    return (
        column_table(df, columns)
        .join(rows, "column", "left")
        .join(unique, "column", "left")
        .select(
            "position",
            "column",
            "dtype",
            F.coalesce("missing", F.lit(0)).alias("missing"),
            F.round(100 * F.col("missing") / F.col("_n"), 3).alias("missing_pct"),
            F.coalesce("n_unique", F.lit(0)).alias("n_unique"),
            "example",
        )
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(rows, duplicate_rows): rows beyond the first of each distinct row."""
    columns = list(columns) if columns else df.columns
    groups = df.groupBy(*[col(c) for c in columns]).agg(F.count("*").alias("_c"))
    return groups.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def drop_duplicates(df: DataFrame, columns: Sequence[str], row_id: str) -> DataFrame:
    """The first row in ``row_id`` order of every distinct tuple of ``columns``.

    ``min_by`` is a partial aggregate: copies collapse before the shuffle, where a
    row_number window would send all copies of a hot row to one task.
    """
    rest = [c for c in df.columns if c not in columns and c != row_id]
    picked = F.min(F.struct(col(row_id), *[col(c) for c in rest])).alias("_first")
    return df.groupBy(*[col(c) for c in columns]).agg(picked).select(
        F.col("_first")[row_id].alias(row_id),
        *[col(c) for c in columns],
        *[F.col("_first")[c].alias(c) for c in rest],
    ).select(*[col(c) for c in df.columns])


def duplicate_policy(df: DataFrame, columns: Sequence[str], preferred: int = 10_000) -> DataFrame:
    """Duplicates counted and kept; says whether dropping them would leave too few rows."""
    found = duplicate_rows(df, columns)
    left = F.col("rows") - F.col("duplicate_rows")
    return found.select(
        F.col("rows").alias("prepared_rows"),
        F.col("duplicate_rows").alias("exact_duplicate_rows"),
        left.alias("rows_after_dedup"),
        F.lit(preferred).cast("long").alias("size_preference_min_rows"),
        (left < preferred).alias("conflict"),
    )


def summary(df: DataFrame, target: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, cols, duplicate rows, missing cells, column list, target present."""
    columns = list(columns) if columns else df.columns
    # Missing cells per distinct row times its copies: one shuffle serves both counts.
    holes = F.lit(0)
    for c in columns:
        holes = holes + F.when(known(df, c).isNull(), 1).otherwise(0)
    groups = df.groupBy(*[col(c) for c in columns]).agg(F.count("*").alias("_c"), F.first(holes).alias("_holes"))
    return groups.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).alias("rows"),
        F.lit(len(columns)).alias("cols"),
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("_holes").cast("long") * F.col("_c")), F.lit(0)).alias("missing_cells"),
        F.lit(",".join(columns)).alias("columns"),
        F.lit(bool(target and target in columns)).alias("target_present"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(known(df, column).isNotNull()).groupBy(col(column).alias("value")).agg(
        F.count("*").alias("count")
    )


def numeric_description(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max) with exact quartiles."""
    base = melt(df, columns).groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantile_columns(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return base.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def distinct_up_to(df: DataFrame, column: str, limit: int) -> int:
    """The distinct count if it is at most ``limit``, else a number above it.

    A sketch rules out the clear cases, so a column of billions of values is never
    shuffled to learn that it has many.
    """
    guess = df.agg(F.approx_count_distinct(col(column), 0.05)).first()[0]
    if guess > 4 * limit:
        return guess
    return df.agg(F.countDistinct(col(column))).first()[0]


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """Counts per value for a target with few values, else its numeric description."""
    if distinct_up_to(df, target, TARGET_VALUES) <= TARGET_VALUES:
        return value_counts(df, target)
    return numeric_description(df, [target])


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every column described: counts for all, top value for text, moments for numbers."""
    columns = list(columns) if columns else df.columns
    numbers = [c for c in numeric_columns(df) if c in columns]
    texts = [c for c in columns if c not in numbers]
    parts = []
    if texts:
        parts.append(
            frequencies(df, texts)
            .groupBy("column")
            .agg(
                F.sum("n").alias("count"),
                F.count("*").alias("unique"),
                F.min(F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("_t"),
            )
            .select(
                "column", "count", "unique", F.col("_t.v").alias("top"), (-F.col("_t.k")).alias("freq")
            )
        )
    if numbers:
        parts.append(numeric_description(df, numbers))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    wanted = {
        "column": "string", "count": "long", "unique": "long", "top": "string", "freq": "long",
        "mean": "double", "std": "double", "min": "double", "p25": "double", "p50": "double",
        "p75": "double", "max": "double",
    }
    return out.select(
        *[
            (F.col(c) if c in out.columns else F.lit(None)).cast(t).alias(c)
            for c, t in wanted.items()
        ]
    )


def cross_tabulation(df: DataFrame, rows: str, classes: str, values: Sequence) -> DataFrame:
    """(rows, <one count per class value>), 0 where a pair never occurs."""
    wide = df.groupBy(col(rows).alias(rows)).pivot(classes, list(values)).agg(F.count(F.lit(1)))
    return wide.select(
        col(rows), *[F.coalesce(col(str(v)), F.lit(0)).alias(f"{classes}_{v}") for v in values]
    )


def input_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(rows, possible): the product of the columns' distinct counts against the rows drawn.

    The product is a double, since it soon exceeds a 64-bit integer.
    """
    unique = frequencies(df, columns).groupBy("column").agg(
        F.count("*").alias("u"), F.sum("n").alias("n")
    )
    product = F.aggregate(
        F.array_sort(F.collect_list(F.col("u").cast("double"))),
        F.lit(1.0),
        lambda acc, u: acc * u,
    )
    return unique.agg(product.alias("possible")).withColumn(
        "rows", df.agg(F.count("*").alias("n")).scalar()
    )


def quartiles(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return quantile_columns(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)


