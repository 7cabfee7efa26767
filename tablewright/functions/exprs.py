"""Column expressions that stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 42


def quoted(name: str) -> str:
    """A column name in back quotes, safe for names holding dots or brackets."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def row_hash(*keys: str | Column, seed: int | str = SEED) -> Column:
    """Hex digest of the seed and the keys: the same row always gets the same one."""
    parts = [col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def unit_interval(digest: Column) -> Column:
    """A digest read as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, and 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def pearson(a: Column, b: Column) -> Column:
    """Correlation over rows where both are present; NULL for a constant column.

    The built-in ``corr`` raises on a constant column in ANSI mode.
    """
    both = a.isNotNull() & b.isNotNull()
    x = F.when(both, a.cast("double"))
    y = F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def dtype_name(data_type: T.DataType) -> str:
    """The type names used in audit tables."""
    # Labels of the three types the audit table knows.
    if isinstance(data_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "int64"
    if isinstance(data_type, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float64"
    if isinstance(data_type, T.StringType):
        return "str"
    return data_type.simpleString()


def known(df: DataFrame, name: str) -> Column:
    """A column with NaN as NULL: floating-point files hold missing numbers either way."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col(name)), col(name))
    return col(name)


def melt(
    df: DataFrame,
    columns: Iterable[str],
    keep: Iterable[str] = (),
    cast: str = "double",
    name: str = "column",
    value: str = "value",
) -> DataFrame:
    """One row per (row, column), NaN as NULL: a map-side generator, no shuffle."""
    columns = list(columns)
    if not columns:
        raise ValueError("melt needs at least one column")
    pairs = [
        F.struct(F.lit(c).alias(name), known(df, c).cast(cast).alias(value)) for c in columns
    ]
    return df.select(*[col(k) for k in keep], F.explode(F.array(*pairs)).alias("_cell")).select(
        *[col(k) for k in keep], f"_cell.{name}", f"_cell.{value}"
    )


def rounded(column: Column, digits: int) -> Column:
    return F.round(column.cast("double"), digits)


def slug(name: Column) -> Column:
    """'7. Random Forest Regressor' becomes '07_random_forest_regressor'."""
    head = F.trim(F.substring_index(name, ".", 1))
    rest = F.regexp_replace(name, r"^[^.]*\.?", "")
    digits = F.regexp_replace(head, "^0+(?=[0-9])", "")
    number = F.when(
        head.rlike("^[0-9]+$"),
        F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits),
    ).otherwise(F.substring(F.regexp_replace(head, r"\W+", ""), 1, 3))
    body = F.regexp_replace(F.lower(F.trim(rest)), "[^a-z0-9]+", "_")
    return F.concat(number, F.lit("_"), F.regexp_replace(body, "^_+|_+$", ""))
