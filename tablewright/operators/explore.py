"""The tables behind the exploratory figures: distributions, correlations, classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import SEED, col, melt, pearson, row_hash, unit_interval
from ..functions.order_stats import quantile_columns
from ..session import local_table
from .profiling import distinct_up_to, quartiles

# A numeric column with more distinct values than this is binned, and a
# density curve has this many points over bins this fine.
FEW_VALUES = 10
GRID_POINTS = 200
FINE_BINS = 1024
# More empty bins in a row than this are one row of a histogram.
EMPTY_RUN = 1000


def _ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return melt(df, columns).where(F.col("value").isNotNull()).groupBy("column").agg(
        F.count("*").alias("n"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.stddev_samp("value").alias("sd"),
    )


def _binned(df: DataFrame, columns: Sequence[str], ranges: DataFrame) -> DataFrame:
    """(column, bin, count) for ``ranges`` holding (column, lo, hi, bins): map-side counts."""
    cells = melt(df, columns).where(F.col("value").isNotNull())
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    place = F.floor(F.try_divide(F.col("value") - F.col("lo"), width))
    return (
        cells.join(F.broadcast(ranges), "column")
        .withColumn("bin", F.least(F.coalesce(place, F.lit(0)), F.col("bins") - 1).cast("long"))
        .groupBy("column", "bin")
        .agg(F.count("*").alias("count"))
    )


def bin_counts(df: DataFrame, columns: Sequence[str], bins: int | str = "auto") -> DataFrame:
    """(column, n, lo, hi, sd, bins). 'auto' takes the narrower of the Sturges and the
    Freedman-Diaconis widths, and at least 1 for whole-number columns."""
    ranges = _ranges(df, columns)
    if bins != "auto":
        return ranges.withColumn("bins", F.lit(int(bins)).cast("long"))
    whole = [
        f.name
        for f in df.schema.fields
        if f.name in columns and f.dataType.typeName() in ("byte", "short", "integer", "long")
    ]
    spread = quantile_columns(df, columns, {"q1": 0.25, "q3": 0.75})
    span = F.col("hi") - F.col("lo")
    sturges = span / (F.log2("n") + 1)
    fd = 2 * (F.col("q3") - F.col("q1")) / F.pow(F.col("n").cast("double"), F.lit(1 / 3))
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    width = F.when(F.col("column").isin(whole or [""]), F.greatest(width, F.lit(1.0))).otherwise(width)
    count = F.ceil(F.try_divide(span, width))
    return ranges.join(F.broadcast(spread), "column").select(
        "column", "n", "lo", "hi", "sd",
        F.when(span == 0, 1).otherwise(F.greatest(count, F.lit(1))).cast("long").alias("bins"),
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int | str = "auto") -> DataFrame:
    """(column, bin, lower, upper, count), empty bins included, last bin closed.

    Between occupied bins, empty ones are listed one by one up to EMPTY_RUN of them; a longer
    run, as an outlier leaves, is one row from its first bin to its last.
    """
    plan = bin_counts(df, columns, bins)
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    counts = _binned(df, columns, plan)
    order = Window.partitionBy("column").orderBy("bin")
    # the first and the last bin of a column are occupied, by its least and greatest value
    gap = F.coalesce(F.lead("bin").over(order) - F.col("bin") - 1, F.lit(0))
    cell = lambda first, last, n: F.struct(first.alias("bin"), last.alias("last"), n.alias("count"))
    after, zero = F.col("bin") + 1, F.lit(0).cast("long")
    one_by_one = F.transform(F.sequence(after, F.col("bin") + F.col("gap")), lambda b: cell(b, b, zero))
    empty = (
        F.when(F.col("gap") == 0, F.array().cast("array<struct<bin:bigint,last:bigint,count:bigint>>"))
        .when(F.col("gap") > EMPTY_RUN, F.array(cell(after, F.col("bin") + F.col("gap"), zero)))
        .otherwise(one_by_one)
    )
    own = F.array(cell(F.col("bin"), F.col("bin"), F.col("count")))
    cells = counts.withColumn("gap", gap).select("column", F.explode(F.concat(own, empty)).alias("_c"))
    return cells.select("column", "_c.*").join(F.broadcast(plan), "column").select(
        "column",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("last") + 1) * width).alias("upper"),
        "count",
    )


def density(
    df: DataFrame, columns: Sequence[str], points: int = GRID_POINTS, fine: int = FINE_BINS
) -> DataFrame:
    """(column, point, x, density): Gaussian kernel estimate with Scott's bandwidth.

    Rows are first counted in ``fine`` bins, so the kernel is summed over bins x
    points values whatever the table's size.
    """
    plan = bin_counts(df, columns, fine)
    span = F.col("hi") - F.col("lo")
    centre = F.col("lo") + (F.col("bin") + 0.5) * span / F.lit(fine)
    x = F.col("lo") + F.col("point") * span / F.lit(points - 1)
    z = F.try_divide(F.col("x") - F.col("centre"), F.col("h"))
    return (
        _binned(df, columns, plan)
        .join(F.broadcast(plan), "column")
        .withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
        .withColumn("centre", centre)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .groupBy("column", "point", "x", "n", "h")
        .agg(F.sum(F.col("count") * F.exp(-0.5 * z * z)).alias("_s"))
        .select(
            "column",
            "point",
            "x",
            F.try_divide(F.col("_s"), F.col("n") * F.col("h") * F.sqrt(2 * F.pi())).alias("density"),
        )
    )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count, position): values ordered as text."""
    counts = (
        melt(df, columns, cast="string")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("count"))
    )
    return counts


def split_by_cardinality(
    df: DataFrame, columns: Sequence[str], few: int = FEW_VALUES
) -> tuple[list[str], list[str]]:
    """Columns to bin (numeric with many values) and columns to count per value."""
    from ..functions.exprs import numeric_columns

    numbers = set(numeric_columns(df))
    binned = [c for c in columns if c in numbers and distinct_up_to(df, c, few) > few]
    return binned, [c for c in columns if c not in binned]


def distributions(
    df: DataFrame, columns: Sequence[str], bins: int | str = "auto"
) -> DataFrame:
    """(column, kind, label, lower, upper, count) for every column."""
    binned, counted = split_by_cardinality(df, columns)
    parts = []
    if binned:
        parts.append(
            histogram(df, binned, bins).select(
                "column",
                F.lit("histogram").alias("kind"),
                F.col("bin").cast("string").alias("label"),
                "lower",
                "upper",
                "count",
            )
        )
    if counted:
        none = F.lit(None).cast("double")
        parts.append(
            category_counts(df, counted).select(
                "column",
                F.lit("count").alias("kind"),
                F.col("value").alias("label"),
                none.alias("lower"),
                none.alias("upper"),
                "count",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for every ordered pair, over the rows where both are present.

    One pass takes a deviation per column and a covariance per pair; only pairs that
    lose rows to NULLs need their own deviations, in a second pass.
    """
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    x = {c: col(c).cast("double") for c in columns}
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.stddev_pop(x[c]).alias(f"s{i}"), F.count(x[c]).alias(f"n{i}")]
    for i, (a, b) in enumerate(pairs):
        aggs.append(F.covar_pop(x[a], x[b]).alias(f"c{i}"))
    total = F.count(F.lit(1)).alias("n")
    row = df.agg(total, *aggs).first()
    whole = {c for i, c in enumerate(columns) if row[f"n{i}"] == row["n"]}
    spread = {c: row[f"s{i}"] for i, c in enumerate(columns)}
    found: dict[tuple[str, str], float | None] = {}
    for i, (a, b) in enumerate(pairs):
        if a in whole and b in whole:
            scale = (spread[a] or 0.0) * (spread[b] or 0.0)
            found[a, b] = row[f"c{i}"] / scale if scale else None
    partial = [p for p in pairs if p not in found]
    if partial:
        own = df.agg(*[pearson(x[a], x[b]).alias(f"r{i}") for i, (a, b) in enumerate(partial)]).first()
        found.update({p: own[f"r{i}"] for i, p in enumerate(partial)})
    rows = [(a, b, r) for (a, b), r in found.items()]
    rows += [(b, a, r) for a, b, r in rows if a != b]
    return local_table(df.sparkSession, rows, "a string, b string, r double")


def correlation_matrix_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same for hundreds of columns without nulls: MLlib's one-pass Gram matrix."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    packed = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(df).select("_v")
    matrix = Correlation.corr(packed, "_v").first()[0].toArray()
    rows = [
        (a, b, float(matrix[i, j]) if matrix[i, j] == matrix[i, j] else None)
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return local_table(df.sparkSession, rows, "a string, b string, r double")


def strongest_pairs(matrix: DataFrame, k: int) -> DataFrame:
    """The k pairs of different columns with the largest |r|, each pair once."""
    return (
        matrix.where(F.col("a") < F.col("b"))
        .orderBy(F.abs("r").desc_nulls_last(), "a", "b")
        .limit(k)
    )


def target_correlation(df: DataFrame, inputs: Sequence[str], target: str) -> DataFrame:
    """(column, r) of every input with the target: one aggregate."""
    one = df.agg(*[pearson(col(c), col(target)).alias(f"_r{i}") for i, c in enumerate(inputs)])
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"_r{i}").alias("r")) for i, c in enumerate(inputs)
    ]
    return one.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


def top_inputs(correlations: DataFrame, k: int = 2) -> DataFrame:
    return correlations.orderBy(F.abs("r").desc_nulls_last(), "column").limit(k)


def class_names(value: Column, names: Mapping) -> Column:
    """The display name of a class; its own text where it has none."""
    if not names:
        return value.cast("string")
    out = None
    for k, v in names.items():
        hit = value == F.lit(k)
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return out.otherwise(value.cast("string"))


def class_distribution(df: DataFrame, target: str, names: Mapping | None = None) -> DataFrame:
    """(class, class_name, count, share_pct)."""
    counts = df.groupBy(col(target).alias("class")).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("t")).scalar()
    return counts.select(
        "class",
        class_names(F.col("class"), names or {}).alias("class_name"),
        "count",
        F.round(100 * F.col("count") / total, 2).alias("share_pct"),
    )


def feature_target_points(
    df: DataFrame, row_id: str, features: Sequence[str], target: str, jitter: float = 0.0, seed: int = SEED
) -> DataFrame:
    """(row_id, feature, x, y): y may be spread by up to +-jitter, the same on every run."""
    noise = (2 * unit_interval(row_hash(row_id, seed=f"{seed}|jitter")) - 1) * F.lit(float(jitter))
    y = col(target).cast("double") + (noise if jitter else F.lit(0.0))
    points = df.withColumn("_y", y)
    return melt(points, features, keep=[row_id, "_y"], name="feature", value="x").select(
        col(row_id), "feature", "x", F.col("_y").alias("y")
    )


def box_statistics(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(class, column, q1, median, q3, whisker_low, whisker_high, outliers) per class."""
    boxes = quartiles(df, features, by=[target])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    cells = melt(df, features, keep=[target]).where(F.col("value").isNotNull())
    return (
        cells.join(F.broadcast(boxes), [target, "column"])
        .groupBy(col(target).alias("class"), "column", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def class_means(df: DataFrame, features: Sequence[str], target: str, classes: Sequence) -> DataFrame:
    """(feature, <one mean per class>) rounded to 3 digits."""
    wide = (
        melt(df, features, keep=[target], name="feature")
        .groupBy("feature")
        .pivot(target, list(classes))
        .agg(F.round(F.avg("value"), 3))
    )
    return wide.select("feature", *[col(str(c)).alias(f"class_{c}") for c in classes])
