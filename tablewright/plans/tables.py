"""Queries over whole tables: projection, profiling, exploration, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import rounded
from ..operators import explore, profiling, split
from ..sources import contracts
from .fixtures import (
    CLF_TARGET,
    NUMERIC,
    REG_TARGET,
    SPLIT_HASH_SQL,
    cte,
    table,
    view,
)
from .registry import query

DUP = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
NULLABLE = ["l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------- projection, filter


@query(
    "b1_prepared_columns",
    cte("reg_view")
    + """ SELECT l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS quantity,
    round(avg(net_price), 6) AS net_price, round(avg(l_tax), 8) AS tax FROM reg_view GROUP BY 1""",
)
def prepared_columns(spark, sf):
    rows = contracts.prepare(view(spark, sf, "reg_view"), contracts.NET_PRICE)
    return rows.groupBy("l_linestatus").agg(
        F.count("*").alias("n"),
        rounded(F.sum("l_quantity"), 4).alias("quantity"),
        rounded(F.avg("net_price"), 6).alias("net_price"),
        rounded(F.avg("l_tax"), 8).alias("tax"),
    )


@query(
    "b3_excluded_columns",
    cte("clf_view")
    + " "
    + _union(
        [
            f"""SELECT '{c}' AS column_name, '{r}' AS reason, TRUE AS excluded, sum(n)::BIGINT AS present,
  count(*) AS distinct_values, bool_and(lo = hi) AS decides_target FROM (SELECT count(*) AS n,
  min(overload) AS lo, max(overload) AS hi FROM clf_view WHERE {c} IS NOT NULL GROUP BY {c})"""
            for c, r in [
                ("overload_reason", "leakage"),
                ("l_orderkey", "identifier"),
                ("l_partkey", "identifier"),
            ]
        ]
    ),
)
def excluded_columns(spark, sf):
    rows = view(spark, sf, "clf_view")
    return contracts.exclusion_facts(rows, contracts.prepare(rows, contracts.OVERLOAD), contracts.OVERLOAD)


@query(
    "b4_first_rows",
    cte("reg_view")
    + " SELECT row_id, l_quantity, round(net_price, 6) AS net_price FROM reg_view ORDER BY row_id LIMIT 5",
)
def first_rows(spark, sf):
    # a preview of five rows is the feature here
    return (
        view(spark, sf, "reg_view")
        .select("row_id", "l_quantity", rounded(F.col("net_price"), 6).alias("net_price"))
        .orderBy("row_id")
        .limit(5)
    )


@query(
    "a3_shape_contract",
    """SELECT 'lineitem' AS dataset, (SELECT count(*) FROM lineitem) AS rows, 11 AS cols,
    60000 AS expected_rows, 11 AS expected_cols, (SELECT count(*) FROM lineitem) = 60000 AS matches""",
)
def shape_contract(spark, sf):
    return contracts.shape_report(table(spark, sf, "lineitem"), "lineitem", (60000, 11))


# ------------------------------------------------------------------------ profile


def _audit_sql(columns: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, dtype) in enumerate(columns):
        parts.append(
            f"""SELECT {i} AS position, '{c}' AS "column", '{dtype}' AS dtype,
            count(*) FILTER ({c} IS NULL) AS missing,
            round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 3) AS missing_pct,
            count(DISTINCT {c}) AS n_unique,
            arg_min({c}, row_id) FILTER ({c} IS NOT NULL)::VARCHAR AS example FROM null_view"""
        )
    return cte("null_view") + " " + _union(parts)


@query(
    "c1_column_audit",
    _audit_sql(
        [
            ("l_quantity", "float64"),
            ("l_extendedprice", "float64"),
            ("l_returnflag", "str"),
            ("l_linestatus", "str"),
        ]
    ),
)
def column_audit(spark, sf):
    return profiling.audit(view(spark, sf, "null_view"), "row_id", NULLABLE)


@query(
    "c2_dataset_summary",
    cte("null_view")
    + """, g AS (SELECT l_quantity, l_extendedprice, l_returnflag, l_linestatus, count(*) AS c
      FROM null_view GROUP BY ALL)
    SELECT (SELECT count(*) FROM null_view) AS rows, 4 AS cols,
    (SELECT sum(c - 1) FROM g)::BIGINT AS duplicate_rows,
    (SELECT count(*) FILTER (l_quantity IS NULL) + count(*) FILTER (l_returnflag IS NULL)
       FROM null_view) AS missing_cells,
    'l_quantity,l_extendedprice,l_returnflag,l_linestatus' AS columns, TRUE AS target_present""",
)
def dataset_summary(spark, sf):
    return profiling.summary(view(spark, sf, "null_view"), "l_linestatus", NULLABLE)


@query(
    "c3_target_counts",
    "SELECT event_type AS value, count(*) AS count FROM events GROUP BY 1",
)
def target_counts(spark, sf):
    return profiling.target_profile(table(spark, sf, "events"), "event_type")


def _describe_sql(source: str, c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 8) AS mean,
    round(stddev_samp({c}), 8) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 8) AS p25,
    round(quantile_cont({c}, 0.5), 8) AS p50, round(quantile_cont({c}, 0.75), 8) AS p75,
    max({c}) AS max FROM {source}"""


@query("c3_target_description", _describe_sql("events", "value"))
def target_description(spark, sf):
    out = profiling.target_profile(table(spark, sf, "events"), "value")
    return out.select(
        "column", "count", "min", "max",
        *[rounded(F.col(c), 8).alias(c) for c in ("mean", "std", "p25", "p50", "p75")],
    )


@query(
    "c4_duplicate_rows",
    cte("dup_view")
    + """ SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dup_view))
    AS duplicate_rows FROM dup_view""",
)
def duplicate_rows(spark, sf):
    return profiling.duplicate_rows(view(spark, sf, "dup_view"))


def _describe_text_sql(source: str, c: str) -> str:
    nulls = ", ".join(f"NULL::DOUBLE AS {n}" for n in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    return f"""SELECT '{c}' AS "column", sum(n)::BIGINT AS count, count(*) AS "unique",
    arg_min({c}, (-n, {c})) AS top, max(n) AS freq, {nulls}
    FROM (SELECT {c}, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1)"""


def _describe_number_sql(source: str, c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS count, NULL::BIGINT AS "unique",
    NULL::VARCHAR AS top, NULL::BIGINT AS freq, round(avg({c}), 8) AS mean,
    round(stddev_samp({c}), 8) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 8) AS p25,
    round(quantile_cont({c}, 0.5), 8) AS p50, round(quantile_cont({c}, 0.75), 8) AS p75,
    max({c}) AS max FROM {source}"""


@query(
    "c5_describe_all",
    cte("null_view")
    + " "
    + _union(
        [_describe_text_sql("null_view", c) for c in ("l_returnflag", "l_linestatus")]
        + [_describe_number_sql("null_view", c) for c in ("l_quantity", "l_extendedprice")]
    ),
)
def describe_all(spark, sf):
    out = profiling.describe(view(spark, sf, "null_view"), NULLABLE)
    return out.select(
        "column", "count", "unique", "top", "freq", "min", "max",
        *[rounded(F.col(c), 8).alias(c) for c in ("mean", "std", "p25", "p50", "p75")],
    )


@query(
    "c6_drop_duplicates",
    cte("dup_rows")
    + """ SELECT min(row_id) AS row_id, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus
    FROM dup_rows GROUP BY ALL""",
)
def drop_duplicates(spark, sf):
    return profiling.drop_duplicates(view(spark, sf, "dup_rows"), DUP, "row_id")


@query(
    "c7_duplicate_policy",
    cte("dup_view")
    + """, d AS (SELECT count(*) AS u FROM (SELECT DISTINCT * FROM dup_view))
    SELECT count(*) AS prepared_rows, count(*) - max(u) AS exact_duplicate_rows,
    max(u) AS rows_after_dedup, 10000::BIGINT AS size_preference_min_rows, max(u) < 10000 AS conflict
    FROM dup_view, d""",
)
def duplicate_policy(spark, sf):
    return profiling.duplicate_policy(view(spark, sf, "dup_view"), DUP)


@query(
    "c8_leakage_crosstab",
    cte("clf_view")
    + """ SELECT overload_reason, count(*) FILTER (overload = 0) AS overload_0,
    count(*) FILTER (overload = 1) AS overload_1 FROM clf_view GROUP BY 1""",
)
def leakage_crosstab(spark, sf):
    return profiling.cross_tabulation(view(spark, sf, "clf_view"), "overload_reason", "overload", [0, 1])


@query(
    "c9_input_combinations",
    cte("dup_view")
    + " SELECT "
    + " * ".join(f"count(DISTINCT {c})::DOUBLE" for c in DUP)
    + " AS possible, count(*) AS rows FROM dup_view",
)
def input_combinations(spark, sf):
    return profiling.input_combinations(view(spark, sf, "dup_view"), DUP)


@query(
    "c10_range_rules",
    """SELECT 'prepared columns in 6-9 range' AS "check", 'PASS' AS status, '6 columns' AS detail
    UNION ALL SELECT 'prepared rows >= 10000', CASE WHEN count(*) >= 10000 THEN 'PASS' ELSE 'WARN' END,
    count(*) || ' rows' FROM lineitem""",
)
def range_rules(spark, sf):
    from ..operators import checks

    return checks.range_rules(contracts.prepare(view(spark, sf, "reg_view"), contracts.NET_PRICE))


# --------------------------------------------------------------------- exploration

_HIST = """, r AS (SELECT '{c}' AS "column", count({c}) AS n, min({c}) AS lo, max({c}) AS hi,
  quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr FROM {t}),
b AS (SELECT "column", n, lo, hi, greatest(1, ceil((hi - lo) / CASE WHEN iqr > 0
  THEN least(2 * iqr / pow(n, 1.0::DOUBLE / 3), (hi - lo) / (log2(n) + 1)) ELSE (hi - lo) / (log2(n) + 1) END))::BIGINT AS bins
  FROM r),
f AS (SELECT "column", lo, hi, bins, unnest(range(0, bins)) AS bin FROM b),
k AS (SELECT least(floor(({c} - lo) / ((hi - lo) / bins)), bins - 1)::BIGINT AS bin, count(*) AS c
  FROM {t}, b WHERE {c} IS NOT NULL GROUP BY 1)
SELECT "column", bin, round(lo + bin * ((hi - lo) / bins), 6) AS lower,
round(lo + (bin + 1) * ((hi - lo) / bins), 6) AS upper, coalesce(c, 0) AS count
FROM f LEFT JOIN k USING (bin)"""


@query("d1_histogram", "WITH z AS (SELECT 1)" + _HIST.format(c="value", t="events"))
def histogram(spark, sf):
    out = explore.histogram(table(spark, sf, "events"), ["value"])
    return out.select(
        "column", "bin", "count",
        rounded(F.col("lower"), 6).alias("lower"), rounded(F.col("upper"), 6).alias("upper"),
    )


@query(
    "d2_density_curve",
    """WITH r AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd
  FROM events),
k AS (SELECT least(floor((value - lo) / ((hi - lo) / 1024)), 1023)::BIGINT AS bin, count(*) AS c
  FROM events, r GROUP BY 1),
g AS (SELECT unnest(range(0, 200)) AS point)
SELECT 'value' AS "column", point::INTEGER AS point, round(lo + point * (hi - lo) / 199, 6) AS x,
round(sum(c * exp(-0.5 * pow((lo + point * (hi - lo) / 199 - (lo + (bin + 0.5) * (hi - lo) / 1024))
  / (sd * pow(n, -0.2::DOUBLE)), 2))) / (max(n) * max(sd * pow(n, -0.2::DOUBLE)) * sqrt(2 * pi())), 9) AS density
FROM k, g, r GROUP BY ALL""",
)
def density_curve(spark, sf):
    out = explore.density(table(spark, sf, "events"), ["value"])
    return out.select(
        "column", "point", rounded(F.col("x"), 6).alias("x"), rounded(F.col("density"), 9).alias("density")
    )


@query(
    "d1_distributions",
    cte("reg_view")
    + _HIST.format(c="l_extendedprice", t="reg_view").replace(
        'SELECT "column", bin, round', 'SELECT "column", \'histogram\' AS kind, bin::VARCHAR AS label, round'
    )
    + """ UNION ALL SELECT 'l_linestatus', 'count', l_linestatus, NULL, NULL, count(*) FROM reg_view GROUP BY 3
    UNION ALL SELECT 'l_tax', 'count', l_tax::VARCHAR, NULL, NULL, count(*) FROM reg_view GROUP BY 3""",
)
def distributions(spark, sf):
    out = explore.distributions(
        view(spark, sf, "reg_view"), ["l_extendedprice", "l_linestatus", "l_tax"]
    )
    return out.select(
        "column", "kind", "label", "count",
        rounded(F.col("lower"), 6).alias("lower"), rounded(F.col("upper"), 6).alias("upper"),
    )


@query(
    "d3_category_counts",
    cte("null_view")
    + " "
    + _union(
        [
            f"""SELECT '{c}' AS "column", {c}::VARCHAR AS value, count(*) AS count FROM null_view
            WHERE {c} IS NOT NULL GROUP BY 2"""
            for c in ("l_returnflag", "l_linestatus")
        ]
    ),
)
def category_counts(spark, sf):
    return explore.category_counts(
        view(spark, sf, "null_view"), ["l_returnflag", "l_linestatus"]
    ).orderBy("column", "value")


_CORR = [*NUMERIC, REG_TARGET]


@query(
    "d4_correlation_matrix",
    cte("reg_view")
    + " "
    + _union(
        [
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r FROM reg_view"
            for a in _CORR
            for b in _CORR
        ]
    ),
)
def correlation_matrix(spark, sf):
    out = explore.correlation_matrix(view(spark, sf, "reg_view"), _CORR)
    return out.select("a", "b", rounded(F.col("r"), 9).alias("r"))


@query(
    "d4_correlation_matrix_wide",
    cte("reg_view")
    + " "
    + _union(
        [
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r FROM reg_view"
            for a in _CORR
            for b in _CORR
        ]
    ),
)
def correlation_matrix_wide(spark, sf):
    out = explore.correlation_matrix_wide(view(spark, sf, "reg_view"), _CORR)
    return out.select("a", "b", rounded(F.col("r"), 9).alias("r"))


@query(
    "d4_strongest_pairs",
    cte("reg_view")
    + " SELECT a, b, round(r, 9) AS r FROM ("
    + _union(
        [
            f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM reg_view"
            for a in _CORR
            for b in _CORR
            if a < b
        ]
    )
    + ") ORDER BY abs(r) DESC, a, b LIMIT 3",
)
def strongest_pairs(spark, sf):
    matrix = explore.correlation_matrix(view(spark, sf, "reg_view"), _CORR)
    return explore.strongest_pairs(matrix, 3).select("a", "b", rounded(F.col("r"), 9).alias("r"))


_TARGET_R = _union(
    [
        f"SELECT '{c}' AS \"column\", corr({c}, net_price) AS r FROM reg_view" for c in NUMERIC
    ]
)


@query(
    "d5_target_correlation",
    cte("reg_view") + f' SELECT "column", round(r, 9) AS r FROM ({_TARGET_R})',
)
def target_correlation(spark, sf):
    out = explore.target_correlation(view(spark, sf, "reg_view"), NUMERIC, REG_TARGET)
    return out.select("column", rounded(F.col("r"), 9).alias("r")).orderBy(F.col("r").desc())


@query(
    "d6_top_inputs",
    cte("reg_view")
    + f' SELECT "column", round(r, 9) AS r FROM ({_TARGET_R}) ORDER BY abs(r) DESC, "column" LIMIT 2',
)
def top_inputs(spark, sf):
    out = explore.target_correlation(view(spark, sf, "reg_view"), NUMERIC, REG_TARGET)
    return explore.top_inputs(out, 2).select("column", rounded(F.col("r"), 9).alias("r"))


@query(
    "d7_class_distribution",
    cte("clf_view")
    + """ SELECT overload AS class, CASE overload WHEN 0 THEN 'No Failure' ELSE 'Failure' END AS class_name,
    count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 2)::DOUBLE AS share_pct
    FROM clf_view GROUP BY 1""",
)
def class_distribution(spark, sf):
    return explore.class_distribution(
        view(spark, sf, "clf_view"), CLF_TARGET, {0: "No Failure", 1: "Failure"}
    )


_JITTER = (
    "(2 * (('0x' || substr(md5('42|jitter|' || row_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE) - 1) * 0.08"
)


@query(
    "d8_feature_target_points",
    cte("clf_view")
    + " "
    + _union(
        [
            f"""SELECT row_id, '{c}' AS feature, {c} AS x,
            round(overload + {_JITTER}, 9) AS y FROM clf_view"""
            for c in ("l_quantity", "l_extendedprice")
        ]
    ),
)
def feature_target_points(spark, sf):
    out = explore.feature_target_points(
        view(spark, sf, "clf_view"), "row_id", ["l_quantity", "l_extendedprice"], CLF_TARGET, 0.08
    )
    return out.select("row_id", "feature", "x", rounded(F.col("y"), 9).alias("y"))


def _box_sql(c: str) -> str:
    return f"""SELECT overload AS class, '{c}' AS "column", round(q1, 6) AS q1, round(m, 6) AS median,
    round(q3, 6) AS q3, min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
    max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
    count(*) FILTER (NOT {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM clf_view JOIN (SELECT overload, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m,
    quantile_cont({c}, 0.75) AS q3 FROM clf_view GROUP BY 1) USING (overload) GROUP BY 1, 2, q1, m, q3"""


@query(
    "d9_box_statistics",
    cte("clf_view") + " " + _union([_box_sql(c) for c in ("l_quantity", "l_extendedprice", "l_discount")]),
)
def box_statistics(spark, sf):
    out = explore.box_statistics(
        view(spark, sf, "clf_view"), ["l_quantity", "l_extendedprice", "l_discount"], CLF_TARGET
    )
    return out.select(
        "class", "column", "whisker_low", "whisker_high", "outliers",
        *[rounded(F.col(c), 6).alias(c) for c in ("q1", "median", "q3")],
    )


@query(
    "d10_class_means",
    cte("clf_view")
    + " "
    + _union(
        [
            f"""SELECT '{c}' AS feature, round(avg({c}) FILTER (overload = 0), 3) AS class_0,
            round(avg({c}) FILTER (overload = 1), 3) AS class_1 FROM clf_view"""
            for c in NUMERIC
        ]
    ),
)
def class_means(spark, sf):
    return explore.class_means(view(spark, sf, "clf_view"), NUMERIC, CLF_TARGET, [0, 1])


# --------------------------------------------------------------------- splits, folds

_H = SPLIT_HASH_SQL
REG_SPLIT_SQL = f"""reg_split AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {_H})
  <= ceil(round(0.2 * count(*) OVER (), 6)) THEN 'test' ELSE 'train' END AS split FROM reg_view)"""
CLF_SPLIT_SQL = f"""clf_n AS (SELECT overload, count(*) AS c, sum(count(*)) OVER () AS n FROM clf_view GROUP BY 1),
clf_q AS (SELECT *, ceil(round(0.2 * n, 6))::BIGINT AS t FROM clf_n),
clf_b AS (SELECT *, (c * t) // n AS base, (c * t) % n AS rest FROM clf_q),
clf_t AS (SELECT overload, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, overload)
  <= t - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM clf_b),
clf_split AS (SELECT v.*, CASE WHEN row_number() OVER (PARTITION BY overload ORDER BY {_H}) <= quota
  THEN 'test' ELSE 'train' END AS split FROM clf_view v JOIN clf_t USING (overload))"""


@query("e1_hold_out", cte("reg_view") + ", " + REG_SPLIT_SQL + " SELECT row_id, split FROM reg_split")
def hold_out(spark, sf):
    return split.hold_out(view(spark, sf, "reg_view"), ["row_id"]).select("row_id", "split")


@query("e2_stratified_hold_out", cte("clf_view") + ", " + CLF_SPLIT_SQL + " SELECT row_id, overload, split FROM clf_split")
def stratified_hold_out(spark, sf):
    rows = split.hold_out(view(spark, sf, "clf_view"), ["row_id"], stratify=CLF_TARGET)
    return rows.select("row_id", "overload", "split")


_BINS = 10


@query(
    "e3_binned_hold_out",
    cte("reg_view")
    + f""", e AS (SELECT DISTINCT unnest(quantile_cont(net_price, [{', '.join(str(i / _BINS) for i in range(_BINS + 1))}])) AS edge
  FROM reg_view),
inner_edges AS (SELECT edge FROM e WHERE edge > (SELECT min(edge) FROM e) AND edge < (SELECT max(edge) FROM e)),
binned AS (SELECT row_id, count(edge) AS bin FROM reg_view LEFT JOIN inner_edges ON edge < net_price GROUP BY 1),
n AS (SELECT bin, count(*) AS c, sum(count(*)) OVER () AS n FROM binned GROUP BY 1),
b AS (SELECT *, ceil(round(0.2 * n, 6))::BIGINT AS t, (c * ceil(round(0.2 * n, 6))::BIGINT) // n AS base,
  (c * ceil(round(0.2 * n, 6))::BIGINT) % n AS rest FROM n),
q AS (SELECT bin, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, bin) <= t - sum(base) OVER ()
  THEN 1 ELSE 0 END AS quota FROM b)
SELECT row_id, bin::INTEGER AS bin, CASE WHEN row_number() OVER (PARTITION BY bin ORDER BY {_H}) <= quota
  THEN 'test' ELSE 'train' END AS split FROM binned JOIN q USING (bin)""",
)
def binned_hold_out(spark, sf):
    rows = split.hold_out_binned(view(spark, sf, "reg_view"), ["row_id"], REG_TARGET, _BINS)
    return rows.select("row_id", "bin", "split")


_TUPLE = ", ".join(DUP)


@query(
    "e4_row_overlap",
    cte("dup_rows")
    + f""", s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {_H}) <= ceil(round(0.2 * count(*) OVER (), 6))
  THEN 'test' ELSE 'train' END AS split FROM dup_rows),
t AS (SELECT s.*, EXISTS (SELECT 1 FROM s o WHERE o.split = 'train' AND o.l_quantity = s.l_quantity
  AND o.l_discount = s.l_discount AND o.l_tax = s.l_tax AND o.l_returnflag = s.l_returnflag
  AND o.l_linestatus = s.l_linestatus) AS seen FROM s WHERE split = 'test')
SELECT count(*) AS test_rows, count(*) FILTER (seen) AS test_rows_also_in_train,
round(100.0 * count(*) FILTER (seen) / count(*), 3)::DOUBLE AS pct FROM t""",
)
def row_overlap(spark, sf):
    return split.row_overlap(split.hold_out(view(spark, sf, "dup_rows"), ["row_id"]), DUP)


@query(
    "e5_positive_rate",
    cte("clf_view")
    + ", "
    + CLF_SPLIT_SQL
    + " SELECT split, count(*) AS rows, round(avg(overload), 9) AS positive_rate FROM clf_split GROUP BY 1",
)
def positive_rate(spark, sf):
    rows = split.hold_out(view(spark, sf, "clf_view"), ["row_id"], stratify=CLF_TARGET)
    out = split.positive_rate(rows, CLF_TARGET)
    return out.select("split", "rows", rounded(F.col("positive_rate"), 9).alias("positive_rate"))


def fold_sql(source: str, name: str, by: str = "", k: int = 5) -> str:
    """Contiguous folds in digest order; the first n mod k hold one row more."""
    part = f"PARTITION BY {by} " if by else ""
    return f"""{name}_r AS (SELECT *, row_number() OVER ({part}ORDER BY {_H}) - 1 AS rn,
  count(*) OVER ({part}) AS cn FROM {source}),
{name} AS (SELECT * EXCLUDE (rn, cn), CASE WHEN rn < (cn % {k}) * (cn // {k} + 1)
  THEN rn // (cn // {k} + 1) ELSE (rn - cn % {k}) // (cn // {k}) END::INTEGER AS fold FROM {name}_r)"""


@query("e6_folds", cte("reg_view") + ", " + fold_sql("reg_view", "f") + " SELECT row_id, fold FROM f")
def folds(spark, sf):
    return split.k_folds(view(spark, sf, "reg_view"), ["row_id"]).select("row_id", "fold")


@query(
    "e7_stratified_folds",
    cte("clf_view") + ", " + fold_sql("clf_view", "f", "overload") + " SELECT row_id, overload, fold FROM f",
)
def stratified_folds(spark, sf):
    rows = split.k_folds(view(spark, sf, "clf_view"), ["row_id"], stratify=CLF_TARGET)
    return rows.select("row_id", "overload", "fold")


@query("e8_split_repeats", "SELECT 0::BIGINT AS only_in_first, 0::BIGINT AS only_in_second")
def split_repeats(spark, sf):
    rows = view(spark, sf, "reg_view")
    once = split.hold_out(rows, ["row_id"])
    again = split.hold_out(rows.repartition(13), ["row_id"])
    return split.rows_in_one_only(once, again)


@query(
    "e1_hash_split",
    cte("reg_view")
    + f""" SELECT CASE WHEN substr({_H}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split,
    count(*) AS rows, round(avg(net_price), 5) AS net_price FROM reg_view GROUP BY 1""",
)
def hash_split(spark, sf):
    rows = split.hash_split(view(spark, sf, "reg_view"), ["row_id"])
    return rows.groupBy("split").agg(
        F.count("*").alias("rows"), rounded(F.avg("net_price"), 5).alias("net_price")
    )
