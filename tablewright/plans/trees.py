"""Queries of trees grown from counts, with the same cuts in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grown
from .fixtures import table
from .registry import query

# inputs of few values, and labels of whole numbers, whose totals are exact in both engines
_INPUTS = {"line": "l_linenumber", "percent_off": "CAST(round(l_discount * 100) AS INT)", "percent_tax": "CAST(round(l_tax * 100) AS INT)"}
_RETURNED, _PIECES = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END", "CAST(l_quantity AS INT)"


def grown_sql(label: str, levels: int, end: str) -> str:
    """Cuts of the first levels: per level the totals, the best cut of each node, and the rows one level down."""
    columns = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _INPUTS.items())
    parts = [f"d0 AS (SELECT '' AS node, {columns}, CAST({label} AS DOUBLE) AS y FROM lineitem)"]
    for i in range(levels):
        stacked = " UNION ALL ".join(f"SELECT node, {k} AS f, '{c}' AS input, {c} AS v, y FROM d{i}" for k, c in enumerate(_INPUTS))
        parts += [
            f"c{i} AS (SELECT node, f, input, v, count(*) AS n, sum(y) AS s, min(y) AS low, max(y) AS high FROM ({stacked}) GROUP BY ALL)",
            f"p{i} AS (SELECT node, f, input, v, sum(n) OVER u AS nl, sum(s) OVER u AS sl, sum(n) OVER a AS n, sum(s) OVER a AS s, "
            f"min(low) OVER a AS low, max(high) OVER a AS high FROM c{i} WINDOW a AS (PARTITION BY node, f), u AS (PARTITION BY node, f ORDER BY v))",
            f"b{i} AS (SELECT node, {i} AS depth, input, v AS \"at\" FROM p{i} WHERE low < high AND nl < n "
            "QUALIFY row_number() OVER (PARTITION BY node ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, f, v) = 1)",
        ]
        value = "CASE b.input " + " ".join(f"WHEN '{c}' THEN d.{c}" for c in _INPUTS) + " END"
        names = ", ".join(f"d.{c}" for c in _INPUTS)
        parts.append(f"d{i + 1} AS (SELECT d.node || CASE WHEN {value} <= b.\"at\" THEN 'L' ELSE 'R' END AS node, {names}, d.y FROM d{i} d JOIN b{i} b ON d.node = b.node)")
    cuts = " UNION ALL ".join(f"SELECT * FROM b{i}" for i in range(levels))
    return f"WITH {', '.join(parts)} {end.format(cuts=cuts, last=f'd{levels}')}"


def _tree(spark, sf, label, **limits):
    rows = table(spark, sf, "lineitem").select(*(F.expr(e).alias(c) for c, e in _INPUTS.items()), F.expr(label).alias("y"))
    return rows, *grown.grow_tree(rows, list(_INPUTS), "y", **limits)


_CUTS = 'SELECT node, depth, input, "at" FROM ({cuts})'


@query("g6_grown_tree_cuts", grown_sql(_PIECES, 3, _CUTS))
def grown_regressor(spark, sf):
    return _tree(spark, sf, _PIECES, max_depth=3)[1]


@query("h4_grown_tree_cuts", grown_sql(_RETURNED, 3, _CUTS))
def grown_classifier(spark, sf):
    return _tree(spark, sf, _RETURNED, max_depth=3)[1]


# without a limit every leaf is one combination of inputs, whatever the cuts were
_CELLS = ", ".join(f"{e} AS {c}" for c, e in _INPUTS.items())


@query(
    "h4_unlimited_tree",
    f"SELECT {', '.join(_INPUTS)}, count(*) AS rows, round(avg(y), 9) AS prediction FROM (SELECT {_CELLS}, {_RETURNED} AS y FROM lineitem) GROUP BY {', '.join(_INPUTS)}",
)
def unlimited_tree(spark, sf):
    rows, cuts, leaves = _tree(spark, sf, _RETURNED)
    cells = rows.groupBy(*_INPUTS).agg(F.count("*").alias("rows"))
    return grown.leaf_values(cells, list(_INPUTS), cuts, leaves).withColumn("prediction", F.round("prediction", 9))
