"""Exact regression and two-class trees of any depth, grown a level at a time from counts.

Each level is one aggregate: totals of every (node, input, value), prefix sums over the values, and the
best cut of each node. No bins, no depth limit, and what the driver holds is one table per level.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Levels that rows are placed through before the plan is cut.
TOGETHER = 8
_TOTALS = {"n": F.sum, "s": F.sum, "low": F.min, "high": F.max}


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _values(inputs: Sequence[str]) -> Column:
    return F.array(*(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in inputs))


def _cuts(live: DataFrame, min_leaf: int) -> DataFrame:
    """(node, feature, at): the best cut of each node that has one."""
    stacked = live.select("node", F.posexplode("x").alias("feature", "value"), *_TOTALS)
    counts = stacked.groupBy("node", "feature", "value").agg(*(f(c).alias(c) for c, f in _TOTALS.items()))
    all_ = Window.partitionBy("node", "feature")
    upto = all_.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.select(
        "node", "feature", "value", F.sum("n").over(upto).alias("nl"), F.sum("s").over(upto).alias("sl"),
        *(f(c).over(all_).alias(c) for c, f in _TOTALS.items()),
    )
    right = F.col("n") - F.col("nl")
    counts = counts.where((F.col("low") < F.col("high")) & (F.col("nl") >= min_leaf) & (right >= max(min_leaf, 1)))
    score = F.col("sl") * F.col("sl") / F.col("nl") + (F.col("s") - F.col("sl")) * (F.col("s") - F.col("sl")) / right
    best = F.max(F.struct(score.alias("score"), (-F.col("feature")).alias("f"), (-F.col("value")).alias("v"))).alias("best")
    return counts.groupBy("node").agg(best).select("node", (-F.col("best.f")).alias("feature"), (-F.col("best.v")).alias("at"))


def _side() -> Column:
    return F.when(F.get("x", F.col("feature")) <= F.col("at"), "L").otherwise("R")


def grow_tree(rows: DataFrame, inputs: Sequence[str], label: str, max_depth: int | None = None, min_leaf: int = 1) -> tuple[DataFrame, DataFrame]:
    """(cuts (node, depth, input, at), leaves (node, n, value)) of the tree with the least squared error.

    For labels 0 and 1 that is the Gini tree. A row goes left if its input is at most ``at``, a value
    that occurs; missing inputs go right. Nodes are named by their way down: ``LRL``; the root is the empty
    string. Impure nodes are cut even where nothing is gained, ties go to the first input, then the
    smallest value. ``max_depth`` None has no limit. Rows without label are left out; no rows give no
    cuts and no leaves.

    Rows of equal inputs become one with totals before the first level, so hot values cost one row.
    Cuts meet rows in a join whose side Spark broadcasts by size, or splits where a node is large. A task of the
    prefix sums holds the distinct values of one input in one node.
    """
    y = F.col(f"`{label}`").cast("double")
    data = rows.select(_values(inputs).alias("x"), y.alias("y")).where(y.isNotNull() & ~F.isnan("y"))
    totals = [F.count("*").alias("n"), F.sum("y").alias("s"), F.min("y").alias("low"), F.max("y").alias("high")]
    live = _kept(data.groupBy("x").agg(*totals).withColumn("node", F.lit("")), "tree-rows")
    cuts, leaves, depth = [], [], 0
    while True:
        found = _cuts(live, min_leaf)
        found = _kept(found if max_depth is None or depth < max_depth else found.where("false"), "tree-cuts")
        done = live.join(found, "node", "left_anti").groupBy("node").agg(F.sum("n").alias("n"), (F.sum("s") / F.sum("n")).alias("value"))
        leaves.append(_kept(done, "tree-leaves"))
        names = F.array(*(F.lit(c) for c in inputs))
        cuts.append(found.select("node", F.lit(depth).alias("depth"), F.get(names, F.col("feature")).alias("input"), "at"))
        if found.isEmpty():
            return reduce(DataFrame.unionByName, cuts), reduce(DataFrame.unionByName, leaves)
        live = _kept(live.join(found, "node").select("x", *_TOTALS, F.concat("node", _side()).alias("node")), "tree-rows")
        depth += 1


def leaf_values(rows: DataFrame, inputs: Sequence[str], cuts: DataFrame, leaves: DataFrame, name: str = "prediction") -> DataFrame:
    """Rows with the value of the leaf they fall in; null if the tree has none."""
    deepest = cuts.agg(F.max("depth")).first()[0]
    place = F.array_position(F.array(*(F.lit(c) for c in inputs)), F.col("input")).cast("int") - 1
    steps = cuts.select(F.col("node").alias("_from"), "depth", place.alias("feature"), "at")
    rows = rows.withColumns({"x": _values(inputs), "node": F.lit("")})
    for depth in range(0 if deepest is None else deepest + 1):
        here = steps.where(F.col("depth") == depth).drop("depth")
        gone = rows.join(here, F.col("node") == F.col("_from"), "left")
        way = F.when(F.col("_from").isNull(), F.col("node")).otherwise(F.concat("node", _side()))
        rows = gone.withColumn("node", way).drop("_from", "feature", "at")
        if depth % TOGETHER == TOGETHER - 1:
            rows = _kept(rows, "tree-places")
    ends = leaves.select(F.col("node").alias("_leaf"), F.col("value").alias(name))
    return rows.join(ends, F.col("node") == F.col("_leaf"), "left").drop("_leaf", "node", "x")
