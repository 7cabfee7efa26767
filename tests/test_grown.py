"""Trees grown from counts against a plain recursive one."""

import random

import pytest

from tablewright.operators import grown


def _plain(rows, k, min_leaf, limit, node=""):
    """{node: (input, at)} and {leaf: (n, mean)} of rows (x, y), by trying every cut."""
    ys = [y for _, y in rows]
    options = []
    if min(ys) < max(ys) and (limit is None or len(node) < limit):
        for f in range(k):
            for v in sorted({x[f] for x, _ in rows}):
                left, right = [y for x, y in rows if x[f] <= v], [y for x, y in rows if x[f] > v]
                if len(left) >= min_leaf and len(right) >= max(min_leaf, 1):
                    options.append((-(sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right)), f, v))
    if not options:
        return {}, {node: (len(ys), sum(ys) / len(ys))}
    _, f, v = min(options)
    cuts, leaves = {node: (f"x{f}", v)}, {}
    for side, part in (("L", [r for r in rows if r[0][f] <= v]), ("R", [r for r in rows if r[0][f] > v])):
        below, ends = _plain(part, k, min_leaf, limit, node + side)
        cuts, leaves = cuts | below, leaves | ends
    return cuts, leaves


@pytest.mark.parametrize(("min_leaf", "limit", "labels"), [(1, None, 2), (4, 3, 2), (2, None, 9)])
def test_same_tree_as_trying_every_cut(spark, min_leaf, limit, labels):
    rng = random.Random(labels + min_leaf)
    rows = [(tuple(float(rng.randrange(4)) for _ in range(3)), float(rng.randrange(labels))) for _ in range(90)]
    frame = spark.createDataFrame([(*x, y) for x, y in rows], "x0 double, x1 double, x2 double, y double")
    cuts, leaves = grown.grow_tree(frame, ["x0", "x1", "x2"], "y", limit, min_leaf)
    expected = _plain(rows, 3, min_leaf, limit)
    assert {r["node"]: (r["input"], r["at"]) for r in cuts.collect()} == expected[0]
    assert {r["node"]: (r["n"], r["value"]) for r in leaves.collect()} == expected[1]


def test_deep_chains_missing_inputs_and_no_rows(spark):
    rows = [(float(i), float(i % 2)) for i in range(14)] + [(None, 5.0), (float("nan"), 5.0), (3.0, None)]
    frame = spark.createDataFrame(rows, "a double, y double")
    cuts, leaves = grown.grow_tree(frame, ["a"], "y")
    got = grown.leaf_values(frame, ["a"], cuts, leaves).collect()
    assert all(r["prediction"] == r["y"] for r in got if r["y"] is not None) and len(got) == len(rows)
    cuts, leaves = grown.grow_tree(frame.where("false"), ["a"], "y")
    assert cuts.count() == leaves.count() == 0
    assert grown.leaf_values(frame, ["a"], cuts, leaves).where("prediction is null").count() == len(rows)
