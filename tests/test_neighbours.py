from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablewright.operators import knn
from tablewright.operators.knn import NearestNeighbours, NearestNeighboursModel, with_neighbours


def _points(n, dims, seed, hot=0.0, grid=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    if grid:  # many exact ties
        x = np.round(x)
    x[: int(n * hot)] = x[0]  # copies of one row
    return [f"{seed}-{i:05d}" for i in range(n)], x


def _brute(qx, ids, rx, k, metric):
    gap = np.abs(qx[:, None, :] - rx[None, :, :])
    d = {"euclidean": np.sqrt((gap**2).sum(2)), "manhattan": gap.sum(2), "chebyshev": gap.max(2)}[metric]
    out = []
    for row in d:
        order = sorted(range(len(ids)), key=lambda j: (round(row[j], 9), ids[j]))[:k]
        out.append([ids[j] for j in order])
    return out


def _frames(spark, q, r):
    asked = spark.createDataFrame(pd.DataFrame({"_id": q[0], "_x": list(q[1])}))
    held = spark.createDataFrame(pd.DataFrame({"id": r[0], "x": list(r[1]), "label": np.arange(len(r[0])) % 3 * 1.0}))
    return asked, held


@pytest.mark.parametrize("metric", knn.METRICS)
@pytest.mark.parametrize("case", ["plain", "ties", "hot"])
@pytest.mark.parametrize("path", ["broadcast", "cells"])
def test_same_as_full_search(spark, metric, case, path):
    kind = {"plain": {}, "ties": {"grid": True}, "hot": {"hot": 0.34}}[case]
    q, r = _points(90, 3, 1, **kind), _points(400, 3, 2, **kind)
    asked, held = _frames(spark, q, r)
    size = {} if path == "broadcast" else {"broadcast_bytes": 0, "block_rows": 25}
    found = with_neighbours(asked, held, 5, metric, **size).collect()
    got = {row["_id"]: list(row["neighbours"]["ids"]) for row in found}
    assert len(found) == 90
    assert [got[i] for i in q[0]] == _brute(q[1], r[0], r[1], 5, metric)


def test_rounds_visit_few_of_the_cells(spark):
    """Rows in clumps: the list of cells is short, and later rounds need not read all of it."""
    rng = np.random.default_rng(8)
    clumps = rng.normal(scale=40, size=(20, 3))
    x = clumps[rng.integers(20, size=2000)] + rng.normal(size=(2000, 3))
    q = [f"q{i}" for i in range(60)], clumps[rng.integers(20, size=60)] + rng.normal(size=(60, 3))
    asked, held = _frames(spark, q, ([f"r{i:04d}" for i in range(2000)], x))
    asked = asked.select(F.col("_id").alias("qid"), F.col("_x").alias("qx"))
    near, visits = knn.search_cells(asked, held, 2000, 5, "euclidean", block_rows=40)
    got = {r["qid"]: r["ids"] for r in near.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("d", "id"))).alias("n")).select("qid", "n.id").withColumnRenamed("id", "ids").collect()}
    assert [got[i] for i in q[0]] == _brute(q[1], [f"r{i:04d}" for i in range(2000)], x, 5, "euclidean")
    assert visits.count() == visits.distinct().count() < 0.2 * 60 * 100


def test_fewer_reference_rows_than_k(spark):
    q, r = _points(10, 2, 3), _points(3, 2, 4)
    asked, held = _frames(spark, q, r)
    for size in ({}, {"broadcast_bytes": 0, "block_rows": 2}):
        rows = with_neighbours(asked, held, 5, **size).collect()
        assert all(len(x["neighbours"]["ids"]) == 3 for x in rows)


def test_distance_weights_and_exact_hits(spark):
    train = spark.createDataFrame([("a", [0.0], 1.0), ("b", [1.0], 5.0), ("c", [3.0], 9.0)], "row_id string, v array<double>, label double")
    train = train.withColumn("features", array_to_vector("v"))
    asked = spark.createDataFrame([("q", [0.0]), ("p", [2.0])], "row_id string, v array<double>").withColumn("features", array_to_vector("v"))
    model = NearestNeighbours(k=2, weights="distance").fit(train)
    got = {r["row_id"]: r["prediction"] for r in model.transform(asked).collect()}
    assert got == {"q": 1.0, "p": pytest.approx(7.0)}


def test_user_columns_survive_and_model_round_trips(spark, tmp_path):
    train = spark.createDataFrame(
        [(f"r{i}", float(i % 2), [float(i), 1.0]) for i in range(20)], "row_id string, label double, v array<double>"
    ).withColumn("features", array_to_vector("v"))
    model = NearestNeighbours(k=3, classify=True).fit(train)
    asked = train.withColumn("id", F.lit(7)).withColumn("x", F.lit("kept"))
    first = model.transform(asked)
    assert first.select("id", "x").distinct().collect() == [(7, "kept")]
    model.write().overwrite().save(str(tmp_path / "m"))
    again = NearestNeighboursModel.load(str(tmp_path / "m")).transform(asked)
    a = {r["row_id"]: (r["prediction"], list(r["probability"])) for r in first.collect()}
    b = {r["row_id"]: (r["prediction"], list(r["probability"])) for r in again.collect()}
    assert a == b


def test_cell_search_lets_finished_tables_go(spark, monkeypatch):
    """Of all tables a search writes, the nearest rows alone are left for its reader."""
    made, original = [], knn._written
    monkeypatch.setattr(knn, "_written", lambda df, label: made.append((label, original(df, label))) or made[-1][1])
    q, r = _points(40, 3, 5), _points(300, 3, 6)
    asked, held = _frames(spark, q, r)
    found = with_neighbours(asked, held, 5, broadcast_bytes=0, block_rows=25).collect()
    got = {row["_id"]: list(row["neighbours"]["ids"]) for row in found}
    assert [got[i] for i in q[0]] == _brute(q[1], r[0], r[1], 5, "euclidean")
    left = [label for label, df in made if any(Path(urlparse(f).path).exists() for f in df.inputFiles())]
    assert left == ["near"] and len(made) > 10


def _few_values(n, seed):
    """Numbers and categories of few values, with copies: many rows are equally far."""
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 50, n) / 15, rng.uniform(0, 3.4, n), rng.integers(0, 11, n) / 3, np.eye(2)[rng.integers(0, 2, n)]])
    x[: n // 10] = x[0]
    return x


@pytest.mark.parametrize("metric", knn.METRICS)
def test_broadcast_search_rules_out_most_rows(monkeypatch, metric):
    """The answer of a full search, of which most distances are never computed."""
    r, q = _few_values(40_000, 3), _few_values(500, 4)
    q[:20] = r[0]
    full = knn.top_k(q, r, 7, metric)
    boxes, pairs, measured = knn.Boxes(r), [0], knn.distances

    def counted(a, b, m):
        pairs[0] += len(a) * len(b)
        return measured(a, b, m)

    monkeypatch.setattr(knn, "distances", counted)
    found = boxes.top_k(q, 7, metric)
    assert all(np.array_equal(a, b) for part, own in zip(full, found) for a, b in zip(part, own))
    assert pairs[0] < len(q) * len(r) / 3


def test_boxes_leave_rows_that_rule_out_little_or_are_not_finite_to_the_full_search():
    rng = np.random.default_rng(5)
    wide, asked = rng.normal(size=(9000, 40)), rng.normal(size=(50, 40))
    holes = _few_values(9000, 6)
    holes[5, 0] = np.nan
    for q, r in ((asked, wide), (_few_values(50, 7), holes)):
        full, found = knn.top_k(q, r, 5, "manhattan"), knn.Boxes(r).top_k(q, 5, "manhattan")
        assert all(np.array_equal(a, b) for part, own in zip(full, found) for a, b in zip(part, own))


@pytest.mark.parametrize("metric", knn.METRICS)
@pytest.mark.parametrize("case", ["wide", "whole numbers", "far from zero", "copies", "not finite"])
def test_rough_distances_change_no_answer(monkeypatch, metric, case):
    """Few rows are measured exactly, and answers are those of the full measure bit by bit."""
    rng = np.random.default_rng(11)
    r, q = rng.normal(size=(6000, 20)), rng.normal(size=(300, 20))
    if case == "whole numbers":
        r, q = np.round(r[:, :4]), np.round(q[:, :4])
    elif case == "far from zero":
        r, q = r + 1e5, q + 1e5
    elif case == "copies":
        r[:2500], q[:100] = r[0], r[0]
    elif case == "not finite":
        r[7, 3], q[5, 2] = np.nan, np.inf
    full = knn._measured_top_k(q, r, 5, metric)
    measured, exact = [], knn.Rough._exact
    monkeypatch.setattr(knn.Rough, "_exact", lambda self, q, at, row: measured.append(len(at)) or exact(self, q, at, row))
    found = knn.top_k(q, r, 5, metric)
    assert all(np.array_equal(a, b) for part, own in zip(full, found) for a, b in zip(part, own))
    if case == "wide":
        assert len(measured) == 2 and sum(measured) < 10 * len(q)


@pytest.mark.parametrize("metric", knn.METRICS)
def test_cells_that_rule_out_little_are_not_listed(spark, monkeypatch, metric):
    """In many dimensions no list of visits is written: all rows are searched, with the answer of a full search."""
    monkeypatch.setattr(knn, "LISTED", 0)
    made, original = [], knn._written
    monkeypatch.setattr(knn, "_written", lambda df, label: made.append((label, original(df, label))) or made[-1][1])
    q, r = _points(60, 20, 12), _points(500, 20, 13)
    r[1][:100] = r[1][0]
    asked, held = _frames(spark, q, r)
    found = with_neighbours(asked, held, 5, metric, broadcast_bytes=0, block_rows=25).collect()
    got = {row["_id"]: list(row["neighbours"]["ids"]) for row in found}
    assert [got[i] for i in q[0]] == _brute(q[1], r[0], r[1], 5, metric)
    assert "routes" not in [label for label, _ in made]
    left = [label for label, df in made if any(Path(urlparse(f).path).exists() for f in df.inputFiles())]
    assert left == ["near"]


def test_a_query_visits_the_few_cells_whose_box_is_near(spark):
    """Inputs of few values beside one of many: the boxes of the rows leave two of 30 cells on average."""
    r, q = _few_values(6000, 21), _few_values(200, 22)
    asked, held = _frames(spark, ([f"q{i}" for i in range(200)], q), ([f"r{i:04d}" for i in range(6000)], r))
    asked = asked.select(F.col("_id").alias("qid"), F.col("_x").alias("qx"))
    near, visits = knn.search_cells(asked, held, 6000, 5, "euclidean", block_rows=200)
    got = {n["qid"]: [m["id"] for m in n["n"]] for n in near.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("d", "id"))).alias("n")).collect()}
    places, _ = knn._measured_top_k(q, r, 5, "euclidean")
    assert [got[f"q{i}"] for i in range(200)] == [[f"r{j:04d}" for j in p] for p in places]
    assert visits.count() < 200 * 3


def test_keys_may_repeat_or_be_null_in_cells(spark):
    """The search in cells and the one over a broadcast agree where rows share a key, have none, or come twice."""
    q, r = _points(60, 3, 31), _points(300, 3, 32)
    q[0][1], q[0][3], r[0][5] = q[0][0], None, r[0][4]
    q[0][8], q[1][8], r[0][9], r[1][9] = q[0][7], q[1][7], r[0][8], r[1][8]
    asked, held = _frames(spark, q, r)
    rows = []
    for size in ({}, {"broadcast_bytes": 0, "block_rows": 25}):
        found = with_neighbours(asked, held, 5, **size).select("_id", "_x", "neighbours.ids", "neighbours.distances").collect()
        rows.append(sorted((str(f["_id"]), f["_x"], f["ids"], f["distances"]) for f in found))
    assert len(rows[0]) == 60 and rows[0] == rows[1]
