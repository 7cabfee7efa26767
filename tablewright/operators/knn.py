"""k nearest neighbours, exact at any size.

A reference side below a checked byte size is broadcast and the search is one map over
the query rows, in which boxes of reference rows are ruled out by their distance. Beyond that, space is cut into cells
of about ``block_rows`` reference rows at medians of sampled rows (``search_cells``):

1. a query searches the cell it lies in, which bounds its k-th distance;
2. it then visits the other cells whose box of rows reaches within that bound, nearest first, in
   rounds between which the bound shrinks. Where boxes rule out little, as with many inputs,
   no visits are listed: blocks of all rows meet batches of queries instead.

Cells are split into blocks and visits into batches of bounded size, so neither a hot
cell nor a hot query region ends in one task. Reference copies are thinned to k rows each per block of input
beforehand. Nothing is cut off: the answer equals a full search, ties broken by id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.exprs import col
from ..session import scratch_path

BROADCAST_BYTES = 64 << 20
BLOCK_ROWS = 20_000
#: Cells a query visits in the round after its home cell; each later round visits so many times more.
STEP = 4
#: Rows of a box of the broadcast search, queries that are sorted into boxes together, and those that are tried first.
LEAF, QUERIES, TRIED = 2048, 10_000, 100
#: Rows of a box inside a cell that many queries lie in, and sampled rows per cell.
FINE, SAMPLED = 256, 32
#: Queries and reference rows of one step of the rough search, and near rows of it held together.
CHUNK, TILE, HELD = 256, 2048, 4_000_000
#: Bytes of vectors on either side of a group that meets all rows.
PART_BYTES = 24 << 20
#: Listed visits below which the search in cells goes on even if they rule out little.
LISTED = 1 << 14
METRICS = ("euclidean", "manhattan", "chebyshev")

_NEIGHBOURS = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.StringType())),
        T.StructField("distances", T.ArrayType(T.DoubleType())),
        T.StructField("labels", T.ArrayType(T.DoubleType())),
    ]
)


def distances(q: np.ndarray, r: np.ndarray, metric: str) -> np.ndarray:
    """All distances of a block of queries to a block of reference rows.

    Summed input by input, so equal vectors give exactly equal distances.
    """
    out = np.zeros((len(q), len(r)))
    # reference rows in tiles that stay in the processor cache
    for start in range(0, len(r), 2048):
        tile, part = out[:, start : start + 2048], r[start : start + 2048]
        for j in range(q.shape[1]):
            gap = q[:, j, None] - part[None, :, j]
            if metric == "euclidean":
                np.multiply(gap, gap, out=gap)
                tile += gap
            elif metric == "manhattan":
                tile += np.abs(gap, out=gap)
            else:
                np.maximum(tile, np.abs(gap, out=gap), out=tile)
    return np.sqrt(out, out=out) if metric == "euclidean" else out


def _near(q: np.ndarray, r: np.ndarray, norms: np.ndarray, k: int, metric: str) -> Iterator[tuple]:
    """Per query: positions that may be among the k nearest, and their exact distances."""
    if metric != "euclidean":
        d = distances(q, r, metric)
        kth = np.partition(d, k - 1, axis=1)[:, k - 1]
        for row, limit in zip(d, kth):
            near = np.flatnonzero(row <= limit)
            yield near, row[near]
        return
    # One matrix product gives squared distances up to rounding; everything within the
    # rounding margin of the k-th is then measured exactly.
    own = np.einsum("ij,ij->i", q, q)
    rough = q @ r.T
    rough *= -2.0
    rough += norms[None, :]
    kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
    limits = kth + 1e-9 * (1.0 + own + norms.max())
    for point, row, limit in zip(q, rough, limits):
        near = np.flatnonzero(row <= limit)
        yield near, distances(point[None, :], r[near], metric)[0]


def top_k(q: np.ndarray, r: np.ndarray, k: int, metric: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Positions and distances of the k nearest rows of ``r`` (sorted by id) per query."""
    k = min(k, len(r))
    rough = Rough(r, metric) if len(r) >= 2 * TILE else None
    places, gaps = [], []
    for start in range(0, len(q), CHUNK):
        part = q[start : start + CHUNK]
        found = (rough.top_k(part, k) if rough is not None else None) or _measured_top_k(part, r, k, metric)
        places += found[0]
        gaps += found[1]
    return places, gaps


def _measured_top_k(q: np.ndarray, r: np.ndarray, k: int, metric: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The same, with the distances of all pairs held at once for a few queries."""
    step = max(1, min(128, 2_000_000 // max(1, len(r))))
    norms = np.einsum("ij,ij->i", r, r)
    places, gaps = [], []
    for start in range(0, len(q), step):
        for near, d in _near(q[start : start + step], r, norms, k, metric):
            first = np.argsort(d, kind="stable")[:k]
            places.append(near[first])
            gaps.append(d[first])
    return places, gaps


class Rough:
    """Distances to all reference rows in single precision, tile by tile, of which few are then measured exactly.

    A row whose rough distance is beyond the k-th by more than twice the largest rounding error is not among the k
    nearest. Rows are taken less their mean, which changes no distance and keeps the error small. Squares stand for euclidean distances.
    """

    def __init__(self, r: np.ndarray, metric: str):
        self.r, self.metric = r, metric
        self.centre = r.mean(axis=0)
        near = r - self.centre
        size = self._size(near)
        self.most, self.raw = float(size.max()), float(self._size(r).max())
        if metric == "euclidean":
            self.turned = np.concatenate([-2.0 * near, size[:, None]], axis=1).astype(np.float32).T.copy()
        else:
            self.turned = near.astype(np.float32).T.copy()

    def _size(self, x: np.ndarray) -> np.ndarray:
        if self.metric == "euclidean":
            return np.einsum("ij,ij->i", x, x)
        return np.abs(x).sum(axis=1) if self.metric == "manhattan" else np.abs(x).max(axis=1, initial=0.0)

    def _tile(self, q: np.ndarray, start: int, limit: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """Rows of a tile within the limit: query, position and rough distance; without a limit a matrix of all."""
        r = self.turned[:, start : start + TILE]
        if self.metric == "euclidean":
            out = q @ r
        else:
            out = np.zeros((len(q), r.shape[1]), dtype=np.float32)
            # of the largest gap the first inputs rule most rows out already
            some = len(r) if limit is None or self.metric == "manhattan" else min(len(r), 12)
            for a in range(0, len(q), 32):  # what stays in the processor cache
                own, part = out[a : a + 32], q[a : a + 32]
                gap = np.empty_like(own)
                for j in range(some):
                    np.abs(np.subtract(part[:, j, None], r[None, j], out=gap), out=gap)
                    if self.metric == "manhattan":
                        own += gap
                    else:
                        np.maximum(own, gap, out=own)
        if limit is None:
            return (out,)
        limit = np.nextafter(limit.astype(np.float32), np.float32(np.inf))
        flat = np.flatnonzero(out <= limit[:, None])
        at, row = np.divmod(flat, out.shape[1])
        d = out.ravel()[flat]
        if self.metric == "chebyshev" and some < len(r):
            for j in range(some, len(r)):
                d = np.maximum(d, np.abs(q[at, j] - r[j, row]))
                if j % 4 == 3:
                    stay = d <= limit[at]
                    at, row, d = at[stay], row[stay], d[stay]
            stay = d <= limit[at]
            at, row, d = at[stay], row[stay], d[stay]
        return at, row + start, d

    def top_k(self, q: np.ndarray, k: int):
        """As ``top_k``; None where single precision does not do or too many rows are equally near."""
        near = q - self.centre
        own = self._size(near)
        largest = self.most + own.max()
        if k > TILE or not np.isfinite(q).all() or not largest < 1e30:
            return None
        margin = 2.0**-22 * (q.shape[1] + 8) * (own + 2 * self.most) + 1e-9 * (1.0 + self._size(q) + self.raw)
        asked = np.concatenate([near, np.ones((len(q), 1))], axis=1) if self.metric == "euclidean" else near
        asked = asked.astype(np.float32)
        (first,) = self._tile(asked, 0, None)
        limit = np.partition(first, k - 1, axis=1)[:, k - 1] + 2 * margin
        at, row = np.nonzero(first <= limit[:, None])
        d = first[at, row]
        turn, again = 1, 2
        for start in range(TILE, len(self.r), TILE):
            more = self._tile(asked, start, limit)
            at, row, d = (np.concatenate([a, b]) for a, b in zip((at, row, d), more))
            if len(at) > HELD:
                return None
            turn += 1
            if turn == again:
                again *= 2
                at, row, d, limit = self._nearer(at, row, d, limit, margin, k)
        at, row, d, limit = self._nearer(at, row, d, limit, margin, k)
        exact = self._exact(q, at, row)
        order = np.lexsort((row, exact, at))
        order = order[_rank(at[order]) < k]
        return list(row[order].reshape(-1, k)), list(exact[order].reshape(-1, k))

    @staticmethod
    def _nearer(at, row, d, limit, margin, k):
        """What stays when the limit is drawn from all rows met."""
        order = np.lexsort((d, at))
        kth = order[_rank(at[order]) == k - 1]
        limit = np.minimum(limit, d[kth] + 2 * margin)
        stay = d <= limit[at]
        return at[stay], row[stay], d[stay], limit

    def _exact(self, q: np.ndarray, at: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Summed input by input, as ``distances`` does."""
        out = np.zeros(len(at))
        for j in range(q.shape[1]):
            gap = q[at, j] - self.r[row, j]
            if self.metric == "euclidean":
                out += gap * gap
            elif self.metric == "manhattan":
                out += np.abs(gap)
            else:
                np.maximum(out, np.abs(gap), out=out)
        return np.sqrt(out) if self.metric == "euclidean" else out


def _rank(query: np.ndarray) -> np.ndarray:
    """Place of every row, from 0, among those of its query; rows are sorted by query."""
    return np.arange(len(query)) - np.searchsorted(query, query)


class Boxes:
    """Reference rows (sorted by id) dealt into boxes of at most ``leaf`` rows, cut at medians.

    Rows that are not all finite stay in one box.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, finite = points, bool(np.isfinite(points).all())
        self.rows, open_ = [], [np.arange(len(points))]
        while open_:
            own = open_.pop()
            if len(own) <= leaf or not finite:
                self.rows.append(np.sort(own))
                continue
            x = points[own]
            cells = x[:, int(np.argmax(x.max(axis=0) - x.min(axis=0)))]
            order = np.argpartition(cells, len(own) // 2)
            open_ += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
        self.low = np.stack([points[r].min(axis=0) for r in self.rows])
        self.high = np.stack([points[r].max(axis=0) for r in self.rows])

    def least(self, q: np.ndarray, metric: str) -> np.ndarray:
        """The distance of every query to every box: no row of the box is nearer."""
        out = np.zeros((len(q), len(self.rows)))
        for j in range(q.shape[1]):
            x = q[:, j, None]
            gap = np.maximum(np.maximum(self.low[None, :, j] - x, x - self.high[None, :, j]), 0.0)
            if metric == "euclidean":
                out += gap * gap
            elif metric == "manhattan":
                out += gap
            else:
                np.maximum(out, gap, out=out)
        return np.sqrt(out, out=out) if metric == "euclidean" else out

    def top_k(self, q: np.ndarray, k: int, metric: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The same as ``top_k`` over all rows."""
        places, gaps = self.nearest(q, k, metric)
        return list(places), list(gaps)

    def nearest(self, q: np.ndarray, k: int, metric: str, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of the k nearest rows as two matrices; rows beyond a query's bound may be
        left out, for which the position is the number of rows.

        Queries of one nearest box go together through the boxes, nearest first, until the next one is farther
        than every k-th distance. Where boxes rule out little, as with many inputs, all rows are searched.
        """
        k = min(k, len(self.points))
        bound = np.full(len(q), np.inf) if bound is None else bound * (1 + 1e-9) + 1e-12
        places, gaps = [np.empty((0, k), dtype=int)], [np.empty((0, k))]
        for start in range(0, len(q), QUERIES):
            part, limit = q[start : start + QUERIES], bound[start : start + QUERIES]
            found = self._search(part, k, metric, limit) if len(self.rows) > 3 and np.isfinite(part).all() else None
            found = found or top_k(part, self.points, k, metric)
            places.append(np.asarray(found[0]))
            gaps.append(np.asarray(found[1]))
        return np.concatenate(places), np.concatenate(gaps)

    def _search(self, q: np.ndarray, k: int, metric: str, bound: np.ndarray):
        some = slice(None, None, -(-len(q) // TRIED))
        if len(q) > TRIED and self._homes(q[some], k, metric, bound[some]) is None:
            return None
        found = self._homes(q, k, metric, bound)
        if found is None:
            return None
        least, home, groups, place, gap = found
        for own in groups:
            part = least[own]
            nearest = part.min(axis=0)
            for box in np.argsort(nearest, kind="stable"):
                if not _within(nearest[box], gap[own, -1].max()):
                    break
                if box != home[own[0]]:
                    self._visit(q, own[_within(part[:, box], gap[own, -1])], box, place, gap, metric)
        return place, gap

    def _homes(self, q: np.ndarray, k: int, metric: str, bound: np.ndarray):
        """Every query in its nearest box; None if the bounds so found rule out little."""
        least = self.least(q, metric)
        home = least.argmin(axis=1)
        place, gap = np.full((len(q), k), len(self.points)), np.repeat(bound[:, None], k, axis=1)
        order = np.argsort(home, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(home[order])) + 1)
        for own in groups:
            box = home[own[0]]
            self._visit(q, own[_within(least[own, box], gap[own, -1])], box, place, gap, metric)
        if np.count_nonzero(_within(least, gap[:, -1:])) > least.size / 4:
            return None
        return least, home, groups, place, gap

    def _visit(self, q: np.ndarray, asked: np.ndarray, box: int, place: np.ndarray, gap: np.ndarray, metric: str) -> None:
        """Puts the rows of a box among the nearest of the queries ``asked``, ties by place."""
        if not len(asked):
            return
        k, rows = place.shape[1], self.rows[box]
        d = distances(q[asked], self.points[rows], metric)
        limit = gap[asked, -1]
        if len(rows) > k:
            limit = np.minimum(limit, np.partition(d, k - 1, axis=1)[:, k - 1])
        at, row = np.nonzero(d <= limit[:, None])
        if not len(at):
            return
        query = np.concatenate([np.repeat(np.arange(len(asked)), k), at])
        far = np.concatenate([gap[asked].ravel(), d[at, row]])
        where = np.concatenate([place[asked].ravel(), rows[row]])
        order = np.lexsort((where, far, query))
        query = query[order]
        order = order[_rank(query) < k]
        place[asked], gap[asked] = where[order].reshape(-1, k), far[order].reshape(-1, k)


def _empty(**dtypes) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([], dtype=t) for c, t in dtypes.items()})


def _matrix(values) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in values])


def with_neighbours(
    queries: DataFrame,
    reference: DataFrame,
    k: int,
    metric: str = "euclidean",
    broadcast_bytes: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``queries`` (_id, _x, ...) plus ``neighbours`` (ids, distances, labels), nearest first.

    ``reference`` holds (id, x, label); _x and x are arrays of doubles.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    size = reference.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("p")).first()
    if size["n"] * (8 * (size["p"] or 0) + 64) <= broadcast_bytes:
        return _broadcast_search(queries, reference, k, metric)
    return _cell_search(queries, reference, size["n"], k, metric, block_rows)


def _broadcast_search(queries: DataFrame, reference: DataFrame, k: int, metric: str) -> DataFrame:
    # size checked by the caller
    pdf = reference.select(col("id").cast("string").alias("id"), "x", "label").toPandas()
    pdf = pdf.sort_values("id", kind="stable")
    data = (pdf["id"].to_numpy(), Boxes(_matrix(pdf["x"])), pdf["label"].to_numpy(dtype=float))
    shared = queries.sparkSession.sparkContext.broadcast(data)

    @F.pandas_udf(_NEIGHBOURS)
    def search(x: pd.Series) -> pd.DataFrame:
        ids, boxes, labels = shared.value
        if len(x) == 0:
            return _empty(ids=object, distances=object, labels=object)
        places, gaps = boxes.top_k(_matrix(x), k, metric)
        return pd.DataFrame(
            {
                "ids": [list(ids[p]) for p in places],
                "distances": [list(g) for g in gaps],
                "labels": [list(labels[p]) for p in places],
            }
        )

    # each row costs a pass over the reference side, far more than moving it once
    tasks = queries.sparkSession.sparkContext.defaultParallelism
    return queries.repartition(tasks, "_id").withColumn("neighbours", search("_x"))


def _cell_search(
    queries: DataFrame, reference: DataFrame, n: int, k: int, metric: str, block_rows: int
) -> DataFrame:
    # equal vectors have equal neighbours: a query is known by its vector, a crowded one in 64 parts, and keys may repeat
    part = F.pmod(F.xxhash64("_id"), F.lit(64))
    key = F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(seed), part, "_x")) for seed in (1, 2)])
    near, visits = _in_cells(queries.select(key.alias("qid"), F.col("_x").alias("qx")), reference, n, k, metric, block_rows)
    _discard(visits)
    best = near.select(F.col("qid").alias("_qid"), F.struct("ids", "distances", "labels").alias("neighbours"))
    return queries.withColumn("_key", key).join(best, F.col("_key") == F.col("_qid"), "left").drop("_key", "_qid")


def search_cells(
    asked: DataFrame, reference: DataFrame, n: int, k: int, metric: str, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(k nearest rows (qid, d, id, label), visits (qid, cell) beyond the home cell) of queries (qid, qx).

    Space is cut into about n / block_rows cells at medians of sampled reference rows; a query's home is the cell
    it lies in. The k-th distance there leaves those cells whose box of rows is within it; they are visited nearest
    first in rounds of 4, 16, 64 and so on, after each of which the k-th distance shrinks and rules out more.
    Queries that list over a quarter of all cells meet all rows instead and have no visits.
    """
    near, visits = _in_cells(asked, reference, n, k, metric, block_rows)
    rows = F.explode(F.arrays_zip(F.col("distances").alias("d"), F.col("ids").alias("id"), F.col("labels").alias("label")))
    return near.select("qid", rows.alias("_n")).select("qid", "_n.d", "_n.id", "_n.label"), visits


_NEAR = "ids array<string>, distances array<double>, labels array<double>"


def _in_cells(
    asked: DataFrame, reference: DataFrame, n: int, k: int, metric: str, block_rows: int
) -> tuple[DataFrame, DataFrame]:
    """The search of ``search_cells``, with the neighbours of a query as one row (qid, ids, distances, labels)."""
    spark = asked.sparkSession
    wanted = max(1, math.ceil(n / block_rows))
    apart = max(1, n // (wanted * SAMPLED))
    rows = reference.select(col("id").cast("string").alias("id"), "x", col("label").cast("double").alias("label"))
    sample = _written(rows.where(F.pmod(F.xxhash64("x", "id"), F.lit(apart)) == 0).select("x"), "sample")
    drawn = [r["x"] for r in sample.collect()] or [r["x"] for r in rows.select("x").limit(1).collect()]
    _discard(sample)
    tree = Cells(_matrix(drawn), max(1, len(drawn) // wanted))
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _joined(batches, block_rows):
            x = _cells(table["x"])
            kept = _few_copies(x, table["id"], k)
            yield from table.take(pa.array(kept)).append_column("cell", pa.array(shared.value.of(x[kept]))).to_batches()

    placed = _written(rows.mapInArrow(place, "id string, x array<double>, label double, cell int"), "cells")
    width = range(len(drawn[0]))
    sides = [f(F.col("x")[i]).alias(f"{side}{i}") for side, f in (("l", F.min), ("h", F.max)) for i in width]
    boxes = _written(placed.groupBy("cell").agg(F.count("*").alias("n"), *sides), "boxes")
    tree.bounded({r["cell"]: ([r[f"l{i}"] for i in width], [r[f"h{i}"] for i in width]) for r in boxes.collect()})
    cells, reach = boxes.select("cell", "n"), spark.sparkContext.broadcast(tree)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("cell", pa.array(reach.value.of(_cells(batch.column("qx"))))).append_column("bound", pa.array(np.full(len(batch), np.inf)))

    own = asked.select("qid", "qx").mapInArrow(home, "qid string, qx array<double>, cell int, bound double")
    near = _written(_merged(_visit(own, placed, cells, k, metric, block_rows, every=True), k), "near")
    queries, quarter = near.count(), boxes.count() / 4
    whole = queries * boxes.count() >= LISTED

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, bound = _cells(batch.column("qx")), _bounds(batch.column("distances"), k)
            at, cell, least = reach.value.within(q, bound, metric)
            other = cell != reach.value.of(q)[at]
            at, cell, least = at[other], cell[other], least[other]
            order = np.lexsort((cell, least, at))
            at, cell, least = at[order], cell[order], least[order]
            sizes = np.bincount(at, minlength=len(q))
            far = sizes > quarter if whole else np.zeros(len(q), dtype=bool)
            short = ~far[at]
            listed = [_lists(v[short], np.where(far, 0, sizes)) for v in (cell, least)]
            table = pa.table([batch.column("qid"), batch.column("qx"), pa.array(reach.value.of(q)), pa.array(bound), pa.array(far), *listed], names=["qid", "qx", "cell", "bound", "far", "cells", "least"])
            yield from table.filter(pa.array(sizes > 0)).to_batches()

    listing = "qid string, qx array<double>, cell int, bound double, far boolean, cells array<int>, least array<double>"
    routes = _written(near.mapInArrow(route, listing), "asked")
    found, visits = [], []
    far = routes.where("far")
    if not far.isEmpty():
        found.append(_written(_search_all(far, placed, k, metric, block_rows), "found"))
    done, last = 0, STEP
    while True:
        open_ = routes.where(F.size("cells") > done).withColumn("cells", F.slice("cells", done + 1, 1 << 30)).withColumn("least", F.slice("least", done + 1, 1 << 30))
        if visits:
            # only queries whose list goes on: few of them are left after each round
            parts = [df.select("qid", *_NAMES).join(open_.select("qid"), "qid", "left_semi") for df in (near, *found)]
            bounds = _merged(reduce(DataFrame.unionByName, parts), k).select("qid", F.when(F.size("distances") >= k, F.element_at("distances", -1)).otherwise(float("inf")).alias("bound"))
            open_ = open_.drop("bound").join(bounds, "qid")
        turns = F.posexplode(F.arrays_zip("cells", "least"))
        open_ = open_.select("qid", "qx", "bound", turns.alias("turn", "_v")).select("qid", "qx", "bound", "turn", "_v.cells", "_v.least").withColumnRenamed("cells", "cell")
        open_ = open_.where(F.col("least") <= F.col("bound") * (1 + 1e-9) + 1e-12)
        now = _written(open_.where(F.col("turn") < last - done).drop("turn", "least"), "visits")
        visits.append(now.select("qid", "cell"))
        if not now.isEmpty():
            found.append(_written(_visit(now, placed, cells, k, metric, block_rows), "found"))
        elif open_.isEmpty():
            break
        done, last = last, last * STEP
    before, near = near, near.select("qid", *_NAMES)
    if found:
        more = _merged(reduce(DataFrame.unionByName, [df.select("qid", *_NAMES) for df in found]), k)
        more = more.select("qid", *[F.col(c).alias(f"_{c}") for c in _NAMES])
        near = near.join(more, "qid", "left").select("qid", *_nearest_of([F.struct(*_NAMES), F.struct(*[F.col(f"_{c}").alias(c) for c in _NAMES])], k))
        near = _written(near, "near")
        _discard(before)
    for table in (placed, boxes, routes, *found):
        _discard(table)
    return near, reduce(DataFrame.unionByName, visits)


class Cells:
    """A tree of cuts at medians of sampled points, whose leaves are the cells, and the boxes of the rows in them."""

    def __init__(self, points: np.ndarray, most: int):
        self.axis, self.cut, self.child, self.cell = [], [], [], []
        open_, leaves = [(points, None)], 0
        while open_:
            own, parent = open_.pop()
            if parent is not None:
                self.child[parent[0]][parent[1]] = len(self.axis)
            axis, cut = _median_cut(own) if len(own) > most else (0, None)
            self.axis.append(axis)
            self.cut.append(np.nan if cut is None else cut)
            self.child.append([len(self.child)] * 2)
            self.cell.append(leaves if cut is None else -1)
            leaves += cut is None
            if cut is not None:
                low = own[:, axis] < cut
                open_ += [(own[~low], (len(self.axis) - 1, 1)), (own[low], (len(self.axis) - 1, 0))]
        self.axis, self.cut, self.child, self.cell = (np.array(v) for v in (self.axis, self.cut, self.child, self.cell))
        self.low = self.high = None

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell every row lies in."""
        node, open_ = np.zeros(len(x), dtype=int), np.arange(len(x))
        while len(open_ := open_[self.cell[node[open_]] < 0]):
            at = node[open_]
            node[open_] = self.child[at, (~(x[open_, self.axis[at]] < self.cut[at])).astype(int)]
        return self.cell[node].astype("int32")

    def bounded(self, boxes: dict[int, tuple[list, list]]) -> None:
        """Sets the boxes: low and high sides by cell; a cell without rows is never reached."""
        width = len(next(iter(boxes.values()))[0])
        self.low, self.high = np.full((len(self.cell), width), np.inf), np.full((len(self.cell), width), -np.inf)
        for node in range(len(self.cell) - 1, -1, -1):
            if self.cell[node] < 0:
                pair = self.child[node]
                self.low[node], self.high[node] = self.low[pair].min(axis=0), self.high[pair].max(axis=0)
            elif self.cell[node] in boxes:
                low, high = (np.array(side, dtype=float) for side in boxes[self.cell[node]])
                # NaN is the largest number to Spark
                self.low[node], self.high[node] = np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)

    def within(self, q: np.ndarray, bound: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, cell, distance to the box of its rows) for the cells within the bound of each query."""
        parts = []
        for start in range(0, len(q), CHUNK):
            at = np.arange(start, min(start + CHUNK, len(q)))
            node = np.zeros(len(at), dtype=int)
            while len(at):
                least = self._least(q[at], node, metric)
                near = _within(least, bound[at])
                at, node, least = at[near], node[near], least[near]
                leaf = self.cell[node] >= 0
                parts.append((at[leaf], self.cell[node[leaf]], least[leaf]))
                at, node = np.repeat(at[~leaf], 2), self.child[node[~leaf]].ravel()
        at, cell, least = (np.concatenate(p) for p in zip(*parts)) if parts else (np.array([], dtype=int), np.array([], dtype=int), np.array([]))
        return at, cell.astype("int32"), least

    def _least(self, q: np.ndarray, node: np.ndarray, metric: str) -> np.ndarray:
        out = np.zeros(len(q))
        for j in range(q.shape[1]):
            x = q[:, j]
            gap = np.maximum(np.maximum(self.low[node, j] - x, x - self.high[node, j]), 0.0)
            if metric == "euclidean":
                out += gap * gap
            elif metric == "manhattan":
                out += gap
            else:
                np.maximum(out, gap, out=out)
        return np.sqrt(out, out=out) if metric == "euclidean" else out


def _median_cut(points: np.ndarray) -> tuple[int, float | None]:
    """(input of the widest range, value nearest to its median that parts the points); no value if all are equal."""
    finite = points[np.isfinite(points).all(axis=1)]
    if not len(finite):
        return 0, None
    axis = int(np.argmax(finite.max(axis=0) - finite.min(axis=0)))
    x = np.sort(finite[:, axis])
    starts = np.flatnonzero(np.diff(x)) + 1
    return axis, float(x[starts[np.argmin(np.abs(starts - len(x) // 2))]]) if len(starts) else None


def _search_all(asked: DataFrame, placed: DataFrame, k: int, metric: str, block_rows: int) -> DataFrame:
    """Top k within the bound of every query (qid, qx, cell, bound) over all rows but those of its home cell.

    One group is a block of rows against a batch of queries, both of bounded size and dealt by hash, whatever the cell.
    """
    spark = asked.sparkSession
    rows, queries = placed.count(), asked.count()
    # either side is shuffled once per part of the other: the larger the parts, the less is moved
    room = max(block_rows, BLOCK_ROWS, min(1 << 16, PART_BYTES // (8 * placed.agg(F.max(F.size("x"))).first()[0])))
    tasks = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-rows // room))
    batches = max(1, -(-queries // room), min(-(-4 * tasks // blocks), -(-queries // CHUNK)))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = asked.withColumn("batch", F.pmod(F.xxhash64("qid"), F.lit(batches)).cast("int")).withColumn("block", numbers(blocks))
    held = placed.withColumn("block", F.pmod(F.xxhash64("id", "x"), F.lit(blocks)).cast("int")).withColumn("batch", numbers(batches))
    asked = asked.select("block", "batch", "qid", "qx", "cell", "bound")
    held = held.select("block", "batch", "id", "x", "label", "cell")
    return _cogrouped(asked, held, ["block", "batch"], k, metric, apart=True)


_NAMES = ["ids", "distances", "labels"]


def _cogrouped(asked: DataFrame, held: DataFrame, keys: list[str], k: int, metric: str, apart: bool = False, every: bool = False) -> DataFrame:
    """The k nearest rows of the same group within the bound of each query, as (qid, qx, ids, distances, labels).

    Queries without any are left out, or kept with ``every``; ``apart`` leaves out rows of a query's own cell.
    """
    schema = to_arrow_schema(T.StructType.fromDDL(f"qid string, qx array<double>, {_NEAR}"))

    def search(q: pa.Table, r: pa.Table) -> pa.Table:
        if not len(q) or not (every or len(r)):
            return schema.empty_table()
        _, first = np.unique(q["qid"].to_numpy(), return_index=True)
        q, r = q.take(pa.array(first)), r.sort_by("id")
        if not len(r):
            sizes, flat, gaps = np.zeros(len(q), dtype=int), np.array([], dtype=int), np.array([])
        else:
            # farther rows cannot be among the k nearest: most visits of a later round give none
            bound = q["bound"].to_numpy()
            places, gaps = Boxes(_cells(r["x"]), FINE if len(q) * 8 > len(r) else LEAF // 2).nearest(_cells(q["qx"]), k, metric, bound)
            kept = (places < len(r)) & _within(gaps, bound[:, None])
            if apart:
                kept &= r["cell"].to_numpy()[np.minimum(places, len(r) - 1)] != q["cell"].to_numpy()[:, None]
            sizes, flat, gaps = kept.sum(axis=1), places[kept], gaps[kept]
        at = pa.array(flat)
        lists = [_lists(v, sizes) for v in (r["id"].combine_chunks().take(at), gaps, r["label"].combine_chunks().take(at))]
        out = pa.table([q["qid"], q["qx"], *lists], names=schema.names).cast(schema)
        return out if every else out.filter(pa.array(sizes > 0))

    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(search, f"qid string, qx array<double>, {_NEAR}")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of all found rows of each query, which come from disjoint parts of the reference."""
    own = [F.first("qx").alias("qx")] if "qx" in found.columns else []
    lists = found.groupBy("qid").agg(*own, F.collect_list(F.struct(*_NAMES)).alias("_all"))
    return lists.select("qid", *(["qx"] if own else []), *_nearest_of(F.col("_all"), k))


def _nearest_of(lists, k: int) -> list[Column]:
    """ids, distances and labels of the k nearest among several lists of rows, ties by id; a list may be null."""
    lists = F.array(*lists) if isinstance(lists, list) else lists
    rows = F.flatten(F.transform(lists, lambda n: F.when(n["ids"].isNotNull(), F.arrays_zip(n["distances"].alias("d"), n["ids"].alias("id"), n["labels"].alias("label"))).otherwise(F.array())))
    best = F.slice(F.array_sort(rows), 1, k)
    return [best["id"].alias("ids"), best["d"].alias("distances"), best["label"].alias("labels")]


def _bounds(distances: pa.Array, k: int) -> np.ndarray:
    """The k-th distance of every list; infinite where there are fewer."""
    sizes = np.diff(distances.offsets.to_numpy())
    out, full = np.full(len(distances), np.inf), sizes >= k
    out[full] = distances.values.to_numpy(zero_copy_only=False)[distances.offsets.to_numpy()[1:][full] - 1]
    return out


def _lists(values, sizes: np.ndarray) -> pa.ListArray:
    """A list column: the values in order, so many to each row."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))


def _cells(x: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of vectors as a matrix."""
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches as tables of at least so many rows, but the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _few_copies(x: np.ndarray, ids: pa.ChunkedArray, k: int) -> np.ndarray:
    """Places of the rows that stay if the k smallest ids stand for all rows of one vector."""
    odd = np.random.default_rng(0).integers(1 << 62, size=x.shape[1]) * 2 + 1
    key = (np.ascontiguousarray(x).view(np.int64) * odd).sum(axis=1)
    _, group, sizes = np.unique(key, return_inverse=True, return_counts=True)
    crowd = np.flatnonzero(sizes[group] > k)
    if not len(crowd):
        return np.arange(len(x))
    _, vector = np.unique(x[crowd], axis=0, return_inverse=True)  # keys of two vectors may agree
    order = np.asarray(pc.sort_indices(ids.take(pa.array(crowd))))
    order = order[np.argsort(vector.ravel()[order], kind="stable")]
    stays = np.ones(len(x), dtype=bool)
    stays[crowd[order[_rank(vector.ravel()[order]) >= k]]] = False
    return np.flatnonzero(stays)


def _within(least: np.ndarray, bound: np.ndarray) -> np.ndarray:
    # a hair of slack for rounding in the two distances
    return least <= bound * (1 + 1e-9) + 1e-12


def _written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe when executors go."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _discard(df: DataFrame) -> None:
    """Deletes the tables that ``_written`` made for ``df`` and that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _visit(
    visits: DataFrame, placed: DataFrame, cells: DataFrame, k: int, metric: str, block_rows: int, every: bool = False
) -> DataFrame:
    """Top k within the bound of every visit (qid, qx, cell, bound): (qid, qx, ids, distances, labels).

    A large cell's rows are spread over its blocks and the visits of a cell over batches, both
    by hash; one group is one block against one batch.
    """
    load = visits.groupBy("cell").agg(F.ceil(F.count("*") / (2 * block_rows)).cast("int").alias("batches"))
    plan = cells.select("cell", F.ceil(F.col("n") / (2 * block_rows)).cast("int").alias("blocks")).join(load, "cell")
    asked = (
        visits.join(F.broadcast(plan), "cell")
        .withColumn("batch", F.pmod(F.xxhash64("qid"), F.col("batches")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cell", "block", "batch", "qid", "qx", "bound")
    )
    held = (
        placed.join(F.broadcast(plan), "cell")
        .withColumn("block", F.pmod(F.xxhash64("id", "x"), F.col("blocks")).cast("int"))
        .withColumn("batch", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)))
        .select("cell", "block", "batch", "id", "x", "label")
    )
    return _cogrouped(asked, held, ["cell", "block", "batch"], k, metric, every=every)


# ------------------------------------------------------------------------- voting


def _weighted(neighbours: Column, k: int, weights: str) -> tuple[Column, Column]:
    """(labels, weights) of the first k neighbours; at distance 0 only exact hits count."""
    labels = F.slice(neighbours["labels"], 1, k)
    gaps = F.slice(neighbours["distances"], 1, k)
    if weights == "uniform":
        return labels, F.transform(gaps, lambda d: F.lit(1.0))
    exact = F.exists(gaps, lambda d: d == 0)
    return labels, F.when(
        exact, F.transform(gaps, lambda d: F.when(d == 0, 1.0).otherwise(0.0))
    ).otherwise(F.transform(gaps, lambda d: 1.0 / d))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def mean_vote(neighbours: Column, k: int, weights: str = "uniform") -> Column:
    labels, w = _weighted(neighbours, k, weights)
    return _total(F.zip_with(labels, w, lambda y, v: y * v)) / _total(w)


def class_shares(neighbours: Column, k: int, weights: str, classes: list[float]) -> Column:
    """Array of the weight share of every class."""
    labels, w = _weighted(neighbours, k, weights)

    def share(c: float) -> Column:
        own = F.zip_with(labels, w, lambda y, v: F.when(y == F.lit(c), v).otherwise(0.0))
        return _total(own) / _total(w)

    return F.array(*[share(c) for c in classes])


class _KnnParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "uniform or distance", TypeConverters.toString)
    metric = Param(Params._dummy(), "metric", "distance", TypeConverters.toString)
    classify = Param(Params._dummy(), "classify", "vote instead of mean", TypeConverters.toBoolean)
    idCol = Param(Params._dummy(), "idCol", "row key, breaks ties", TypeConverters.toString)
    broadcastBytes = Param(Params._dummy(), "broadcastBytes", "largest reference side sent whole", TypeConverters.toInt)
    blockRows = Param(Params._dummy(), "blockRows", "rows of a block of a cell", TypeConverters.toInt)


class NearestNeighbours(Estimator, _KnnParams, DefaultParamsReadable, DefaultParamsWritable):
    """The model is its training table, written to the shared folder."""

    @keyword_only
    def __init__(self, *, k=5, weights="uniform", metric="euclidean", classify=False, idCol="row_id",
                 broadcastBytes=BROADCAST_BYTES, blockRows=BLOCK_ROWS,
                 featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(k=5, weights="uniform", metric="euclidean", classify=False, idCol="row_id",
                         broadcastBytes=BROADCAST_BYTES, blockRows=BLOCK_ROWS)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "NearestNeighboursModel":
        path = scratch_path(df.sparkSession, "neighbours")
        label = col(self.getLabelCol()).cast("double")
        df.select(
            col(self.getOrDefault("idCol")).cast("string").alias("id"),
            vector_to_array(self.getFeaturesCol()).alias("x"),
            label.alias("label"),
        ).write.parquet(path)
        classes = []
        if self.getOrDefault("classify"):
            seen = df.sparkSession.read.parquet(path).select("label").distinct()
            classes = sorted(r["label"] for r in seen.collect())
        model = NearestNeighboursModel(path=path, classes=classes)
        return self._copyValues(model)


class NearestNeighboursModel(Model, _KnnParams, MLReadable, MLWritable):
    path = Param(Params._dummy(), "path", "training table", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "class values", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, path="", classes=None):
        super().__init__()
        self._setDefault(
            k=5, weights="uniform", metric="euclidean", classify=False, idCol="row_id", path="", classes=[],
            broadcastBytes=BROADCAST_BYTES, blockRows=BLOCK_ROWS,
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def reference(self, spark) -> DataFrame:
        return spark.read.parquet(self.getOrDefault("path"))

    def neighbours(self, df: DataFrame, k: int | None = None) -> DataFrame:
        """``df`` plus _id, _x and neighbours."""
        queries = df.withColumn("_id", col(self.getOrDefault("idCol")).cast("string")).withColumn(
            "_x", vector_to_array(self.getFeaturesCol())
        )
        return with_neighbours(
            queries, self.reference(df.sparkSession), k or self.getOrDefault("k"), self.getOrDefault("metric"),
            self.getOrDefault("broadcastBytes"), self.getOrDefault("blockRows"),
        )

    def vote(self, found: DataFrame, k: int, weights: str) -> DataFrame:
        near, out = F.col("neighbours"), self.getPredictionCol()
        if not self.getOrDefault("classify"):
            return found.withColumn(out, mean_vote(near, k, weights))
        classes = self.getOrDefault("classes")
        shares = found.withColumn("_shares", class_shares(near, k, weights, classes))
        best = F.array_position("_shares", F.array_max("_shares")).cast("int") - 1
        return (
            shares.withColumn("probability", array_to_vector("_shares"))
            .withColumn(out, F.array(*[F.lit(c) for c in classes])[best])
            .drop("_shares")
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        found = self.vote(self.neighbours(df), self.getOrDefault("k"), self.getOrDefault("weights"))
        return found.drop("_id", "_x", "neighbours")

    def write(self) -> MLWriter:
        return _KnnWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _KnnReader(cls)


class _KnnWriter(MLWriter):
    def __init__(self, instance: NearestNeighboursModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        self.instance.reference(spark).write.mode("overwrite").parquet(f"{path}/reference")


class _KnnReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> NearestNeighboursModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = NearestNeighboursModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._set(path=f"{path}/reference")


def neighbour_rows(found: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., rank, neighbour, distance, label): one row per neighbour."""
    near = F.arrays_zip(
        F.col("neighbours.ids").alias("neighbour"),
        F.col("neighbours.distances").alias("distance"),
        F.col("neighbours.labels").alias("label"),
    )
    return found.select(*[col(c) for c in keep], F.posexplode(near).alias("_p", "_n")).select(
        *[col(c) for c in keep], (F.col("_p") + 1).alias("rank"), "_n.*"
    )
