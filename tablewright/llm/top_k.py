"""Exact top-k inner products: vectors by falling length, rotated partial sums, bounds.

Vectors are whole numbers. An orthonormal rotation from the singular vectors of all of them
moves most of their length into the first coordinates. The inner product over these plus the
product of the remaining lengths (Cauchy-Schwarz) bounds the whole product; only pairs whose
bound reaches the query's k-th best score so far are computed exactly. A first round over the longest
vectors gives every query such a score; later blocks of vectors are read from the longest on
and left when length alone cannot reach it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cuts, range_of, stored

#: Vectors in a block, queries in a block, vectors compared in one step, ranges of length.
BLOCK, QUERIES, STEP, BANDS = 4096, 512, 512, 64
#: Longer vectors are not rotated; bounds hold in any orthonormal basis.
ROTATED = 1024
_LONG = (1 << 63) - 1


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows (vec_id, v, norm): floor(scale * x) of finite vectors, one row for each id."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    parts = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(finite).select(F.col("vec_id").cast("long"), parts.alias("v"))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    return rows.withColumn("norm", F.sqrt(square))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to one width."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, strongest first, from the summed width x width products."""
    if not 0 < width <= ROTATED:
        return np.eye(width)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0), width).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["cell", "x"])

    cells = vectors.select("v").mapInArrow(run, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x"))
    product = np.zeros(width * width)
    for row in cells.collect():  # width squared at most
        product[row["cell"]] = row["x"]
    if not np.isfinite(product).all():
        return np.eye(width)
    return np.linalg.eigh(product.reshape(width, width))[1][:, ::-1]


def _packed(rows: DataFrame, block: str, width: int, more: list[str]) -> DataFrame:
    """One row for each block: ids, whole-number matrix and further columns, longest first."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("norm", "descending"), ("vec_id", "ascending")])
        matrix = _matrix(table.column("v").combine_chunks(), width)
        columns = [table.column(c).to_numpy() for c in ("vec_id", *more)]
        data = [pa.array([c.tobytes()], type=pa.binary()) for c in (columns[0], matrix, *columns[1:])]
        longest = pa.array([float(table.column("norm")[0].as_py())])
        return pa.Table.from_arrays([table.column(block).slice(0, 1), longest, *data], [block, "longest", "ids", "matrix", *more])

    schema = f"{block} long, longest double, ids binary, matrix binary" + "".join(f", {c} binary" for c in more)
    return rows.select(block, "vec_id", "v", "norm", *more).groupBy(block).applyInArrow(run, schema)


class Best:
    """The k best (score, smallest id) of each query so far."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.astype(np.float64)
        self.query, self.ids, self.score = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query, ids = np.concatenate([self.query, query]), np.concatenate([self.ids, ids])
        score = np.concatenate([self.score, score])
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else query
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        kth = place == self.k - 1
        self.floor[query[kth]] = np.maximum(self.floor[query[kth]], score[kth].astype(np.float64))
        kept = place < self.k
        self.query, self.ids, self.score = query[kept], ids[kept], score[kept]


def _search(queries: np.ndarray, own: np.ndarray, floor: np.ndarray, vectors: np.ndarray, ids: np.ndarray, basis: np.ndarray, head: int, k: int) -> Best:
    """Best vectors of one block, which lies longest first, for a block of queries."""
    best = Best(floor, k)
    q, v = queries.astype(np.float64), vectors.astype(np.float64)
    qn, vn = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    small = qn.max(initial=0) * vn.max(initial=0) < 2.0**52  # sums of products are exact in doubles
    turned_q, turned_v = q @ basis, v @ basis
    rest_q = np.sqrt((turned_q[:, head:] ** 2).sum(axis=1))
    rest_v = np.sqrt((turned_v[:, head:] ** 2).sum(axis=1))
    slack = 1e-9  # of the product of lengths, far above the rounding of a rotated sum
    for at in range(0, len(ids), STEP):
        part = slice(at, at + STEP)
        open_ = np.flatnonzero(qn * vn[at] * (1 + slack) >= best.floor)
        if not len(open_):
            break
        lengths = qn[open_, None] * vn[None, part]
        bound = turned_q[open_, :head] @ turned_v[part, :head].T + rest_q[open_, None] * rest_v[None, part] + slack * lengths
        hit = bound >= best.floor[open_, None]
        hit &= ids[None, part] != own[open_, None]
        row, column = np.nonzero(hit)
        row, column = open_[row], column + at
        if not small:
            left, right = queries[row].astype(object), vectors[column].astype(object)
            exact = np.clip((left * right).sum(axis=1), -_LONG - 1, _LONG).astype(np.int64)
        elif 4 * len(row) > hit.size:
            exact = (q[open_] @ v[part].T)[hit].astype(np.int64)
        else:
            exact = np.einsum("ij,ij->i", q[row], v[column]).astype(np.int64)
        best.add(row, ids[column], exact)
    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, head: int = 16) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k highest scores of every query, all if fewer.

    Every query meets every other row; ties go to the smaller vec_id. Rows with a null vec_id,
    a null vector or one that holds null or a non-finite number take no part. Vectors of
    different lengths are filled up with zeros. Of rows of one vec_id the smallest vector (in array
    order) counts. Scores beyond a long are cut to its ends. An empty table gives no rows.
    """
    rows = stored(whole_vectors(vectors, scale), "vectors")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.count(F.when(is_query, 1)).alias("q")).first()
    width = facts["width"] or 0
    basis = rotation(rows, width)
    at = cuts(rows, "norm", min(BANDS, -(-facts["n"] // BLOCK)))
    banded = rows.withColumn("band", range_of(F.col("norm"), at))
    counts = {r["band"]: r["count"] for r in banded.groupBy("band").count().collect()}
    parts = [max(1, -(-counts.get(b, 0) // BLOCK)) for b in range(len(at) + 1)]
    before = [sum(parts[:b]) for b in range(len(parts))]
    number = F.get(F.lit(before), F.col("band")) + F.pmod(F.xxhash64("vec_id"), F.get(F.lit(parts), F.col("band")))
    blocks = stored(_packed(banded.withColumn("block", number.cast("long")), "block", width, []), "blocks")
    lengths, none = blocks.select("block", "longest"), float("-inf")
    asked = rows.where(is_query).withColumn("asked", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-facts["q"] // QUERIES)))).cast("long"))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q_ids, q, floor, ids, v in zip(*(batch.column(i).to_pylist() for i in range(5))):
                own, ids = np.frombuffer(q_ids, dtype=np.int64), np.frombuffer(ids, dtype=np.int64)
                q, v = np.frombuffer(q, dtype=np.int64).reshape(len(own), width), np.frombuffer(v, dtype=np.int64).reshape(len(ids), width)
                best = _search(q, own, np.frombuffer(floor), v, ids, basis, head, k)
                yield pa.RecordBatch.from_arrays([pa.array(own[best.query]), pa.array(best.ids), pa.array(best.score)], ["query_id", "vec_id", "score"])

    def over(questions: DataFrame, first: int, last: int) -> DataFrame:
        """Scores of blocks of queries against those of the blocks numbered first to last that are long enough."""
        q = _packed(questions, "asked", width, ["floor"]).select("asked", F.col("ids").alias("q_ids"), F.col("matrix").alias("q"), "floor")
        least = F.when(F.col("norm") > 0, F.col("floor") / F.col("norm")).otherwise(F.lit(none))
        wanted = questions.groupBy("asked").agg(F.min(least).alias("least"))
        wanted = wanted.withColumn("block", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))))
        wanted = wanted.join(lengths, "block").where(F.col("longest") * (1 + 1e-9) >= F.col("least")).select("asked", "block")
        met = wanted.join(q, "asked").join(blocks.drop("longest"), "block").select("q_ids", "q", "floor", "ids", "matrix")
        return met.mapInArrow(search, "query_id long, vec_id long, score long")

    def best_of(scores: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    top = before[-1]  # the blocks of the longest band come first
    started = stored(best_of(over(asked.withColumn("floor", F.lit(none)), top, top + parts[-1] - 1)), "first-scores")
    scores = started.select("query_id", "vec_id", "score")
    if top:
        floors = started.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
        questions = asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(none)))
        scores = scores.unionByName(over(questions, 0, top - 1))
    return best_of(scores).select("query_id", "rank", "vec_id", "score")
