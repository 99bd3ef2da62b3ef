"""Exact nearest neighbours by a block matrix join over int8 tiles.

Vectors are packed into blocks of rows. Query and candidate blocks meet on a grid: a
candidate block goes to one column per group of query blocks and the other way round, so
blocks travel, not pairs. In a tile, int8 products give every inner product up to a bound on
the quantisation error; only pairs that can still enter a query's current heap are computed
again from the original vectors in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

BLOCK = 1024
# Blocks on either side of one tile.
TILE_QUERIES, TILE_CANDIDATES = 2, 16


def usable(vector: str) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scale per row, and the length of the rounding error per row."""
    scale = np.abs(rows).max(axis=1) / 127
    scale[scale == 0] = 1  # a denormal row: all codes are zero, all of it is error
    codes = np.rint(rows / scale[:, None])
    error = np.sqrt(((rows - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes.astype(np.int8), scale, error


def _pack(rows: DataFrame, block: int) -> DataFrame:
    """(b, dim, ids, data): ``block`` rows of one dimension as bytes; b numbers the blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, tuple[list, list]] = {}

        def packed(dim):
            ids, data = open_blocks.pop(dim)
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "ids": [np.array(ids, dtype=np.int64).tobytes()],
                "data": [np.array(data, dtype=np.float64).tobytes()]})

        for batch in batches:
            for i, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, data = open_blocks.setdefault(len(vector), ([], []))
                ids.append(i)
                data.append(vector)
                if len(ids) == block:
                    yield packed(len(vector))
        for dim in list(open_blocks):
            yield packed(dim)

    blocks = rows.mapInArrow(run, "dim int, ids binary, data binary")
    return stored(blocks.withColumn("b", F.monotonically_increasing_id()), "blocks")


def tile_top(queries: list, candidates: list, dim: int, k: int):
    """Rows (query_id, score, vec_id) of the ``k`` best of a tile for each of its queries."""
    for qids, qdata in queries:
        q = np.frombuffer(qdata, dtype=np.float64).reshape(-1, dim)
        qi = np.frombuffer(qids, dtype=np.int64)
        heaps: list[list] = [[] for _ in qi]
        qc, qs, qe = quantise(q)
        qf = qc.astype(np.float32)
        qn = np.sqrt((q * q).sum(axis=1))
        floor = np.full(len(qi), -np.inf)
        for cids, cdata in candidates:
            c = np.frombuffer(cdata, dtype=np.float64).reshape(-1, dim)
            ci = np.frombuffer(cids, dtype=np.int64)
            cc, cs, ce = quantise(c)
            # float32 holds sums of int8 products exactly up to 2**24, which is 1,040 dimensions.
            exact = qf @ cc.astype(np.float32).T if dim <= 1040 else qc.astype(np.float64) @ cc.T.astype(np.float64)
            near = exact * (qs[:, None] * cs[None, :])
            cn = np.sqrt((c * c).sum(axis=1))
            # |qc - q'c'| <= |q||e_c| + |e_q||c'| for the rounded q', c'; the rest is float rounding.
            bound = (qn[:, None] * ce[None, :] + qe[:, None] * (cn + ce)[None, :]
                     + 1e-9 * qn[:, None] * cn[None, :]) * (1 + 1e-9)
            same = qi[:, None] == ci[None, :]
            low = np.where(same, -np.inf, near - bound)
            if low.shape[1] >= k:
                kth = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
            else:
                kth = np.full(len(qi), -np.inf)
            alive = (near + bound >= np.maximum(floor, kth)[:, None]) & ~same
            at_q, at_c = np.nonzero(alive)
            score = np.empty(len(at_q))
            for s in range(0, len(at_q), 65536):
                e = s + 65536
                score[s:e] = (q[at_q[s:e]] * c[at_c[s:e]]).sum(axis=1)
            for i, x, j in zip(at_q.tolist(), score.tolist(), ci[at_c].tolist()):
                entry, heap = (x, -j), heaps[i]
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
            floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
        for i, heap in zip(qi.tolist(), heaps):
            yield from ((i, x, -j) for x, j in heap)


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query.

    Exact: every candidate but rows with the query's own id is considered, fewer than ``k``
    are returned only if there are no more. Ties go to the smaller vec_id. Rows with a null
    id or with vectors null, empty, zero or holding null or non-finite components take no part;
    vectors of different lengths never meet. Repeated query rows count once, repeated
    candidate ids once per different vector. Empty tables give an empty result; other
    columns are ignored.
    """
    def side(frame: DataFrame, per_tile: int) -> DataFrame:
        rows = frame.select(F.col(id_col).cast("long").alias("id"),
                            F.col(vector_col).cast("array<double>").alias("v"))
        rows = rows.where(F.col("id").isNotNull() & usable("v"))
        blocks = _pack(rows, block)
        sizes = blocks.groupBy("dim").agg(F.ceil(F.count("*") / per_tile).alias("groups"))
        dealt = F.pmod(F.xxhash64("b"), F.col("groups")).alias("g")
        return stored(blocks.join(sizes, "dim").select("dim", "ids", "data", "groups", dealt), "grouped")

    left, right = side(queries, TILE_QUERIES), side(candidates, TILE_CANDIDATES)
    columns = right.select("dim", F.col("groups").alias("columns")).distinct()
    rows = left.select("dim", F.col("groups").alias("rows")).distinct()
    grid = "dim", "r", "c", "side", "ids", "data"
    sent = left.join(columns, "dim").withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))).select(
        "dim", F.col("g").alias("r"), "c", F.lit(0).alias("side"), "ids", "data")
    sent = sent.select(*grid).union(right.join(rows, "dim").withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).select(
        "dim", "r", F.col("g").alias("c"), F.lit(1).alias("side"), "ids", "data"))

    def tile(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sides: tuple[list, list] = ([], [])
        for s, ids, data in zip(*(table.column(n).to_pylist() for n in ("side", "ids", "data"))):
            sides[s].append((ids, data))
        out = list(tile_top(*sides, key[0].as_py(), k))
        return pa.table({"query_id": pa.array([o[0] for o in out], pa.int64()),
                         "score": pa.array([o[1] for o in out], pa.float64()),
                         "vec_id": pa.array([o[2] for o in out], pa.int64())})

    found = sent.groupBy("dim", "r", "c").applyInArrow(tile, "query_id long, score double, vec_id long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""
