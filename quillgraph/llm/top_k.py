"""Exact top-k inner products by distributed histogram selection.

Every round scores all candidates against a block of queries, builds a global histogram of the scores
inside each query's current interval and keeps the bin that holds the kth value. When few scores are
left (or the interval is one score wide) a last pass filters by the found bound and ties are broken by
the smaller id.

Defined results: vectors that are null, or hold null, NaN or infinite components, take no part, nor do
rows without an id; vectors only meet vectors of the same length; ties go to the smaller id; rows that
repeat a query's id are its own and never its neighbours; an empty table gives no rows; other columns
are ignored. A query with fewer than k candidates gets all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import keep

BINS = 1024
#: Queries whose vectors and bounds are held by the driver and sent to executors at once.
QUERY_BLOCK = 2048
LONG = 2**63 - 1


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v array<long>) with v = floor(scale * x); native, drops rows that take no part."""
    x = F.transform(F.col(embedding), lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).filter(F.coalesce(fine, F.lit(False)))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale)).alias("v"))


def _matrices(ids: np.ndarray, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and the matrix, for each length of vector."""
    offsets = np.asarray(vectors.offsets, np.int64)
    flat = np.asarray(vectors.flatten(), np.int64)
    offsets = offsets - offsets[0]
    lengths = np.diff(offsets)
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[offsets[rows][:, None] + np.arange(d)]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; results beyond 64 bits are clipped to the range of long."""
    most = lambda m: max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    bound = most(a) * most(b) * max(1, a.shape[1])
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -LONG, LONG).astype(np.int64)


class _Block:
    """A block of queries with the interval [low, high) in which each kth score lies."""

    def __init__(self, ids: list[int], vectors: list[list[int]], k: int, reach: int, bins: int = BINS):
        self.ids, self.k, self.bins = np.asarray(ids, np.int64), k, bins
        self.parts = []
        lengths = np.asarray([len(v) for v in vectors])
        for d in np.unique(lengths):
            rows = np.flatnonzero(lengths == d)
            self.parts.append((rows, np.asarray([vectors[i] for i in rows], np.int64).reshape(len(rows), d)))
        norms = [int(sum(x * x for x in map(int, v)) ** 0.5) + 2 for v in vectors]
        bound = [min(LONG, n * reach) for n in norms]
        self.low = np.asarray([-b for b in bound], object)
        self.high = np.asarray([b + 1 for b in bound], object)
        self.above = np.zeros(len(ids), np.int64)
        self.open = np.ones(len(ids), bool)

    def width(self) -> np.ndarray:
        return np.asarray([max(1, -(-(h - l) // self.bins)) for l, h in zip(self.low, self.high, strict=True)], object)

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query rows, candidate ids, scores with a row per query); a query's own row is marked by the mask later."""
        for batch in batches:
            ids = np.asarray(batch.column(0), np.int64)
            for rows, matrix in _matrices(ids, batch.column(1)):
                for queries, own in self.parts:
                    if own.shape[1] == matrix.shape[1]:
                        step = max(1, 4_000_000 // max(1, len(queries)))
                        for i in range(0, len(rows), step):
                            yield queries, ids[rows[i : i + step]], _product(own, matrix[i : i + step])


def _histogram(block: _Block):
    low = np.asarray([int(x) for x in block.low], np.int64)
    width = np.asarray([int(min(x, LONG)) for x in block.width()], np.int64)
    last = np.asarray([int(h) - 1 for h in block.high], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(block.ids), block.bins), np.int64)
        for queries, ids, scores in block.scored(batches):
            lo, w, hi = low[queries][:, None], width[queries][:, None], last[queries][:, None]
            inside = (scores >= lo) & (scores <= hi) & (ids[None, :] != block.ids[queries][:, None])
            # unsigned difference: the interval may be wider than the range of long
            b = (scores.astype(np.uint64) - lo.astype(np.uint64)) // w.astype(np.uint64)
            flat = (queries[:, None] * block.bins + np.minimum(b, block.bins - 1).astype(np.int64))[inside]
            counts += np.bincount(flat, minlength=counts.size).reshape(counts.shape)
        # bins below a task's own kth value cannot hold the global one
        need = np.maximum(block.k - block.above, 1)[:, None]
        higher = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (higher < need) & block.open[:, None])
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[q, b], pa.int64())], ["q", "bin", "n"])

    return run


def _finish(block: _Block):
    low = np.asarray([int(x) for x in block.low], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for queries, ids, scores in block.scored(batches):
            hit = (scores >= low[queries][:, None]) & (ids[None, :] != block.ids[queries][:, None])
            for r in np.flatnonzero(hit.any(axis=1)):
                q, (s0, i0) = int(queries[r]), best.get(int(queries[r]), (np.zeros(0, np.int64),) * 2)
                s, i = np.concatenate([s0, scores[r][hit[r]]]), np.concatenate([i0, ids[hit[r]]])
                order = np.lexsort((i, -s))[: block.k]
                best[q] = s[order], i[order]
        q = np.concatenate([np.full(len(s), q) for q, (s, _) in best.items()] or [np.zeros(0)]).astype(np.int32)
        s = np.concatenate([s for s, _ in best.values()] or [np.zeros(0)]).astype(np.int64)
        i = np.concatenate([i for _, i in best.values()] or [np.zeros(0)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s)], ["q", "vec_id", "score"])

    return run


def _select(candidates: DataFrame, block: _Block) -> DataFrame:
    spark = candidates.sparkSession
    while block.open.any():
        sent = spark.sparkContext.broadcast(block)
        counts = candidates.mapInArrow(lambda b: _histogram(sent.value)(b), "q int, bin int, n long")
        counts = counts.groupBy("q", "bin").agg(F.sum("n").alias("n"))
        needed = spark.createDataFrame([(i, int(block.k - block.above[i])) for i in np.flatnonzero(block.open).tolist()], "q int, need long")
        down = W.partitionBy("q").orderBy(F.desc("bin"))
        cut = counts.withColumn("upto", F.sum("n").over(down.rowsBetween(W.unboundedPreceding, 0))).join(F.broadcast(needed), "q")
        # at most one row for each query of the block; without a kth value its lowest bin
        found = cut.groupBy("q").agg(F.max(F.when(F.col("upto") >= F.col("need"), F.struct("bin", "n", "upto"))).alias("hit")).collect()
        width, seen = block.width(), set()
        for row in found:
            if row.hit is None:
                continue
            q, seen = row.q, seen | {row.q}
            lower = block.low[q] + row.hit.bin * width[q]
            block.low[q], block.high[q] = lower, min(block.high[q], lower + width[q])
            block.above[q] += row.hit.upto - row.hit.n
            block.open[q] = width[q] > 1 and row.hit.n > 4 * block.k
        for q in np.flatnonzero(block.open).tolist():
            if q not in seen:  # fewer than k candidates: take all
                block.open[q] = False
        sent.unpersist()
    sent = spark.sparkContext.broadcast(block)
    last = candidates.mapInArrow(lambda b: _finish(sent.value)(b), "q int, vec_id long, score long")
    rank = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ids = spark.createDataFrame([(i, int(x)) for i, x in enumerate(block.ids)], "q int, query_id long")
    ranked = last.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= block.k)
    return ranked.join(F.broadcast(ids), "q").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k(vectors: DataFrame, is_query, k: int = 5, query_block: int = QUERY_BLOCK, bins: int = BINS, **columns) -> DataFrame:
    """The k best candidates of every query row: query_id, rank, vec_id, score.

    is_query: a condition on vec_id. Queries go in hashed blocks of about query_block rows, so what the
    driver and a broadcast hold is bounded; every block scores all rows."""
    rows = quantised(vectors, **columns)
    spark = rows.sparkSession
    queries = rows.filter(is_query)
    square = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    reach = rows.agg(F.max(square)).first()[0]
    n = queries.count()
    blocks = max(1, -(-n // query_block))
    out = None
    if blocks > 1:  # quantised once for all passes
        rows = keep(rows)
        queries = rows.filter(is_query)
    for b in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect() if n else []
        if block:
            held = _Block([r.vec_id for r in block], [r.v for r in block], k, int(reach**0.5) + 2, bins)
            part = keep(_select(rows, held))
            out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
