"""Exact top-k search by Fagin's threshold algorithm over sorted per-dimension lists.

Every component becomes the integer floor(1024 x); the score is the inner product of integers. Vectors are dealt
by a hash of their id to shards of about ``SHARD``. A shard keeps a list of its vectors for each
dimension, sorted by the component. For a query all lists are walked together from the end that the sign of the
query's component favours, a stretch of positions at a time; vectors met for the first time are scored at
once. No vector below the walked stretch can score more than the sum of the query's components times the next
components of its lists. When that bound is below the k-th best score so far, the walk ends: nothing is missed, as ties
with the k-th score go on. A first walk over one shard gives each query a score to begin with, which its k-th best
over all vectors cannot fall below; so all other shards can stop earlier.

Queries meet shards in blocks of ``BLOCK`` queries; each such meeting yields k rows a query, merged at the end. Shards
and blocks are dealt by hashes, so neither copies of a vector nor a frequent id make a large task.

Defined cases: vectors that are null or hold a null or non-finite component, and rows without id, take no part;
an empty or zero vector does, with score 0. Components that a shorter vector lacks count as 0. A query is no candidate of its own, by id.
Rows of one id are candidates each; of several query rows with one id the least vector (compared component by component) asks.
Ties go to the smaller id. With fewer than k candidates all are returned. Scores that could pass 64 bits are an
error. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.tables import written

SCALE = 1024
SHARD = 8192
BLOCK = 256
#: Positions of each list walked before the bound is looked at again; later stretches are longer.
FIRST_STRETCH = 16
_NONE = -(1 << 63)


def integers(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``x`` (whole numbers) of the vectors that take part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & fine).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


def matrix(rows: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Lists of whole numbers as a matrix of ``width`` columns at least; what a list lacks is 0."""
    lists = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), max(width, int(size.max(initial=0)))), dtype=np.int64)
    out[np.repeat(np.arange(len(lists)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
    return out


class Lists:
    """Some vectors with, for each dimension, the list of their positions sorted by the component."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        by_id = np.argsort(ids, kind="stable")  # so that of equal scores the smaller id comes first
        self.ids, self.x = ids[by_id], x[by_id]
        self.most = np.abs(self.x).max(axis=0, initial=0)
        self.up = np.argsort(self.x, axis=0, kind="stable").astype(np.int32)

    def _products(self, rows: np.ndarray | slice, query: np.ndarray) -> np.ndarray:
        """Inner products, exact: in doubles, which are faster, only where every partial sum fits into 53 bits."""
        largest = sum(int(a) * int(b) for a, b in zip(self.most, np.abs(query)))
        if largest < 1 << 53:
            return (self.x[rows].astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
        if largest >= 1 << 63:
            raise OverflowError("inner products of these vectors do not fit into 64 bits")
        return self.x[rows] @ query

    def best(self, own: int, query: np.ndarray, k: int, least: int = _NONE) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and scores of the k best but ``own`` that reach ``least``, best first; and how many vectors were scored."""
        n = len(self.ids)
        dims = np.flatnonzero(query)
        weights = query[dims]
        seen = self.ids == own
        met, scores, scored = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        begin, stretch = 0, FIRST_STRETCH
        while begin < n:
            end = min(n, begin + stretch)
            if len(dims):
                ranks = np.arange(begin, end)[:, None]
                at = np.where(weights > 0, n - 1 - ranks, ranks)
                found = np.zeros(n, dtype=bool)
                found[self.up[at, dims]] = True
                new = np.flatnonzero(found & ~seen)
            else:
                new, end = np.flatnonzero(~seen), n
            seen[new] = True
            scored += len(new)
            score = self._products(new, query)
            keep = score >= least
            met, scores = np.concatenate([met, new[keep]]), np.concatenate([scores, score[keep]])
            order = np.lexsort((met, -scores))[:k]
            met, scores = met[order], scores[order]
            if len(met) == k:
                least = max(least, int(scores[-1]))
            if seen.all():
                break
            if end < n:
                edge = self.x[self.up[np.where(weights > 0, n - 1 - end, end), dims], dims]
                if int(self._edge(edge, weights)) < least:
                    break
            begin, stretch = end, stretch * 2
        return met, scores, scored

    @staticmethod
    def _edge(edge: np.ndarray, weights: np.ndarray) -> int:
        return sum(int(a) * int(b) for a, b in zip(edge, weights))


def search(vectors: DataFrame, is_query: Column, top: int = 10, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the vectors with the largest inner products with each query."""
    spark = vectors.sparkSession
    rows = written(integers(vectors), "topk-vectors")
    asking = rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("x").alias("query"))
    asking = written(asking, "topk-queries")
    n, n_queries = rows.count(), asking.count()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-n_queries // block))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "x"), F.lit(shards)).cast("int"))
    asking = asking.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if left.num_rows and right.num_rows:
            x = matrix(left["x"])
            y = matrix(right["query"], x.shape[1])
            lists = Lists(left["vec_id"].to_numpy(), np.pad(x, ((0, 0), (0, y.shape[1] - x.shape[1]))))
            least = right["least"].to_numpy()
            for i, asked in enumerate(right["query_id"].to_numpy().tolist()):
                met, score, _ = lists.best(asked, y[i], top, int(least[i]))
                out.append((np.full(len(met), asked), lists.ids[met], score))
        return pa.table({c: np.concatenate(v) for c, v in zip(("query_id", "vec_id", "score"), zip(*out))})

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def meet(own: DataFrame, queries: DataFrame, n_shards: int) -> DataFrame:
        """The best of these shards for every query: a group is a shard and a block of queries."""
        keys = ["shard", "block"]
        left = own.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rank, "query_id long, vec_id long, score long")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    open_ = asking.withColumn("least", F.lit(_NONE))
    if shards > 1:
        first = meet(rows.where("shard = 0"), open_, 1)
        reached = first.where(F.col("rank") == top).select("query_id", F.col("score").alias("least"))
        open_ = written(asking.join(reached, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(_NONE))), "topk-floors")
    return meet(rows, open_, shards).select("query_id", "rank", "vec_id", "score")
