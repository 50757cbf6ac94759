"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, each quantised by its own ``k`` centroids, so ``2 k`` centroids make
``k * k`` cells. A query goes through pairs of centroids by the sum of their squared distances, with a
heap, until the cells met hold enough different vectors; all entries of these cells are then ranked by
their exact distance. k-means sees a bounded sample (``SAMPLE``, by a hash of the id); every vector is in
the index. How much is enough is measured on the same sample: the share of it that has to be met to
have ``RECALL`` of its true neighbours, and ``CANDIDATES`` vectors at least.

Cells with more than ``GROUP`` entries are split by a hash of the id, and so are the queries that meet in
a cell; each part yields its best, which are merged per query. So neither many copies of a vector nor
many queries of one make a large task.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows
without id, take no part; neither do vectors whose length is not the most frequent one (the shorter of
equals). A query is no candidate of its own, by id. Rows of one id are candidates each. Ties go to the
smaller id; a query with fewer candidates gets them all.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.tables import written

SAMPLE = 20_000
CANDIDATES = 1000
RECALL = 0.96
PER_CELL = 256
MOST_CENTROIDS = 1024
GROUP = 8192


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the vectors that take part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(fine)
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("embedding") == (sizes[0]["n"] if sizes else 0))


def matrix(array: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(array), -1) if len(array) else flat.reshape(0, 1)


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1), 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 3) -> np.ndarray:
    """Lloyd's algorithm from k different rows; an empty centroid moves to the farthest row."""
    x = np.unique(x, axis=0)
    start = np.random.default_rng(seed).permutation(len(x))[: min(k, len(x))]
    centroids = x[np.sort(start)].copy()
    for _ in range(rounds):
        d = _distances(x, centroids)
        near = d.argmin(1)
        n = np.bincount(near, minlength=len(centroids))
        sums = np.stack([np.bincount(near, x[:, j], minlength=len(centroids)) for j in range(x.shape[1])], axis=1)
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
        for c in np.flatnonzero(n == 0):
            moved[c] = x[d.min(1).argmax()]
        if np.allclose(moved, centroids):
            break
        centroids = moved
    return centroids


@dataclass(frozen=True)
class Codebook:
    """Centroids of both halves."""

    left: np.ndarray
    right: np.ndarray
    share: float = 1.0  # of all vectors that a query has to meet

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, left=self.left, right=self.right, share=self.share)
        return out.getvalue()

    @staticmethod
    def from_bytes(raw: bytes) -> Codebook:
        held = np.load(io.BytesIO(raw))
        return Codebook(held["left"], held["right"], float(held["share"]))

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.left.shape[1]
        return _distances(x[:, :cut], self.left), _distances(x[:, cut:], self.right) if x.shape[1] > cut else np.zeros((len(x), 1))

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * b.shape[1] + b.argmin(1)


def traverse(a: np.ndarray, b: np.ndarray) -> Iterator[int]:
    """Cells (row of a times len(b) plus row of b) by ascending ``a[i] + b[j]``: the multi-sequence walk."""
    by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    heap = [(a[by_a[0]] + b[by_b[0]], 0, 0)]
    done_in_row = np.zeros(len(a), dtype=int)
    seen = {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        done_in_row[i] = j + 1
        yield int(by_a[i] * len(b) + by_b[j])
        # A pair enters once both pairs before it have left.
        for p, q in ((i + 1, j), (i, j + 1)):
            ready = p < len(a) and q < len(b) and (p == 0 or done_in_row[p - 1] > q) and (q == 0 or done_in_row[p] >= q)
            if ready and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (a[by_a[p]] + b[by_b[q]], p, q))


def share_to_meet(book: Codebook, x: np.ndarray, top: int, recall: float, queries: int = 200) -> float:
    """The share of ``x`` in cells no farther than those of ``recall`` of the true ``top`` neighbours."""
    x = np.unique(x, axis=0)
    if len(x) < 2:
        return 1.0
    a, b = book.halves(x)
    i, j = a.argmin(1), b.argmin(1)
    shares = []
    for q in np.linspace(0, len(x) - 1, min(queries, len(x))).astype(int):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        to_cell = a[q][i] + b[q][j]
        near = np.argsort(d, kind="stable")[: min(top, len(x) - 1)]
        shares += [(to_cell <= to_cell[v]).mean() for v in near]
    return float(np.quantile(shares, recall))


def train(vectors: DataFrame, n: int, k: int, top: int = 10, recall: float = RECALL) -> Codebook:
    """The codebook of a bounded sample, trained in one task."""
    edge = min((1 << 63) - 1, int((1 << 64) * min(1.0, SAMPLE / max(n, 1))) - (1 << 63))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = [matrix(b.column(0)) for b in batches if b.num_rows]
        if x:
            x = np.concatenate(x)
            cut = max(1, x.shape[1] // 2)
            book = Codebook(kmeans(x[:, :cut], k), kmeans(x[:, cut:], k) if x.shape[1] > cut else np.zeros((1, 1)))
            book = replace(book, share=share_to_meet(book, x, top, recall))
            yield pa.RecordBatch.from_arrays([pa.array([book.to_bytes()], pa.binary())], ["book"])

    sample = vectors.where(F.xxhash64("vec_id") <= F.lit(edge)).select("embedding").repartition(1)
    row = sample.mapInArrow(run, "book binary").first()
    return Codebook.from_bytes(bytes(row[0])) if row else Codebook(np.zeros((1, 1)), np.zeros((1, 1)))


def search(vectors: DataFrame, is_query: Column, top: int = 10, candidates: int = CANDIDATES, recall: float = RECALL) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (Euclidean distance) of each query's nearest vectors found."""
    spark = vectors.sparkSession
    vectors = usable(vectors)
    n = vectors.count()
    k = int(np.clip(round((n / PER_CELL) ** 0.5), 2, MOST_CENTROIDS))
    book = train(vectors, n, k, top, recall)
    raw = book.to_bytes()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Codebook.from_bytes(raw)
        for batch in batches:
            cells = own.cells(matrix(batch.column(1))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), *batch.columns], ["cell", "vec_id", "embedding"])

    entries = written(vectors.mapInArrow(assign, "cell int, vec_id long, embedding array<double>"), "imi-entries")
    # Rows and different vectors of each cell: k * k rows at most.
    sizes = {r[0]: (r[1], r[2]) for r in entries.groupBy("cell", F.xxhash64("embedding").alias("h")).count().groupBy("cell").agg(F.sum("count"), F.count(F.lit(1))).collect()}
    shared = spark.sparkContext.broadcast(sizes)
    enough = max(candidates, book.share * sum(different for _, different in sizes.values()))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = Codebook.from_bytes(raw), shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = own.halves(matrix(batch.column(1)))
            at, cells = [], []
            for i in range(batch.num_rows):
                met = 0
                for cell in traverse(a[i], b[i]):
                    if cell in held:
                        at.append(i), cells.append(cell)
                        met += held[cell][1]
                        if met > enough:
                            break
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in batch.columns), pa.array(cells, pa.int32())], ["query_id", "query", "cell"])

    queries = entries.where(is_query).select("vec_id", "embedding")
    probes = written(queries.mapInArrow(probe, "query_id long, query array<double>, cell int"), "imi-probes")
    asked = {r[0]: r[1] for r in probes.groupBy("cell").count().collect()}
    parts = [(c, max(1, -(-sizes[c][0] // GROUP)), max(1, -(-asked[c] // GROUP))) for c in sorted(asked)]
    split = F.broadcast(spark.createDataFrame(parts, "cell int, entry_parts int, query_parts int"))  # k * k rows at most
    e = entries.join(split, "cell").select(
        "cell", F.pmod(F.xxhash64("vec_id"), "entry_parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("group"), "vec_id", "embedding",
    )
    q = probes.join(split, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("entry_parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("query_id"), "query_parts").cast("int").alias("group"), "query_id", "query",
    )

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            ids, x = left["vec_id"].to_numpy(), matrix(left["embedding"].combine_chunks())
            by_id = np.argsort(ids, kind="stable")
            ids, x = ids[by_id], x[by_id]
            asking, y = right["query_id"].to_numpy(), matrix(right["query"].combine_chunks())
            step = max(1, (1 << 21) // x.size)
            for at in range(0, len(asking), step):
                who = asking[at : at + step]
                d = np.sqrt(((x[None] - y[at : at + step, None]) ** 2).sum(2))
                d[who[:, None] == ids[None]] = np.inf
                best = np.argsort(d, axis=1, kind="stable")[:, :top]  # of equal distances the smaller id
                found = np.take_along_axis(d, best, 1)
                use = np.isfinite(found)
                out.append((np.repeat(who, use.sum(1)), ids[best][use], found[use]))
        return pa.table({c: np.concatenate(v) for c, v in zip(("query_id", "vec_id", "score"), zip(*out))})

    keys = ["cell", "part", "group"]
    found = e.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
