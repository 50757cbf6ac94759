"""Filter interaction audit: what each of several filters removes in every order they can run in.

Each document gets a mask with a bit for every filter it fails. The masks of a part are counted and turned
into an ordered decision diagram: a level per filter, a low edge for passing and a high edge for failing it,
equal subdiagrams shared, every node weighted with the documents below it. Another order of the filters is
reached by swapping adjacent levels, which touches two levels only; plain changes run through all orders
with one swap each. The path of low edges from the root is the documents that pass everything so far: at
each step the low child's weight is what is kept, the high child's what is removed.

The work on texts is one scan; documents then travel as id, part, mask and a 256-bit digest of the text.
Groups of equal texts are counted before each shuffle, so neither a text nor a part nor an id is a hot key;
a diagram gets 128 rows at most (32 masks, two labels).

Defined cases: a null text is empty, a null language the part ``''``. An id that is null counts as larger than
all others (two null ids are equal), and has no label. Several labels of one id count as their largest. Rows that
are repeated count each. A part without rows has none in the result; an empty table gives an empty result.
Other columns of the tables are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm import words as W

FILTERS = "ABCDE"
MIN_WORDS = 200
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#$%&*|")] = True

Weight = tuple[int, ...]


def failures(texts: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Bits of the filters A to D that each text fails (A is 1, B 2, C 4, D 8), and the text's digest."""
    w = W.words(texts)
    hashes, n = w.hashes(), w.counts()
    begin = np.concatenate(([0], np.cumsum(n)))
    different = np.zeros(w.n_docs, dtype=np.int64)
    for i in np.flatnonzero(n).tolist():
        own = np.sort(hashes[begin[i] : begin[i + 1]])
        different[i] = 1 + np.count_nonzero(own[1:] != own[:-1])

    def counted(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[w.offsets[1:]] - sums[w.offsets[:-1]]

    points = counted((w.data & 0xC0) != 0x80)
    fails = (n < MIN_WORDS, 100 * different < 50 * n, 100 * counted(_UPPER[w.data]) > 3 * points, counted(_SYMBOL[w.data]) > 0)
    body, at = memoryview(np.ascontiguousarray(w.data)), w.offsets.tolist()
    digests = [hashlib.sha256(body[a:b]).digest() for a, b in zip(at, at[1:])]
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails)), digests


def masks(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` of the filters that need the text alone, and ``digest`` of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in W.blocks(batches, "text"):
            mask, digest = failures(W.column(block, "text"))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), pa.array(mask, pa.int32()), pa.array(digest, pa.binary())],
                ["doc_id", "part", "mask", "digest"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def counted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` of all five filters, ``n``, ``good`` and ``toxic`` documents: at most 32 rows a part."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    rows = masks(docs).groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("rows"))
    rows = rows.join(known, "doc_id", "left").select(
        "doc_id", "part", "mask", "digest", "rows", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic"))
    )
    # Of each group of equal texts: how many, its smallest id (null last), and how many have that id.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rows")).alias("first")
    same = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(F.sum("rows").alias("n"), first)
    # A text has at most 4 such groups in each part.
    text = Window.partitionBy("digest")
    smallest = F.min(F.struct("first.last", "first.doc_id")).over(text)
    originals = F.when(F.struct("first.last", "first.doc_id").eqNullSafe(F.col("smallest")), F.col("first.rows")).otherwise(0)
    split = same.withColumn("smallest", smallest).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask").alias("mask"), originals.alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(16)).alias("mask"), (F.col("n") - originals).alias("n")),
        )),
    )
    return split.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def plain_changes(n: int) -> Iterator[int]:
    """Positions i to swap with i + 1, one after the other, that run through all orders of n things."""
    if n < 2:
        return
    inner, down = plain_changes(n - 1), True
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        at = next(inner, None)
        if at is None:
            return
        yield at + 1 if down else at
        down = not down


class Diagram:
    """An ordered decision diagram whose terminals are weights; no level is skipped, equal nodes are one."""

    def __init__(self, weights: dict[int, Weight], n: int) -> None:
        """weights: of each mask, in which bit i stands for variable i."""
        nothing = (0,) * len(next(iter(weights.values())))
        self.order = list(range(n))
        values = [weights.get(sum(1 << i for i in range(n) if row >> (n - 1 - i) & 1), nothing) for row in range(1 << n)]
        ends: dict[Weight, int] = {}
        ids = [ends.setdefault(v, len(ends)) for v in values]
        self.weight: list[list[Weight]] = [[] for _ in range(n)] + [list(ends)]
        self.nodes: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # low and high child in the next level
        for level in reversed(range(n)):
            table: dict[tuple[int, int], int] = {}
            ids = [table.setdefault(pair, len(table)) for pair in zip(ids[::2], ids[1::2])]
            self._put(level, table)

    def _put(self, level: int, table: dict[tuple[int, int], int]) -> None:
        below = self.weight[level + 1]
        self.nodes[level] = list(table)
        self.weight[level] = [tuple(a + b for a, b in zip(below[low], below[high])) for low, high in table]

    def swap(self, level: int) -> None:
        """Exchanges the variables of this level and the next; all other levels stay as they are."""
        table: dict[tuple[int, int], int] = {}
        below, pairs = self.nodes[level + 1], []
        for low, high in self.nodes[level]:
            (ll, lh), (hl, hh) = below[low], below[high]
            pairs.append((table.setdefault((ll, hl), len(table)), table.setdefault((lh, hh), len(table))))
        self._put(level + 1, table)
        self.nodes[level] = pairs
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self) -> Iterator[tuple[int, Weight, Weight, Weight]]:
        """At each level of the all-pass path: its variable, the weight kept, removed, and failing this variable only."""
        node = 0
        for level, variable in enumerate(self.order):
            low, high = self.nodes[level][node]
            alone = high
            for below in range(level + 1, len(self.order)):
                alone = self.nodes[below][alone][0]
            yield variable, self.weight[level + 1][low], self.weight[level + 1][high], self.weight[-1][alone]
            node = low

    def failing(self) -> Weight:
        """Weight that fails the first variable."""
        return self.weight[1][self.nodes[0][0][1]]


def steps(weights: dict[int, Weight], filters: Sequence[str] = FILTERS) -> list[tuple]:
    """Order, step, filter, kept, removed, failing only this filter (weights each), for every order of the filters;
    and for each row all documents that fail the filter, and the filter's removals summed over all orders."""
    diagram = Diagram(weights, len(filters))
    rows, failing, removals = [], {}, dict.fromkeys(range(len(filters)), 0)
    changes = plain_changes(len(filters))
    while True:
        name = "".join(filters[v] for v in diagram.order)
        failing[diagram.order[0]] = diagram.failing()
        for step, (variable, kept, removed, alone) in enumerate(diagram.all_pass(), 1):
            removals[variable] += removed[0]
            rows.append((name, step, variable, kept, removed, alone))
        at = next(changes, None)
        if at is None:
            return [(name, step, filters[v], kept, removed, alone, failing[v], removals[v]) for name, step, v, kept, removed, alone in rows]
        diagram.swap(at)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step; see ``steps``."""
    fields = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

    def run(group: pa.Table) -> pa.Table:
        held = group.to_pydict()
        weights = {m: (n, g, t) for m, n, g, t in zip(held["mask"], held["n"], held["good"], held["toxic"])}
        out = [
            (held["part"][0], order, step, kept[0], removed[0], failing[0] - removed[0], alone[0], removed[1], removed[2], total)
            for order, step, _, kept, removed, alone, failing, total in steps(weights)
        ]
        columns = list(zip(*out))
        return pa.table({
            "part": pa.array(columns[0], pa.string()), "filter_order": pa.array(columns[1], pa.string()), "step": pa.array(columns[2], pa.int32()),
            **{c: pa.array(v, pa.int64()) for c, v in zip(fields, columns[3:])},
        })

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in fields)
    return counted(docs, labels).groupBy("part").applyInArrow(run, schema)
