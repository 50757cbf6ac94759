"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.tables import written


def _star(pairs: DataFrame) -> DataFrame:
    """For each ``u`` its smallest neighbour or itself, joined to its neighbours ``v``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return pairs.join(least, "u")


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node of ``edges`` (``a``, ``b``).

    Each round points all larger neighbours of a node to its smallest one, then all smaller ones; rounds
    end when the edges no longer change. Edges stay in tables: rounds grow with the logarithm of the size.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), label)
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large)
        out = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = written(out.where("u <> v").distinct(), label)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
