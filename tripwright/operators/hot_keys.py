"""Join many rows to one row per key when a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.session import written

# A key is hot above this share of all rows, so there are fewer than its inverse of them.
HOT_SHARE = 1 / 10_000


def join_per_key(
    rows: DataFrame, per_key: DataFrame, key: str, count: str, hot_share: float = HOT_SHARE
) -> DataFrame:
    """Left join of ``rows`` with ``per_key``, which holds each key once and its row ``count``.

    Rows of hot keys meet a broadcast of these keys, fewer than ``1 / hot_share`` by their
    definition, and are not shuffled; nor are rows without a key. The rows of all other keys take an
    ordinary shuffle join, in which no key is hot. ``per_key`` is stored once, since it is read for
    the total, the hot and the other keys.
    """
    per_key = written(per_key, "per-key")
    limit = (per_key.agg(F.sum(count)).head()[0] or 0) * hot_share
    values = [c for c in per_key.columns if c != key]
    hot = F.broadcast(per_key.where(F.col(count) > limit))
    columns = [*rows.columns, *values]
    spread = rows.join(hot.withColumn("is_hot", F.lit(True)), key, "left")
    kept = spread.where(F.col("is_hot") | F.col(key).isNull()).select(columns)
    others = rows.where(F.col(key).isNotNull()).join(hot.select(key), key, "left_anti")
    cold = others.join(per_key.where(F.col(count) <= limit), key, "left").select(columns)
    return kept.unionAll(cold)
