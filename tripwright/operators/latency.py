"""Percentiles of the newest samples per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripwright.operators.hot_keys import join_per_key
from tripwright.session import written

NEWEST = 200
TARGET_P95 = 100.0
_SALTS = 64
_ACCURACY = 10000
# Values of a key that one task may walk over, and slices that a round cuts a bracket into.
_WALK = 4096
_SLICES = 1024


def newest_per_key(
    samples: DataFrame, key: str, *order: str, n: int = NEWEST, salts: int = _SALTS
) -> DataFrame:
    """The ``n`` newest rows of each key, newest meaning last in the given order.

    Both row-number filters run in part before their shuffle, so a task sends at most n rows per
    key and salt. The salted first step keeps a key that holds much of the table from meeting in
    one task; the second sees at most ``n * salts`` rows per key.
    """
    latest_first = [F.desc(c) for c in order]
    salted = samples.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    first = W.partitionBy(key, "salt").orderBy(*latest_first)
    second = W.partitionBy(key).orderBy(*latest_first)
    return (
        salted.withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= n)
        .drop("rank", "salt")
        .withColumn("rank", F.row_number().over(second))
        .where(F.col("rank") <= n)
        .drop("rank")
    )


def order_statistics(samples: DataFrame, key: str, value: str, **fractions: float) -> DataFrame:
    """Per key the samples ``sorted[floor(n * fraction)]``, counted from 0, one column each.

    One scan brackets every wanted sample by approximate percentiles, a second counts the samples
    below each bracket and each value inside it; nearly all samples fall to that before the first
    shuffle. Where a key has more than ``_WALK`` values inside a bracket, slices of the bracket are
    counted until the wanted rank lies in one with few enough, so no task walks over more. A rank
    outside its bracket, which the error bound of the percentiles excludes, widens the brackets.
    """
    names = sorted(fractions, key=fractions.get)
    known = samples.select(F.col(key).alias("k"), F.col(value).alias("v")).where("v is not null")
    margin = 2.0 / _ACCURACY
    while True:
        inside = _inside_brackets(known, [fractions[n] for n in names], margin)
        missed = "rank < below or rank >= below + rows"
        if not _totals(inside).where(missed).limit(1).count():
            break
        margin *= 16
    while _totals(inside).where(f"distinct > {_WALK} and high > low").limit(1).count():
        inside = _narrowed(inside)
    rank = W.partitionBy("k", "slot").orderBy("v")
    running = inside.withColumn("upto", F.col("below") + F.sum("rows").over(rank))
    picks = [
        F.expr(f"min(v) filter (where slot = {i} and upto > rank) as {name}")
        for i, name in enumerate(names)
    ]
    return running.groupBy(F.col("k").alias(key)).agg(*picks).select(key, *fractions)


def _inside_brackets(known: DataFrame, fractions: list[float], margin: float) -> DataFrame:
    """``k, slot, v, rows, rank, below``: the counted values inside each bracket of a key, the wanted
    rank and how many samples are smaller than the bracket."""
    edges = [min(max(f + m, 0.0), 1.0) for f in fractions for m in (-margin, margin)]
    wanted = ", ".join(f"{e!r}D" for e in edges)
    brackets = known.groupBy("k").agg(
        F.count("*").alias("total"),
        F.expr(f"percentile_approx(v, array({wanted}), {_ACCURACY})").alias("edges"),
    )
    slots = ", ".join(
        f"case when v < edges[{2 * i}] then named_struct('slot', {i}, 'at', cast(null as {{t}}))"
        f" when v <= edges[{2 * i + 1}] then named_struct('slot', {i}, 'at', v) end"
        for i in range(len(fractions))
    ).format(t=dict(known.dtypes)["v"])
    ranks = " ".join(f"when {i} then floor(total * {f!r}D)" for i, f in enumerate(fractions))
    counts = (
        join_per_key(known, brackets, "k", "total")
        .selectExpr("k", "total", f"explode(filter(array({slots}), x -> x is not null)) as s")
        .groupBy("k", "total", "s.slot", "s.at")
        .agg(F.count("*").alias("rows"))
    )
    counts = written(counts, "bracketed")
    below = counts.where("at is null").select("k", "slot", F.col("rows").alias("below"))
    values = counts.where("at is not null").withColumn("rank", F.expr(f"case slot {ranks} end"))
    joined = values.join(below, ["k", "slot"], "left")
    return joined.selectExpr("k", "slot", "at as v", "rows", "rank", "coalesce(below, 0) as below")


def _totals(inside: DataFrame) -> DataFrame:
    """One row per key and slot."""
    return inside.groupBy("k", "slot", "rank", "below").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("distinct"),
        F.min("v").cast("double").alias("low"), F.max("v").cast("double").alias("high"),
    )


def _narrowed(inside: DataFrame) -> DataFrame:
    """The same brackets cut down to the slice, of ``_SLICES`` equal ones, that holds the wanted rank."""
    ends = _totals(inside).select("k", "slot", "low", "high", "distinct")
    slice_no = f"least(cast(floor((v - low) / (high - low) * {_SLICES}) as int), {_SLICES - 1})"
    dealt = inside.join(ends, ["k", "slot"]).withColumn(
        "slice", F.expr(f"case when distinct > {_WALK} and high > low then {slice_no} else 0 end")
    )
    order = W.partitionBy("k", "slot").orderBy("slice")
    sums = dealt.groupBy("k", "slot", "slice", "rank", "below").agg(F.sum("rows").alias("n"))
    sums = sums.withColumn("before", F.col("below") + F.sum("n").over(order) - F.col("n"))
    found = sums.where("before <= rank and rank < before + n")
    kept = dealt.drop("rank", "below").join(
        found.select("k", "slot", "slice", "rank", F.col("before").alias("below")), ["k", "slot", "slice"]
    )
    return written(kept.select("k", "slot", "v", "rows", "rank", "below"), "narrowed")


def p50_p95(samples: DataFrame, key: str, value: str) -> DataFrame:
    return order_statistics(samples, key, value, p50=0.5, p95=0.95)


def latency_summary(
    samples: DataFrame, key: str, value: str, target: float = TARGET_P95
) -> DataFrame:
    """Per key the least, mean, p50, p95 and greatest sample, and whether p95 meets the target."""
    spread = samples.groupBy(key).agg(
        F.count("*").alias("n"),
        F.min(value).alias("min"),
        F.avg(value).alias("avg"),
        F.max(value).alias("max"),
    )
    joined = spread.join(p50_p95(samples, key, value), key)
    return joined.select(
        key, "n", "min", "avg", "p50", "p95", "max", (F.col("p95") < target).alias("passed")
    )
