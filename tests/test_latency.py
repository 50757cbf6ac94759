import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripwright.operators import latency

SCHEMA = "key string, value double, at timestamp_ntz, id bigint"


def samples(n, seed=1, decimals=0):
    """Two thirds of the samples share one key; times repeat."""
    rng = random.Random(seed)
    start = datetime(2015, 1, 1)
    return [
        ("hot" if rng.random() < 2 / 3 else f"k{rng.randrange(4)}",
         round(rng.expovariate(1 / 50), decimals), start + timedelta(seconds=rng.randrange(n // 2)), i)
        for i in range(n)
    ]


def by_key(rows):
    keys = {}
    for row in rows:
        keys.setdefault(row[0], []).append(row)
    return keys


def test_newest_and_percentiles(spark):
    made = samples(3000)
    frame = spark.createDataFrame(made, SCHEMA).repartition(7)
    newest = latency.newest_per_key(frame, "key", "at", "id").persist()
    wanted = {k: sorted(rows, key=lambda r: r[2:])[-200:] for k, rows in by_key(made).items()}
    found = by_key([tuple(r) for r in newest.collect()])
    assert {k: sorted(rows, key=lambda r: r[2:]) for k, rows in found.items()} == wanted
    for row in latency.p50_p95(newest, "key", "value").collect():
        values = sorted(r[1] for r in wanted[row.key])
        assert row.p50 == values[len(values) // 2]
        assert row.p95 == values[int(len(values) * 0.95)]


@pytest.mark.parametrize("n", [1, 2, 3, 19, 20, 21, 100])
def test_percentile_positions(spark, n):
    frame = spark.range(n).selectExpr("'a' as key", "cast(id as double) as value")
    row = latency.p50_p95(frame, "key", "value").head()
    assert (row.p50, row.p95) == (n // 2, int(n * 0.95))


def test_summary_of_many_distinct_values(spark):
    made = samples(40000, decimals=9)
    frame = spark.createDataFrame(made, SCHEMA).repartition(5)
    for row in latency.latency_summary(frame, "key", "value").collect():
        values = sorted(r[1] for r in made if r[0] == row.key)
        n = len(values)
        assert (row.n, row.min, row.max) == (n, values[0], values[-1])
        assert (row.p50, row.p95) == (values[n // 2], values[int(n * 0.95)])
        assert row.avg == pytest.approx(sum(values) / n)
        assert row.passed is (row.p95 < 100)


def test_one_value_only(spark):
    frame = spark.range(1000).select(F.lit("a").alias("key"), F.lit(7.0).alias("value"))
    row = latency.latency_summary(frame, "key", "value").head()
    assert (row.p50, row.p95, row.passed) == (7.0, 7.0, True)
    assert latency.latency_summary(frame, "key", "value", target=7.0).head().passed is False


def test_many_values_of_one_key_are_narrowed(spark, monkeypatch):
    """Two million distinct values of one key leave more inside a bracket than one task walks over."""
    monkeypatch.setattr(latency, "_WALK", 100)
    n = 2_000_000
    frame = spark.range(0, n, 1, 8).selectExpr("'a' as key", "cast(id * 3 as double) / 7 as value")
    frame = frame.unionByName(spark.range(40).selectExpr("'b' as key", "cast(5 as double) as value"))
    rows = {r.key: (r.p50, r.p95) for r in latency.p50_p95(frame, "key", "value").collect()}
    assert rows == {"a": (n // 2 * 3 / 7, int(n * 0.95) * 3 / 7), "b": (5.0, 5.0)}


def test_nulls_and_integers(spark):
    given = [("a", 3), ("a", None), ("a", 1), (None, 7), (None, 8), ("c", None)]
    frame = spark.createDataFrame(given, "key string, value bigint")
    rows = {r.key: (r.p50, r.p95) for r in latency.p50_p95(frame, "key", "value").collect()}
    assert rows == {"a": (3, 3)}
