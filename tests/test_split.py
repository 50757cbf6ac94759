from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripwright.operators import split


def test_hash_split_is_stable_and_complete(spark):
    rows = spark.range(5000).withColumn("key", F.concat_ws("-", "id", F.col("id") % 7))

    def train_ids(frame, seed=42, fraction=0.8):
        chosen = split.in_train_by_hash(F.col("key"), seed, fraction)
        return {r.id for r in frame.where(chosen).collect()}

    ids = train_ids(rows.repartition(1))
    assert ids == train_ids(rows.repartition(8, "key"))
    assert 0.77 < len(ids) / 5000 < 0.83
    assert ids != train_ids(rows, seed=7)
    assert train_ids(rows, fraction=1.5) == ids
    rest = rows.where(~split.in_train_by_hash(F.col("key")))
    assert rest.count() + len(ids) == 5000
    assert train_ids(rows, fraction=0.3) < ids


@pytest.mark.parametrize("n", [0, 1, 2, 333, 800, 999, 1000, 2000])
def test_first_rows_by_integer_keys(spark, n):
    """Heavily tied first key: a third of the rows share one value."""
    made = [(0 if i % 3 == 0 else (i * 7919) % 50 - 25, (i * 104729) % 100000 * 10**9, i) for i in range(1000)]
    frame = spark.createDataFrame(made, "a int, b bigint, c smallint").repartition(5)
    chosen = split.in_first(frame, ["a", "b", "c"], n)
    assert sorted(tuple(r) for r in frame.where(chosen).collect()) == sorted(made)[:n]


def test_first_rows_by_times(spark):
    start = datetime(2015, 1, 1)
    made = [(start + timedelta(microseconds=(i * 7919) ** 2 % 10**12), start.date() + timedelta(days=i % 5)) for i in range(300)]
    frame = spark.createDataFrame(made, "t timestamp_ntz, d date")
    by_time = frame.where(split.in_first(frame, ["t", "d"], 120))
    assert sorted(tuple(r) for r in by_time.collect()) == sorted(made)[:120]
    by_day = frame.where(split.in_first(frame, ["d", "t"], 120))
    assert sorted((r.d, r.t) for r in by_day.collect()) == sorted((d, t) for t, d in made)[:120]
    zoned = frame.select(F.col("t").cast("timestamp").alias("t"))
    assert zoned.where(split.in_first(zoned, ["t"], 50)).count() == 50


def test_order_keys_are_checked(spark):
    frame = spark.createDataFrame([(1, "x"), (None, "y")], "a int, s string")
    with pytest.raises(TypeError):
        split.in_first(frame, ["s"], 1)


def test_nulls_come_first(spark):
    made = [(a, b) for a in (None, None, 1, 2) for b in (None, 5, 6, 7)]
    made = [(a, b, i) for i, (a, b) in enumerate(made)]
    frame = spark.createDataFrame(made, "a int, b int, i int").repartition(3)
    order = sorted(made, key=lambda r: tuple((x is not None, x or 0) for x in r))
    for n in range(1, 17):
        first = split.in_first(frame, ["a", "b", "i"], n)
        assert {r.i for r in frame.where(first).collect()} == {r[2] for r in order[:n]}
        assert frame.where(~first).count() == 16 - n


def test_equal_rows_stay_together(spark):
    frame = spark.createDataFrame([(1,), (2,), (2,), (2,), (3,)], "a int")
    assert frame.where(split.in_first(frame, ["a"], 2)).count() == 4


def test_ordered_split(spark):
    frame = spark.range(105).selectExpr("id", "date_add(date'2015-01-01', int(id)) as d")
    chosen = split.in_train_by_order(frame, ["d"])
    assert [r.id for r in frame.where(chosen).orderBy("id").collect()] == list(range(84))
    assert frame.where(~chosen).count() == 21
    assert isinstance(frame.head().d, date)
