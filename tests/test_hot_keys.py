import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tripwright.operators.hot_keys import join_per_key


def test_hot_and_cold_keys_join_alike(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 200).alias("k"), "id"
    )
    rows = rows.unionByName(spark.range(50).selectExpr("cast(null as bigint) as k", "id"))
    known = rows.where("k is not null")
    per_key = known.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    for share in (0.1, 1e-4, 1.0):
        joined = join_per_key(rows, per_key, "k", "n", hot_share=share)
        plain = rows.join(per_key, "k", "left").select(joined.columns)
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_keys_without_a_match_and_no_rows(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], "k int, id int")
    none = spark.createDataFrame([], "k int, n long")
    assert sorted(r.id for r in join_per_key(rows, none, "k", "n").collect()) == [1, 2, 3]
    assert join_per_key(rows.limit(0), none, "k", "n").count() == 0


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_no_task_gets_a_hot_key(spark, adaptive):
    """Half of the rows hold one key. Joined values are used, so the joins stay in the plan."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"), "id"
    )
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": adaptive,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = join_per_key(rows, per_key, "k", "n", hot_share=0.1)
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            joined.explain()
        parts = (
            joined.withColumn("part", F.spark_partition_id())
            .groupBy("part", (F.col("k") == -1).alias("hot"))
            .agg(F.count("*").alias("rows"), F.sum("n").alias("n"), F.sum("first").alias("first"))
            .collect()
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    plan = out.getvalue()
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
    assert set(re.findall(r"hashpartitioning\((\w+)#", plan)) == {"k"}
    hot, cold = ([p for p in parts if p.hot == h] for h in (True, False))
    assert sum(p.rows for p in hot) == 20_000 and sum(p.n for p in hot) == 20_000**2
    assert max(p.rows for p in hot) <= 2 * 20_000 / 8
    assert sum(p.rows for p in cold) == sum(p.n for p in cold) == 20_000
    assert max(p.rows for p in cold) <= 2 * 20_000 / 40
