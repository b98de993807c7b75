from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marquee.operators.joins import heavy_keys, join_small


@pytest.mark.parametrize("how", ["inner", "left"])
def test_both_ways_give_the_same(spark, how):
    large = spark.range(200).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 7)) AS k")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("k9", 4)], "k string, v int")
    near = join_small(large, small, "k", how, spread_by="id")
    far = join_small(large, small, "k", how, spread_by="id", limit=0)
    assert sorted(near.collect(), key=str) == sorted(far.collect(), key=str)
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()


def test_a_key_of_half_the_rows_is_no_heavy_task(spark):
    """No task of the join has more than twice the mean, and only heavy keys are cut."""
    large = spark.range(40_000).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 11 = 0 THEN NULL ELSE concat('k', id % 997) END AS k"
    )
    small = spark.range(997).selectExpr("concat('k', id) AS k", "id AS v").unionByName(
        spark.sql("SELECT 'hot' AS k, 1L AS v")
    )
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [r.k for r in heavy_keys(large.filter("k IS NOT NULL"), "k", 16).collect()] == ["hot"]
        joined = join_small(large, small, "k", "left", spread_by="id", limit=0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * sum(sizes) / 16 and sum(sizes) == 40_000
        near = large.join(small, "k", "left")
        assert joined.exceptAll(near.select(*joined.columns)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
