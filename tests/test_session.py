from __future__ import annotations

from pyspark.sql import functions as F

from marquee.session import spread


def test_spread_of_a_file_with_one_row_group(spark, tmp_path):
    """A file cut into many splits of which a single one holds the rows keeps all cores at work."""
    path = str(tmp_path / "rows")
    spark.range(0, 60000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(path)
    kept = {n: spark.conf.get(n) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name in kept:
            spark.conf.set(name, "1m")
        scan = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        assert cores / 4 < scan.rdd.getNumPartitions() < cores * 4
        per_task = spread(scan, "id").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in per_task) == 60000
    assert max(r["count"] for r in per_task) < 2 * 60000 / cores
