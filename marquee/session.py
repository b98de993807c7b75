"""Session helpers: the few settings the jobs rely on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs depend on for results (time zone, duplicate JSON keys) or for scale.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # html rows are large: keep Arrow batches small enough for a Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    # a listing task takes many folders, where a table has one for each of its files
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
}


def configured(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created and return it."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "marquee", **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Where it is unset, as in tests on a local
    master, a folder inside the warehouse is used; elsewhere the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Hash a table over all cores when its scan may leave cores without work.

    For costly per-row work. How many tasks a scan has says little about that: files are cut by bytes,
    but a row group is read whole by one task, so of the tasks of a few files most may have no rows.
    A table of several tasks a core is left as it is, so nothing large is shuffled.
    """
    cores, tasks = scan.sparkSession.sparkContext.defaultParallelism, scan.rdd.getNumPartitions()
    if tasks >= cores * 4:
        return scan
    return scan.repartition(cores if tasks * 4 <= cores else cores * 4, key)


def all_tasks(spark: SparkSession) -> int:
    """Tasks for a shuffle before costly work on few bytes, which would be coalesced otherwise."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Pages are parsed in workers by a helper of the package, wherever the session was started.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="marquee-package-"), "marquee")
    context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(here), "marquee"))
    _SHIPPED.add(context.applicationId)
