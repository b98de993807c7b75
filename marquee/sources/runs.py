"""Tables earlier runs left behind: manifests, rejects, URL state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schema import MANIFEST, METRICS, REJECT, SOURCE_COUNTS, URL_STATE
from marquee.sinks.history import UrlHistory


def _last_part(pattern: str):
    """The run or reject file (or folder) a row was read from."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Manifests ``run-*.json`` with the name they were filed under; broken documents are left out.

    ``run_time`` is the time in the name, by which manifests are ordered; names break ties.
    """
    schema = T.StructType(MANIFEST.fields + [T.StructField("_broken", T.StringType())])
    files = (
        spark.read.format("binaryFile")
        .load(f"{path.rstrip('/')}/run-*.json")
        .select("path", F.decode("content", "UTF-8").alias("value"))
    )
    # a document on every line, or one over the whole file
    lines = F.filter(F.split("value", r"\r?\n"), lambda line: F.trim(line) != "")
    by_line = F.forall(lines, lambda line: F.regexp_like(line, F.lit(r"\A\s*\{.*\}\s*\z")))
    documents = F.when(by_line, lines).otherwise(F.array("value"))
    each = files.select("path", F.explode(documents).alias("document"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = each.filter("trim(document) <> ''").select(
        "path", F.from_json("document", schema, options).alias("m")
    )
    named = parsed.select(
        "m.*",
        "path",
        F.regexp_extract("path", r".*/(run-[^/]+\.json)(?:/[^/]*)?\z", 1).alias("name"),
    )
    return with_run_time(named.filter(F.col("_broken").isNull()).drop("_broken"))


def with_run_time(manifests: DataFrame) -> DataFrame:
    """Add the time a manifest's name ends in: yyyymmddThhmmss."""
    stamp = F.regexp_extract("name", r"(\d{8}T\d{6})[^-/]*\z", 1)
    return manifests.withColumn("run_time", F.try_to_timestamp(stamp, F.lit("yyyyMMdd'T'HHmmss")))


def read_reject_files(spark: SparkSession, path: str) -> DataFrame:
    """Files or folders ``reject_*.json`` of one reject or an array of them in a file; the time comes
    from the name, else it is now."""
    rejects = (
        spark.read.schema(REJECT)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(f"{path.rstrip('/')}/reject_*.json")
    )
    stamp = _last_part(r".*_(\d{8}T\d{6}\d{1,6})\.json(?:/.*)?\z")
    readable = F.regexp_replace(
        stamp, r"\A(\d{4})(\d\d)(\d\d)T(\d\d)(\d\d)(\d\d)(\d+)\z", "$1-$2-$3 $4:$5:$6.$7"
    )
    named = F.when(stamp != "", readable.try_cast("timestamp"))
    return rejects.select(
        "entity",
        "reason",
        F.col("entity.source_id").alias("source_id"),
        F.coalesce(named, F.current_timestamp()).alias("rejected_at"),
    )


def read_url_state(spark: SparkSession, path: str) -> DataFrame:
    """The state of all URLs; a missing table is an empty one, an unreadable one fails."""
    return UrlHistory(spark, path).read().select(*URL_STATE.fieldNames())


def read_source_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts per run and source that runs have written."""
    return spark.read.schema(SOURCE_COUNTS).parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics rows ``run_*.json`` of runs."""
    return spark.read.schema(METRICS).json(f"{path.rstrip('/')}/run_*.json")
