"""The reports a user calls: source status, rejects, URL explanation, registry check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators import prefix, validate
from marquee.operators.joins import join_small
from marquee.sources import registry as registry_source


def newest_run_per_source(manifests: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """The stats of the newest run that mentions a source.

    Manifests have run_id, run_time, name and source_stats. Runs that write the counts of their
    sources as a table instead of into the manifest are looked up in ``counts``.
    """
    columns = ["rows_new", "rows_updated", "rejects"]
    named = ["run_id", "run_time", "name"]
    mentioned = manifests.select(*named, F.explode("source_stats").alias("source_id", "s")).select(
        *named, "source_id", *[F.col(f"s.{name}") for name in columns]
    )
    if counts is not None:
        listed = join_small(counts, manifests.select(*named), "run_id", spread_by="source_id")
        mentioned = mentioned.unionByName(listed.select(*mentioned.columns))
    newest = Window.partitionBy("source_id").orderBy(
        F.desc_nulls_last("run_time"), F.desc("name")
    )
    return (
        mentioned.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .select("source_id", "run_id", *columns)
    )


def status(registry: DataFrame, manifests: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Every registered source with its latest counts; zeros and no run when it never ran."""
    latest = newest_run_per_source(manifests, counts)
    return registry.select("source_id", "row_no").join(latest, "source_id", "left").select(
        "row_no",
        "source_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows_new", "rows_updated", "rejects")],
        F.col("run_id").alias("last_run"),
    )


def inspect_rejects(
    rejects: DataFrame, days: int = 7, source_id: str | None = None, now: Column | None = None
) -> DataFrame:
    """Reject reasons of the last days, of all sources or of one.

    Rejects have reason, rejected_at and source_id.
    """
    now = F.current_timestamp() if now is None else now
    recent = rejects.filter(F.col("rejected_at") >= now - F.make_dt_interval(F.lit(days)))
    if source_id is not None:
        recent = recent.filter(F.col("source_id") == source_id)
    return validate.reason_counts(recent)


def explain(urls: DataFrame, registry: DataFrame) -> DataFrame:
    """Which source a URL belongs to and how it would be fetched."""
    chosen = registry.select(
        "row_no", "base_url", "source_id", "type", "max_qps",
        F.col("css_rules_path").alias("rules_path"), "robots_ok",
    )
    return prefix.first_prefix_match(urls, chosen).drop("base_url")


def validate_sources(registry: DataFrame, rule_paths: DataFrame) -> DataFrame:
    """OK, DISABLED or FAIL per registry row; the detail says what is wrong."""
    checked = registry_source.validate(registry, rule_paths)
    return checked.select(
        "row_no",
        "source_id",
        F.when(F.col("detail") == "disabled", "DISABLED")
        .when(F.col("ok"), "OK")
        .otherwise("FAIL")
        .alias("status"),
        F.when(F.col("ok") & (F.col("detail") == "ok"), "").otherwise(F.col("detail")).alias("detail"),
    )
