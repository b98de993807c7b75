"""The source registry: a CSV of listing sources, read as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import present, strip
from marquee.operators.joins import join_small
from marquee.schema import REGISTRY

# What the registry accepts.
TRUE_WORDS = ["1", "true", "yes", "y"]
TYPES = ["events", "festivals", "sports"]
FREQUENCIES = ["daily", "weekly", "monthly"]
COUNTRY = r"\A[A-Z]{2}\z"
_NUMBER = r"(?i)\A[+-]?(\d+\.?\d*([e][+-]?\d+)?|\.\d+([e][+-]?\d+)?|inf|infinity|nan)\z"
_WHOLE = r"\A[+-]?\d+\z"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """The registry as text with its row order.

    ``multiLine`` honours line breaks in quotes and reads a file in one piece, so the generated
    number follows the file.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("inferSchema", False)
        .csv(path)
    )
    names = [F.col(f"`{name}`").alias(name.strip()) for name in raw.columns]
    return raw.select(*names).withColumn("row_no", F.monotonically_increasing_id())


def coerce(text: DataFrame) -> DataFrame:
    """Typed registry rows. ``bad_numbers`` names number columns whose text is no number.

    A flag is true when the column is missing altogether; an empty flag is false. Empty numbers
    take their default.
    """
    have = set(text.columns)

    def column(name: str) -> Column:
        return strip(F.col(name)) if name in have else F.lit(None).cast("string")

    def flag(name: str) -> Column:
        if name not in have:
            return F.lit(True)
        return F.coalesce(F.lower(column(name)).isin(TRUE_WORDS), F.lit(False))

    def number(name: str, kind: str, pattern: str, default: float) -> tuple[Column, Column]:
        value = present(column(name))
        sound = F.regexp_like(value, F.lit(pattern))
        typed = F.when(value.isNull(), F.lit(default)).when(sound, value.try_cast(kind))
        return typed.cast(kind), F.when(value.isNotNull() & ~sound, F.lit(name))

    qps, bad_qps = number("max_qps", "double", _NUMBER, 1.0)
    concurrency, bad_concurrency = number("concurrency", "int", _WHOLE, 1)
    order = F.col("row_no") if "row_no" in have else F.monotonically_increasing_id()
    typed = {
        "robots_ok": flag("robots_ok"),
        "sitemap_url": present(column("sitemap_url")),
        "max_qps": qps,
        "concurrency": concurrency,
        "enabled": flag("enabled"),
        "row_no": order,
    }
    columns = [typed.get(name, column(name)).alias(name) for name in REGISTRY.fieldNames()]
    return text.filter(present(column("source_id")).isNotNull()).select(
        *columns, F.array_compact(F.array(bad_qps, bad_concurrency)).alias("bad_numbers")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    return coerce(read_text(spark, path))


def row_errors() -> Column:
    """What is wrong with a registry row by itself."""
    checks = [
        (~F.col("type").isin(TYPES) | F.col("type").isNull(), "type: not one of " + ", ".join(TYPES)),
        (
            ~F.coalesce(F.regexp_like("country", F.lit(COUNTRY)), F.lit(False)),
            "country: not two capital letters",
        ),
        (
            ~F.coalesce(F.col("crawl_freq").isin(FREQUENCIES), F.lit(False)),
            "crawl_freq: not one of " + ", ".join(FREQUENCIES),
        ),
        (F.col("base_url").isNull(), "base_url: missing"),
        (F.array_contains("bad_numbers", "max_qps"), "max_qps: not a number"),
        (~(F.col("max_qps") > 0) | F.isnan("max_qps"), "max_qps: not greater than 0"),
        (F.array_contains("bad_numbers", "concurrency"), "concurrency: not a whole number"),
        (~(F.col("concurrency") > 0), "concurrency: not greater than 0"),
    ]
    return F.array_compact(F.array(*[F.when(failed, F.lit(text)) for failed, text in checks]))


def with_rule_check(registry: DataFrame, rule_paths: DataFrame) -> DataFrame:
    """Add ``rule_found``: whether the row's rule exists among ``rule_paths`` (rule_path), and
    ``rule_problem``: what is wrong with it, where the rules come with their ``problem``."""
    problem = F.col("problem") if "problem" in rule_paths.columns else F.lit(None).cast("string")
    known = rule_paths.select(
        F.col("rule_path").alias("css_rules_path"),
        F.lit(True).alias("rule_found"),
        problem.alias("rule_problem"),
    ).distinct()
    joined = join_small(
        registry, known, "css_rules_path", "left", spread_by="source_id", measure=rule_paths
    )
    return joined.withColumn("rule_found", F.coalesce("rule_found", F.lit(False)))


def validate(registry: DataFrame, rule_paths: DataFrame) -> DataFrame:
    """(source_id, ok, detail, row_no): 'ok', 'disabled', or what is wrong with the row.

    The rule file is only looked for when the source is enabled.
    """
    checked = with_rule_check(registry, rule_paths)
    missing = F.when(
        F.col("enabled") & ~F.col("rule_found"),
        F.concat(F.lit("css_rules_path: no such rule: "), F.coalesce("css_rules_path", F.lit(""))),
    )
    unreadable = F.when(
        F.col("enabled") & F.col("rule_problem").isNotNull(),
        F.concat(F.lit("css_rules_path: rule not understood: "), "rule_problem"),
    )
    errors = F.array_compact(F.concat(row_errors(), F.array(missing, unreadable)))
    return checked.withColumn("_errors", errors).select(
        "source_id",
        (F.size("_errors") == 0).alias("ok"),
        F.when(F.size("_errors") > 0, F.array_join("_errors", "; "))
        .when(F.col("enabled"), "ok")
        .otherwise("disabled")
        .alias("detail"),
        "row_no",
    )


def enabled_sources(registry: DataFrame, rule_paths: DataFrame) -> DataFrame:
    """Enabled sources; the query fails on the first bad row, disabled ones included.

    A source whose rule is not understood is no bad row: it stays, with the problem in
    ``rule_problem``, so that the others can run.
    """
    checked = with_rule_check(registry, rule_paths)
    problem = F.when(F.size(row_errors()) > 0, F.array_join(row_errors(), "; ")).when(
        F.col("enabled") & ~F.col("rule_found"), F.lit("css_rules_path: no such rule")
    )
    message = F.concat(F.lit("Invalid source row "), F.col("source_id"), F.lit(": "), problem)
    # the error is raised inside the filter, so no later step can be planned ahead of it
    return checked.filter(
        F.when(problem.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(
            F.col("enabled")
        )
    ).select(*REGISTRY.fieldNames(), "rule_problem")


def select_sources(
    registry: DataFrame,
    source_id: str = "all",
    entity_type: str = "all",
    limit: int | None = None,
) -> DataFrame:
    """Sources of a run in registry order; this is also the dry-run listing."""
    chosen = registry
    if source_id != "all":
        chosen = chosen.filter(F.col("source_id") == source_id)
    if entity_type != "all":
        chosen = chosen.filter(F.col("type") == entity_type)
    if limit is not None:
        chosen = chosen.orderBy("row_no").limit(limit)
    return chosen.select(
        "row_no",
        "source_id",
        F.col("type").alias("entity_type"),
        F.col("base_url").alias("url"),
        F.col("css_rules_path").alias("rule_path"),
        "max_qps",
        "concurrency",
        *[name for name in ("rule_problem",) if name in chosen.columns],
    )
