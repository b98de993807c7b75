"""Selector rules: one small YAML document per source, read and parsed in the workers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.selectors import field_specs
from marquee.schema import RULES


def _row(path: str, document: str) -> tuple:
    import yaml

    data = yaml.safe_load(document) or {}
    selectors = data.get("selectors") or {}
    paging = data.get("pagination") or {}
    fields = {str(name): str(expression) for name, expression in (data.get("fields") or {}).items()}
    return (
        path,
        selectors.get("list_item", "body"),
        fields,
        paging.get("next_selector"),
        bool(paging.get("month_grid", False)),
        int(paging.get("max_pages", 1)),
        (data.get("date_scopes") or {}).get("timezone"),
    )


def parse(documents: DataFrame) -> DataFrame:
    """Rules from (rule_path, document) rows, with defaults for what a document leaves out."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_row(*pair) for pair in zip(batch["rule_path"], batch["document"])]
            yield pd.DataFrame(rows, columns=RULES.fieldNames())

    return documents.select("rule_path", "document").mapInPandas(read, RULES)


def read(spark: SparkSession, root: str, pattern: str = "*.yaml") -> DataFrame:
    """All rule files under ``root``; rule_path is relative to it, as the registry writes it."""
    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(root, wholetext=True)
    )
    base = root.rstrip("/") + "/"
    path = F.col("_metadata.file_path")
    at = F.instr(path, base)
    relative = F.substring(path, at + len(base), F.length(path))
    return parse(files.select(relative.alias("rule_path"), F.col("value").alias("document")))


def exploded(rules: DataFrame) -> DataFrame:
    """One row per field rule, its expression split."""
    return rules.select("rule_path", F.explode(field_specs(F.col("fields"))).alias("spec")).select(
        "rule_path", "spec.*"
    )
