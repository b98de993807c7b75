"""Per-type constraints as generated columns, and the accept / reject split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.binding import computed
from marquee.schema import COUNTRY_PATTERN, ENTITY_COLUMNS, PROPERTIES, REQUIRED

_JSON_TYPES = {"strings": "array", "slots": "array", "number": "number"}


def prune(entities: DataFrame, entity_type: str) -> DataFrame:
    """Only the columns the type allows; the type itself stays as the partition column."""
    keep = {name for name, _ in PROPERTIES[entity_type]}
    return entities.select("entity_type", *[c for c in entities.columns if c in keep])


def prune_mixed(entities: DataFrame) -> DataFrame:
    """Blank the columns a row's type does not allow, for a frame of several types."""
    blanked = {}
    for name in ENTITY_COLUMNS:
        allowed = [kind for kind, fields in PROPERTIES.items() if name in dict(fields)]
        if len(allowed) < len(PROPERTIES) and name in entities.columns:
            blanked[name] = F.when(F.col("entity_type").isin(allowed), F.col(name))
    return entities.withColumns(blanked)


def _field_errors(name: str, kind: str) -> Column:
    """Messages about one present value, as an array that may hold nulls."""
    value, path = F.col(name), f"$.{name}"
    wrong = F.array_contains(F.coalesce("mistyped", F.array().cast("array<string>")), name)
    expected = _JSON_TYPES.get(kind, "string")
    type_error = F.when(wrong, F.lit(f"{path}: value is not of type '{expected}'"))
    found = [type_error]
    if kind in ("text", "country"):
        checks = {
            "text": (value == "", F.lit(f"{path}: '' should be non-empty")),
            "country": (
                ~F.regexp_like(value, F.lit(COUNTRY_PATTERN)),
                F.concat(
                    F.lit(f"{path}: '"), value, F.lit(f"' does not match '{COUNTRY_PATTERN}'")
                ),
            ),
        }
        failed, message = checks[kind]
        found.append(F.when(~wrong & failed, message))
    if kind == "strings":
        message = F.lit(f"{path}: item is not of type 'string'")
        found.append(F.when(~wrong & F.exists(value, lambda item: item.isNull()), message))
    return F.array(*found)


def type_errors(entity_type: str) -> Column:
    """Every constraint message of the type: missing fields first, then field by field."""
    missing = [
        F.when(F.col(name).isNull(), F.lit(f"$: '{name}' is a required property"))
        for name in REQUIRED[entity_type]
    ]
    fields = [_field_errors(name, kind) for name, kind in PROPERTIES[entity_type]]
    return F.array_compact(F.concat(F.array(*missing), *fields))


def validate(entities: DataFrame) -> DataFrame:
    """Add ``reasons``: all messages about a row, empty when it is acceptable."""
    if "mistyped" not in entities.columns:
        entities = entities.withColumn("mistyped", F.array().cast("array<string>"))
    reasons = F.when(F.lit(False), F.array().cast("array<string>"))
    for kind in PROPERTIES:
        reasons = reasons.when(F.col("entity_type") == kind, type_errors(kind))
    reasons = F.coalesce(
        reasons,
        F.array(F.concat(F.lit("$: unknown type '"), F.col("entity_type"), F.lit("'"))),
    )
    if "date_errors" in entities.columns:
        reasons = F.concat(F.coalesce("date_errors", F.array().cast("array<string>")), reasons)
    return computed(entities, {"reasons": reasons})


def accepted(validated: DataFrame) -> DataFrame:
    return prune_mixed(validated.filter(F.size("reasons") == 0)).drop(
        "reasons", "date_errors", "mistyped"
    )


def rejected(validated: DataFrame) -> DataFrame:
    """Rejects with their reasons and the entity as it was before pruning."""
    fields = [F.col(c) for c in ("entity_type", *ENTITY_COLUMNS) if c in validated.columns]
    return validated.filter(F.size("reasons") > 0).select(
        "source_id", F.struct(*fields).alias("entity"), F.col("reasons").alias("reason")
    )


def reason_counts(rejects: DataFrame) -> DataFrame:
    """How often each reason occurs."""
    return (
        rejects.select(F.explode("reason").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("rejects"))
    )
