"""Rule expressions as columns: which element, which attribute, one value or all."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.binding import bind
from marquee.functions.text import strip


def _cut_suffix(value: Column, suffix: str) -> Column:
    return F.when(
        F.endswith(value, F.lit(suffix)), F.left(value, F.length(value) - len(suffix))
    ).otherwise(value)


def _selector_and_attr(expression: Column) -> Column:
    """``sel@attr`` and ``sel::attr(name)`` split in two; attr is null when there is none."""
    at = F.instr(expression, "@")
    call = F.instr(expression, "::attr(")
    rest = F.length(expression)
    return (
        F.when(
            at > 0,
            F.struct(
                strip(F.left(expression, at - 1)).alias("selector"),
                strip(F.substring(expression, at + 1, rest)).alias("attr"),
            ),
        )
        .when(
            call > 0,
            F.struct(
                strip(F.left(expression, call - 1)).alias("selector"),
                F.regexp_replace(
                    F.substring(expression, call + len("::attr("), rest), r"\)+\z", ""
                ).alias("attr"),
            ),
        )
        .otherwise(
            F.struct(
                strip(expression).alias("selector"), F.lit(None).cast("string").alias("attr")
            )
        )
    )


def field_spec(name: Column, expression: Column) -> Column:
    """A field rule as (field, selector, attr, multi, text_fallback)."""

    def from_text(text: Column) -> Column:
        multi = F.endswith(text, F.lit("[]"))
        return bind(_cut_suffix(text, "[]"), lambda single: from_single(single, multi))

    def from_single(single: Column, multi: Column) -> Column:
        fallback = F.endswith(single, F.lit("|text"))
        bare = F.replace(_cut_suffix(single, "|text"), F.lit(" @"), F.lit("@"))
        return bind(
            bind(bare, _selector_and_attr),
            lambda part: F.struct(
                name.alias("field"),
                part["selector"].alias("selector"),
                part["attr"].alias("attr"),
                multi.alias("multi"),
                fallback.alias("text_fallback"),
            ),
        )

    return bind(strip(expression), from_text)


def field_specs(fields: Column) -> Column:
    """All field rules of a map of expressions."""
    return F.transform(F.map_entries(fields), lambda e: field_spec(e["key"], e["value"]))


def link_spec(expression: Column) -> Column:
    """The next-page rule as (selector, attr); the attribute defaults to href when it is used."""
    bare = F.replace(strip(expression), F.lit(" @"), F.lit("@"))
    return bind(bind(bare, lambda text: _cut_suffix(text, "[]")), _selector_and_attr)
