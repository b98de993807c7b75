"""Reading loosely typed JSON kept as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.binding import bind
from marquee.functions.text import present, strip

NO_STRINGS = "array<string>"


def field(node: Column, name: str) -> Column:
    """A member of an object as VARIANT; null when absent or when the node is no object."""
    return F.try_variant_get(node, f'$["{name}"]', "variant")


def is_object(node: Column) -> Column:
    # a struct names the one member it takes, a map would copy them all
    return F.try_variant_get(node, "$", "struct<`@type`:variant>").isNotNull()


def items(node: Column) -> Column:
    """The elements of a JSON array; null for anything else."""
    return F.try_variant_get(node, "$", "array<variant>")


def string(node: Column) -> Column:
    """The trimmed text of a JSON string that is not blank; null for anything else.

    Numbers would be cast to text, so the JSON type is checked first.
    """
    return F.when(
        F.schema_of_variant(node) == "STRING",
        present(strip(F.try_variant_get(node, "$", "string"))),
    )


def strings(node: Column) -> Column:
    """The non-blank strings of a JSON array, trimmed; null for anything else."""
    return F.array_compact(F.transform(items(node), string))


def first_string(node: Column) -> Column:
    """A non-blank string, or the first one of a list."""
    return bind(node, first_string_of)


def first_string_of(value: Column) -> Column:
    """The same of a value that costs nothing to name again, such as a column."""
    return F.coalesce(string(value), F.get(strings(value), 0))


def truthy(node: Column) -> Column:
    """The node, or null when it is empty, zero, false or null."""
    text = F.to_json(node)
    empty = text.isin('""', "[]", "{}", "null", "false") | F.regexp_like(
        text, F.lit(r"\A-?0(\.0*)?([eE][+-]?\d+)?\z")
    )
    return F.when(~empty, node)
