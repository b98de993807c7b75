"""Text helpers as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.schema import TAXONOMY

# The white space that counts, and the contact and price patterns.
SPACE = r"[\s\x1c-\x1f]"
EMAIL = r"(?iu)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
PHONE = r"(?U)[+\d][\d\-().\s\x1c-\x1f]{4,}"
PRICE = r"(?U)(\d+)(?:[.,](\d{2}))?"


def strip(value: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.regexp_replace(value, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def present(value: Column) -> Column:
    """The value, or null when it is an empty string."""
    return F.nullif(value, F.lit(""))


def normal_text(value: Column) -> Column:
    """Lower case with runs of white space as one space and none at the ends."""
    return F.trim(F.regexp_replace(F.lower(value), rf"(?U){SPACE}+", " "))


def contact_pool(*parts: Column) -> Column:
    """The texts contacts are searched in, blanks left out."""
    return F.concat_ws(" ", *[present(part) for part in parts])


def emails(pool: Column) -> Column:
    found = F.regexp_extract_all(pool, F.lit(EMAIL), F.lit(0))
    every = F.array_sort(F.array_distinct(F.transform(found, F.lower)))
    # the pattern is tried at every character: not where there is no sign of an address
    return F.when(~F.contains(pool, F.lit("@")), F.array().cast("array<string>")).otherwise(every)


def phones(pool: Column) -> Column:
    found = F.regexp_extract_all(pool, F.lit(PHONE), F.lit(0))
    digits = F.transform(found, lambda hit: F.regexp_replace(hit, r"(?U)[^+\d]", ""))
    return F.array_sort(F.array_distinct(digits))


def price_value(text: Column) -> Column:
    """The first number of the text with at most two decimals; null when there is none."""
    major = present(F.regexp_extract(text, PRICE, 1)).try_cast("double")
    minor = present(F.regexp_extract(text, PRICE, 2)).try_cast("double")
    return major + F.coalesce(minor, F.lit(0.0)) / 100


def taxonomy(
    title: Column,
    entity_type: Column | None = None,
    sport_type: Column | None = None,
    mapping: Sequence[tuple[str, str]] = TAXONOMY,
) -> Column:
    """Categories whose keyword occurs anywhere in the lower-cased title, in mapping order."""
    lowered = F.lower(F.coalesce(title, F.lit("")))
    labels = [F.when(F.contains(lowered, F.lit(word)), F.lit(label)) for word, label in mapping]
    if entity_type is not None and sport_type is not None:
        labels.append(F.when(entity_type == "sports", F.lower(present(sport_type))))
    return F.array_distinct(F.array_compact(F.array(*labels)))


def url_hash(url: Column) -> Column:
    return F.sha2(url, 256)
