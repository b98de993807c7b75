"""The recipe of the deduplication key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.binding import bind
from marquee.functions.datetimes import day_and_offset
from marquee.functions.text import normal_text, present

# Fixed value: the date an entity without start and end is keyed by.
UNDATED = "1970-01-01T00:00:00Z"


def _blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def key_date(start: Column, end: Column) -> Column:
    """The date the key is built on, null when the entity has none."""
    return F.coalesce(present(start), present(end))


def _place(row: dict[str, Column]) -> tuple[Column, Column, Column, Column]:
    return (
        normal_text(_blank(row["title"])),
        normal_text(_blank(F.coalesce(present(row["venue_name"]), row["address"]))),
        normal_text(_blank(row["city"])),
        _blank(row["source_id"]),
    )


def _columns() -> dict[str, Column]:
    names = ["title", "start", "end", "venue_name", "address", "city", "source_id"]
    return {name: F.col(name) for name in names}


def key_parts(row: dict[str, Column] | None = None) -> Column:
    """``(dedup_key, identity, day, dated)`` of an entity.

    ``identity`` stands for everything in the key but the calendar day, so two keys are one day
    apart exactly when the identities agree and the days differ by one.
    """
    row = row or _columns()
    title, venue, city, source = _place(row)
    date = key_date(row["start"], row["end"])

    def parts(when: Column) -> Column:
        bucket = F.concat(when["day"], F.lit("T00:00:00"), when["offset"])
        return F.struct(
            F.sha1(F.concat_ws("|", title, bucket, venue, city, source)).alias("dedup_key"),
            F.sha1(F.concat_ws("|", title, when["offset"], venue, city, source)).alias("identity"),
            F.unix_date(when["day"].try_cast("date")).alias("day"),
            date.isNotNull().alias("dated"),
        )

    text = F.coalesce(date, F.lit(UNDATED)).cast("string")
    # text that is no date still gets a key of its own, so such rows are never merged or lost
    raw = F.struct(text.alias("day"), text.alias("offset"))
    return bind(F.coalesce(day_and_offset(text), raw), parts)


def entity_key(row: dict[str, Column] | None = None) -> Column:
    return key_parts(row)["dedup_key"]


def nearby_keys(row: dict[str, Column] | None = None) -> Column:
    """Keys of the same entity one day earlier and later; empty when it has no date."""
    row = row or _columns()
    title, venue, city, source = _place(row)
    date = key_date(row["start"], row["end"])

    def shifted(when: Column) -> Column:
        def key(days: int) -> Column:
            day = F.date_add(when["day"].try_cast("date"), days).cast("string")
            bucket = F.concat(day, F.lit("T00:00:00"), when["offset"])
            return F.sha1(F.concat_ws("|", title, bucket, venue, city, source))

        return F.array(key(-1), key(1))

    return F.when(date.isNotNull(), bind(day_and_offset(date), shifted)).otherwise(
        F.array().cast("array<string>")
    )
