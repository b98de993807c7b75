"""ISO-8601 date-times that keep their offset.

A parsed value is a struct ``(local timestamp_ntz, offset int)``: the wall-clock reading and the
offset from UTC in seconds (null when the text names none). Nothing here depends on the session
time zone.
"""

from __future__ import annotations

import re
import zoneinfo
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.binding import bind
from marquee.functions.text import present

# The accepted ISO-8601 forms. Calendar, week and ordinal dates; a time needs a
# complete date. Groups: year, dash, month, day, week, weekday, ordinal day, hour, colon, minute,
# second, fraction, offset, month of a yyyy-mm date, week of a week without weekday.
_ISO = (
    r"(?s)\A(\d{4})"
    r"(?:(-?)(?:(\d\d)\2(\d\d)|W(\d\d)\2([1-7])|(\d{3}))"
    r"(?:.(\d\d)(?:(:?)(\d\d)(?:\9(\d\d)(?:[.,](\d+))?)?)?([Zz]|[+-]\d\d(?::?\d\d)?)?)?"
    r"|-(\d\d)|-?W(\d\d))?\z"
)
_GROUPS = 15
_MARK = "\u0001"
# Text as `iso_text` writes it, for which the day and the offset can simply be cut out.
_NORMAL = r"\A\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d{6})?[+-]\d\d:\d\d\z"
_PLAIN = (
    r"\A(?!0000)\d{4}-\d\d-\d\dT[0-2]\d:[0-5]\d:[0-5]\d[+-](?:[01]\d|2[0-3]):[0-5]\d\z"
)
_UTC_OFFSET = r"(?s)\AUTC(.)(\d\d)(?:.?.?|.(\d\d).*)\z"

# Names the JVM does not carry, with a zone of the same rules.
_RENAMED = {"ROC": "Asia/Taipei"}
_UNKNOWN = {"Factory", "localtime"}


def zone_names() -> list[str]:
    """IANA zone names known to this Python, from its own time zone database."""
    return sorted(zoneinfo.available_timezones() - _UNKNOWN)


@cache
def _zone_pattern() -> str:
    """All names as one pattern, those of a region together."""
    regions: dict[str, list[str]] = {}
    for name in zone_names():
        region, slash, place = name.partition("/")
        regions.setdefault(region + slash, []).append(re.escape(place))
    parts = (f"{re.escape(region)}(?:{'|'.join(places)})" for region, places in regions.items())
    return rf"\A(?:{'|'.join(parts)})\z"


def is_zone_name(name: Column) -> Column:
    return F.coalesce(F.regexp_like(name, F.lit(_zone_pattern())), F.lit(False))


def parse_iso(text: Column) -> Column:
    """Parse ISO-8601 text; null when it is none."""
    return F.coalesce(_parse_plain(text), _parse_any(text))


def _parse_plain(text: Column) -> Column:
    """The most common form, yyyy-mm-ddThh:mm:ss±hh:mm, without taking it apart."""
    local = F.left(text, F.lit(19)).try_cast("timestamp_ntz")
    return F.when(
        F.regexp_like(text, F.lit(_PLAIN)) & local.isNotNull(),
        F.struct(local.alias("local"), _plain_offset(text).alias("offset")),
    )


def _plain_offset(text: Column) -> Column:
    hours, minutes = (F.substring(text, at, 2).try_cast("int") for at in (21, 24))
    sign = F.when(F.substring(text, 20, 1) == "-", -1).otherwise(1)
    return (sign * (hours * 3600 + minutes * 60)).cast("int")


def plain_offset(text: Column) -> Column:
    """The offset in seconds of text that is already written as `iso_text` writes its value.

    Null for any other text, whatever it says.
    """
    written = F.regexp_like(text, F.lit(_PLAIN)) & ~F.endswith(text, F.lit("-00:00"))
    there = F.left(text, F.lit(19)).try_cast("timestamp_ntz").isNotNull()
    return F.when(written & there, _plain_offset(text))


def _parse_any(text: Column) -> Column:
    marked = F.regexp_replace(
        text, _ISO, _MARK + _MARK.join(f"${group}" for group in range(1, _GROUPS + 1))
    )
    return bind(F.split(marked, _MARK), _from_parts)


def _from_parts(parts: Column) -> Column:
    def part(group: int) -> Column:
        return present(F.get(parts, group))

    def number(group: int) -> Column:
        return part(group).try_cast("int")

    year = part(1)
    month = F.coalesce(part(3), part(14))
    first = F.concat(year, F.lit("-01-01")).try_cast("date")
    week = F.coalesce(number(5), number(15))
    fourth = F.date_add(first, 3)
    week_date = F.when(
        week.between(1, 53),
        F.date_add(
            F.date_sub(fourth, F.weekday(fourth)),
            (week - 1) * 7 + F.coalesce(number(6), F.lit(1)) - 1,
        ),
    )
    ordinal = F.date_add(first, number(7) - 1)
    date = (
        F.when(
            month.isNotNull(),
            F.concat_ws("-", year, month, F.coalesce(part(4), F.lit("01"))).try_cast("date"),
        )
        .when(week.isNotNull(), week_date)
        .when(part(7).isNotNull(), F.when(F.year(ordinal) == number(1), ordinal))
        .otherwise(first)
    )
    minute = F.coalesce(part(10), F.lit("00"))
    second = F.coalesce(part(11), F.lit("00"))
    fraction = F.rpad(F.left(F.coalesce(part(12), F.lit("")), F.lit(6)), 6, "0")
    clock = F.concat(minute, second, fraction)
    midnight = part(8) == "24"
    hour = (
        F.when(part(8).isNull(), F.lit("00"))
        .when(midnight, F.when(F.regexp_like(clock, F.lit("^0+$")), F.lit("00")))
        .otherwise(part(8))
    )
    day = F.when(midnight, F.date_add(date, 1)).otherwise(date)
    local = F.concat(
        day.cast("string"), F.lit(" "), hour, F.lit(":"), minute, F.lit(":"), second,
        F.lit("."), fraction,
    ).try_cast("timestamp_ntz")
    offset_text = F.regexp_replace(part(13), ":", "")
    hours = F.substring(offset_text, 2, 2).try_cast("int")
    minutes = F.coalesce(present(F.substring(offset_text, 4, 2)).try_cast("int"), F.lit(0))
    sign = F.when(F.startswith(offset_text, F.lit("-")), -1).otherwise(1)
    offset = (
        F.when(offset_text.isNull(), F.lit(None).cast("int"))
        .when(F.lower(offset_text) == "z", F.lit(0))
        .otherwise(sign * (hours * 3600 + minutes * 60))
    )
    sound = (
        (F.size(parts) == _GROUPS + 1)
        & (year != "0000")
        & local.isNotNull()
        & (offset_text.isNull() | (F.lower(offset_text) == "z") | ((hours < 24) & (minutes < 60)))
    )
    return F.when(sound, F.struct(local.alias("local"), offset.alias("offset")))


def offset_text(seconds: Column) -> Column:
    """An offset in seconds as ±HH:MM, with :SS only when it has seconds; null gives ''."""
    size = F.abs(seconds)

    def two(value: Column) -> Column:
        return F.lpad(F.floor(value).cast("string"), 2, "0")

    return F.coalesce(
        F.concat(
            F.when(seconds < 0, "-").otherwise("+"),
            two(size / 3600),
            F.lit(":"),
            two((size % 3600) / 60),
            F.when(size % 60 != 0, F.concat(F.lit(":"), two(size % 60))).otherwise(""),
        ),
        F.lit(""),
    )


def iso_text(parsed: Column) -> Column:
    """ISO-8601 text of a parsed value, microseconds only when there are any."""

    def written(value: Column) -> Column:
        text = value["text"]
        fraction = F.substring(text, 21, 6)
        return F.concat(
            F.substring(text, 1, 10),
            F.lit("T"),
            F.substring(text, 12, 8),
            F.when(fraction != "", F.concat(F.lit("."), F.rpad(fraction, 6, "0"))).otherwise(""),
            offset_text(value["offset"]),
        )

    parts = F.struct(
        parsed["local"].cast("string").alias("text"), parsed["offset"].alias("offset")
    )
    return bind(parts, written)


def shift(local: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, local)


def zone_offset(name: Column) -> Column:
    """Seconds of a ``UTC±HH[:MM]`` name that is no IANA name; null for any other name."""
    hours = present(F.regexp_extract(name, _UTC_OFFSET, 2)).try_cast("int")
    minutes = F.coalesce(present(F.regexp_extract(name, _UTC_OFFSET, 3)).try_cast("int"), F.lit(0))
    sign = F.when(F.substring(name, 4, 1) == "+", 1).otherwise(-1)
    return F.when((hours < 24) & (minutes < 60), sign * (hours * 3600 + minutes * 60))


def to_zone(
    parsed: Column, zone: Column, named: Column | None = None, fixed: Column | None = None
) -> Column:
    """Move a parsed value to a zone; a value without offset is a reading in that zone.

    Without a usable zone a value keeps its offset, and one without offset is taken as UTC.
    ``named`` and ``fixed`` are `is_zone_name` and `zone_offset` of the zone where these are known.
    """
    local, offset = parsed["local"], parsed["offset"]
    name = zone
    for alias, same in _RENAMED.items():
        name = F.when(zone == alias, F.lit(same)).otherwise(name)
    named = is_zone_name(zone) if named is None else named
    fixed = zone_offset(zone) if fixed is None else fixed
    utc = F.when(offset.isNull(), F.convert_timezone(name, F.lit("UTC"), local)).otherwise(
        shift(local, -offset)
    )

    def in_zone(instant: Column) -> Column:
        there = F.when(offset.isNull(), local).otherwise(
            F.convert_timezone(F.lit("UTC"), name, instant)
        )
        return bind(
            there,
            lambda reading: F.struct(
                reading.alias("local"),
                F.timestamp_diff("SECOND", instant, reading).cast("int").alias("offset"),
            ),
        )

    return F.when(
        parsed.isNotNull(),
        F.when(named, bind(utc, in_zone))
        .when(
            fixed.isNotNull(),
            F.struct(
                F.when(offset.isNull(), local)
                .otherwise(shift(local, fixed - offset))
                .alias("local"),
                fixed.alias("offset"),
            ),
        )
        .otherwise(F.struct(local.alias("local"), F.coalesce(offset, F.lit(0)).alias("offset"))),
    )


def convert(text: Column, zone: Column) -> Column:
    """Parse text and move it to the zone: the parsed struct, null when the text is no date."""
    return bind(parse_iso(text), lambda parsed: to_zone(parsed, zone))


def zone_of(parsed: Column) -> Column:
    """The zone name a value carries by itself: UTC or ``UTC±HH:MM``."""
    minutes = F.floor(parsed["offset"] / 60) * 60
    return F.when(parsed["offset"] == 0, F.lit("UTC")).otherwise(
        F.concat(F.lit("UTC"), offset_text(minutes))
    )


def instant(text: Column) -> Column:
    """The instant of ISO text as a UTC reading (timestamp_ntz); no offset means UTC."""
    return bind(
        parse_iso(text),
        lambda parsed: shift(parsed["local"], -F.coalesce(parsed["offset"], F.lit(0))),
    )


def day_and_offset(text: Column) -> Column:
    """Calendar day and offset text of a date-time as ``(day string, offset string)``."""
    normal = F.struct(
        F.substring(text, 1, 10).alias("day"), F.right(text, F.lit(6)).alias("offset")
    )
    other = bind(
        parse_iso(text),
        lambda parsed: F.when(
            parsed.isNotNull(),
            F.struct(
                F.substring(parsed["local"].cast("string"), 1, 10).alias("day"),
                offset_text(parsed["offset"]).alias("offset"),
            ),
        ),
    )
    return F.when(F.regexp_like(text, F.lit(_NORMAL)), normal).otherwise(other)


def day_bucket(text: Column) -> Column:
    """Midnight of the same calendar day at the same offset, as ISO text."""
    return bind(
        day_and_offset(text), lambda part: F.concat(part["day"], F.lit("T00:00:00"), part["offset"])
    )


def slot_from_text(text: Column) -> Column:
    """Split slot text at its first pipe, else at its first hyphen; else start and end agree."""
    from marquee.functions.text import strip

    def halves(mark: str) -> Column:
        at = F.instr(text, mark)
        return F.struct(
            strip(F.left(text, at - 1)).alias("start"),
            strip(F.substring(text, at + 1, F.length(text))).alias("end"),
        )

    return (
        F.when(F.contains(text, F.lit("|")), halves("|"))
        .when(F.contains(text, F.lit("-")), halves("-"))
        .otherwise(F.struct(strip(text).alias("start"), strip(text).alias("end")))
    )


def slots_from_text(texts: Column) -> Column:
    return F.transform(texts, slot_from_text)
