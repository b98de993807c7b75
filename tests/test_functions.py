"""Column functions against plain-Python answers."""

from __future__ import annotations

import hashlib
from datetime import UTC, datetime
from urllib.parse import urljoin
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from marquee.functions import datetimes, keys, text, urls
from marquee.operators.normalise import normalise_datetimes


def column(spark, values, build):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x string")
    rows = frame.select("i", build(F.col("x")).alias("y")).collect()
    return [row.y for row in sorted(rows, key=lambda row: row.i)]


ISO = [
    "2024-07-01T20:00:00-04:00", "2024-07-01T20:00:00.5Z", "2024-07-01 20:00", "2024-07-01",
    "2024", "2024-07", "20240701T1000", "20240701", "2024-W27", "2024W271", "2024-W27-1T10:00",
    "2024-183", "2024183T1015", "2024-366", "2023-366", "2024-07-01T24:00", "2024-07-01T24:01",
    "2024-07-01T10:11:12,123456789", "2024-07-01T10:00:00-04", "2024-07-01T10:00:00+0530",
    "2024-07-01T10:00:00+05:30", "2024-07-01T10:00:00z", "2024-13-01", "2024-02-30", "soon",
    "", "0000-01-01", "2024-07-01T10:60", "2024-07-01T25:00", "2024-07-01T10:00:00+24:00",
    "2024-07T10:00", "2024-W27T10:00", "2020-W53-7", "2024-07-01T101112.25+01:00",
    "2024-07-01T10:00:00-00:00", " 2024-07-01", "2024-07-01T10:00:00 ", "1899-12-31T23:59:59",
]


def expected_iso(value):
    parser = pytest.importorskip("dateutil.parser")
    try:
        return parser.isoparse(value).isoformat()
    except (ValueError, TypeError):
        return None


def test_iso_parsing_agrees_with_dateutil(spark):
    got = column(spark, ISO, lambda x: datetimes.iso_text(datetimes.parse_iso(x)))
    assert dict(zip(ISO, got)) == {value: expected_iso(value) for value in ISO}


# (value, zone) -> worked out by hand from the published offsets of the zones
CONVERTED = {
    ("2026-01-15T06:00:00Z", "Asia/Kolkata"): "2026-01-15T11:30:00+05:30",
    ("2026-01-15T06:00:00Z", "Asia/Kathmandu"): "2026-01-15T11:45:00+05:45",
    ("2026-01-15T06:00:00Z", "UTC"): "2026-01-15T06:00:00+00:00",
    ("2026-01-15T06:00:00Z", "UTC+05:30"): "2026-01-15T11:30:00+05:30",
    ("2026-01-15T06:00:00Z", "UTC-07"): "2026-01-14T23:00:00-07:00",
    ("2026-01-15T06:00:00Z", "UTC-03:15"): "2026-01-15T02:45:00-03:15",
    ("2026-01-15T06:00:00Z", "EST"): "2026-01-15T01:00:00-05:00",
    ("2026-01-15T06:00:00Z", "ROC"): "2026-01-15T14:00:00+08:00",
    # summer and winter, and an hour's shift by 30 minutes only
    ("2026-07-15T06:00:00Z", "Europe/Berlin"): "2026-07-15T08:00:00+02:00",
    ("2026-01-15T06:00:00Z", "Europe/Berlin"): "2026-01-15T07:00:00+01:00",
    ("2026-07-15T06:00:00Z", "Australia/Lord_Howe"): "2026-07-15T16:30:00+10:30",
    ("2026-01-15T06:00:00Z", "Australia/Lord_Howe"): "2026-01-15T17:00:00+11:00",
    # without an offset the text is local time; a time that occurs twice is the first one
    ("2026-07-15T06:00:00", "Europe/Berlin"): "2026-07-15T06:00:00+02:00",
    ("2026-10-25T02:30:00", "Europe/Berlin"): "2026-10-25T02:30:00+02:00",
    ("2026-07-15", "Asia/Kolkata"): "2026-07-15T00:00:00+05:30",
    ("2026-12-31T23:30:00", None): "2026-12-31T23:30:00+00:00",
    ("2026-12-31T23:30:00", "Nowhere/None"): "2026-12-31T23:30:00+00:00",
    # no zone, or none that is known: the offset stays
    ("2026-12-31T23:30:00-03:00", None): "2026-12-31T23:30:00-03:00",
    ("2026-12-31T23:30:00-03:00", ""): "2026-12-31T23:30:00-03:00",
    ("2026-12-31T23:30:00-03:00", "Nowhere/None"): "2026-12-31T23:30:00-03:00",
    ("2026-12-31T23:30:00.25+09:30", "UTC"): "2026-12-31T14:00:00.250000+00:00",
}


def test_zone_conversion(spark):
    frame = spark.createDataFrame(list(CONVERTED), "x string, z string")
    rows = frame.select(
        "x", "z", datetimes.iso_text(datetimes.convert(F.col("x"), F.col("z"))).alias("y")
    ).collect()
    assert {(r.x, r.z): r.y for r in rows} == CONVERTED


def test_every_zone_name_is_usable(spark):
    names = [(name,) for name in datetimes.zone_names()]
    frame = spark.createDataFrame(names, "z string")
    got = frame.select(
        "z", datetimes.iso_text(datetimes.convert(F.lit("2024-07-01T12:00:00Z"), F.col("z")))
    ).collect()
    want = {
        n: datetime(2024, 7, 1, 12, tzinfo=UTC).astimezone(ZoneInfo(n)).isoformat()
        for (n,) in names
    }
    different = {r[0] for r in got if r[1] != want[r[0]]}
    # the two time zone databases may be of different age; they must agree almost everywhere
    assert len(different) <= 5, different


def test_dates_of_a_row(spark):
    schema = (
        "i int, start string, `end` string, timezone string, "
        "time_slots array<struct<start string, `end` string>>"
    )
    rows = [
        (1, "2024-01-02", "2024-01-03T10:00+02:00", "Europe/Berlin",
         [("2024-05-01T10:00", "2024-05-01T11:00Z"), ("", ""), ("bad", "2024-05-01")]),
        (2, None, "", None, None),
        (3, "2024-01-02T10:00-05:30", "x", None, [("2024-05-01T10:00", "2024-05-01T11:00")]),
    ]
    done = normalise_datetimes(spark.createDataFrame(rows, schema)).orderBy("i").collect()
    assert [(r.start, r.end, r.timezone) for r in done] == [
        ("2024-01-02T00:00:00+01:00", "2024-01-03T09:00:00+01:00", "Europe/Berlin"),
        (None, "", None),
        ("2024-01-02T10:00:00-05:30", "x", "UTC-05:30"),
    ]
    assert [r.time_slots and [tuple(slot) for slot in r.time_slots] for r in done] == [
        [("2024-05-01T10:00:00+02:00", "2024-05-01T13:00:00+02:00"),
         ("bad", "2024-05-01T00:00:00+02:00")],
        None,
        [("2024-05-01T10:00:00-05:30", "2024-05-01T11:00:00-05:30")],
    ]
    assert [len(r.date_errors) for r in done] == [1, 0, 1]


def test_day_bucket(spark):
    cases = ["2024-07-01T20:00:00-04:00", "2024-07-01T20:00:00.000001+05:30", "2024-07-01T20Z",
             "2024-07-01", "never"]
    assert column(spark, cases, datetimes.day_bucket) == [
        "2024-07-01T00:00:00-04:00", "2024-07-01T00:00:00+05:30", "2024-07-01T00:00:00+00:00",
        "2024-07-01T00:00:00", None,
    ]


def test_zone_of_value(spark):
    cases = ["2024-07-01T20:00:00-04:00", "2024-07-01T20:00:00Z", "2024-07-01T20:00:00+05:30"]
    got = column(spark, cases, lambda x: datetimes.zone_of(datetimes.parse_iso(x)))
    assert got == ["UTC-04:00", "UTC", "UTC+05:30"]


def test_slots_split(spark):
    cases = ["a | b", "a|b|c", "10:00 - 12:00", "2024-07-01", "noon", "\ta|b-c\n"]
    got = column(spark, cases, datetimes.slot_from_text)
    assert [(g.start, g.end) for g in got] == [
        ("a", "b"), ("a", "b|c"), ("10:00", "12:00"), ("2024", "07-01"), ("noon", "noon"),
        ("a", "b-c"),
    ]


def test_normal_text(spark):
    cases = ["  Kite\t\tMaking ", "A B", "", "École  ÉTÉ", "a\x1fb"]
    assert column(spark, cases, text.normal_text) == [" ".join(c.lower().split()) for c in cases]


def test_strip(spark):
    cases = [" \t a b  \n", "", "\n", "x\n"]
    assert column(spark, cases, text.strip) == [c.strip() for c in cases]


def test_contacts(spark):
    cases = [
        "Call +1 (212) 555-0100 or +1 (212) 555-0100, ask BOX@Hall.org or box@hall.org",
        "17.25 88 Sternweg Comet",
        "nothing",
        "a@b.co c.d+e@x-y.museum 12345",
    ]
    assert column(spark, cases, text.emails) == [
        ["box@hall.org"], [], [], ["a@b.co", "c.d+e@x-y.museum"],
    ]
    assert column(spark, cases, text.phones) == [["+12125550100"], ["172588"], [], ["12345"]]


def test_contact_pool_skips_blanks(spark):
    row = spark.sql("SELECT 'a' a, '' b, CAST(NULL AS STRING) c, 'd' d")
    assert row.select(text.contact_pool(*map(F.col, "abcd"))).first()[0] == "a d"


def test_price(spark):
    cases = ["45", "1,250", "$15.5", "from 12.50 to 20", "Free", "", "12,34,56"]
    assert column(spark, cases, text.price_value) == [45.0, 1.25, 15.0, 12.5, None, None, 12.34]


def test_taxonomy(spark):
    rows = spark.createDataFrame(
        [(1, "Jazz Party", "events", None), (2, "Running Football", "sports", "Running"),
         (3, "Swim", "sports", "Swimming"), (4, "Swim", "events", "Swimming"),
         (5, None, "sports", "")],
        "i int, t string, e string, s string",
    )
    got = rows.select("i", text.taxonomy(F.col("t"), F.col("e"), F.col("s"))).orderBy("i").collect()
    assert [row[1] for row in got] == [
        ["music", "art"], ["football", "running"], ["swimming"], [], [],
    ]


def test_absolute_url(spark):
    bases = [
        "https://a.example.com/x/y/z.html?q=1#f", "http://a.example.com", "file://tests/h/a.html",
        "https://a.example.com/x/", "https://a.example.com/x/../y/b",
    ]
    hrefs = [
        "b.html", "/b", "?p=2", "#top", "//cdn.example.org/x", "https://o.example.org/../a", "..",
        "../b/./c", "./", "../../../../d", "", "mailto:x@y.org", "/a/../b/", "b//c", "b?x=/../y",
        "/", "..?z", " /one ", "\ta\nb",
    ]
    frame = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    rows = frame.select("b", "h", urls.absolute_url(F.col("b"), F.col("h")).alias("u")).collect()
    wrong = [(r.b, r.h, r.u, urljoin(r.b, r.h)) for r in rows if r.u != urljoin(r.b, r.h)]
    assert wrong == []


def test_canonical_url(spark):
    cases = ["HTTPS://Example.COM", "http://Example.com:80/A?b#C", "https://e.org:8443/x"]
    assert column(spark, cases, urls.canonical_url) == [
        "https://example.com/", "http://example.com/A?b#C", "https://e.org:8443/x",
    ]
    assert column(spark, ["/x", "ftp://a/b", "https://a/b"], urls.is_web_url) == [
        False, False, True,
    ]


def test_clean_images(spark):
    frame = spark.createDataFrame([([" b", "a", "", "b", " "],)], "x array<string>")
    assert frame.select(urls.clean_images(F.col("x"))).first()[0] == ["b", "a"]


ENTITY = "title string, start string, end string, venue_name string, address string, city string, source_id string"  # noqa: E501


def test_keys(spark):
    rows = spark.createDataFrame(
        [
            ("Kite \t Making", "2027-11-13T09:30:00+09:00", None, "Kura", "x", "Kanazawa", "market"),
            ("Coxed Four", None, None, "", "2 Wharf  Lane", "Whanganui", "rowing"),
            ("Mirror Maze", "", "2027-06-29T23:45:00+01:00", "Cais", None, "Aveiro", "lights"),
        ],
        ENTITY,
    )
    got = [row[0] for row in rows.select(keys.entity_key()).collect()]
    assert got == [
        hashlib.sha1(identity.encode()).hexdigest()
        for identity in (
            "kite making|2027-11-13T00:00:00+09:00|kura|kanazawa|market",
            "coxed four|1970-01-01T00:00:00+00:00|2 wharf lane|whanganui|rowing",
            "mirror maze|2027-06-29T00:00:00+01:00|cais|aveiro|lights",
        )
    ]


def test_nearby_keys(spark):
    rows = spark.createDataFrame(
        [("T", "2024-03-01T10:00:00+00:00", None, "v", None, "c", "s"),
         ("T", None, None, "v", None, "c", "s")],
        ENTITY,
    )

    def key(day):
        return hashlib.sha1(f"t|{day}T00:00:00+00:00|v|c|s".encode()).hexdigest()

    got = [row[0] for row in rows.select(keys.nearby_keys()).collect()]
    assert got == [[key("2024-02-29"), key("2024-03-02")], []]
