"""What reading a page and shaping its rows may not do more often than needed."""

from __future__ import annotations

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from marquee.functions import datetimes, urls
from marquee.operators import html, jsonld
from marquee.operators.normalise import normalise_datetimes


class _Parsed(html.Page):
    """A page read by the standard parser whatever its markup."""

    def _read_plain(self, text: str) -> bool:
        return False


def _read(page: html.Page) -> tuple:
    return page.tags, page.attrs, page.parents, page.ends, page.texts, page.text_at


PLAIN = [
    "",
    "<!DOCTYPE html><html><head><title>a b</title></head><body class='x y'>t<br/>u</body></html>",
    '<P ID="q" hidden data-a=\'1\'>a &amp; b<!-- c --><b>c</b></p ><li><my-el a="&lt;"/></li>',
    "<script type=\"application/ld+json\">{\"a\": \"<b>x</p>\"}</script><style>a > b {}</STYLE><p>x",
]
ODD = [
    "<p a=1>x</p>", "a < b", "x &amp", "<script>x</script >y</script>", "<script>x", "</ p>", "<p a = 'b'>",
    "<title>a &amp; <b>c</title>", "<!-- a -- b -->c", "<!-->x", "<script><!-- </script> --></script>",
    "<script/>x", "<p a='<'>x", "<p", "<?pi?>x", "<![CDATA[x]]>y", "<p a='1'b='2'>x",
]


@pytest.mark.parametrize("text", PLAIN)
def test_plain_markup_is_not_given_to_the_parser(monkeypatch, text):
    wanted = _read(_Parsed(text))
    monkeypatch.setattr(HTMLParser, "feed", None)
    assert _read(html.Page(text)) == wanted


@pytest.mark.parametrize("text", ODD)
def test_other_markup_is_read_as_the_parser_does(text):
    assert _read(html.Page(text)) == _read(_Parsed(text))


def test_elements_are_found_by_class():
    page = html.Page('<div class="a b"><p class="a">x</p><i class="ab">y</i></div><p class="b a c">z</p>')
    assert page.select(".a") == [0, 1, 3]
    assert page.select("p.a.c, i") == [2, 3]
    assert page.select(".a", 0) == [1]
    # only elements of the class are looked at
    seen, matches = [], page._matches
    page._matches = lambda at, step: seen.append(at) or matches(at, step)
    page.select(".ab")
    assert seen == [2]


def test_a_block_is_parsed_once(spark):
    plan = spark.range(1).select(jsonld.nodes(F.col("id").cast("string")).alias("n"))._jdf.queryExecution()
    assert plan.analyzed().toString().lower().replace("_", "").count("parsejson") == 1


def test_names_written_with_escapes_are_opened(spark):
    texts = [
        r'{"@graph": [{"a": 1}, {"b": 2}]}', '{"@list": [{"a": 1}, 3]}', '{"@graph": [{"@graph": [{"c": 3}]}]}',
        '[{"a": 1}, 2]', "3", "no json", r'{"\u0040graph": [{"a": 1}, {"b": 2}]}',
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(1)
    found = frame.select("i", F.transform(jsonld.nodes(F.col("t")), lambda n: F.to_json(n)).alias("n")).orderBy("i")
    assert [row.n for row in found.collect()] == [
        ['{"a":1}', '{"b":2}'], ['{"a":1}'], ['{"c":3}'], ['{"a":1}'], [], [], ['{"a":1}', '{"b":2}'],
    ]


def test_text_that_needs_no_zone_is_known(spark):
    texts = {
        "2024-01-02T10:00:00-05:30": -19800, "2024-01-02T10:00:00+00:00": 0, "2024-01-02T10:00:00-00:00": None,
        "2024-02-30T10:00:00+01:00": None, "2024-01-02T24:00:00+01:00": None, "2024-01-02T10:00+01:00": None,
        "0000-01-02T10:00:00+01:00": None, "2024-01-02T10:00:00Z": None, "": None,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", datetimes.plain_offset(F.col("t")).alias("o")).collect()
    assert {row.t: row.o for row in rows} == texts


def test_dates_are_moved_only_to_other_zones(spark):
    slots = [("2024-01-02T10:00:00-05:30", "2024-01-02T10:00:00Z")]
    rows = [
        (1, "2024-01-02T10:00:00-05:30", "2024-01-02T12:00:00+01:00", None, slots),
        (2, "2024-01-02T10:00:00-00:00", None, None, slots),
        (3, "2024-01-02T10:00:00+00:00", "2024-01-02T10:00:00+01:00", "UTC", None),
        (4, "2024-07-02T10:00:00+01:00", "2024-07-02T10:00:00+02:00", "Europe/Berlin", None),
        (5, "2024-07-02T10:00:00+01:00", "2024-07-02T10:00:00", "Nowhere", None),
        (6, "2024-07-02T10:00:00+01:00", "2024-07-02T10:00:00", "UTC+99:00", None),
    ]
    schema = "i int, start string, `end` string, timezone string, time_slots array<struct<start string, `end` string>>"
    done = normalise_datetimes(spark.createDataFrame(rows, schema)).orderBy("i").collect()
    assert [(r.start, r.end, r.timezone, len(r.date_errors)) for r in done] == [
        ("2024-01-02T10:00:00-05:30", "2024-01-02T05:30:00-05:30", "UTC-05:30", 0),
        ("2024-01-02T10:00:00+00:00", None, "UTC", 0),
        ("2024-01-02T10:00:00+00:00", "2024-01-02T09:00:00+00:00", "UTC", 0),
        ("2024-07-02T11:00:00+02:00", "2024-07-02T10:00:00+02:00", "Europe/Berlin", 0),
        ("2024-07-02T10:00:00+01:00", "2024-07-02T10:00:00+00:00", "Nowhere", 0),
        ("2024-07-02T10:00:00+01:00", "2024-07-02T10:00:00+00:00", "UTC+99:00", 1),
    ]
    assert [tuple(r.time_slots[0]) for r in done[:2]] == [
        ("2024-01-02T10:00:00-05:30", "2024-01-02T04:30:00-05:30"),
        ("2024-01-02T15:30:00+00:00", "2024-01-02T10:00:00+00:00"),
    ]


def test_simple_urls_are_put_in_form_as_others_are(spark):
    texts = [
        "http://A.b/c", "HTTPS://A.B", "http://a.b?x#Y", "http://a.b#y/z", "http://u@H.c/x", "http://h:80/",
        "https://h:443", "http://h:81/x", "http://a.b/\nX", "http://a.b/c@d:80", "http://a.b:x/y", "ftp://x/",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    both = frame.select(urls.canonical_url(F.col("t")).alias("a"), urls._any_canonical(F.col("t")).alias("b"))
    assert [r.a for r in both.collect()] == [r.b for r in both.collect()]
