from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marquee.functions.selectors import field_spec, link_spec
from marquee.operators import rules
from marquee.operators.html import Page, compile_selector
from marquee.schema import RULES

HTML = """<html><body>
<ul class="shows big"><li class="x"><h3>One <b>bold</b></h3><a href=" /one ">go</a>
<img src="a.png"><img src="b.png"/><time class=start datetime="2024-01-01"></time>
<span class="slot">10|11</span><span class="slot">12-13</span></li>
<li><h3></h3><p>un<p>closed</li></ul>
<div id="main"><li>not listed</li></div>
<script>var t = "<li>no</li>";</script>
<a rel="next" href="?p=2">2</a><a class="month-next" href="m2">m</a><a class="next">none</a>
</body></html>"""


def test_selectors():
    page = Page(HTML)

    def text(selector, start=-1):
        return [page.text(at) for at in page.select(selector, start)]

    assert text("ul.shows > li h3") == ["Onebold", ""]
    assert len(page.select("li")) == 3 and len(page.select("ul li")) == 2
    assert text("#main > li") == ["not listed"]
    assert text("ul > h3") == [] and text("ul h3 > b") == ["bold"]
    assert text("li.x span.slot, li.x b") == ["bold", "10|11", "12-13"]
    assert text("a[rel='next'], a.month-next") == ["2", "m"]
    assert text("time.start[datetime]") == [""] and text("[datetime=2024-01-01].start") == [""]
    second = page.select("ul.shows > li")[1]
    assert page.text(second) == "unclosed" and text("p", second) == ["unclosed", "closed"]
    assert page.text(page.select("body")[0]).find("var t") == -1
    assert page.text(page.select("script")[0]).startswith("var t")


@pytest.mark.parametrize("selector", ["", "li:first-child", "a + b", ">"])
def test_unsupported_selectors_raise(selector):
    with pytest.raises(ValueError):
        compile_selector(selector)


def test_expressions(spark):
    cases = {
        "h3": ("h3", None, False, False),
        " a @href ": ("a", "href", False, False),
        "img@src[]": ("img", "src", True, False),
        "img::attr(src)": ("img", "src", False, False),
        "time.start@datetime|text": ("time.start", "datetime", False, True),
        "time@datetime|text[]": ("time", "datetime", True, True),
        ".loc .name": (".loc .name", None, False, False),
        "meta[itemprop='startDate']@content": ("meta[itemprop='startDate']", "content", False, False),
    }
    frame = spark.createDataFrame([(e,) for e in cases], "e string")
    rows = frame.select("e", field_spec(F.lit("f"), F.col("e")).alias("s")).collect()
    got = {r.e: (r.s.selector, r.s.attr, r.s.multi, r.s.text_fallback) for r in rows}
    assert got == cases
    links = spark.createDataFrame([("a.next @href",), ("a.next",), ("a@href[]",)], "e string")
    got = [tuple(r.s) for r in links.select(link_spec(F.col("e")).alias("s")).collect()]
    assert got == [("a.next", "href"), ("a.next", None), ("a", "href")]


def rule(**changes):
    base = {
        "rule_path": "r", "list_item": "ul.shows > li", "fields": {}, "next_selector": None,
        "month_grid": False, "max_pages": 1, "timezone": None,
    }
    return {**base, **changes}


def pages(spark, html=HTML, entity_type="events"):
    return spark.createDataFrame(
        [("s", entity_type, "r", 0, 0, "https://e.org/list/", html)],
        "source_id string, entity_type string, rule_path string, row_no long, page_idx int, "
        "url string, html string",
    )


def test_extraction(spark):
    fields = {
        "title": "h3", "detail_url": "a@href", "images": "img@src[]", "time_slots": ".slot",
        "start": "time@datetime", "end": "time@end|text", "venue": "h3", "venue_name": ".none",
        "city": ".slot[]", "sport_type": "h3",
    }
    spec = spark.createDataFrame([rule(fields=fields, timezone="UTC")], RULES)
    one, two = rules.extract(pages(spark), spec).orderBy("seq").collect()
    assert (one.title, one.url, one.images) == ("Onebold", "/one", ["a.png", "b.png"])
    assert [(s.start, s.end) for s in one.time_slots] == [("10", "11"), ("12", "13")]
    assert (one.start, one.end, one.venue_name, one.timezone) == (
        "2024-01-01", None, "Onebold", "UTC",
    )
    assert one.city == '["10|11","12-13"]' and one.mistyped == ["city"]
    assert one.sport_type is None
    assert two.title is None and two.images == [] and two.time_slots == []
    assert two.seq.item == 1 and two.mistyped == ["city"]


def test_a_single_image_is_mistyped(spark):
    spec = spark.createDataFrame([rule(fields={"images": "img::attr(src)"})], RULES)
    one, two = rules.extract(pages(spark), spec).orderBy("seq").collect()
    assert (one.images, one.mistyped) == (["a.png"], ["images"])
    assert (two.images, two.mistyped) == (None, [])


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({"max_pages": 5}, []),
        ({"next_selector": "ul a", "max_pages": 5}, ["https://e.org/one "]),
        ({"next_selector": "a[rel]@href", "max_pages": 5}, ["https://e.org/list/?p=2"]),
        ({"next_selector": "a.next", "max_pages": 5}, []),
        (
            {"next_selector": "a[rel]@href", "month_grid": True, "max_pages": 5},
            ["https://e.org/list/?p=2", "https://e.org/list/?p=2", "https://e.org/list/m2"],
        ),
        (
            {"next_selector": "a[rel]@href", "month_grid": True, "max_pages": 3},
            ["https://e.org/list/?p=2", "https://e.org/list/?p=2"],
        ),
        ({"next_selector": "a[rel]", "month_grid": True, "max_pages": 1}, []),
    ],
)
def test_frontier(spark, changes, expected):
    spec = spark.createDataFrame([rule(**changes)], RULES)
    rows = rules.frontier(pages(spark), spec).orderBy("page_idx").collect()
    assert [r.url for r in rows] == expected
    assert [r.page_idx for r in rows] == list(range(1, len(expected) + 1))


@pytest.mark.parametrize(
    ("selector", "found"),
    [
        ("a[href^='/event']", 1), ("a[href$='.pdf']", 1), ("a[href*='ven']", 1), ("a[rel~=next]", 1),
        ("a[href='/event/1']", 1), ("a[href]", 2), ("a[href^='']", 0),
    ],
)
def test_attribute_operators(selector, found):
    page = Page("<a href='/event/1' rel='next last'>x</a><a href='/doc.pdf'>y</a>")
    assert len(page.select(selector)) == found


@pytest.mark.parametrize("selector", ["a:nth-child(2)", "a:not(.b)", "a + b", "a ~ b", "a[href|='x']"])
def test_selectors_beyond_the_helper_are_refused(selector):
    with pytest.raises(ValueError):
        Page("<a>x</a>").select(selector)


def test_page_join_from_buckets_moves_no_html(spark, tmp_path):
    """Nothing is exchanged above the scan of a bucketed bronze table."""
    from marquee.operators import extract
    from marquee.sinks import tables
    from marquee.sources import pages as page_source

    visits = pages(spark).drop("html")
    shown = pages(spark).selectExpr(
        "url", "html", "CAST(map() AS MAP<STRING, STRING>) AS headers", "TIMESTAMP'2024-01-01 00:00:00' AS fetched_at"
    )
    path = str(tmp_path / "bronze")
    tables.write_bronze_table(shown, "bronze_of_a_test", path, buckets=4)
    tables.write_bronze_table(shown.withColumn("url", F.lit("other")), "bronze_of_a_test", path, buckets=4)
    spark.sql("DROP TABLE bronze_of_a_test")
    bronze = page_source.bronze_table(spark, "bronze_of_a_test", path, buckets=4)
    spec = spark.createDataFrame([rule(fields={"title": "h3"})], RULES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = extract.read(visits.join(bronze.select("url", "html"), "url"), spec, "hrefs", "problem")
        assert len(read.collect()[0]["items"]) == 2 and bronze.count() == 2
        lines = read._jdf.queryExecution().executedPlan().toString().splitlines()
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        depth, above = len(lines[scan]) - len(lines[scan].lstrip(" :+-*")), []
        for line in reversed(lines[:scan]):
            at = len(line) - len(line.lstrip(" :+-*"))
            if at < depth:
                above.append(line)
                depth = at
        assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bronze_of_a_test")


def test_rules_that_are_not_understood(spark):
    table = spark.createDataFrame(
        [rule(), rule(rule_path="next", next_selector="a:nth-child(2)"), rule(rule_path="item", list_item=""),
         rule(rule_path="field", fields={"title": "h3 + p", "start": "time"})], RULES,
    )
    got = {r.rule_path: r.problem for r in rules.checked(table).collect()}
    assert got["r"] is None and got["next"].startswith("next_selector: ") and got["item"].startswith("list_item: ")
    assert got["field"].startswith("title: ") and "start" not in got["field"]


def test_one_reading_keeps_errors_apart(spark):
    """A next rule that fails costs the links; the items stand, and so do other pages."""
    table = spark.createDataFrame([rule(next_selector="a:nth-child(2)", max_pages=3)], RULES)
    ruled = rules.with_rules(pages(spark).unionByName(pages(spark, None)), table)
    got = rules.read_pages(ruled, ["url"], "items", "hrefs", "problem").collect()
    read, none = sorted(got, key=lambda r: len(r["items"]), reverse=True)
    assert len(read["items"]) == 2 and read.hrefs is None and read.problem.startswith("links: unsupported")
    assert none["items"] == [] and none.hrefs == [] and none.problem is None
