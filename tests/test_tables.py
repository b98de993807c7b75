"""State, robots, prefix, merge and count operators on small tables."""

from __future__ import annotations

import pytest

from urllib.robotparser import RobotFileParser

from pyspark.sql import functions as F

from marquee.operators import merge, prefix, robots, state, stats
from marquee.schema import COUNTERS, GOLD_FIXED, GOLD_REFRESHED, URL_STATE


def test_latest_state_and_headers(spark):
    seen = spark.createDataFrame(
        [("a", "1", "", "9", 1), ("a", "2", None, "10", 1), ("b", "", "Mon", "5", 1)], URL_STATE
    )
    latest = state.latest_state(seen)
    assert {tuple(r) for r in latest.collect()} == {
        ("a", "2", "", "10", 1), ("b", "", "Mon", "5", 1),
    }
    urls = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    got = {r.url: r.headers for r in state.conditional_headers(urls, latest).collect()}
    assert got == {"a": {"If-None-Match": "2"}, "b": {"If-Modified-Since": "Mon"}, "c": {}}


def test_unchanged_pages_are_skipped(spark):
    known = spark.createDataFrame(
        [("a", "1", "Mon", "5", 1), ("b", "1", "", "5", 1), ("c", "", "Mon", "5", 1),
         ("e", "1", "Mon", "5", 1)], URL_STATE,
    )
    pages = spark.createDataFrame(
        [("a", "1", "Tue", 200), ("b", "2", "", 200), ("c", "9", "Mon", 200), ("d", "1", "", 200),
         ("e", None, None, 304)],
        "url string, etag string, last_modified string, status int",
    )
    assert {r.url for r in state.changed_pages(pages, known).collect()} == {"b", "d"}
    after = state.next_state(pages, known, F.lit(8))
    got = {r.url: (r.etag, r.last_modified, r.last_seen) for r in after.collect()}
    assert got["e"] == ("1", "Mon", "8") and got["b"] == ("2", "", "8")


def test_resume_needs_the_same_page_set(spark):
    ddl = "source_id string, url string, page_idx int, urls_hash string"
    visits = spark.createDataFrame([("s", "a", 0, "h"), ("s", "b", 1, "h"), ("t", "c", 0, "i")], ddl)
    done = spark.createDataFrame([("s", "a", 0, "h"), ("t", "c", 0, "old")], ddl)
    assert {r.url for r in state.unfinished_pages(visits, done).collect()} == {"b", "c"}


ROBOTS = """
# comment
User-agent: other
User-agent: MarqueeBot
Disallow: /private  # inside
Allow: /private/open
Disallow:

User-agent: *
Crawl-delay: 3
Allow: /p%61th/ok
Disallow: /path
Disallow: /q?x=1

User-agent: *
Disallow: /
Disallow: /after
User-agent: late
Disallow: /late
"""


def test_robots_agree_with_the_standard_library(spark):
    texts = {
        "a.org": ROBOTS, "b.org": "", "c.org": "User-agent: *\r\nDisallow: /",
        "d.org": "Disallow: /x\nUser-agent: *\n\nDisallow: /y", "e.org": "user-agent:*\nDisallow:",
        "f.org:80": "User-Agent: *\nDisallow: /a b\nDisallow: /*",
    }
    paths = [
        "", "/", "/private", "/private/open", "/private/open/x", "/path", "/path/ok", "/p%61th/ok",
        "/pa", "/q?x=1", "/q?x=12", "/q", "/after", "/late", "/x", "/y", "/a%20b", "/a+b", "/*x",
        "/path?", "/é",
    ]
    table = spark.createDataFrame(list(texts.items()), "host string, text string")
    urls = [f"https://{host}{path}" for host in texts for path in paths]
    for agent in ("*", "MarqueeBot/1.0", "late", "nobody"):
        frame = spark.createDataFrame([(u,) for u in urls], "url string")
        got = {r.url: r.allowed for r in robots.with_permission(frame, table, agent).collect()}
        wrong = []
        for host, text in texts.items():
            parser = RobotFileParser()
            parser.parse(text.splitlines())
            for path in paths:
                url = f"https://{host}{path}"
                if parser.can_fetch(agent, url) != got[url]:
                    wrong.append((agent, url, got[url]))
        assert wrong == []


def test_files_unknown_hosts_and_error_replies_are_allowed(spark):
    table = spark.createDataFrame(
        [("x", "User-agent: *\nDisallow: /", 404), ("y", "User-agent: *\nDisallow: /", 200)],
        "host string, text string, status int",
    )
    urls = spark.createDataFrame([("file://y/a",), ("http://x/a",), ("http://y/a",), ("http://z/",)],
                                 "url string")
    assert {r.url for r in robots.allowed_urls(urls, table).collect()} == {
        "file://y/a", "http://x/a", "http://z/",
    }


def test_first_prefix_in_registry_order_wins(spark):
    sources = spark.createDataFrame(
        [(2, "long", "http://a.org/x"), (1, "short", "http://a.org/"), (3, "twin", "http://a.org/"),
         (0, "late", "http://b.org/y")],
        "row_no long, source_id string, base_url string",
    )
    urls = ["http://a.org/x/1", "http://b.org/y", "http://b.org/", "http://c", ""]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    found = prefix.first_prefix_match(frame, sources)
    assert {r.url: (r.matched, r.source_id) for r in found.collect()} == {
        "http://a.org/x/1": (True, "short"), "http://b.org/y": (True, "late"),
        "http://b.org/": (False, None), "http://c": (False, None), "": (False, None),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortAggregate" not in plan


def test_prefixes_that_end_inside_a_host(spark):
    sources = spark.createDataFrame(
        [(5, "any", "http"), (3, "co", "https://e.co"), (4, "path", "https://e.com/a"), (2, "query", "https://q?"),
         (1, "none", None), (6, "empty", "")],
        "row_no long, source_id string, base_url string",
    )
    urls = ["https://e.com/a/1", "https://e.co/", "https://e.org", "https://q?x", "https://q/?x", "ftp://e.co", "http", ""]
    frame = spark.createDataFrame([(u,) for u in urls * 2], "url string")
    got = {r.url: r.source_id for r in prefix.first_prefix_match(frame, sources).collect()}
    assert got == {
        "https://e.com/a/1": "co", "https://e.co/": "co", "https://e.org": "any", "https://q?x": "query",
        "https://q/?x": "any", "ftp://e.co": "empty", "http": "any", "": "empty",
    }


def gold(spark, rows):
    columns = [*merge.KEYS, "seq", *GOLD_FIXED, *GOLD_REFRESHED]
    kinds = {"seq": "long", "price_value": "double"}
    ddl = ", ".join(f"`{name}` {kinds.get(name, 'string')}" for name in columns)
    return spark.createDataFrame(
        [tuple({**{"entity_type": "events"}, **row}.get(name) for name in columns) for row in rows],
        ddl,
    )


def test_upsert(spark):
    first = gold(spark, [
        {"dedup_key": "a", "seq": 1, "title": "A", "price_text": "5", "time_slots_json": "[1]"},
        {"dedup_key": "b", "seq": 2, "title": "B", "url": "u"},
    ])
    empty = first.filter("false")
    table = merge.upsert(empty, merge.one_per_key(first))
    again = merge.upsert(table, merge.one_per_key(first))
    assert sorted(again.collect()) == sorted(table.collect())
    second = gold(spark, [
        {"dedup_key": "a", "seq": 1, "title": "A1", "price_text": "6", "time_slots_json": "[2]"},
        {"dedup_key": "a", "seq": 2, "title": "A2", "url": "v"},
        {"dedup_key": "c", "seq": 3, "title": "C", "entity_type": "sports"},
        {"dedup_key": "c", "seq": 5, "title": "C5", "url": "w"},
        {"dedup_key": "c", "seq": 4, "title": "C4", "url": "x"},
    ])
    after = merge.upsert(table, merge.one_per_key(second))
    got = {(r.entity_type, r.dedup_key): (r.title, r.price_text, r.url, r.time_slots_json)
           for r in after.collect()}
    assert got == {
        ("events", "a"): ("A", None, "v", "[1]"),
        ("events", "b"): ("B", None, "u", None),
        ("events", "c"): ("C4", None, "w", None),
        ("sports", "c"): ("C", None, None, None),
    }


def test_gold_rows_write_arrays_as_json(spark):
    row = spark.sql(
        """SELECT 'events' entity_type, 's' source_id, 't' title, NULL start, NULL `end`,
        'v' venue_name, 'a' address, 'c' city, 'US' country, CAST(NULL AS ARRAY<STRING>) emails,
        array('x') phones, array(named_struct('start','1','end','2')) time_slots"""
    )
    (got,) = merge.gold_rows(row).collect()
    assert (got.emails_json, got.phones_json, got.images_json) == ("[]", '["x"]', "[]")
    assert got.time_slots_json == '[{"start":"1","end":"2"}]' and len(got.dedup_key) == 40


def test_merge_versions(spark):
    ddl = "k string, title string, tags array<string>, price double"
    old = spark.createDataFrame([("a", "x", ["1"], 1.0), ("b", "y", [], None), ("d", "z", [], 2.0)], ddl)
    new = spark.createDataFrame([("a", "", [], None), ("b", "y2", ["2"], None), ("c", "n", [], None)], ddl)
    got = {r.k: tuple(r)[1:] for r in merge.merge_versions(old, new, "k").collect()}
    assert got == {
        "a": ("x", ["1"], 1.0, False), "b": ("y2", ["2"], None, True),
        "c": ("n", [], None, False), "d": ("z", [], 2.0, False),
    }


def test_counts(spark):
    rows = spark.createDataFrame(
        [("s", "new"), ("s", "new"), ("s", "rejected"), ("t", "updated")],
        "source_id string, outcome string",
    )
    assert {tuple(r) for r in stats.source_stats(rows).collect()} == {
        ("s", 2, 0, 1), ("t", 0, 1, 0),
    }
    replies = spark.createDataFrame([(200,), (204,), (404,), (304,), (101,)], "status int")
    full = stats.with_default_counters(stats.status_classes(replies)).collect()
    values = {r.counter: r.value for r in full}
    assert set(values) == {*COUNTERS, "http_1xx"} and values["http_2xx"] == 2
    assert values["duplicates"] == 0
    one = spark.range(1).select(stats.counter_map({"retries": F.lit(3), "robots_disallow": F.lit(1)}))
    made = one.first()[0]
    assert made["retries"] == 3 and made["robots_disallow"] == 1 and len(made) == 15


def test_column_fill(spark):
    frame = spark.sql("SELECT 'e' entity_type, 1 b, CAST(NULL AS INT) c, 'x' a")
    assert {tuple(r) for r in stats.column_fill(frame).collect()} == {("e", "a", 1), ("e", "b", 1)}


def test_between_is_inclusive(spark):
    frame = spark.createDataFrame(
        [("2024-01-01T00:00:00+00:00",), ("2024-01-01T00:00:00-01:00",), ("2024-01-02T01:00:00+01:00",),
         (None,)], "start string",
    )
    kept = stats.between(frame, "2024-01-01T01:00:00Z", "2024-01-02").collect()
    # a row without a date is not before or after anything
    assert [r.start for r in kept] == ["2024-01-01T00:00:00-01:00", "2024-01-02T01:00:00+01:00", None]
    for bounds in (("01/06/2024", None), (None, "soon"), ("", None)):
        with pytest.raises(ValueError, match="no ISO-8601"):
            stats.between(frame, *bounds)


def test_a_damaged_state_table_is_no_empty_one(spark, tmp_path):
    from marquee.sinks.tables import GoldTable, write_url_state
    from marquee.sources.runs import read_url_state

    path = str(tmp_path / "none")
    assert read_url_state(spark, path).count() == 0 and GoldTable(spark, path).read().count() == 0
    write_url_state(spark.createDataFrame([("a", "1", "", "5", 1)], URL_STATE), path, "one")
    (written,) = (tmp_path / "none" / "rows").glob("*/place=*/*.parquet")
    (written.parent / f".{written.name}.crc").unlink(missing_ok=True)
    written.write_bytes(b"no parquet file at all")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_url_state(spark, path).collect()
    for version in (tmp_path / "none" / "versions").iterdir():
        version.write_text("{")
    with pytest.raises(Exception):
        read_url_state(spark, path)
