from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.plans import reports
from marquee.plans.run import run
from marquee.sinks import tables
from marquee.sources import pages as page_source
from marquee.sources import registry, rules, runs
from tests.pages import MARKET, PAGES, REGISTRY, RULES


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    (folder / "sources.csv").write_text(REGISTRY)
    (folder / "rules").mkdir()
    for name, text in RULES.items():
        (folder / "rules" / name).write_text(text)
    pages = spark.createDataFrame(list(PAGES.items()), "url string, html string")
    return (
        registry.read(spark, str(folder / "sources.csv")),
        rules.read(spark, str(folder / "rules")),
        pages,
    )


@pytest.fixture(scope="module")
def finished(spark, inputs, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("out"))
    return root, run(spark, root, "run-20240901T120000", *inputs)


def test_registry_and_rules(spark, inputs):
    sources, rule_table, _ = inputs
    rows = {r.source_id: r for r in sources.collect()}
    assert [r.source_id for r in sorted(rows.values(), key=lambda r: r.row_no)] == [
        "dome", "rowing", "market", "lights", "climb", "shut",
    ]
    assert rows["climb"].max_qps == 1.0 and rows["climb"].concurrency == 1
    assert rows["lights"].enabled and rows["market"].enabled and not rows["shut"].enabled
    assert rows["lights"].sitemap_url and rows["market"].sitemap_url is None
    spec = {r.rule_path: r for r in rule_table.collect()}
    assert spec["climb.yaml"].max_pages == 1 and spec["lights.yaml"].month_grid
    assert spec["rowing.yaml"].next_selector is None
    fields = rules.exploded(rule_table).filter("rule_path = 'market.yaml' AND field = 'start'")
    (start,) = fields.collect()
    assert (start.selector, start.attr, start.multi) == ("data.opens", "value", False)


def test_run_counts(finished):
    _, result = finished
    assert result.counts == {"events": 11, "festivals": 4, "sports": 5}
    expected = {
        "pages_fetched": 7, "http_2xx": 7, "entities_new": 20, "duplicates": 2,
        "validates_failed": 1, "quarantine_rows": 1, "parse_failures": 0, "unchanged_skips": 0,
    }
    assert {name: result.counters[name] for name in expected} == expected
    per_source = {r.source_id: (r.rows_new, r.rows_updated, r.rejects)
                  for r in result.source_stats.collect()}
    assert per_source == {
        "dome": (4, 0, 0), "rowing": (2, 0, 1), "market": (7, 0, 0), "lights": (4, 0, 0),
        "climb": (3, 0, 0),
    }


def test_silver_rows(spark, finished):
    root, _ = finished
    silver = spark.read.json(f"{root}/silver")
    rows = {r.title: r for r in silver.collect()}
    comet, dial = rows["Comet Jazz"], rows["Art of the Sundial"]
    # the price and the house number together look like a phone number
    assert (comet.price_value, comet.phones, comet.taxonomy, comet.timezone) == (
        17.25, ["172588"], ["music"], "UTC+01:00",
    )
    assert (dial.start, dial.end) == ("2027-07-09T11:00:00+02:00", "2027-07-09T15:30:00+02:00")
    assert dial.timezone == "Europe/Berlin" and len(dial.time_slots) == 2
    assert dial.taxonomy == ["art"] and dial.organizer == "Sternfreunde"
    assert sorted(dial.images) == [
        "https://dome.example.net/dial.png", "https://dome.example.net/noon.png",
    ]
    assert rows["Dark Skies"].start == "2027-11-12T18:00:00+01:00"
    days = sorted(r.start[:10] for r in silver.collect() if r.title == "Kite Making")
    assert days == ["2027-11-13", "2027-11-15"] and rows["Kite Making"].timezone == "UTC+09:00"
    assert rows["Koto Recital"].timezone == "Asia/Tokyo"
    lead = rows["Lead Class"]
    assert (lead.sport_type, lead.start, lead.taxonomy) == ("Climbing", None, ["climbing"])
    assert rows["Dawn Circuit"].taxonomy == ["running"]
    assert "Never Visited" not in rows and "Novice Heat" not in rows


def test_quarantine(spark, finished):
    root, _ = finished
    (reject,) = spark.read.json(f"{root}/quarantine").collect()
    assert reject.entity.title == "Novice Heat" and reject.entity.images
    assert reject.reason == ["$.images: value is not of type 'array'"]


def test_csv_and_gold(spark, finished):
    root, _ = finished
    festivals = spark.read.option("header", True).option("escape", '"').csv(
        f"{root}/exports/2024-09-01/festivals"
    )
    assert festivals.columns == sorted(festivals.columns)
    assert "price_text" not in festivals.columns and festivals.count() == 4
    assert festivals.filter("title = 'Mirror Maze'").first().images == (
        '["https://lights.example.net/2027-06-29.webp"]'
    )
    gold = tables.GoldTable(spark, f"{root}/gold").read()
    assert gold.count() == 20 and gold.select("dedup_key").distinct().count() == 20


def test_repeated_run_changes_nothing_and_a_second_run_updates(spark, inputs, finished, tmp_path):
    root, _ = finished
    before = sorted(tables.GoldTable(spark, f"{root}/gold").read().collect(), key=str)
    run(spark, root, "run-20240901T120000", *inputs)
    assert sorted(tables.GoldTable(spark, f"{root}/gold").read().collect(), key=str) == before
    sources, rule_table, pages = inputs
    changed = pages.withColumn("html", F.replace("html", F.lit("17.25"), F.lit("19.75")))
    result = run(
        spark, root, "run-20240902T120000", sources, rule_table, changed, source_id="dome"
    )
    assert result.counts == {"events": 4}
    gold = tables.GoldTable(spark, f"{root}/gold").read()
    assert gold.count() == 20
    assert gold.filter("title = 'Comet Jazz'").first().price_text == "19.75"
    counts = runs.read_source_counts(spark, f"{root}/source_counts")
    report = reports.status(sources, runs.read_manifests(spark, f"{root}/manifests"), counts)
    got = {r.source_id: (r.rows_new, r.rejects, r.last_run) for r in report.collect()}
    assert got["dome"] == (4, 0, "run-20240902T120000")
    assert got["rowing"] == (2, 1, "run-20240901T120000")
    assert got["shut"] == (0, 0, None)


def test_filters_of_a_run(spark, inputs, tmp_path):
    sources, rule_table, pages = inputs
    robots_table = spark.createDataFrame(
        [("lights.example.net", "User-agent: *\nDisallow: /june")], "host string, text string"
    )
    state = spark.createDataFrame(
        [(MARKET, "e1", "", "5", 1)],
        "url string, etag string, last_modified string, last_seen string, version int",
    )
    tagged = pages.withColumns({"etag": F.lit("e1"), "last_modified": F.lit("")})
    result = run(
        spark, str(tmp_path), "r-20240903T000000", sources, rule_table, tagged,
        robots_table=robots_table, url_state=state,
    )
    assert result.counts == {"events": 4, "festivals": 1, "sports": 5}
    assert result.counters["robots_disallow"] == 1 and result.counters["unchanged_skips"] == 1
    one = run(spark, str(tmp_path), "r-20240904T000000", sources, rule_table, pages,
              entity_type="festivals", limit=1, since="2027-06-01", until="2027-06-18T20:00+01:00")
    assert one.counts == {"festivals": 2}


def test_bad_registry_row_stops_the_run(spark, inputs, tmp_path):
    _, rule_table, pages = inputs
    bad = tmp_path / "bad.csv"
    bad.write_text(REGISTRY + "odd,https://x,events,USA,true,,dome.yaml,daily,1,1,false\n")
    with pytest.raises(Exception, match="Invalid source row odd: country"):
        run(spark, str(tmp_path), "r-20240901", registry.read(spark, str(bad)), rule_table, pages)


def test_validate_sources(spark, inputs, tmp_path):
    _, rule_table, _ = inputs
    path = tmp_path / "sources.csv"
    path.write_text(
        REGISTRY
        + "a,https://x,events,USA,true,,dome.yaml,hourly,0,1,true\n"
        + "b,https://x,events,US,true,,lost.yaml,daily,x,1.5,true\n"
        + ",https://x,events,US,true,,lost.yaml,daily,1,1,true\n"
    )
    checked = reports.validate_sources(registry.read(spark, str(path)), rule_table)
    got = {r.source_id: (r.status, r.detail) for r in checked.collect()}
    assert got["market"] == ("OK", "") and got["shut"] == ("DISABLED", "disabled")
    assert got["a"][0] == "FAIL" and "country" in got["a"][1] and "max_qps" in got["a"][1]
    assert "lost.yaml" in got["b"][1] and "concurrency: not a whole" in got["b"][1]
    assert len(got) == 8


def test_explain(spark, inputs):
    sources, _, _ = inputs
    urls = spark.createDataFrame([("https://market.example.net/stalls/page9",), ("https://no",)],
                                 "url string")
    got = {r.url: r for r in reports.explain(urls, sources).collect()}
    market = got["https://market.example.net/stalls/page9"]
    assert (market.matched, market.source_id, market.rules_path) == (True, "market", "market.yaml")
    assert not got["https://no"].matched


def test_select_sources(spark, inputs):
    sources, _, _ = inputs
    chosen = registry.select_sources(sources, entity_type="sports", limit=1).collect()
    assert [r.source_id for r in chosen] == ["rowing"]
    assert registry.select_sources(sources, source_id="nobody").count() == 0


def test_reject_files(spark, tmp_path):
    now = datetime.now(UTC)
    for name, source, reasons in [
        (now - timedelta(days=1), "a", ["r1", "r2"]),
        (now - timedelta(days=30), "a", ["r1"]),
        ("odd", "b", ["r1"]),
    ]:
        stamp = name if isinstance(name, str) else name.strftime("%Y%m%dT%H%M%S%f")
        text = ", ".join(f'"{r}"' for r in reasons)
        (tmp_path / f"reject_{stamp}.json").write_text(
            '{\n "entity": {"source_id": "%s"},\n "reason": [%s]}' % (source, text)
        )
    rejects = runs.read_reject_files(spark, str(tmp_path))
    got = {r.reason: r.rejects for r in reports.inspect_rejects(rejects).collect()}
    assert got == {"r1": 2, "r2": 1}
    only = reports.inspect_rejects(rejects, source_id="b").collect()
    assert [(r.reason, r.rejects) for r in only] == [("r1", 1)]
    assert {r.reason: r.rejects for r in reports.inspect_rejects(rejects, 60).collect()}["r1"] == 3


def test_manifest_files(spark, tmp_path):
    (tmp_path / "run-20240101T000000.json").write_text(
        '{"run_id": "20240101T000000",\n "source_stats": {"a": {"rows_new": 1, "rejects": 2}}}'
    )
    (tmp_path / "run-events-20240102T000000.json").write_text(
        '{"run_id": "x", "source_stats": {"b": {"rows_new": 5, "rows_updated": 1, "rejects": 0}}}'
    )
    (tmp_path / "run-20250101T000000.json").write_text("{broken")
    # a document whose nested objects begin a line is one document
    (tmp_path / "run-odd-20230101T000000.json").write_text(
        '{"run_id": "y", "source_stats":\n{"c":\n{"rows_new": 2}\n},\n"paths":\n{}\n}\n'
    )
    manifests = runs.read_manifests(spark, str(tmp_path))
    assert manifests.count() == 3
    manifests = manifests.filter("run_id <> 'y'")
    got = {r.name: r.run_time for r in manifests.collect()}
    assert got == {
        "run-20240101T000000.json": datetime(2024, 1, 1),
        "run-events-20240102T000000.json": datetime(2024, 1, 2),
    }
    newest = {r.source_id: r.rows_new for r in reports.newest_run_per_source(manifests).collect()}
    assert newest == {"a": 1, "b": 5}


def test_page_files_and_bronze(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<p>one\ntwo</p>")
    pages = page_source.read_files(spark, str(tmp_path / "in"), "https://e.org/")
    (page,) = pages.collect()
    assert (page.url, page.html) == ("https://e.org/a.html", "<p>one\ntwo</p>")
    out = str(tmp_path / "bronze")
    tables.write_bronze(pages, out)
    tables.write_bronze(pages, out)
    bronze = page_source.read_bronze(spark, out)
    assert bronze.count() == 2 and len(bronze.first().url_hash) == 64


def test_run_date(spark):
    assert tables.run_date_text(spark, "events-20250925T224210") == "2025-09-25"
    with pytest.raises(ValueError):
        tables.run_date_text(spark, "events")


def test_url_state_table(spark, tmp_path):
    path = str(tmp_path / "state")
    assert runs.read_url_state(spark, path).count() == 0
    rows = spark.createDataFrame(
        [("a", "1", "", "5", 1), ("b", "1", "", "5", 2)],
        "url string, etag string, last_modified string, last_seen string, version int",
    )
    tables.write_url_state(rows, path, "one")
    assert [r.url for r in runs.read_url_state(spark, path).collect()] == ["a"]
    # under the same name nothing is added twice; a later batch replaces what it saw again
    later = rows.filter("url = 'a'").withColumns({"etag": F.lit("2"), "last_seen": F.lit("10")})
    for _ in range(2):
        tables.write_url_state(later, path, "two")
    assert [(r.url, r.etag) for r in runs.read_url_state(spark, path).collect()] == [("a", "2")]


def test_manifest_of_many_sources(spark, tmp_path):
    """No source is lost however many rows the manifest has."""
    rows = spark.range(25_000).selectExpr("concat('s', id) AS source_id", "id % 3 AS share")
    rows.groupBy("share").agg(F.collect_list("source_id").alias("ids")).selectExpr(
        "'r' AS run_id",
        "map_from_entries(transform(ids, i -> struct(i, "
        "named_struct('rows_new', 1L, 'rows_updated', 0L, 'rejects', 0L)))) AS source_stats",
    ).coalesce(1).write.json(f"{tmp_path}/run-20240101T000000.json")
    manifests = runs.read_manifests(spark, str(tmp_path))
    assert manifests.select(F.explode("source_stats")).count() == 25_000
