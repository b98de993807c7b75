"""Queries over the generated tables, one per operator: name -> (spark, folder) -> DataFrame.

The tables hold no listings, so each query first shapes whole tables into listings with plain
projections and joins, then calls the library. `oracles` holds the same answers in SQL.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import datetimes, keys, selectors, text
from marquee.operators import (
    dedup,
    extract,
    jsonld,
    merge,
    normalise,
    robots,
    rules,
    state,
    stats,
    validate,
)
from marquee.plans import reports
from marquee.plans.run import judge, run
from marquee.schema import RULES
from marquee.session import checkpoint_dir, configured, spread
from marquee.sinks import tables
from marquee.sinks.history import KeptKeys
from marquee.sources import pages as page_source
from marquee.sources import registry, runs
from marquee.streaming import dedup as stream_dedup
from marquee.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configured(spark).read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for queries that write."""
    return f"{checkpoint_dir(spark).rstrip('/')}/queries/{name}-{uuid.uuid4().hex}"


def joined(array: str | Column, mark: str = ",") -> Column:
    return F.array_join(array, mark)


# --- Tables shaped as listings ----------------------------------------------------------------


def event_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as listings: 20 sources, one venue per user, the title in untidy case."""
    events = spread(table(spark, folder, "events"), "event_id")
    return events.select(
        "event_id",
        "ts",
        "value",
        F.lit("events").alias("entity_type"),
        F.col("event_id").alias("seq"),
        F.expr("concat('src', user_id % 20)").alias("source_id"),
        F.expr("concat('  ', upper(event_type), ' \t Night ')").alias("title"),
        F.concat(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")
        ).alias("start"),
        F.lit(None).cast("string").alias("end"),
        F.expr("concat('venue ', user_id)").alias("venue_name"),
        F.lit("").alias("address"),
        F.expr("concat('city ', user_id % 7)").alias("city"),
        F.lit("US").alias("country"),
    )


def customer_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as normalised listings of all three types, many with something wrong."""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "CASE c_custkey % 3 WHEN 0 THEN 'events' WHEN 1 THEN 'festivals' ELSE 'sports' END"
        " AS entity_type",
        "c_custkey AS seq",
        "concat('src', c_custkey % 5) AS source_id",
        "CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS title",
        "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS sport_type",
        "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE '2024-05-01T10:00:00+00:00' END AS start",
        "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE '2024-05-01T12:00:00+00:00' END AS `end`",
        "CASE WHEN c_custkey % 23 = 0 THEN '' ELSE 'UTC' END AS timezone",
        "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('hall ', c_nationkey) END AS venue_name",
        "concat(c_nationkey, ' Main St') AS address",
        "concat('city ', c_nationkey) AS city",
        "CASE WHEN c_custkey % 13 = 0 THEN 'usa' ELSE 'US' END AS country",
        "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE"
        " array(named_struct('start', '2024-05-01', 'end', '2024-05-02')) END AS time_slots",
        "CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS STRING) AS price_text",
        "CAST(c_acctbal AS DOUBLE) AS price_value",
        "CAST(NULL AS STRING) AS organizer",
        "concat('https://c', c_custkey, '.example.com/') AS url",
        "array(concat('c', c_custkey, '@example.com')) AS emails",
        "CAST(array() AS ARRAY<STRING>) AS phones",
        "array('x.jpg') AS images",
        "CAST(array() AS ARRAY<STRING>) AS taxonomy",
        "CASE WHEN c_custkey % 29 = 0 THEN array('images') ELSE"
        " CAST(array() AS ARRAY<STRING>) END AS mistyped",
    )


def order_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One listing page per order: JSON-LD of six shapes, and the same listing as a list item."""
    orders = spread(table(spark, folder, "orders"), "o_orderkey")
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    rows = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "o_orderkey",
            "o_custkey",
            "o_orderkey % 6 AS kind",
            "date_format(o_orderdate, 'yyyy-MM-dd') AS day",
            "date_format(o_orderdate + INTERVAL 1 DAY, 'yyyy-MM-dd') AS next_day",
            "o_orderpriority",
            "c_name",
            "c_mktsegment",
            "n_name",
            "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING) AS price",
            "CASE WHEN o_orderkey % 13 = 0 THEN 'USA' ELSE 'US' END AS country",
        )
    )
    node = """named_struct(
        '@type', CASE kind WHEN 2 THEN parse_json('["Thing","Festival"]')
            WHEN 3 THEN parse_json('"SportsEvent"') WHEN 4 THEN parse_json('"MusicEvent"')
            ELSE parse_json('"Event"') END,
        'name', concat(' Show ', o_orderpriority, ' '),
        'startDate', concat(day, 'T18:00:00-05:00'),
        'endDate', CASE WHEN kind = 5 THEN NULL ELSE concat(day, 'T20:00:00-05:00') END,
        'sport', CASE WHEN kind = 3 THEN c_mktsegment END,
        'location', named_struct('name', c_name, 'address', named_struct(
            'streetAddress', '', 'street', concat(c_mktsegment, ' St'),
            'addressLocality', n_name, 'addressCountry', country)),
        'offers', array(named_struct('price',
            CASE WHEN kind = 5 THEN parse_json('5') ELSE parse_json(concat('"', price, '"')) END)),
        'image', array(concat('https://Img.example.com/', o_orderkey), ''),
        'url', 'https://Shows.Example.com',
        'subEvent', CASE WHEN kind = 5 THEN array(named_struct(
            'startDate', concat(day, 'T21:00:00-05:00'), 'endDate', concat(day, 'T22:00:00-05:00')
        )) END)"""
    with_node = rows.withColumn("node", F.expr(f"to_json({node})"))
    block = """CASE kind
        WHEN 1 THEN concat('{"@graph":[{"@graph":[', node, ',7]},"x"]}')
        WHEN 2 THEN concat('[', node, ']')
        WHEN 3 THEN concat('{"@list":[', node, ']}') ELSE node END"""
    item = """concat('<ul class="shows"><li><h3>Show <b>', o_orderpriority, '</b></h3>',
        '<time class="from" datetime="', next_day, 'T18:00:00-05:00"></time>',
        '<time class="to" datetime="', next_day, 'T20:00:00-05:00"></time>',
        '<span class="venue">', c_name, '</span><span class="addr">', c_mktsegment, ' St</span>',
        '<span class="city">', n_name, '</span><span class="country">', country, '</span>',
        '<span class="price">from ', price, '</span></li></ul>')"""
    return with_node.select(
        "o_orderkey",
        F.expr("concat('src', o_custkey % 50)").alias("source_id"),
        F.expr(
            "CASE WHEN o_orderkey % 11 = 0 THEN 'sports' WHEN kind = 2 THEN 'festivals'"
            " WHEN kind = 3 THEN 'sports' ELSE 'events' END"
        ).alias("entity_type"),
        F.lit("shows").alias("rule_path"),
        F.col("o_orderkey").alias("row_no"),
        F.lit(0).alias("page_idx"),
        F.expr("concat('https://shows.example.com/', o_orderkey)").alias("url"),
        F.concat(
            F.lit('<html><head><script type="application/ld+json">'),
            F.expr(block),
            F.lit("</script></head><body>"),
            F.expr(item),
            F.lit("</body></html>"),
        ).alias("html"),
    )


def rule(spark: SparkSession, name: str, **parts) -> DataFrame:
    """A rule table of one rule."""
    row = {
        "rule_path": name, "list_item": "body", "fields": {}, "next_selector": None,
        "month_grid": False, "max_pages": 1, "timezone": None, **parts,
    }
    return spark.createDataFrame([tuple(row[f] for f in RULES.fieldNames())], RULES)


def order_rule(spark: SparkSession) -> DataFrame:
    return rule(
        spark,
        "shows",
        list_item="ul.shows > li",
        fields={
            "title": "h3", "start": "time.from@datetime", "end": "time.to@datetime",
            "venue": ".venue", "addr": ".addr", "city": ".city", "country": ".country",
            "price_text": ".price",
        },
    )


def site_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The raw pages with the columns extraction needs."""
    return spread(table(spark, folder, "pages"), "page_id").select(
        "page_id",
        "url",
        "html",
        F.lit("site").alias("source_id"),
        F.lit("events").alias("entity_type"),
        F.lit("site").alias("rule_path"),
        F.col("page_id").alias("row_no"),
        F.lit(0).alias("page_idx"),
    )


def supplier_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as registry text, some rows bad."""
    return table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS row_no",
        "concat(' src', s_suppkey) AS source_id",
        "concat('https://h', s_suppkey, '.example.com/') AS base_url",
        "CASE s_suppkey % 5 WHEN 0 THEN 'events' WHEN 1 THEN 'festivals' WHEN 2 THEN 'sports'"
        " WHEN 3 THEN ' events ' ELSE 'music' END AS type",
        "CASE WHEN s_suppkey % 7 = 0 THEN 'usa' ELSE 'US' END AS country",
        "'true' AS robots_ok",
        "'' AS sitemap_url",
        "concat('rules/', s_nationkey, '.yaml') AS css_rules_path",
        "CASE WHEN s_suppkey % 11 = 0 THEN 'hourly' ELSE 'daily' END AS crawl_freq",
        "CASE WHEN s_suppkey % 13 = 0 THEN '0' WHEN s_suppkey % 17 = 0 THEN 'fast'"
        " WHEN s_suppkey % 19 = 0 THEN '' ELSE '2.5' END AS max_qps",
        "'2' AS concurrency",
        "CASE WHEN s_suppkey % 3 = 0 THEN 'no' ELSE ' Yes ' END AS enabled",
    )


def nation_rules(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "CASE WHEN n_regionkey = 3 THEN 'none' ELSE concat('rules/', n_nationkey, '.yaml') END"
        " AS rule_path"
    )


# --- Keys and duplicates -----------------------------------------------------------------------


def entity_key(spark: SparkSession, folder: str) -> DataFrame:
    return event_listings(spark, folder).select(
        "event_id",
        keys.entity_key().alias("dedup_key"),
        datetimes.day_bucket(F.col("start")).alias("bucket"),
        text.normal_text(F.col("title")).alias("title"),
    )


def near_keys(spark: SparkSession, folder: str) -> DataFrame:
    near = event_listings(spark, folder).select("event_id", keys.nearby_keys().alias("near"))
    return near.selectExpr("event_id", "near[0] AS key_before", "near[1] AS key_after")


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_dedup(event_listings(spark, folder)).select("event_id", "dedup_key")


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.near_dedup(event_listings(spark, folder)).select("event_id", "dedup_key")


def scrambled(listings: DataFrame) -> DataFrame:
    return listings.withColumn(
        "seq", F.expr("named_struct('a', (event_id * 7919 + 13) % 1000003, 'b', event_id)")
    )


def near_dedup_any_order(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup.near_dedup(scrambled(event_listings(spark, folder)))
    return kept.select("event_id", "dedup_key")


def near_dedup_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of January's second half that duplicate nothing kept in the first half."""
    listings = event_listings(spark, folder)
    first = dedup.near_dedup(listings.filter("ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'"))
    second = dedup.near_dedup(
        listings.filter("ts >= TIMESTAMP_NTZ'2024-01-16 00:00:00'"),
        kept_before=first.select("identity", "day"),
    )
    return first.select("event_id").unionByName(second.select("event_id"))


def duplicate_counts(spark: SparkSession, folder: str) -> DataFrame:
    listings = event_listings(spark, folder)
    return dedup.duplicate_counts(listings, dedup.near_dedup(listings))


# --- Field normalisers -------------------------------------------------------------------------


def contacts_emails(spark: SparkSession, folder: str) -> DataFrame:
    found = spread(table(spark, folder, "documents"), "doc_id").select(
        "doc_id", text.emails(F.col("text")).alias("emails")
    )
    return found.select(
        "doc_id", joined("emails").alias("emails"), F.size("emails").cast("long").alias("n")
    )


def contacts_phones(spark: SparkSession, folder: str) -> DataFrame:
    found = spread(table(spark, folder, "documents"), "doc_id").select(
        "doc_id", text.phones(F.col("text")).alias("phones")
    )
    return found.select(
        "doc_id", joined("phones").alias("phones"), F.size("phones").cast("long").alias("n")
    )


def price_value(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", text.price_value(F.col("text")).alias("price_value")
    )


def taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return documents.select(
        "doc_id", joined(text.taxonomy(F.col("text"), F.col("lang"), F.col("lang"))).alias("labels")
    )


def taxonomy_map(spark: SparkSession, folder: str) -> DataFrame:
    mapping = [("ring", "jewellery"), ("bolt", "hardware"), ("widget", "hardware")]
    parts = table(spark, folder, "part").select(
        "p_partkey",
        text.taxonomy(F.col("p_name"), F.lit("sports"), F.col("p_type"), mapping).alias("labels"),
    )
    return parts.select("p_partkey", joined("labels").alias("labels"))


def datetime_norm(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates in five spellings, in five kinds of zone."""
    orders = spread(table(spark, folder, "orders"), "o_orderkey").selectExpr(
        "o_orderkey AS row_no",
        """CASE o_orderkey % 5
            WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
            WHEN 1 THEN concat(date_format(o_orderdate, 'yyyyMMdd'), 'T0930')
            WHEN 2 THEN concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 23:15:10.25')
            WHEN 3 THEN concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T22:00:00Z')
            ELSE concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T01:30:00+05:30') END AS start""",
        """CASE o_orderkey % 7
            WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Asia/Kolkata' WHEN 2 THEN 'Europe/Berlin'
            WHEN 3 THEN 'UTC-04:00' WHEN 4 THEN 'Nowhere/Else' WHEN 5 THEN '' END AS timezone""",
        "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T24:00') AS `end`",
        "array(named_struct('start', date_format(o_orderdate, 'yyyy-MM'), 'end', '')) AS time_slots",
    )
    done = normalise.normalise_datetimes(orders)
    return done.select(
        F.col("row_no").alias("o_orderkey"), "start", F.col("end").alias("finish"), "timezone",
        F.size("time_slots").cast("long").alias("slots"),
        F.size("date_errors").cast("long").alias("errors"),
    )


def slots(spark: SparkSession, folder: str) -> DataFrame:
    lines = spread(table(spark, folder, "lineitem"), "l_orderkey").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """CASE l_linenumber % 3
            WHEN 0 THEN concat(' ', date_format(l_shipdate, 'yyyy-MM-dd'), ' | ', l_returnflag, '|x ')
            WHEN 1 THEN concat(l_linestatus, ' - ', date_format(l_shipdate, 'yyyy-MM-dd'))
            ELSE concat('\t', l_returnflag, ' ') END AS slot""",
    )
    split = lines.withColumn("slot", datetimes.slot_from_text(F.col("slot")))
    return split.select(
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("l_linenumber"),
        F.col("slot.start").alias("slot_start"),
        F.col("slot.end").alias("slot_end"),
    )


def since_until(spark: SparkSession, folder: str) -> DataFrame:
    listings = event_listings(spark, folder)
    kept = stats.between(listings, "2024-01-10T00:00:00-02:00", "2024-01-20T12:00:00Z")
    return kept.select("event_id", "source_id")


# --- Validation --------------------------------------------------------------------------------


def validated_customers(spark: SparkSession, folder: str) -> DataFrame:
    return validate.validate(customer_listings(spark, folder))


def validate_rows(spark: SparkSession, folder: str) -> DataFrame:
    return validated_customers(spark, folder).select(
        "c_custkey", F.size("reasons").cast("long").alias("n"), joined("reasons", "; ").alias("reasons")
    )


def accepted_rows(spark: SparkSession, folder: str) -> DataFrame:
    return validate.accepted(validated_customers(spark, folder)).select(
        "c_custkey", "entity_type", "title", "sport_type", "start", "timezone"
    )


def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    rejects = validate.rejected(validated_customers(spark, folder))
    return validate.reason_counts(rejects)


def inspect_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Reasons of the last week for one source, as of a fixed moment."""
    listings = validated_customers(spark, folder)
    rejects = listings.filter(F.size("reasons") > 0).select(
        "source_id",
        F.col("reasons").alias("reason"),
        F.expr("TIMESTAMP'2024-06-30 00:00:00' - make_dt_interval(c_custkey % 20)").alias("rejected_at"),
    )
    return reports.inspect_rejects(
        rejects, days=7, source_id="src1", now=F.expr("TIMESTAMP'2024-06-30 00:00:00'")
    )


def csv_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Per type, the columns an export would have and how many rows fill them."""
    return stats.column_fill(validate.accepted(validated_customers(spark, folder)).drop("c_custkey", "seq"))


# --- Extraction --------------------------------------------------------------------------------


def jsonld_extract(spark: SparkSession, folder: str) -> DataFrame:
    found = jsonld.extract(order_pages(spark, folder))
    return found.select(
        F.col("seq.row_no").alias("o_orderkey"), "entity_type", "title", "sport_type", "start",
        F.col("end").alias("finish"), "venue_name", "address", "city", "country", "price_text",
        "url", joined("images").alias("images"),
        joined(F.transform("time_slots", lambda s: F.concat(s["start"], F.lit("/"), s["end"]))).alias("slots"),
    )


def rule_extract(spark: SparkSession, folder: str) -> DataFrame:
    menu = rule(
        spark, "site", list_item="nav li", fields={"title": "a", "detail_url": "a@href"}, timezone="UTC"
    )
    found = rules.extract(site_pages(spark, folder), menu)
    return found.select(
        F.col("seq.row_no").alias("page_id"),
        F.col("seq.item").cast("long").alias("item"),
        "title",
        "url",
        "timezone",
    )


def page_title(spark: SparkSession, folder: str) -> DataFrame:
    heading = rule(spark, "site", list_item="article", fields={"title": "h1"})
    found = rules.extract(site_pages(spark, folder), heading)
    return found.select(F.col("seq.row_no").alias("page_id"), "title")


def extract_both(spark: SparkSession, folder: str) -> DataFrame:
    """JSON-LD and rule entities of every page in one pass: how many of each, per type."""
    found = extract.extract(order_pages(spark, folder), order_rule(spark))
    return found.groupBy("entity_type", F.col("seq.origin").cast("long").alias("origin")).agg(
        F.count("*").alias("entities"), F.countDistinct("title").alias("titles")
    )


MENU = {"next_selector": "nav li a @href", "month_grid": True, "max_pages": 4}


def month_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The raw pages with their menu links marked as month links."""
    marked = F.replace("html", F.lit("<li><a "), F.lit('<li><a class="x month-next" '))
    return site_pages(spark, folder).withColumn("html", marked)


def link_frontier(spark: SparkSession, folder: str) -> DataFrame:
    links = rules.frontier(month_pages(spark, folder), rule(spark, "site", **MENU))
    return links.select(
        F.col("row_no").alias("page_id"), F.col("page_idx").cast("long").alias("page_idx"), "url"
    )


def urlset_hash(spark: SparkSession, folder: str) -> DataFrame:
    ruled = rules.with_rules(month_pages(spark, folder), rule(spark, "site", **MENU))
    links = rules.next_links(ruled, ["page_id", "url"])
    return links.select(
        "page_id", rules.url_set_hash(F.concat(F.array("url"), F.col("links"))).alias("urls_hash")
    )


def rule_expressions(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").selectExpr(
        "p_partkey",
        """CASE p_partkey % 6
            WHEN 0 THEN concat(' .', replace(p_name, ' ', ' .'), ' ')
            WHEN 1 THEN concat('.', p_type, ' @href')
            WHEN 2 THEN concat('img.', p_type, '@src[]')
            WHEN 3 THEN concat('a > b::attr(', p_type, '))')
            WHEN 4 THEN concat('time.', p_size, '@datetime|text')
            ELSE concat('time.', p_size, '@datetime|text[]') END AS expression""",
    )
    spec = parts.select("p_partkey", selectors.field_spec(F.lit("f"), F.col("expression")).alias("s"))
    return spec.select("p_partkey", "s.selector", "s.attr", "s.multi", "s.text_fallback")


# --- Pages, state, robots, prefixes ------------------------------------------------------------


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").selectExpr(
        "page_id", "url", "TIMESTAMP'2024-01-01 00:00:00' + make_dt_interval(0, 0, page_id * 7) AS fetched_at"
    )
    named = page_source.with_bronze_columns(pages)
    return named.select(
        "page_id", "url_hash", "snapshot", F.col("fetch_date").cast("string").alias("fetch_date")
    )


def replies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").selectExpr(
        "page_id", "url",
        "CASE WHEN page_id % 4 = 0 THEN NULL ELSE concat('e', page_id % 5) END AS etag",
        "CASE WHEN page_id % 3 = 0 THEN '' ELSE concat('day ', page_id % 2) END AS last_modified",
        "CASE WHEN page_id % 10 = 9 THEN 304 ELSE 200 END AS status",
    )


EN_FR = "url LIKE '%/en/%' OR url LIKE '%/fr/%'"


def known_urls(spark: SparkSession, folder: str, known: str = EN_FR) -> DataFrame:
    """State of some pages, the English and French ones unless told otherwise: two observations each."""
    return (
        table(spark, folder, "pages")
        .filter(known)
        .selectExpr(
            "url",
            "explode(array(named_struct('etag', 'old', 'last_modified', 'day 9', 'last_seen', '99'),"
            " named_struct('etag', CASE WHEN page_id % 2 = 0 THEN concat('e', page_id % 5) END,"
            " 'last_modified', 'day 1', 'last_seen', '100'))) AS s",
        )
        .select("url", "s.*")
    )


def latest_state(spark: SparkSession, folder: str) -> DataFrame:
    return state.latest_state(known_urls(spark, folder, "true")).drop("version")


def changed_pages(spark: SparkSession, folder: str) -> DataFrame:
    known = state.latest_state(known_urls(spark, folder))
    return state.changed_pages(replies(spark, folder), known).select("page_id", "url")


def next_state(spark: SparkSession, folder: str) -> DataFrame:
    known = state.latest_state(known_urls(spark, folder))
    return state.next_state(replies(spark, folder), known, F.lit(200)).drop("version")


def conditional_headers(spark: SparkSession, folder: str) -> DataFrame:
    known = state.latest_state(known_urls(spark, folder))
    headers = state.conditional_headers(table(spark, folder, "pages"), known)
    return headers.select(
        "url",
        F.try_element_at("headers", F.lit("If-None-Match")).alias("if_none_match"),
        F.try_element_at("headers", F.lit("If-Modified-Since")).alias("if_modified_since"),
    )


def resume(spark: SparkSession, folder: str) -> DataFrame:
    """Pages left to process when the English ones are done, but the set of every fourth site changed."""
    visits = table(spark, folder, "pages").selectExpr(
        "page_id", "url", "CAST(page_id % 4 AS INT) AS page_idx",
        "regexp_extract(url, '://([^/]+)', 1) AS source_id",
        "sha1(regexp_extract(url, '://([^/]+)', 1)) AS urls_hash",
    )
    done = visits.filter("url LIKE '%/en/%'").withColumn(
        "urls_hash", F.expr("CASE WHEN length(source_id) % 4 = 0 THEN 'other' ELSE urls_hash END")
    )
    return state.unfinished_pages(visits, done).select("page_id", "url")


def robots_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    hosts = pages.select(F.expr("regexp_extract(url, '://([^/?#]+)', 1)").alias("host")).distinct()
    texts = hosts.selectExpr(
        "host",
        r"""CASE length(host) % 3
            WHEN 0 THEN 'User-agent: *\nDisallow: /fr\nDisallow: /en/1 # some\nAllow: /en\nDisallow: /e'
            WHEN 1 THEN 'User-agent: *\nDisallow:\n\nUser-Agent: Marquee\nAllow: /de/\nDisallow: /'
            ELSE 'User-agent: other\nDisallow: /' END AS text""",
    )
    return robots.allowed_urls(pages, texts, "marquee/1.0")


def url_sources(spark: SparkSession, folder: str) -> DataFrame:
    """A registry of the sites and of their language sections, sections before some sites."""
    pages = table(spark, folder, "pages")
    sites = pages.selectExpr(
        "regexp_extract(url, '^([a-z]+://[^/]+/)', 1) AS base_url", "2 * page_id + 1 AS row_no"
    )
    sections = pages.selectExpr(
        "regexp_extract(url, '^([a-z]+://[^/]+/[a-z]+)', 1) AS base_url", "2 * page_id AS row_no"
    )
    bases = sites.unionByName(sections).groupBy("base_url").agg(F.min("row_no").alias("row_no"))
    return bases.select(
        "row_no", "base_url", F.concat(F.lit("s"), "row_no").alias("source_id"),
        F.lit("events").alias("type"), F.lit(1.0).alias("max_qps"),
        F.lit("r.yaml").alias("css_rules_path"), F.lit(True).alias("robots_ok"),
    )


def url_explain(spark: SparkSession, folder: str) -> DataFrame:
    """Page URLs, and the same URLs on an unknown scheme, explained."""
    pages = table(spark, folder, "pages").select("url")
    urls = pages.unionByName(pages.select(F.concat(F.lit("x"), "url").alias("url")))
    found = reports.explain(urls, url_sources(spark, folder))
    return found.select("url", "matched", "source_id", "rules_path", "robots_ok")


# --- Gold, merges ------------------------------------------------------------------------------


def event_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    listings = event_listings(spark, folder).selectExpr(
        "*", "CAST(CAST(value AS DECIMAL(18, 2)) AS STRING) AS price_text",
        "CAST(NULL AS STRING) AS timezone", "CAST(NULL AS STRING) AS organizer",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('u', event_id) END AS url",
        "array(named_struct('start', start, 'end', start)) AS time_slots",
        "CASE WHEN event_id % 2 = 0 THEN array(source_id) END AS taxonomy",
        "value AS price_value",
    )
    rows = merge.gold_rows(listings.withColumn("event_time", F.col("ts")))
    early = F.col("start") < "2024-01-16T"
    return rows.filter(early), rows.filter(~early)


def gold_view(gold: DataFrame) -> DataFrame:
    return gold.select(
        "entity_type", "dedup_key", "title", "source_id", "start", "price_text", "price_value",
        "url", "time_slots_json", "taxonomy_json", "emails_json",
    )


def upsert_gold(spark: SparkSession, folder: str) -> DataFrame:
    first, second = (merge.one_per_key(batch) for batch in event_batches(spark, folder))
    empty = first.filter(F.lit(False))
    return gold_view(merge.upsert(merge.upsert(empty, first), second))


def gold_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same upserts through the written gold table, the second one applied twice."""
    first, second = (merge.one_per_key(batch) for batch in event_batches(spark, folder))
    gold = tables.GoldTable(spark, scratch(spark, "gold"))
    gold.upsert(first, "run-1")
    gold.upsert(second, "run-2")
    gold.upsert(second, "run-2")
    return gold_view(gold.read())


def merge_promote(spark: SparkSession, folder: str) -> DataFrame:
    """The first event of each user, promoted by the last one."""
    events = table(spark, folder, "events")
    row = """named_struct('title', CASE WHEN value < 50 THEN '' ELSE event_type END,
        'tags', CASE WHEN event_type = 'view' THEN CAST(array() AS ARRAY<STRING>)
                     ELSE array(event_type) END,
        'price', CASE WHEN event_type = 'error' THEN NULL ELSE value END)"""
    existing = events.groupBy("user_id").agg(F.expr(f"min_by({row}, event_id)").alias("r"))
    newest = events.groupBy("user_id").agg(F.expr(f"max_by({row}, event_id)").alias("r"))
    merged = merge.merge_versions(
        existing.select("user_id", "r.*"), newest.select("user_id", "r.*"), "user_id"
    )
    return merged.select("user_id", "title", joined("tags").alias("tags"), "price", "mutated")


# --- Registry ----------------------------------------------------------------------------------


def registry_validate(spark: SparkSession, folder: str) -> DataFrame:
    coerced = registry.coerce(supplier_registry(spark, folder))
    return registry.validate(coerced, nation_rules(spark, folder)).drop("row_no")


def registry_report(spark: SparkSession, folder: str) -> DataFrame:
    coerced = registry.coerce(supplier_registry(spark, folder))
    report = reports.validate_sources(coerced, nation_rules(spark, folder))
    return report.groupBy("status").agg(
        F.count("*").alias("sources"), F.countDistinct("detail").alias("details")
    )


def select_sources(spark: SparkSession, folder: str) -> DataFrame:
    coerced = registry.coerce(supplier_registry(spark, folder))
    chosen = registry.select_sources(coerced.filter("enabled"), entity_type="events", limit=25)
    return chosen.select("row_no", "source_id", "entity_type", "url", "rule_path", "max_qps")


# --- Runs and reports --------------------------------------------------------------------------


def order_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest per month of orders, with the counts of its sources."""
    per_source = (
        table(spark, folder, "orders")
        .selectExpr(
            "date_format(date_trunc('month', o_orderdate), \"yyyyMMdd'T'HHmmss\") AS month",
            "concat('src', o_custkey % 400) AS source_id", "o_orderstatus",
        )
        .groupBy("month", "source_id")
        .agg(
            F.count("*").alias("rows_new"),
            F.count_if(F.col("o_orderstatus") == "O").alias("rows_updated"),
            F.count_if(F.col("o_orderstatus") == "F").alias("rejects"),
        )
    )
    entry = F.struct("source_id", F.struct("rows_new", "rows_updated", "rejects"))
    manifests = per_source.groupBy("month").agg(
        F.map_from_entries(F.collect_list(entry)).alias("source_stats")
    )
    named = manifests.select(
        F.concat(F.lit("run-"), "month").alias("run_id"),
        F.concat(F.lit("run-"), "month", F.lit(".json")).alias("name"),
        "source_stats",
    )
    return runs.with_run_time(named)


def status_latest(spark: SparkSession, folder: str) -> DataFrame:
    coerced = registry.coerce(supplier_registry(spark, folder))
    return reports.status(coerced, order_manifests(spark, folder)).drop("row_no")


def source_stats(spark: SparkSession, folder: str) -> DataFrame:
    outcomes = event_listings(spark, folder).join(
        table(spark, folder, "events").select("event_id", "event_type"), "event_id"
    ).select(
        "source_id",
        F.expr(
            "CASE event_type WHEN 'click' THEN 'new' WHEN 'view' THEN 'updated'"
            " WHEN 'error' THEN 'rejected' ELSE 'other' END"
        ).alias("outcome"),
    )
    return stats.source_stats(outcomes)


def counts_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return stats.counts_by_type(customer_listings(spark, folder))


def counters(spark: SparkSession, folder: str) -> DataFrame:
    counted = table(spark, folder, "events").groupBy(
        F.expr(
            "CASE event_type WHEN 'click' THEN 'entities_new' WHEN 'view' THEN 'duplicates'"
            " WHEN 'error' THEN 'validates_failed' WHEN 'signup' THEN 'retries'"
            " ELSE 'robots_disallow' END"
        ).alias("counter")
    ).agg(F.count("*").alias("value"))
    return stats.with_default_counters(counted)


def http_classes(spark: SparkSession, folder: str) -> DataFrame:
    answered = table(spark, folder, "events").selectExpr("100 + event_id * 37 % 500 AS status")
    return stats.status_classes(answered)


def run_partition(spark: SparkSession, folder: str) -> DataFrame:
    runs_of_orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.expr("concat('run-', lower(o_orderstatus), '-', date_format(o_orderdate, \"yyyyMMdd'T'HHmmss\"))")
        .alias("run_id"),
    )
    return runs_of_orders.select(
        "o_orderkey", tables.run_date(F.col("run_id")).cast("string").alias("run_date")
    )


def listing_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """Pages to clean rows: extract, normalise, validate, dedup, count per source.

    Judged rows feed two branches, so they are written once, as in a run.
    """
    path = scratch(spark, "judged")
    judge(order_pages(spark, folder), order_rule(spark)).write.parquet(path)
    judged = spark.read.parquet(path)
    kept = dedup.near_dedup(validate.accepted(judged))
    outcomes = kept.select("source_id", F.lit("new").alias("outcome")).unionByName(
        judged.filter(F.size("reasons") > 0).select("source_id", F.lit("rejected").alias("outcome"))
    )
    return stats.source_stats(outcomes)


def order_run(spark: SparkSession, folder: str):
    """A whole written run over one page per order, each order being a source of its own."""
    root = scratch(spark, "run")
    order_pages(spark, folder).write.parquet(f"{root}/pages")
    pages = spark.read.parquet(f"{root}/pages")
    sources = pages.select(
        "row_no", "source_id", F.col("url").alias("base_url"), F.col("entity_type").alias("type"),
        F.lit("US").alias("country"), F.lit("shows").alias("css_rules_path"),
        F.lit("daily").alias("crawl_freq"),
    )
    run_id = f"{uuid.uuid4().hex}-20240901T000000"
    done = run(
        spark, root, run_id, registry.coerce(sources), order_rule(spark),
        pages.select("url", "html"),
    )
    return root, done


def full_run(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of a whole written run, from its manifest."""
    root, _ = order_run(spark, folder)
    manifests = runs.read_manifests(spark, f"{root}/manifests")
    counted = manifests.select(F.explode("metrics").alias("counter", "value"))
    return counted.filter("counter <> 'run_duration_ms'")


def full_run_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver rows of a whole written run, read back from JSON."""
    root, _ = order_run(spark, folder)
    silver = T.StructType(
        [
            T.StructField(name, T.DoubleType() if name == "price_value" else T.StringType())
            for name in ("entity_type", "source_id", "title", "sport_type", "start", "timezone",
                         "venue_name", "price_text", "price_value", "url")
        ]
    )
    return spark.read.schema(silver).json(f"{root}/silver").drop("run_id")


# --- Sinks read back ---------------------------------------------------------------------------


def silver_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "silver")
    tables.write_silver(event_listings(spark, folder), path, "run-20240131")
    written = spark.read.schema(
        "title string, start string, source_id string, country string, entity_type string, run_id string"
    ).json(path)
    return written.select("title", "start", "source_id", "country", "entity_type", "run_id")


def csv_sink(spark: SparkSession, folder: str) -> DataFrame:
    """All types exported twice on one day and read back: the second export replaces the first."""
    accepted = validate.accepted(validated_customers(spark, folder))
    path = scratch(spark, "csv")
    for run_id in ("run-20240131T000000", "run-20240131T120000"):
        folders = tables.write_csv(accepted, path, run_id)
    names = ["title", "start", "city", "price_text", "emails", "images", "time_slots"]
    read = spark.read.option("header", True).option("escape", '"')
    exports = []
    for written in folders:
        rows = read.csv(written)
        exports.append(
            rows.select(
                F.lit(written.rsplit("/", 1)[-1]).alias("entity_type"),
                *[F.col(n) if n in rows.columns else F.lit(None).cast("string").alias(n) for n in names],
            )
        )
    return functools.reduce(DataFrame.unionByName, exports)


def quarantine_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "quarantine")
    tables.write_rejects(validate.rejected(validated_customers(spark, folder)), path, "run-1")
    read = spark.read.schema(
        "entity struct<source_id:string,title:string,start:string,country:string>,"
        " reason array<string>, run_id string"
    ).json(path)
    return read.select(
        "entity.source_id", "entity.title", "entity.start", "entity.country",
        joined("reason", "; ").alias("reasons"),
    )


def bronze_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "bronze")
    pages = table(spark, folder, "pages").selectExpr(
        "url", "html", "map('x-page', CAST(page_id AS STRING)) AS headers",
        "TIMESTAMP'2024-01-01 00:00:00' + make_dt_interval(0, 0, page_id * 7) AS fetched_at",
    )
    tables.write_bronze(pages, path)
    bronze = page_source.read_bronze(spark, path)
    return bronze.select(
        "url_hash", "snapshot", F.sha2("html", 256).alias("html_hash"),
        state.header("X-Page").alias("page_id"),
    )


# --- Streams -----------------------------------------------------------------------------------


def stream_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Events arriving in two batches, deduplicated across both by micro-batches."""
    listings = event_listings(spark, folder)
    root = scratch(spark, "stream")
    source, kept = f"{root}/in", f"{root}/kept"
    early = "ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'"

    def process(batch: DataFrame, batch_id: int) -> None:
        keys, name = KeptKeys(batch.sparkSession, f"{root}/keys"), f"batch-{batch_id}"
        unique = incremental.dedup_batch(batch, keys, name)
        columns = unique.select("event_id", "dedup_key", "identity", "day")
        incremental.write_batch(columns, kept, batch_id)
        keys.remember(batch.sparkSession.read.parquet(kept).filter(F.col("batch") == batch_id), name)

    for arrived in (listings.filter(early), listings.filter(f"NOT {early}")):
        arrived.write.mode("append").parquet(source)
        stream = spark.readStream.schema(listings.schema).parquet(source)
        query = (
            stream.writeStream.foreachBatch(process)
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.parquet(kept).select("event_id", "dedup_key")


def stream_stateful_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The same by Structured Streaming state, in three arrivals with a restart before each.

    Every third event is in an arrival, so two of three come after later ones; some have no date, and
    their order is a struct.
    """
    configured(spark).conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    listings = event_listings(spark, folder).withColumns({
        "start": F.expr("CASE WHEN event_id % 50 <> 0 THEN start END"),
        "seq": F.expr("named_struct('part', event_id div 1000, 'no', event_id)"),
    })
    root = scratch(spark, "stateful")
    for number in range(3):
        arrived = listings.filter(F.col("event_id") % 3 == number)
        arrived.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(listings.schema).parquet(f"{root}/in")
        kept = stream_dedup.near_stream(stream).select("dedup_key", "source_id")
        query = (
            kept.writeStream.format("parquet")
            .option("path", f"{root}/kept")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{root}/kept").select("dedup_key", "source_id")


QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        entity_key, near_keys, exact_dedup, near_dedup, near_dedup_any_order,
        near_dedup_incremental, duplicate_counts, contacts_emails, contacts_phones, price_value,
        taxonomy, taxonomy_map, datetime_norm, slots, since_until, validate_rows, accepted_rows,
        reject_reasons, inspect_rejects, csv_columns, jsonld_extract, rule_extract, page_title,
        extract_both, link_frontier, urlset_hash, rule_expressions, snapshots, latest_state,
        changed_pages, next_state, conditional_headers, resume, robots_filter, url_explain,
        upsert_gold, gold_table, merge_promote, registry_validate, registry_report, select_sources,
        status_latest, source_stats, counts_by_type, counters, http_classes, run_partition,
        listing_pipeline, full_run, full_run_silver, silver_sink, csv_sink, quarantine_sink,
        bronze_sink, stream_near_dedup, stream_stateful_dedup,
    )
}
