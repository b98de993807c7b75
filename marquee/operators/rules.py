"""Entities and next links picked from pages by declarative selector rules.

Only the HTML itself is read in Python workers, once for everything a rule asks of a page; rows go
in and out as Arrow batches, the rule expressions are split and the values are shaped by Spark
columns. A page that cannot be read costs itself alone, and a rule with a selector that is not
understood is found before any page is.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.datetimes import slots_from_text
from marquee.functions.selectors import field_specs, link_spec
from marquee.functions.text import present
from marquee.functions.urls import absolute_url
from marquee.functions.variants import NO_STRINGS
from marquee.operators.html import Page, compile_selector
from marquee.operators.joins import join_small

MONTH_LINKS = "a[rel='next'], a.month-next"

# What a worker reads from one list item: single values, and lists of values.
_ITEMS = pa.list_(
    pa.struct(
        [
            ("one", pa.map_(pa.string(), pa.string())),
            ("many", pa.map_(pa.string(), pa.list_(pa.string()))),
        ]
    )
)
_ITEMS_DDL = "array<struct<one:map<string,string>,many:map<string,array<string>>>>"


def _prepared(rules: DataFrame) -> DataFrame:
    """Rules as the workers take them, their expressions split."""
    return rules.select(
        "rule_path",
        "list_item",
        "month_grid",
        "max_pages",
        F.to_json(field_specs(F.col("fields"))).alias("specs"),
        link_spec(F.col("next_selector")).alias("next"),
        F.col("timezone").alias("rule_timezone"),
    )


def with_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages with the rule of their source.

    The expressions of a rule are split before the join, so once per rule and not per page. A rule
    may serve a great part of all pages, so pages are not gathered by rule.
    """
    return join_small(pages, _prepared(rules), "rule_path", spread_by="url", measure=rules)


@lru_cache(maxsize=1024)
def _specs(text: str) -> list[dict]:
    """The field rules of a rule, from the text they travel as."""
    return [{"attr": None, **spec} for spec in json.loads(text)]


def checked(rules: DataFrame) -> DataFrame:
    """(rule_path, problem): selectors of a rule that are not understood, null when all are."""
    frame = _prepared(rules).select(
        "rule_path", "list_item", "specs", F.col("next.selector").alias("next")
    )

    def problem(list_item: str | None, specs: str | None, following: str | None) -> str | None:
        named = [("list_item", list_item), ("next_selector", following or None)]
        named += [(spec["field"], spec["selector"]) for spec in _specs(specs or "[]")]
        wrong = []
        for name, selector in named:
            try:
                if selector is not None or name == "list_item":
                    compile_selector(selector or "")
            except ValueError as error:
                wrong.append(f"{name}: {error}")
        return "; ".join(wrong) or None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inputs = (batch.column(name).to_pylist() for name in ("list_item", "specs", "next"))
            found = pa.array([problem(*row) for row in zip(*inputs, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rule_path"), found], names=["rule_path", "problem"]
            )

    return frame.mapInArrow(read, "rule_path string, problem string")


def _read_item(page: Page, at: int, specs) -> dict:
    one, many = [], []
    for spec in specs:
        elements = page.select(spec["selector"], at)
        values = (page.value(e, spec["attr"], spec["text_fallback"]) for e in elements)
        if spec["multi"] or spec["field"] == "time_slots":
            many.append((spec["field"], [value for value in values if value]))
        else:
            one.append((spec["field"], next(values, None)))
    return {"one": one, "many": many}


def _hrefs(page: Page, rule: dict | None, month_grid: bool) -> list[str]:
    """At most one link by the next rule, then the month links."""
    found = []
    if rule is not None and rule["selector"]:
        attr = rule["attr"] or "href"
        values = (page.attrs[at].get(attr.lower()) for at in page.select(rule["selector"]))
        found += [value for value in values if value][:1]
    if month_grid:
        values = (page.attrs[at].get("href") for at in page.select(MONTH_LINKS))
        found += [value for value in values if value]
    return found


def _read_page(html, list_item, specs, following, month_grid, max_pages, wanted) -> tuple:
    """(items, hrefs, problem) of a page.

    A part that cannot be read is null and named in the problem; the other part stands.
    """
    if html is None:
        return [], [], None
    try:
        page = Page(html)
    except (AssertionError, ValueError) as error:
        return None, None, f"page: {error}"
    items, hrefs, problems = None, None, []
    if "items" in wanted:
        try:
            items = [_read_item(page, at, _specs(specs)) for at in page.select(list_item)]
        except ValueError as error:
            problems.append(f"items: {error}")
    if "hrefs" in wanted:
        try:
            hrefs = _hrefs(page, following, month_grid) if (max_pages or 0) > 1 else []
        except ValueError as error:
            problems.append(f"links: {error}")
    return items, hrefs, "; ".join(problems) or None


_OUTPUTS = {
    "items": (_ITEMS, _ITEMS_DDL),
    "hrefs": (pa.list_(pa.string()), "array<string>"),
    "problem": (pa.string(), "string"),
}


def read_pages(ruled: DataFrame, keep: list[str], *wanted: str) -> DataFrame:
    """``keep`` and, from one reading of each page, what is wanted of it.

    ``items`` are the values of all list items, ``hrefs`` the links to further pages as they are
    written, ``problem`` says what could not be read. The kept columns pass through the worker as
    Arrow data and are not touched there. Needs html and the rule columns of `with_rules`.
    """
    inputs = ["html", "list_item", "specs", "next", "month_grid", "max_pages"]
    frame = ruled.select(*keep, *[F.col(name).alias(f"_in_{name}") for name in inputs])
    schema = T.StructType(
        [frame.schema[name] for name in keep]
        + [T.StructField(name, T.DataType.fromDDL(_OUTPUTS[name][1])) for name in wanted]
    )
    places = {"items": 0, "hrefs": 1, "problem": 2}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = (batch.column(f"_in_{name}").to_pylist() for name in inputs)
            found = [_read_page(*row, wanted) for row in zip(*values, strict=True)]
            made = [
                pa.array([row[places[name]] for row in found], type=_OUTPUTS[name][0])
                for name in wanted
            ]
            columns = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*keep, *wanted])

    return frame.mapInArrow(read, schema)


class PageItems:
    """A table function: the list items of a page, one row each, for use in SQL."""

    def eval(self, html: str, list_item: str, specs: str):
        items, _, _ = _read_page(html, list_item, specs, None, False, 1, ("items",))
        for at, item in enumerate(items or []):
            yield at, dict(item["one"]), dict(item["many"])


def register_page_items(spark: SparkSession, name: str = "page_items") -> None:
    """``page_items(html, list_item, specs)`` in SQL, joined with LATERAL.

    ``specs`` is the JSON of a rule's field specs (`field_specs`). Rows are item, one and many.
    """
    schema = "item int, one map<string,string>, many map<string,array<string>>"
    spark.udtf.register(name, F.udtf(PageItems, returnType=schema, useArrow=True))


# Entity field -> the rule fields it is read from, in order.
_SOURCES = {
    "title": ["title"], "sport_type": ["sport_type"], "start": ["start"], "end": ["end"],
    "timezone": ["timezone"], "venue_name": ["venue_name", "venue"],
    "address": ["address", "addr"], "city": ["city"], "country": ["country"],
    "price_text": ["price_text"], "organizer": ["organizer"], "url": ["detail_url"],
}


def columns(one: Column, many: Column, wanted: Column, rule_timezone: Column) -> dict[str, Column]:
    """The entity columns of a list item.

    A field rule with ``[]`` where one value belongs, and an image rule without it, give a value
    of the wrong type: the row says so in ``mistyped`` and validation rejects it.
    """

    def single(name: str) -> Column:
        return F.try_element_at(one, F.lit(name))

    def listed(name: str) -> Column:
        return F.try_element_at(many, F.lit(name))

    def filled(name: str) -> Column:
        return F.coalesce(F.size(listed(name)) > 0, F.lit(False))

    def value(name: str) -> Column:
        return F.coalesce(single(name), F.when(filled(name), F.to_json(listed(name))))

    def is_list(names: list[str]) -> Column:
        first, *rest = names
        if not rest:
            return F.map_contains_key(many, first)
        # an empty first choice gives way to the second
        empty = F.coalesce(single(first), F.lit("")) == ""
        return filled(first) | (empty & F.map_contains_key(many, rest[0]))

    shaped = {}
    for name, names in _SOURCES.items():
        choices = [present(value(choice)) for choice in names[:-1]]
        shaped[name] = F.coalesce(*choices, value(names[-1]))
    shaped["timezone"] = F.coalesce(
        present(value("timezone")), present(rule_timezone), value("timezone")
    )
    shaped["sport_type"] = F.when(wanted == "sports", shaped["sport_type"])
    image = single("images")
    shaped["time_slots"] = slots_from_text(
        F.coalesce(listed("time_slots"), F.array().cast(NO_STRINGS))
    )
    shaped["images"] = (
        F.when(F.map_contains_key(many, "images"), listed("images"))
        .when(image.isNotNull(), F.array(image))
        .when(~F.map_contains_key(one, "images"), F.array().cast(NO_STRINGS))
    )
    wrong = [F.when(is_list(names), F.lit(name)) for name, names in _SOURCES.items()]
    wrong.append(
        F.when(~F.map_contains_key(many, "images") & image.isNotNull(), F.lit("images"))
    )
    shaped["mistyped"] = F.array_compact(F.array(*wrong))
    return shaped


def extract(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Raw entities of ``pages`` (html, source_id, entity_type, rule_path, row_no, page_idx)."""
    keep = ["source_id", "entity_type", "row_no", "page_idx", "rule_timezone"]
    found = read_pages(with_rules(pages, rules), keep, "items").select(
        *keep, F.posexplode("items").alias("item", "_found")
    )
    shaped = columns(
        F.col("_found.one"), F.col("_found.many"), F.col("entity_type"), F.col("rule_timezone")
    )
    seq = F.struct("row_no", "page_idx", F.lit(1).alias("origin"), F.lit(0).alias("block"), "item")
    return found.select(
        "entity_type",
        seq.alias("seq"),
        "source_id",
        *[column.alias(name) for name, column in shaped.items()],
    )


def absolute_links(url: Column, hrefs: Column, max_pages: Column) -> Column:
    """The further pages a first page names, in visiting order, no more than max_pages - 1."""
    links = F.transform(F.coalesce(hrefs, F.array().cast("array<string>")), lambda h: absolute_url(url, h))
    return F.slice(links, 1, F.greatest(max_pages - 1, F.lit(0)))


def next_links(ruled: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``links``: the further pages a first page names, absolute, in visiting order.

    At most one link by the next rule, then the month links, no more than max_pages - 1 in all.
    Needs url, html and the rule columns of `with_rules`.
    """
    carried = list(dict.fromkeys([*keep, "url", "max_pages"]))
    found = read_pages(ruled.filter(F.col("max_pages") > 1), carried, "hrefs")
    links = absolute_links(F.col("url"), F.col("hrefs"), F.col("max_pages"))
    return found.select(*keep, links.alias("links"))


def frontier(first_pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per further page: source columns, url and page_idx (1, 2, ...)."""
    keep = ["source_id", "entity_type", "rule_path", "row_no"]
    links = next_links(with_rules(first_pages, rules), keep)
    return links.select(
        *keep, F.posexplode("links").alias("_at", "url")
    ).select(*keep, "url", (F.col("_at") + 1).alias("page_idx"))


def url_set_hash(urls: Column) -> Column:
    """Fingerprint of the pages of one source: its first page and the further ones."""
    return F.sha1(F.array_join(F.sort_array(urls), "|"))
