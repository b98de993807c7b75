"""Table schemas, per-type constraints and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

ENTITY_TYPES = ["events", "festivals", "sports"]

SLOT = T.StructType([T.StructField("start", T.StringType()), T.StructField("end", T.StringType())])
STRINGS = T.ArrayType(T.StringType())

REGISTRY = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("base_url", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("robots_ok", T.BooleanType()),
        T.StructField("sitemap_url", T.StringType()),
        T.StructField("css_rules_path", T.StringType()),
        T.StructField("crawl_freq", T.StringType()),
        T.StructField("max_qps", T.DoubleType()),
        T.StructField("concurrency", T.IntegerType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("row_no", T.LongType()),
    ]
)

FIELD_SPEC = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("selector", T.StringType()),
        T.StructField("attr", T.StringType()),
        T.StructField("multi", T.BooleanType()),
        T.StructField("text_fallback", T.BooleanType()),
    ]
)

RULES = T.StructType(
    [
        T.StructField("rule_path", T.StringType()),
        T.StructField("list_item", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("next_selector", T.StringType()),
        T.StructField("month_grid", T.BooleanType()),
        T.StructField("max_pages", T.IntegerType()),
        T.StructField("timezone", T.StringType()),
    ]
)

PAGES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

URL_STATE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("etag", T.StringType()),
        T.StructField("last_modified", T.StringType()),
        T.StructField("last_seen", T.StringType()),
        T.StructField("version", T.IntegerType()),
    ]
)

# The arrival order of an extracted entity: registry row, page of the source, JSON-LD (0) before
# rules (1), script block, position in the block. Orderable, and unique per entity.
SEQ = T.StructType(
    [
        T.StructField("row_no", T.LongType()),
        T.StructField("page_idx", T.IntegerType()),
        T.StructField("origin", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("item", T.IntegerType()),
    ]
)

ENTITY = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("sport_type", T.StringType()),
        T.StructField("start", T.StringType()),
        T.StructField("end", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("venue_name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("time_slots", T.ArrayType(SLOT)),
        T.StructField("price_text", T.StringType()),
        T.StructField("price_value", T.DoubleType()),
        T.StructField("organizer", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("emails", STRINGS),
        T.StructField("phones", STRINGS),
        T.StructField("images", STRINGS),
        T.StructField("taxonomy", STRINGS),
    ]
)
ENTITY_COLUMNS = ENTITY.fieldNames()

SOURCE_STATS = T.MapType(
    T.StringType(),
    T.StructType(
        [
            T.StructField("rows_new", T.LongType()),
            T.StructField("rows_updated", T.LongType()),
            T.StructField("rejects", T.LongType()),
        ]
    ),
)

SOURCE_COUNTS = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("rows_new", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rejects", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField(
            "paths",
            T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())),
        ),
        T.StructField("source_stats", SOURCE_STATS),
        T.StructField("metrics", T.MapType(T.StringType(), T.LongType())),
        T.StructField("exit_code", T.IntegerType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("counters", T.MapType(T.StringType(), T.LongType())),
        T.StructField("generated_at", T.StringType()),
    ]
)

REJECT = T.StructType(
    [
        T.StructField("entity", ENTITY),
        T.StructField("reason", STRINGS),
    ]
)

# --- Fixed values (they must equal the published data contract) -------------------------------

# Fields of every type, in schema order; "any" accepts an empty string, "text" does not.
_TAIL = [
    ("price_text", "any"),
    ("organizer", "any"),
    ("url", "any"),
    ("emails", "strings"),
    ("phones", "strings"),
    ("images", "strings"),
    ("price_value", "number"),
    ("taxonomy", "strings"),
]
_PLACE = [
    ("venue_name", "text"),
    ("address", "text"),
    ("city", "text"),
    ("country", "country"),
    ("time_slots", "slots"),
]
_DATED = [
    ("source_id", "text"),
    ("title", "text"),
    ("start", "any"),
    ("end", "any"),
    ("timezone", "text"),
    *_PLACE,
    *_TAIL,
]
PROPERTIES = {
    "events": _DATED,
    "festivals": _DATED,
    "sports": [
        ("source_id", "text"),
        ("title", "text"),
        ("sport_type", "text"),
        ("timezone", "any"),
        *_PLACE,
        *_TAIL,
    ],
}
REQUIRED = {
    "events": [
        "source_id", "title", "start", "end", "timezone",
        "venue_name", "address", "city", "country", "time_slots",
    ],
    "festivals": [
        "source_id", "title", "start", "end", "timezone",
        "venue_name", "address", "city", "country",
    ],
    "sports": [
        "source_id", "title", "sport_type", "time_slots",
        "venue_name", "address", "city", "country",
    ],
}
COUNTRY_PATTERN = "^[A-Z]{2}$"

# Lower-cased JSON-LD @type values and the entity type each stands for.
JSONLD_TYPES = {
    "event": "events",
    "music event": "events",
    "eventseries": "events",
    "festival": "festivals",
    "sportsevent": "sports",
    "sports event": "sports",
}

# Title keyword -> category, tried in this order.
TAXONOMY = [("jazz", "music"), ("art", "art"), ("football", "football"), ("running", "running")]

# Counters every run reports, zero when nothing happened.
COUNTERS = [
    "pages_fetched",
    "http_2xx",
    "http_3xx",
    "http_4xx",
    "http_5xx",
    "retries",
    "unchanged_skips",
    "parse_failures",
    "validates_failed",
    "entities_new",
    "entities_updated",
    "quarantine_rows",
    "duplicates",
    "run_duration_ms",
]

# Gold table: columns written once, and columns every later run refreshes (even to null).
GOLD_FIXED = [
    "source_id", "title", "venue_name", "address", "city", "country", "time_slots_json",
]
GOLD_REFRESHED = [
    "start", "end", "timezone", "price_text", "price_value", "organizer", "url",
    "emails_json", "phones_json", "images_json", "taxonomy_json", "sport_type",
]
