"""Seconds per headline query on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.plans import catalog  # noqa: E402
from marquee.session import local_session, ship_package  # noqa: E402

HEADLINE = [
    "entity_key", "exact_dedup", "near_dedup", "near_dedup_any_order", "contacts_emails",
    "contacts_phones", "price_value", "taxonomy", "datetime_norm", "slots", "validate_rows",
    "reject_reasons", "jsonld_extract", "rule_extract", "extract_both", "link_frontier",
    "changed_pages", "robots_filter", "url_explain", "upsert_gold", "registry_validate",
    "status_latest", "source_stats", "listing_pipeline", "full_run",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "marquee-bench", **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    spark.range(1).count()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
