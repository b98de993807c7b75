"""Near-duplicate rule against a plain greedy pass in arrival order."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.operators import dedup

ENTITY = (
    "seq long, title string, start string, `end` string, venue_name string, address string, "
    "city string, source_id string"
)


def greedy(rows, seen=()):
    """Keep rows in arrival order by the documented rule; rows are (seq, title, day or None)."""
    seen, kept = set(seen), []
    for seq, title, day in sorted(rows):
        at = day if day is not None else date(1970, 1, 1)
        near = [at] if day is None else [at, at - timedelta(1), at + timedelta(1)]
        if any((title, d) in seen for d in near):
            continue
        seen.add((title, at))
        kept.append(seq)
    return kept, seen


def frame(spark, rows):
    return spark.createDataFrame(
        [
            (seq, title, day and f"{day}T10:00:00+00:00", None, "v", "", "c", "s")
            for seq, title, day in rows
        ],
        ENTITY,
    )


def random_rows(rng, count, titles, span, first=0):
    start = date(1969, 12, 28)
    order = rng.sample(range(first, first + count), count)
    return [
        (
            seq,
            rng.choice(titles),
            None if rng.random() < 0.1 else start + timedelta(rng.randrange(span)),
        )
        for seq in order
    ]


@pytest.mark.parametrize("seed", range(4))
def test_near_dedup_is_the_greedy_rule(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, 600, [f"t{i}" for i in range(60)], 12)
    kept = dedup.near_dedup(frame(spark, rows))
    assert sorted(row.seq for row in kept.select("seq").collect()) == greedy(rows)[0]


def test_near_dedup_continues_from_earlier_batches(spark):
    rng = random.Random(7)
    titles = [f"t{i}" for i in range(60)]
    first, second = random_rows(rng, 300, titles, 12), random_rows(rng, 400, titles, 12, 300)
    before = dedup.near_dedup(frame(spark, first))
    after = dedup.near_dedup(frame(spark, second), kept_before=before.select("identity", "day"))
    kept, seen = greedy(first)
    want, _ = greedy(second, seen)
    assert sorted(row.seq for row in before.select("seq").collect()) == kept
    assert sorted(row.seq for row in after.select("seq").collect()) == want


def test_result_does_not_depend_on_partitioning(spark):
    rows = random_rows(random.Random(3), 500, ["a", "b"], 60)
    results = [
        sorted(
            r.seq
            for r in dedup.near_dedup(frame(spark, rows).repartition(n)).select("seq").collect()
        )
        for n in (1, 3, 7)
    ]
    assert results[0] == results[1] == results[2]


def test_days_and_offsets(spark):
    days = [10, 11, 12, 14, 13]
    rows = [(i, "x", date(2024, 7, d)) for i, d in enumerate(days)]
    kept = dedup.near_dedup(frame(spark, rows)).select(F.substring("start", 9, 2)).collect()
    assert sorted(int(r[0]) for r in kept) == [10, 12, 14]
    # the same instant at two offsets has two keys
    two = spark.createDataFrame(
        [(1, "x", "2024-07-01T20:00:00-04:00", None, "v", "", "c", "s"),
         (2, "x", "2024-07-02T00:00:00+00:00", None, "v", "", "c", "s")],
        ENTITY,
    )
    assert dedup.near_dedup(two).count() == 2


def test_exact_dedup_keeps_first_arrival(spark):
    rows = [(3, "x", date(2024, 1, 1)), (1, "x", date(2024, 1, 1)), (2, "y", date(2024, 1, 1))]
    kept = dedup.exact_dedup(frame(spark, rows))
    assert sorted(r.seq for r in kept.collect()) == [1, 2]


def test_key_without_a_date_text_is_not_merged(spark):
    two = spark.createDataFrame(
        [(1, "x", "soon", None, "v", "", "c", "s"), (2, "x", "later", None, "v", "", "c", "s")],
        ENTITY,
    )
    assert dedup.near_dedup(two).count() == 2


def test_plan_reduces_copies_before_the_shuffle(spark, tables):
    rows = frame(spark, [(1, "x", date(2024, 1, 1))])
    plan = dedup.near_dedup(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min(") >= 1 and "SortAggregate" not in plan
    exact = dedup.exact_dedup(rows)._jdf.queryExecution().executedPlan().toString()
    assert exact.count("WindowGroupLimit") == 2
