from __future__ import annotations

import os
import random
import time
from datetime import UTC, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.operators.state import latest_state
from marquee.schema import PAGES as PAGE_SCHEMA
from marquee.sinks import tables
from marquee.sources import registry, rules, runs
from marquee.streaming import dedup
from marquee.streaming.dedup import exact_stream, near_stream
from marquee.streaming.incremental import run_stream
from tests.pages import DOME, MARKET_2, PAGES, REGISTRY, RULES


def test_pages_arriving_over_time(spark, tmp_path):
    """Second page, then an unchanged page and a changed one, arrive after the first pages."""
    (tmp_path / "sources.csv").write_text(REGISTRY)
    (tmp_path / "rules").mkdir()
    for name, text in RULES.items():
        (tmp_path / "rules" / name).write_text(text)
    sources = registry.read(spark, str(tmp_path / "sources.csv"))
    rule_table = rules.read(spark, str(tmp_path / "rules"))
    bronze, root = str(tmp_path / "bronze"), str(tmp_path / "out")

    def arrive(pages, hour):
        at = datetime(2024, 9, 1, hour, tzinfo=UTC)
        rows = [(url, html, {"ETag": etag}, at) for url, html, etag in pages]
        tables.write_bronze(spark.createDataFrame(rows, PAGE_SCHEMA), bronze)
        query = run_stream(
            spark, bronze, root, sources, rule_table,
            checkpoint=str(tmp_path / "checkpoint"),
        )
        query.awaitTermination()

    second = MARKET_2
    arrive([(url, html, "1") for url, html in PAGES.items() if url != second], 1)
    gold = tables.GoldTable(spark, f"{root}/gold")
    assert gold.read().filter("source_id = 'market'").count() == 3
    arrive([(second, PAGES[second], "1")], 2)
    # the repeated fair was kept in the first batch; two days after a kept one is no duplicate
    titles = {r.title for r in gold.read().filter("source_id = 'market'").collect()}
    assert {"Tea Tasting", "Paper Folding", "Indigo Dyeing"} <= titles and "Never Visited" not in titles
    assert gold.read().filter("source_id = 'market'").count() == 7
    changed = PAGES[DOME].replace("Comet Jazz", "Comet Swing")
    arrive([(second, PAGES[second], "1"), (DOME, changed, "2")], 3)
    assert gold.read().count() == 21
    seen = latest_state(runs.read_url_state(spark, f"{root}/url_state"))
    state = {r.url: r.etag for r in seen.collect()}
    assert state[DOME] == "2" and state[second] == "1"
    manifests = runs.read_manifests(spark, f"{root}/manifests")
    skips = manifests.select("run_id", F.col("metrics")["unchanged_skips"].alias("n")).collect()
    assert {r.run_id: r.n for r in skips}["stream-2-20240901"] == 1


def test_stream_state_comes_to_an_end(spark, tmp_path):
    """A key is forgotten after its time and let in again; within it, it is a duplicate."""
    ddl = (
        "seq long, title string, start string, `end` string, venue_name string, address string, "
        "city string, source_id string"
    )
    source, kept = str(tmp_path / "in"), str(tmp_path / "kept")

    def arrive(seq):
        rows = [(seq, "t", "2024-05-01T10:00:00+00:00", None, "v", "", "c", "s")]
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(source)

    def wait_for(rows, seconds=90):
        until = time.monotonic() + seconds
        while time.monotonic() < until and (not os.path.exists(kept) or spark.read.schema("seq long").parquet(kept).count() < rows):
            time.sleep(0.5)
        return spark.read.schema("seq long").parquet(kept).count()

    arrive(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        stream = near_stream(spark.readStream.schema(ddl).parquet(source), ttl_ms=6_000).select("seq")
        query = (
            stream.writeStream.format("parquet").option("path", kept)
            .option("checkpointLocation", str(tmp_path / "checkpoint")).start()
        )
        try:
            assert wait_for(1) == 1
            time.sleep(10)
            arrive(2)
            assert wait_for(2) == 2
        finally:
            query.stop()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r.seq for r in spark.read.schema("seq long").parquet(kept).collect()} == {1, 2}


def test_the_exact_step_calls_no_state_from_python(spark, tmp_path):
    """The first row of a key passes: of the earliest micro-batch, and of that the lowest place."""
    ddl = (
        "seq struct<part long, no string>, title string, start string, `end` string, venue_name string, "
        "address string, city string, source_id string"
    )
    rng, source, want = random.Random(5), str(tmp_path / "in"), {}
    os.mkdir(source)
    stream = exact_stream(spark.readStream.schema(ddl).parquet(source)).select("title", "start", "seq")
    for batch in range(3):
        places = [(part, str(no)) for part in range(20) for no in range(20)]
        rows = [
            (place, rng.choice("abc"), rng.choice([None, "soon", *[f"2024-05-{day:02}" for day in range(1, 31)]]))
            for place in rng.sample(places, 90)
        ]
        new = {}
        for place, *key in sorted(rows):
            new.setdefault(tuple(key), place)
        want = new | want
        entities = [(place, title, start, None, "v", "", "c", "s") for place, title, start in rows]
        spark.createDataFrame(entities, ddl).repartition(3).write.mode("append").parquet(source)
        query = (
            stream.writeStream.format("parquet").option("path", str(tmp_path / "kept"))
            .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        operators = {state["operatorName"] for at in query.recentProgress for state in at["stateOperators"]}
        assert operators == {"dedupe"}, batch
    kept = spark.read.parquet(str(tmp_path / "kept")).collect()
    assert len(kept) == len(want)
    assert {(r.title, r.start): tuple(r.seq) for r in kept} == want


@pytest.mark.parametrize("struct", [False, True])
def test_first_rows_of_a_task_in_little_memory(monkeypatch, struct):
    """Reduced as the batches come; a row without a place yields to those with one."""
    monkeypatch.setattr(dedup, "REDUCED_AT", 8)
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "c", None]), rng.random() < 0.5, seq if seq % 7 else None) for seq in range(200)]
    rng.shuffle(rows)
    kind = pa.struct([("part", pa.int64()), ("no", pa.string())]) if struct else pa.int64()

    def place(seq):
        return seq if seq is None or not struct else {"part": seq // 10, "no": str(seq % 10)}

    batches = [
        pa.record_batch([
            pa.array([key for key, _, _ in part], pa.string()), pa.array([dated for _, dated, _ in part]),
            pa.array([place(seq) for _, _, seq in part], kind),
        ], ["dedup_key", "dated", "seq"])
        for part in (rows[at : at + 5] for at in range(0, 200, 5))
    ]
    want = {}
    for key, dated, seq in rows:
        if seq is not None:
            want[key, dated] = min(seq, want.get((key, dated), seq))
    got = [row for batch in dedup._first_of_key(iter(batches)) for row in batch.to_pylist()]
    assert len(got) == len(want)
    assert {(r["dedup_key"], r["dated"]): r["seq"] for r in got} == {key: place(seq) for key, seq in want.items()}
    assert not list(dedup._first_of_key(iter(())))
