"""Hard negatives against brute force over all rows, ties and odd rows included."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import hard_negatives, queries

SCHEMA = "vec_id long, label int, embedding array<double>, row string, tile string"


def brute(rows, anchor, positives=5, negatives=5, lowest=80, highest=100):
    """All scores of all anchors, in plain Python."""
    used = []
    for vec_id, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [max(-(2**63), min(2**63 - 1, math.floor(256 * x))) for x in vector]
        used.append((vec_id, label, whole))
    out = []
    for at, (vec_id, label, vector) in enumerate(used):
        if vec_id is None or not anchor(vec_id):
            continue
        scored = []
        for i, (other, kind, components) in enumerate(used):
            if i != at and len(components) == len(vector):
                score = sum(x * y for x, y in zip(vector, components, strict=True))
                score = max(-(2**63), min(2**63 - 1, score))
                scored.append((-score, other is None, other or 0, other, kind))
        scored.sort(key=lambda s: s[:3])
        for p in [s for s in scored if s[4] == label][:positives]:
            window = [s for s in scored if s[4] != label and lowest * -p[0] <= 100 * -s[0] <= highest * -p[0]]
            out += [(vec_id, p[3], rank, s[3], -p[0], -s[0]) for rank, s in enumerate(window[:negatives], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    names = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    return sorted((tuple(r[n] for n in names) for r in hard_negatives.mined(frame, F.col("vec_id") % 10 == 0, **options).collect()), key=repr)


def clustered(random, count, size, spread=0.1):
    centres = random.normal(size=(8, size)) / math.sqrt(size)
    return centres[random.integers(8, size=count)] + spread * random.normal(size=(count, size)) / math.sqrt(size)


@pytest.mark.parametrize("tile,page", [(16_384, 128), (60, 4)])
def test_clusters_against_brute_force(spark, monkeypatch, tile, page):
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    monkeypatch.setattr(hard_negatives, "PAGE", page)
    random = np.random.default_rng(5)
    vectors = clustered(random, 600, 8)
    rows = [(i, int(random.integers(3)), v.tolist()) for i, v in enumerate(vectors)]
    got = mined(spark, rows)
    assert got == brute(rows, lambda v: v % 10 == 0) and len(got) > 1000
    got = mined(spark, rows, positives=2, negatives=7, lowest=-50, highest=120)
    assert got == brute(rows, lambda v: v % 10 == 0, 2, 7, -50, 120)


def test_ties_copies_and_odd_rows(spark):
    random = np.random.default_rng(6)
    rows = [(i, i % 2, random.integers(-2, 3, 3).astype(float).tolist()) for i in range(120)]
    rows += [(1000 + i, 1, [1.0, 1.0, 0.0]) for i in range(60)]  # one vector many times
    rows += [(10, 0, [1.0, 1.0, 0.0])] * 3  # repeated rows, anchors among them
    rows += [(None, 0, [1.0, 1.0, 0.0]), (None, 1, [1.0, 1.0, 0.0])]
    rows += [(20, None, [1.0] * 3), (30, 1, None), (40, 1, [1.0, None, 0.0]), (50, 1, [float("nan")] * 3)]
    rows += [(60, 1, [float("-inf"), 0.0, 0.0]), (70, 0, [0.0] * 3), (800, 0, []), (801, 0, []), (802, 1, [])]
    rows += [(90, 1, [1.0, 2.0]), (91, 0, [1.0, 2.0]), (92, 1, [1.0, 2.0]), (100, 5, [1.0, 1.0, 1.0])]
    got = mined(spark, rows)
    # a repeated anchor gives its rows once for each copy; which copy is its positive has no bearing
    assert got == brute(rows, lambda v: v % 10 == 0)
    assert [r for r in got if r[0] == 800] == [(800, 801, 1, 802, 0, 0)]


def test_scores_beyond_double_and_long(spark):
    random = np.random.default_rng(7)
    large = (random.normal(size=(80, 3)) * 1e9).tolist()
    rows = [(i, i % 3, v) for i, v in enumerate(large)]
    assert mined(spark, rows) == brute(rows, lambda v: v % 10 == 0)
    rows += [(200 + i, i % 3, (random.normal(size=3) * 1e300).tolist()) for i in range(12)]
    rows += [(300, 0, []), (301, 0, []), (302, 1, [])]
    assert mined(spark, rows) == brute(rows, lambda v: v % 10 == 0)


def test_no_rows_and_no_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, 1, [1.0])]) == []
    assert mined(spark, [(1, 1, [1.0]), (2, 1, [1.0]), (3, 2, [1.0])]) == []


def test_boxes_are_passed_over():
    random = np.random.default_rng(8)
    vectors = np.floor(256 * clustered(random, 20_000, 6, 0.02))
    labels = random.integers(2, size=len(vectors))
    tree = hard_negatives.Tree(vectors, labels, np.arange(len(vectors)), np.arange(len(vectors)))
    seen = []
    score = np.dot

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                seen.append(at)
            return np.asarray(self)[at]

    tree.vectors = tree.vectors.view(Counted)
    anchor = vectors[:1]
    found = tree.search(anchor[0], labels[0], 0, tree.bounds(anchor), 0, [(-(2**62), 2**62)], False, 5)
    scores = score(vectors, anchor[0])
    want = sorted((-s, i) for i, s in enumerate(scores) if labels[i] != labels[0])[:5]
    assert [(-s, i) for s, i, _ in found[0]] == want
    assert len(seen) < len(tree.pages) / 4


def test_query_against_sql(spark, tables):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tables}/embeddings.parquet'")
    got = queries.op13_box_tree_negatives(spark, tables)
    want = connection.sql(queries.ORACLES["op13_box_tree_negatives"])
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r[c] for c in want.columns) for r in got.collect()]
    assert sorted(rows) == sorted(want.fetchall()) and rows
