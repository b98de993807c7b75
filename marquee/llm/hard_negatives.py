"""Hard negatives of anchors by inner product, searched in R-trees packed sort-tile-recursive.

1. Components become whole numbers (``floor(256 x)``). Rows of one label with equal vectors have the
   same score with any anchor, so only the few with the smallest ids of them can be returned: a rank
   filter that also runs before the shuffle leaves those, and a vector that a third of all rows
   repeat is a handful of rows.
2. Sort-tile-recursive packing. Spark sorts the rows by (length, label, first coordinate) into slabs
   and each slab by a second coordinate into tiles, both as range partitions with the row number last
   in the key, so that ties split as well. Inside a tile the same rule goes on over further
   coordinates, the widest first, down to pages of ``PAGE`` rows of one label, and ``FANOUT`` pages or
   nodes in a row make a node of the level above.
3. A node's bounding box gives an interval of inner products with an anchor: each coordinate
   contributes between its products with the box's two ends. A queue takes boxes by falling upper
   end. A box is passed over when it has no row of a label looked for, when its interval lies outside
   every score window, or when its upper end is strictly below the scores that would be replaced.
4. First the positives (same label, no window), then the negatives, whose windows come from the
   positives' scores. The anchors travel to the tiles (the stated query set against all rows), where
   they stream past one tree; a tile is bounded and so is what it answers for an anchor, and a rank
   filter joins the answers of the tiles.

Scores are exact: products in double precision while no sum can reach 2**53, in Python's whole
numbers beyond. A component or score that no long holds becomes the nearest long.

Cases: rows with a null label, a null vector or a null or non-finite component take no part. Rows of
other lengths than an anchor's are no candidates for it; empty vectors score 0 with each other. A
null id is no anchor and comes after all ids in ties. Repeated rows are rows of their own, also as
anchors, so a copy of an anchor is its positive. Of equal scores the smaller id comes first, of equal
ids any. An anchor without positives, or a positive without negatives, gives no rows; an empty table
none. Extra columns are ignored, clashing names included.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import saved

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOWEST, HIGHEST = 80, 100  # per cent of the positive's score
TILE = 16_384  # rows of a tile at most (about), fewer when there are more cores than tiles
PAGE = 128
FANOUT = 8
ASKED = 256  # anchors whose intervals with all boxes of a tile are held at once
EXACT = 2**53
LAST = 2**63 - 1
FOUND = "anchor_row long, window int, score long, vec_id long, row long"


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector, length, row): whole-number vectors of the rows that take part.

    ``row`` numbers the rows once they are written, so that a row can be told from its copies.
    """
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))))
    return rows.where(good).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), whole.alias("vector"),
        F.size("embedding").alias("length"), F.monotonically_increasing_id().alias("row"),
    )


class Tree:
    """An R-tree over the rows of one tile and one vector length, level by level from the pages up."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        order = np.concatenate([_packed(vectors, at) for at in _runs(labels)])
        self.vectors, self.labels = vectors[order], labels[order]
        self.ids, self.rows = ids[order], rows[order]
        pages = [
            (start, min(start + PAGE, run[-1] + 1))
            for run in _runs(self.labels)
            for start in range(run[0], run[-1] + 1, PAGE)
        ]
        self.pages = np.array(pages, np.int64)
        starts = self.pages[:, 0]
        low = np.minimum.reduceat(self.vectors, starts, axis=0)
        high = np.maximum.reduceat(self.vectors, starts, axis=0)
        own = self.labels[starts]
        self.levels = [(low, high, own, own)]  # boxes, smallest and largest label below
        while len(low) > 1:
            starts = np.arange(0, len(low), FANOUT)
            low = np.minimum.reduceat(low, starts, axis=0)
            high = np.maximum.reduceat(high, starts, axis=0)
            least = np.minimum.reduceat(self.levels[-1][2], starts)
            most = np.maximum.reduceat(self.levels[-1][3], starts)
            self.levels.append((low, high, least, most))

    def bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(lower, upper) ends of the inner products of each anchor with each box, by level."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        ends = [
            (np.dot(up, low.T) + np.dot(down, high.T), np.dot(up, high.T) + np.dot(down, low.T))
            for low, high, _, _ in self.levels
        ]
        return [(held_by_long(lower), held_by_long(upper)) for lower, upper in ends]

    def search(self, anchor, label, row, bounds, at, windows, same: bool, most: int) -> list:
        """For each window (lowest, highest score) its first rows as [(score, id, row)].

        Best first over boxes; stops when no box left can hold a row that any window still takes.
        """
        found: list[list[tuple]] = [[] for _ in windows]
        floors = [low for low, _ in windows]  # a row must reach it to be returned
        ceiling = max(high for _, high in windows)
        top = len(self.levels) - 1
        queue = [(-bounds[top][1][at, 0], top, 0)]
        while queue:
            upper, level, node = heapq.heappop(queue)
            floor = min(floors)
            if -upper < floor:
                break
            if not self._useful(bounds[level][0][at, node], -upper, windows, floors):
                continue
            if level:
                low, high, least, greatest = self.levels[level - 1]
                part = slice(node * FANOUT, min((node + 1) * FANOUT, len(low)))
                ends = bounds[level - 1][1][at, part]
                if same:
                    fits = (least[part] <= label) & (greatest[part] >= label)
                else:
                    fits = (least[part] != label) | (greatest[part] != label)
                for i in np.flatnonzero(fits & (ends >= floor)).tolist():
                    heapq.heappush(queue, (-ends[i], level - 1, part.start + i))
                continue
            start, end = self.pages[node]
            if (self.labels[start] == label) != same:  # a page has one label
                continue
            scores = held_by_long(np.dot(self.vectors[start:end], anchor))
            for i in np.flatnonzero((scores >= floor) & (scores <= ceiling)).tolist():
                if self.rows[start + i] == row:
                    continue
                score = scores[i]
                entry = (-score, self.ids[start + i], self.rows[start + i])
                for w, (_, highest) in enumerate(windows):
                    if floors[w] <= score <= highest:
                        held = found[w]
                        held.append(entry)
                        if len(held) > most:
                            held.sort()
                            held.pop()
                        if len(held) == most:
                            floors[w] = max(floors[w], -max(held)[0])
        return [[(-s, i, r) for s, i, r in sorted(held)] for held in found]

    @staticmethod
    def _useful(lower, upper, windows, floors) -> bool:
        return any(
            lower <= high and upper >= floor
            for (_, high), floor in zip(windows, floors, strict=True)
        )


def _runs(labels: np.ndarray) -> list[np.ndarray]:
    """The places of each label, in order of labels."""
    order = np.argsort(labels, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(labels[order])) + 1)


def _packed(vectors: np.ndarray, rows: np.ndarray, used: tuple[int, ...] = ()) -> np.ndarray:
    """Sort-tile-recursive order of some rows: slabs by the widest coordinate, each packed further."""
    pages = -(-len(rows) // PAGE)
    if pages <= 1 or len(used) == vectors.shape[1]:
        return rows
    part = vectors[rows]
    width = part.max(axis=0) - part.min(axis=0)
    for coordinate in used:
        width[coordinate] = -1
    coordinate = int(np.argmax(width))
    rows = rows[np.argsort(part[:, coordinate], kind="stable")]
    slabs = max(2, round(pages**0.5)) if pages > 3 else pages
    size = -(-pages // slabs) * PAGE  # whole pages
    return np.concatenate([
        _packed(vectors, rows[at : at + size], (*used, coordinate)) for at in range(0, len(rows), size)
    ])


def held_by_long(values: np.ndarray) -> np.ndarray:
    """Python's whole numbers cut to the range of a long; doubles as they are."""
    return np.clip(values, -LAST - 1, LAST) if values.dtype == object else values


def matrix(vectors: list, length: int, exact: bool) -> np.ndarray:
    """Rows of doubles if their products are exact, else of Python's whole numbers."""
    values = np.array(vectors, np.int64).reshape(len(vectors), length)
    return values.astype(np.float64) if exact else values.astype(object)


def tiles(rows: DataFrame, keep: int) -> tuple[DataFrame, int]:
    """``rows`` written with the number of their tile, and how many tiles there are.

    Of equal vectors of a label the ``keep`` rows with the smallest ids stay.
    """
    first = Window.partitionBy("label", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    points = saved(
        rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= keep).drop("place"),
        "points",
    )
    count = points.count()  # read from the files' footers
    cores = rows.sparkSession.sparkContext.defaultParallelism
    number = max(-(-count // TILE), min(cores, -(-count // 1024)), 1)

    def by(coordinate: int) -> list[Column]:
        value = F.coalesce(F.get("vector", F.lit(coordinate)), F.lit(0).cast("long"))
        return [F.col("length"), F.col("label"), value, F.col("row")]

    slabbed = points.repartitionByRange(max(1, round(number**0.5)), *by(0))
    slabbed = saved(slabbed.withColumn("slab", F.spark_partition_id()), "slabs")
    tiled = slabbed.repartitionByRange(number, F.col("slab"), *by(1))
    out = saved(tiled.withColumn("tile", F.spark_partition_id()).drop("slab"), "tiles")
    return out, 1 + (out.agg(F.max("tile")).first()[0] or 0)


def search(
    tiled: DataFrame, number: int, anchors: DataFrame, same: bool, most: int, exact: bool
) -> DataFrame:
    """(anchor_row, window, score, vec_id, row, rank): the first rows of each window of an anchor.

    ``anchors`` has row, label, length, vector, and the lowest and highest score of each window in
    the arrays low and high. ``same``: rows of the anchor's label, else of all others. The rows of a
    tile come first in its task, then the anchors stream past their trees in batches.
    """
    if same:
        homes = tiled.groupBy("length", "label").agg(F.collect_set("tile").alias("tile"))
        asks = anchors.join(homes, ["length", "label"])
    else:
        asks = anchors.withColumn("tile", F.sequence(F.lit(0), F.lit(number - 1)))
    asks = asks.withColumn("tile", F.explode("tile"))
    none = F.lit(None)
    both = tiled.select(
        "tile", F.lit(0).alias("side"), "length", "label", "vec_id", "row", "vector",
        none.cast("array<long>").alias("low"), none.cast("array<long>").alias("high"),
    ).unionByName(asks.select(
        "tile", F.lit(1).alias("side"), "length", "label", none.cast("long").alias("vec_id"), "row",
        "vector", "low", "high",
    ))
    dealt = both.repartitionById(number, F.col("tile")).sortWithinPartitions("tile", "side")

    def answers(trees: dict[int, Tree], asks: pd.DataFrame) -> Iterator[tuple]:
        for length, own in asks.groupby("length"):
            if length not in trees:
                continue
            tree = trees[length]
            vectors = matrix(own["vector"].tolist(), length, exact)
            bounds = tree.bounds(vectors)
            each = zip(own["label"].tolist(), own["row"].tolist(), own["low"], own["high"], strict=True)
            for i, (label, row, low, high) in enumerate(each):
                windows = list(zip(low.tolist(), high.tolist(), strict=True))
                found = tree.search(vectors[i], label, row, bounds, i, windows, same, most)
                for window, held in enumerate(found):
                    for score, vec_id, other in held:
                        yield row, window, int(score), vec_id, other

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tile, held, trees = None, [], {}
        for batch in batches:
            for at, part in batch.groupby("tile"):
                if at != tile:
                    tile, held, trees = at, [], {}
                side = part["side"].to_numpy()
                if not side.all():
                    held.append(part[side == 0])
                if held and side.any():
                    trees = {
                        length: Tree(
                            matrix(own["vector"].tolist(), length, exact), own["label"].to_numpy(np.int64),
                            own["vec_id"].astype("Int64").fillna(LAST).to_numpy(np.int64),
                            own["row"].to_numpy(np.int64),
                        )
                        for length, own in pd.concat(held).groupby("length")
                    }
                    held = []
                asks = part[side == 1]
                for start in range(0, len(asks), ASKED):
                    rows = list(answers(trees, asks[start : start + ASKED]))
                    frame = pd.DataFrame(rows, columns=["anchor_row", "window", "score", "vec_id", "row"])
                    frame["vec_id"] = frame["vec_id"].astype("Int64").mask(frame["vec_id"] == LAST)
                    yield frame

    found = dealt.mapInPandas(run, FOUND)
    best = Window.partitionBy("anchor_row", "window").orderBy(
        F.desc("score"), F.col("vec_id").asc_nulls_last(), "row"
    )
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)


def mined(
    rows: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id, label and embedding; ``anchor`` says by these which rows are anchors. Each
    of the first ``positives`` rows of an anchor's label gets the first ``negatives`` rows of other
    labels whose score is from ``lowest`` to ``highest`` per cent of the positive's.
    """
    kept = saved(usable(rows.select("vec_id", "label", "embedding")), "vectors")
    widest = kept.agg(
        F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))), F.max("length")
    ).first()
    exact = (widest[0] or 0.0) ** 2 * (widest[1] or 0) < EXACT
    tiled, number = tiles(kept, max(positives + 1, negatives))
    anchors = kept.where(anchor).select("row", "vec_id", "label", "length", "vector")
    any_score = {"low": F.array(F.lit(-LAST - 1)), "high": F.array(F.lit(LAST))}
    first = saved(
        search(tiled, number, anchors.withColumns(any_score), True, positives, exact), "positives"
    )
    score = F.col("score").cast("decimal(19,0)")
    low = F.ceil(score * lowest / 100).cast("long")
    high = F.floor(score * highest / 100).cast("long")
    windows = first.groupBy("anchor_row").agg(
        F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("w")
    )  # at most ``positives`` each
    asks = anchors.join(windows.withColumnRenamed("anchor_row", "row"), "row").select(
        "row", "label", "length", "vector", F.col("w.low").alias("low"), F.col("w.high").alias("high")
    )
    second = search(tiled, number, asks, False, negatives, exact)
    named = first.join(
        anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row"
    ).select(
        "anchor_row", "anchor_id", (F.col("rank") - 1).alias("window"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return second.join(named, ["anchor_row", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
