"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

1. Vectors equal in every component become one node with a weight.
2. On a bounded sample, principal axes and several rotations are learned that bring the centred
   vectors close to the corners of a cube (iterative quantisation: alternate codes and an orthogonal
   fit). The signs after rotation are balanced binary codes.
3. The code bits are cut into substrings, one hash table each. By the pigeonhole principle a pair
   that differs in fewer bits than there are tables shares a bucket in one of them. Bits per
   substring and the number of tables are those of least cost by which sample pairs just at the
   threshold meet in the learned codes with the recall asked (``plan``); where comparing every pair
   costs less than that, as in small tables, every pair is compared.
4. The vectors travel to their buckets and are reranked there: one product of original vectors in
   double precision per block. A pair is counted in the first table where it meets, so nothing is
   counted twice and no pair is ever written: a block returns a row per vector with its number of
   links, and a spanning forest.
5. Buckets above ``BLOCK`` vectors are cut into chunks, and each two chunks meet in a block of their
   own, so a bucket that holds a third of all vectors is many bounded tasks.

Links are exact where found; of pairs just at the threshold up to 1 - ``RECALL`` may be missed, fewer
of closer ones (tests measure it against brute force, with and without a common direction). Vectors that are null, empty, zero, or hold a null or non-finite component link with
nothing. Vectors of different lengths never link, each length has codes of its own. Repeated rows
and equal vectors link with each other. Null ids are kept; a component made of them only is null. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import map_groups, saved, spread
from marquee.llm.components import components

THRESHOLD = 0.9
RECALL = 0.97  # of the tables, for pairs just at the threshold, measured on sample pairs
SAMPLE = 20_000  # vectors per length that rotations are learned from, at most (in expectation)
ROUNDS = 30
IN_BUCKET = 16
BLOCK = 1024
FEWEST_BITS = 4
PAIRS = 2000  # sample pairs of a set on which codes are measured
MOST_TABLES = 4096
PRODUCTS = 512  # comparisons in a bucket that cost about as much as sending a vector to one
SEED = 20240607


def valid(vector: Column) -> Column:
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    any_value = F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & ~bad & any_value, F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, free of overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def learn(sample: np.ndarray, bits: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(mean, directions): sign((x - mean) @ directions) is the code of ``bits`` bits.

    Each rotation of the principal axes starts from another random one and gives as many bits as
    there are dimensions.
    """
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    projected = centred @ axes
    random = np.random.default_rng(seed)
    size = axes.shape[1]
    directions = []
    for _ in range(math.ceil(bits / size)):
        rotation, _ = np.linalg.qr(random.normal(size=(size, size)))
        for _ in range(ROUNDS):
            codes = np.where(projected @ rotation > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ codes)
            rotation = left @ right
        directions.append(axes @ rotation)
    return mean, np.hstack(directions)[:, :bits]


def sample_pairs(sample: np.ndarray, threshold: float, seed: int = SEED) -> list[tuple]:
    """Sets of pairs (a, b) just at the threshold, on which codes are measured.

    Pairs of the sample just above it where there are enough of them, and made ones that always are:
    sample vectors turned by the threshold's angle, in any direction and in directions in which
    sample vectors differ.
    """
    random = np.random.default_rng(seed)
    anchors = sample[random.permutation(len(sample))[:PAIRS]]
    found = []
    for start in range(0, len(anchors), 256):  # bounded memory: 256 rows of the product
        product = anchors[start : start + 256] @ sample.T
        x, y = np.nonzero((product >= threshold) & (product < threshold + (1 - threshold) / 10))
        found.append((x + start, y))
    a, b = (np.concatenate(side) for side in zip(*found, strict=True))
    some = random.permutation(len(a))[:PAIRS]
    sets = [(anchors[a[some]], sample[b[some]])] if len(a) >= PAIRS // 10 else []
    ways = sample[random.integers(len(sample), size=(2, len(anchors)))]
    for way in (random.normal(size=anchors.shape), ways[0] - ways[1]):
        way = way - (way * anchors).sum(axis=1, keepdims=True) * anchors
        norm = np.linalg.norm(way, axis=1)
        good = norm > 1e-9
        turned = way[good] / norm[good, None] * math.sqrt(1 - threshold**2)
        if good.any():
            sets.append((anchors[good], threshold * anchors[good] + turned))
    return sets


def _tables(agree: list[np.ndarray], bits: int, recall: float) -> float:
    """Tables by which every set of pairs, each with its share of agreeing bits, meets as asked."""
    low, high = 0, MOST_TABLES + 1  # not enough, enough or too many
    while high - low > 1:
        at = (low + high) // 2
        if min(float(np.mean(1 - (1 - share**bits) ** at)) for share in agree) >= recall:
            high = at
        else:
            low = at
    return high if high <= MOST_TABLES else math.inf


def measured(sets: list[tuple], mean: np.ndarray, directions: np.ndarray, bits: int) -> float:
    """The share of pairs that share a bucket, in the set where it is smallest."""
    shares = []
    for a, b in sets:
        same = ((a - mean) @ directions > 0) == ((b - mean) @ directions > 0)
        shares.append(same.reshape(len(a), -1, bits).all(axis=2).any(axis=1).mean())
    return float(min(shares))


def plan(
    sample: np.ndarray, count: int, threshold: float = THRESHOLD, recall: float = RECALL
) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(mean, directions, bits per substring, tables) for so many vectors.

    Centred codes of pairs at the threshold differ the more the further the vectors lie from the
    origin as a whole, so the learned codes themselves are measured on ``sample_pairs``. Of all
    numbers of bits the one of least cost is taken. Tables are added until the pairs meet as asked.
    """
    size = sample.shape[1]

    def cost(bits: int, tables: float) -> float:
        bucket = count / 2**bits
        return tables * (max(1.0, bucket / BLOCK) + bucket / PRODUCTS)

    if count <= IN_BUCKET:  # what a bucket holds
        return sample.mean(axis=0), np.zeros((size, 0)), 0, 1
    most = min(30, max(6, round(math.log2(count / IN_BUCKET))))
    sets = sample_pairs(sample, threshold)
    mean, directions = learn(sample, max(256, 4 * size))
    if not sets:  # all alike or of one dimension: one code holds them
        return mean, directions[:, :FEWEST_BITS], FEWEST_BITS, 1
    agree = [
        (((a - mean) @ directions > 0) == ((b - mean) @ directions > 0)).mean(axis=1)
        for a, b in sets
    ]
    bits, tables = min(
        ((b, _tables(agree, b, recall)) for b in range(FEWEST_BITS, most + 1)), key=lambda x: cost(*x)
    )
    while tables <= MOST_TABLES:
        mean, directions = learn(sample, bits * tables)
        if measured(sets, mean, directions, bits) >= recall:
            return mean, directions, bits, tables
        tables += math.ceil(tables / 8)
    raise ValueError(f"no {MOST_TABLES} tables find pairs at cosine {threshold} with recall {recall}")


def nodes(embeddings: DataFrame) -> DataFrame:
    """(vec_id, node): equal vectors share a node; rows that link with nothing have none."""
    text = F.concat_ws(",", F.col("embedding").cast("array<string>"))
    return embeddings.select(
        "vec_id", "embedding", F.when(valid(F.col("embedding")), F.md5(text)).alias("node")
    )


def near_links(
    embeddings: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = embeddings.sparkSession
    rows = nodes(embeddings)
    distinct = saved(
        rows.where("node is not null")
        .groupBy("node")
        .agg(F.any_value("embedding").alias("embedding"), F.count("*").alias("weight")),
        "vectors",
    )
    kind = distinct.schema["embedding"].dataType.simpleString()
    lengths = {
        r[0]: r[1] for r in distinct.groupBy(F.size("embedding")).count().collect()
    }  # one number per vector length
    sent = {}
    for length, count in lengths.items():
        share = min(1.0, SAMPLE / count)
        # nodes are md5 digits, so their first ones are a random draw that every run repeats
        draw = F.conv(F.substring("node", 1, 8), 16, 10).cast("long") < share * 2**32
        sample = distinct.where((F.size("embedding") == length) & draw).select("embedding").toPandas()
        if len(sample) < 2:
            sample = distinct.where(F.size("embedding") == length).select("embedding").limit(2).toPandas()
        vectors = unit(np.array(sample["embedding"].tolist(), float))
        sent[length] = plan(vectors, count, threshold, recall)
    if not sent:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"),
        )
    model = spark.sparkContext.broadcast(sent)  # dimensions x bits, not growing with rows

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = batch["embedding"].map(len).to_numpy()
            for length in np.unique(size):
                mean, directions, bits, tables = model.value[int(length)]
                part = batch[size == length]
                vectors = unit(np.array(part["embedding"].tolist(), float))
                signs = (vectors - mean) @ directions > 0
                powers = 1 << np.arange(bits)
                keys = signs.reshape(len(part), tables, bits) @ powers
                yield pd.DataFrame({
                    "node": part["node"].to_numpy(), "weight": part["weight"].to_numpy(),
                    "length": np.int32(length), "embedding": list(part["embedding"]),
                    "codes": list(keys.astype("int32")),
                })

    coded = saved(
        spread(distinct).mapInPandas(
            code, f"node string, weight long, length int, embedding {kind}, codes array<int>"
        ),
        "codes",
    )
    found = saved(_blocks(coded, threshold), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    graph = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    each = (
        distinct.select("node", "weight")
        .join(links, "node", "left")
        .join(graph, "node", "left")
        .select(
            "node",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    placed = rows.select("vec_id", "node").join(each, "node", "left")
    smallest = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    alone = F.col("component").isNull()
    named = placed.join(smallest.where("component is not null"), "component", "left")
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return named.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def _blocks(coded: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) per vector with links in a block; root is one linked in the same tree."""
    thin = coded.select("length", F.posexplode("codes").alias("at", "key"))
    counts = thin.groupBy("length", "at", "key").count()
    large = counts.where(F.col("count") > BLOCK).select(
        "length", "at", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("chunks")
    )
    shared = counts.where("count > 1").select("length", "at", "key")
    rows = coded.select("*", F.posexplode("codes").alias("at", "key"))
    rows = rows.join(shared, ["length", "at", "key"], "left_semi")
    rows = rows.join(large, ["length", "at", "key"], "left").na.fill(1, ["chunks"])
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    rows = rows.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    )
    rows = rows.select(
        "length", "at", "key",
        F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "node", "weight", F.col("embedding"), "codes",
    )

    def rerank(block: pd.DataFrame) -> Iterable[pd.DataFrame]:
        if len(block) < 2:
            return
        at, low, high = (int(block[c].iloc[0]) for c in ("at", "low", "high"))
        vectors = unit(np.array(block["embedding"].tolist(), float))
        codes = np.array(block["codes"].tolist(), "int32")[:, :at]
        weight = block["weight"].to_numpy("int64")
        node = block["node"].to_numpy()
        mine = block["own"].to_numpy() == low
        total = np.zeros(len(block), "int64")
        root = np.arange(len(block))
        for start in range(0, len(block), 256):  # bounded memory: 256 rows of the product
            part = slice(start, start + 256)
            linked = vectors[part] @ vectors.T >= threshold
            linked &= np.arange(len(block)) > np.arange(len(block))[part, None]
            if low != high:
                linked &= mine[part, None] != mine
            a, b = np.nonzero(linked)
            a += start
            if at and len(a):
                fresh = np.ones(len(a), bool)
                for seen in range(at):
                    fresh &= codes[a, seen] != codes[b, seen]
                a, b = a[fresh], b[fresh]
            np.add.at(total, a, weight[b])
            np.add.at(total, b, weight[a])
            _join(root, a, b)
        some = np.flatnonzero(total)
        if len(some):
            yield pd.DataFrame(
                {"node": node[some], "links": total[some], "root": node[[_top(root, i) for i in some]]}
            )

    return map_groups(
        rows, ["length", "at", "key", "low", "high"], rerank, "node string, links long, root string"
    )


def _top(root: np.ndarray, at: int) -> int:
    while root[at] != at:
        root[at] = root[root[at]]
        at = root[at]
    return at


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        if root[x] == root[y]:
            continue
        x, y = _top(root, x), _top(root, y)
        root[max(x, y)] = min(x, y)
