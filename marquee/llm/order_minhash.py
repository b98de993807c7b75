"""Near-duplicate documents by order MinHash and banded alignment.

A document is its sequence of five-word runs (``SHINGLE`` words, lower case). Every run is labelled
with its occurrence number. For each of ``TABLES`` hash functions the ``KEEP`` labelled runs of the
smallest hash are taken and put back in text order; their joint hash is the key of one table. Two
documents meet in a table when they agree on those runs and on their order, which follows edit
similarity rather than overlap of sets. A changed word costs up to five runs: copies that keep 0.65
of their runs' union (about one word in twenty changed here and there) miss all tables with a
probability of 0.006, those that keep 0.45 (one in ten) with 0.2; a test measures what is found.

Similarity of two documents is measured on a banded alignment of their words, of which one changed
word breaks one and not five: with m words matched in order, m / (n1 + n2 - m). The band holds all
alignments that can reach the threshold, as those leave out at most (1 - s) / (1 + s) of the n1 + n2
words. ``THRESHOLD`` is 0.8.

1. Equal texts are one node (md5), whatever their number.
2. Candidates are families: connected components of the documents that share a table key, linked to
   the smallest node of their bucket, so a bucket of any size gives one edge per member.
3. Within a family all pairs are judged that are not connected yet, in blocks: families above
   ``BLOCK`` documents are cut in chunks and each two chunks meet in a block of their own. Before the
   alignment, the number of common labelled words (an upper bound of the matches) comes from one
   matrix product per block. No pair is lost by a cap, and none is written: a block returns the
   links that join its groups.
4. Groups are the connected components of the links; the document with the smallest id stays.

Cases: null text links with nothing; empty texts, and texts without a word, link only with texts
equal to them; texts shorter than five words are one run; repeated rows are copies of each other and
one stays (``deduplicated``); null ids sort last; an empty table gives no rows; extra columns are
kept by ``deduplicated`` and ignored by ``groups``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import keeps_columns, map_groups, saved, spread
from marquee.llm.components import components
from marquee.llm.words import occurrences, shingles, word_numbers

SHINGLE = 5
THRESHOLD = 0.8
TABLES = 16
KEEP = 3
BLOCK = 128
BLOCK_BYTES = 8 << 20
SEED = 17


def sketch(runs: np.ndarray, tables: int = TABLES, keep: int = KEEP, seed: int = SEED) -> np.ndarray:
    """One 64-bit key per table for the runs of a document in text order."""
    labelled = runs + occurrences(runs).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    labelled ^= labelled >> np.uint64(31)
    factors = np.random.default_rng(seed).integers(1 << 62, size=tables, dtype=np.uint64)
    factors = factors * np.uint64(2) + np.uint64(1)
    keys = np.empty(tables, np.int64)
    for table, factor in enumerate(factors):
        hashed = labelled * factor
        hashed ^= hashed >> np.uint64(32)
        hashed *= factor
        if len(hashed) > keep:
            least = np.sort(np.argpartition(hashed, keep)[:keep])  # back in text order
        else:
            least = np.arange(len(hashed))
        key = np.uint64(table)
        with np.errstate(over="ignore"):
            for value in labelled[least]:
                key = (key ^ value) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(32)
        keys[table] = key.astype(np.int64)
    return keys


def matched(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence of two sequences over matches at most ``band`` off the diagonal.

    Bit-parallel: the row of the alignment is one integer, a match table per value masked to the
    band.
    """
    start = 0
    least = min(len(a), len(b))
    same = a[:least] == b[:least]
    start = least if same.all() else int(np.argmin(same))
    a, b, least = a[start:], b[start:], least - start
    same = a[len(a) - least :][::-1] == b[len(b) - least :][::-1]
    end = least if same.all() else int(np.argmin(same))
    a, b = a[: len(a) - end].tolist(), b[: len(b) - end].tolist()
    if not a or not b:
        return start + end
    places: dict[int, int] = {}
    for at, value in enumerate(a):
        places[value] = places.get(value, 0) | 1 << at
    full = (1 << len(a)) - 1
    row = full
    width = (1 << (2 * band + 1)) - 1
    for at, value in enumerate(b):
        match = places.get(value)
        if match:
            low = at - band
            match &= width << low if low > 0 else width >> -low
            if match:
                met = row & match
                row = ((row + met) | (row - met)) & full
    return start + end + len(a) - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Matched words over all words, exact where it reaches the threshold."""
    total = len(a) + len(b)
    if not total:
        return 1.0
    band = int(total * (1 - threshold) / (1 + threshold)) + 1
    both = matched(a, b, band)
    return both / (total - both)


def text_node(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def keyed(documents: DataFrame) -> DataFrame:
    """(doc_id, node, keys, bytes): the sketch of each document, keys null without words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = []
            for text in batch["text"]:
                runs = shingles(word_numbers(text), SHINGLE)
                keys.append(sketch(runs) if len(runs) else None)
            yield pd.DataFrame({"node": batch["node"], "bytes": batch["text"].map(len), "keys": keys})

    texts = documents.where("text is not null").select("text", text_node(F.col("text")).alias("node"))
    return spread(texts).mapInPandas(run, "node string, bytes long, keys array<long>")


def judge(block: pd.DataFrame) -> Iterable[pd.DataFrame]:
    """Links that connect the documents of a block: (a, b, similarity)."""
    block = block.drop_duplicates("node", ignore_index=True)
    if len(block) < 2:
        return
    low, high = int(block["low"].iloc[0]), int(block["high"].iloc[0])
    words = [word_numbers(text) for text in block["text"]]
    lengths = np.array([len(w) for w in words])
    labelled = [w + occurrences(w).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) for w in words]
    common = _common(labelled)
    bound = common / np.maximum(lengths[:, None] + lengths - common, 1)
    wanted = np.triu(bound >= THRESHOLD, 1)
    if low != high:
        mine = block["own"].to_numpy() == low
        wanted &= mine[:, None] != mine
    a, b = np.nonzero(wanted)
    order = np.argsort(-bound[a, b], kind="stable")  # the surest first: later ones are often joined
    root = list(range(len(block)))

    def top(at: int) -> int:
        while root[at] != at:
            root[at] = root[root[at]]
            at = root[at]
        return at

    found = []
    for x, y in zip(a[order].tolist(), b[order].tolist(), strict=True):
        if top(x) != top(y):
            measured = similarity(words[x], words[y])
            if measured >= THRESHOLD:
                root[top(y)] = top(x)
                found.append((block["node"][x], block["node"][y], measured))
    if found:
        yield pd.DataFrame(found, columns=["a", "b", "similarity"])


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of common values of every two sets, by products over slices of the values."""
    total = np.zeros((len(sets), len(sets)), np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1  # a value of one set alone is common to none
    owner, place = owner[shared], np.unique(place[shared], return_inverse=True)[1]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    step = 4096
    edges = np.searchsorted(place, np.arange(0, (place[-1] + 1 if len(place) else 0) + step, step))
    for at, (first, last) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        some = np.zeros((len(sets), step), np.float32)
        some[owner[first:last], place[first:last] - at * step] = 1
        total += some @ some.T
    return total


def groups(documents: DataFrame) -> DataFrame:
    """(doc_id, node, class_id) for every row; class_id is the smallest id of its group."""
    ids = documents.select("doc_id", text_node(F.col("text")).alias("node"))
    keys = saved(keyed(documents), "order-keys").groupBy("node").agg(
        F.any_value("keys").alias("keys"), F.max("bytes").alias("bytes")
    )
    keys = saved(keys.where("keys is not null"), "order-nodes")
    buckets = keys.select("node", F.posexplode("keys").alias("at", "key"))
    first = buckets.groupBy("at", "key").agg(F.min("node").alias("a"), F.count("*").alias("n"))
    stars = buckets.join(first.where("n > 1"), ["at", "key"]).select("a", F.col("node").alias("b"))
    family = saved(components(stars), "families")
    sizes = (
        family.join(keys.select("node", "bytes"), "node")
        .groupBy("component")
        .agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        .select(
            "component",
            F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("chunks"),
        )
    )
    members = family.join(sizes, "component").withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    )
    # one row per text: the first of the equal ones, found on thin columns
    texts = documents.where("text is not null").select(
        F.col("doc_id").alias("id"), "text", text_node(F.col("text")).alias("node")
    )
    chosen = ids.groupBy("node").agg(F.min("doc_id").alias("id"))
    members = members.join(chosen, "node")
    rows = (
        texts.join(members, (texts.node == members.node) & texts.id.eqNullSafe(members.id))
        .select("component", "chunks", "own", members.node, "text")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "own", "node", "text",
        )
    )
    links = saved(
        map_groups(rows, ["component", "low", "high"], judge, "a string, b string, similarity double"),
        "order-links",
    )
    graph = components(links.select("a", "b"))
    named = ids.join(graph, "node", "left").withColumn("group", F.coalesce("component", "node"))
    smallest = named.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    return named.join(smallest, "group", "left").select(
        "doc_id", "node", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("class_id"),
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, kept (the smallest id of the group stays)."""
    out = groups(documents)
    return out.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


@keeps_columns
def deduplicated(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stay: one of each group, every row with null text."""
    kept = groups(documents).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    per_key = kept.groupBy("doc_id", "node").agg(F.count("*").alias("_rows"))
    # one text per class where several texts share the id
    per_key = saved(per_key, "order-kept")
    rows = documents.withColumn("_node", text_node(F.col("text")))
    joined = rows.alias("d").join(
        per_key.alias("k"),
        F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & F.col("d._node").eqNullSafe(F.col("k.node")),
    )
    place = F.row_number().over(Window.partitionBy("d.doc_id", "d._node").orderBy("d._node"))
    numbered = joined.select(*[f"d.`{c}`" for c in documents.columns], "d._node", place.alias("_place"))
    return numbered.where("_place = 1 or _node is null").select(*[f"`{c}`" for c in documents.columns])
