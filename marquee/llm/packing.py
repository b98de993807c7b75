"""Harmonic packing of documents into sequences of a fixed number of tokens.

Lengths fall into reciprocal-capacity classes: class k holds pieces of at most floor(capacity / k)
tokens and every sequence of the class takes exactly k of them, so a piece's sequence follows from
its rank within its class alone and workers fill sequences independently. Documents may be cut, so
pieces are cut to sit just below a class limit:

* whole pieces of ``capacity`` tokens are class 1 and need no partner;
* a remainder within ``slack`` of a class limit stays whole, else the largest limit that fits is
  cut off and the rest goes on;
* tails shorter than the smallest limit are cut by their binary digits into the classes
  capacity / 16, / 8 ... which are filled exactly.

The set of classes is fixed (69 for 2048), so what the last, partial sequence of each class holds is
bounded by a constant whatever the input. Those pieces alone are packed first-fit by falling size.

A piece's rank is its number within (map task, class) plus the pieces of that class in the tasks
before, from a table of one row per task and class. Nothing sorts or collects a class.

Cases: null text is an empty document (one token, the end id); empty text likewise; a document
longer than a sequence is cut; repeated rows are packed once each; an empty table gives no rows;
extra columns are ignored, clashing names included. A null id stays null.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import saved, spread

CAPACITY = 2048
WHOLE_CLASSES = 64  # classes 1..64 by any reciprocal, beyond by powers of two
SLACK = 1 / 64
END_ID = 1

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "class int, task int, rank long"
)
COLUMNS = [c.split()[0] for c in PIECES.split(", ")]
ARROW = pa.schema(
    [(c.split()[0], pa.int64() if c.endswith("long") else pa.int32()) for c in PIECES.split(", ")]
)


@lru_cache(maxsize=4)
def classes(capacity: int = CAPACITY) -> tuple[int, ...]:
    """The class numbers k, rising; the limit of class k is capacity // k."""
    small = [k for k in range(1, WHOLE_CLASSES + 1) if capacity // k]
    while small[-1] * 2 <= capacity:
        small.append(small[-1] * 2)
    return tuple(small)


@lru_cache(maxsize=1 << 14)
def cut(rest: int, capacity: int = CAPACITY, slack: float = SLACK) -> tuple[tuple[int, int], ...]:
    """(length, class) of the pieces of a remainder below the capacity."""
    limits = [(capacity // k, k) for k in classes(capacity)]
    pieces = []
    while rest:
        fits = [(limit, k) for limit, k in limits if limit >= rest]
        limit, k = fits[-1]
        if rest >= limit * (1 - slack):
            pieces.append((rest, k))
            break
        limit, k = limits[len(fits)]
        pieces.append((limit, k))
        rest -= limit
    return tuple(pieces)


class Encoder:
    """Token ids of texts, from a tokenizer file held in memory.

    ``ranks`` (the same vocabulary as a rank file) is several times faster than the tokenizer file
    and gives the same ids; the tests compare the two. Lines of three fields are the tokenizer file's
    added tokens, whose strings in a text are their ids there too.
    """

    def __init__(self, source: bytes, pattern: str | None):
        if pattern is None:
            from tokenizers import Tokenizer

            model = Tokenizer.from_str(source.decode())
            self.encode = lambda text: model.encode(text, add_special_tokens=False).ids
        else:
            import tiktoken

            lines = [line.split() for line in source.splitlines()]
            ranks = {base64.b64decode(x[0]): int(x[1]) for x in lines if len(x) == 2}
            added = {base64.b64decode(x[0]).decode(): int(x[1]) for x in lines if len(x) == 3}
            model = tiktoken.Encoding(
                "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added
            )
            self.encode = lambda text: model.encode(text, allowed_special="all")


_ENCODERS: dict[int, Encoder] = {}


def tokenizer_file(path: str) -> bytes:
    """A vocabulary of a few megabytes at most, read on the driver and sent to the workers."""
    with open(path, "rb") as file:
        return file.read()


def with_added_tokens(ranks: bytes, tokenizer: bytes) -> bytes:
    """The rank file with the added tokens of the tokenizer file as lines of three fields."""
    lines = [ranks.rstrip()]
    for token in json.loads(tokenizer).get("added_tokens") or []:
        if token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError(f"added token {token['content']!r} takes more than its own string")
        lines.append(base64.b64encode(token["content"].encode()) + b" %d added" % token["id"])
    return b"\n".join(lines) + b"\n"


def pieces(
    documents: DataFrame,
    source: bytes,
    pattern: str | None = None,
    capacity: int = CAPACITY,
    slack: float = SLACK,
) -> DataFrame:
    """Tokenise every whole text once and cut it: one thin row per piece (no token leaves the task).

    Ranks count from zero within (task, class); the result must be written before it is used, as
    task numbers belong to this run of the scan (``pack`` does).
    """
    sent = documents.sparkSession.sparkContext.broadcast((source, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        source, pattern = sent.value
        key = zlib.crc32(source)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(source, pattern)
        encode = _ENCODERS[key].encode
        task = TaskContext.get().partitionId()
        count = dict.fromkeys(classes(capacity), 0)
        for batch in batches:
            rows = []
            docs, texts = (batch.column(name).to_pylist() for name in ("doc_id", "text"))
            for doc, text in zip(docs, texts, strict=True):
                ids = encode(text) if text else []
                ids.append(END_ID)
                data = np.array(ids, "<u4").tobytes()
                total = len(ids)
                whole, rest = divmod(total, capacity)
                at = 0
                for length, k in ((capacity, 1),) * whole + cut(rest, capacity, slack):
                    crc = zlib.crc32(data[4 * at : 4 * (at + length)])
                    rows.append((doc, at, length, crc, total, k, task, count[k]))
                    count[k] += 1
                    at += length
            columns = zip(*rows, strict=True) if rows else [[]] * len(ARROW)
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW
            )

    return spread(documents.select("doc_id", "text")).mapInArrow(run, PIECES)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequences of the pieces: adds sequence_id and offset (gapless in the sequence).

    Sequences are numbered by class, then by rank, then the mixed ones; numbers of classes do not
    overlap.
    """
    made = saved(cut_pieces, "pieces")
    counts = made.groupBy("class", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    of_class = Window.partitionBy("class")
    offsets = counts.select(
        "class",
        "task",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(of_class).alias("of_class"),
    )
    # first sequence number of each class: one row per class
    sizes = offsets.groupBy("class").agg(F.max("of_class").alias("of_class"))
    full = F.floor(F.col("of_class") / F.col("class"))
    earlier = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("class", F.coalesce(F.sum(full).over(earlier), F.lit(0)).alias("first"))
    placed = made.join(offsets.join(firsts, "class"), ["class", "task"]).withColumn(
        "rank", F.col("before") + F.col("rank")
    )
    whole = placed.where(F.col("rank") < full * F.col("class")).select(
        "*",
        (F.col("first") + F.floor(F.col("rank") / F.col("class"))).cast("long").alias("sequence_id"),
    )
    last = sizes.agg(F.coalesce(F.sum(full), F.lit(0)).cast("long").alias("last"))
    mixed = _first_fit(placed.where(F.col("rank") >= full * F.col("class")), capacity)
    mixed = mixed.crossJoin(F.broadcast(last)).withColumn(  # one row
        "sequence_id", F.col("sequence_id") + F.col("last")
    )
    whole = _offsets(whole.select(*COLUMNS, "sequence_id"))
    # the mixed sequences may hold thousands of tiny pieces, but no more than their capacity
    return whole.unionByName(_offsets(mixed.select(*COLUMNS, "sequence_id")))


def _offsets(placed: DataFrame) -> DataFrame:
    """Offset of each piece: the lengths before it in its sequence."""
    order = Window.partitionBy("sequence_id").orderBy(
        F.desc("length"), "rank", "class", "doc_id", "start"
    )
    running = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("offset", running - F.col("length"))


def _first_fit(leftover: DataFrame, capacity: int) -> DataFrame:
    """Pack the bounded rest (fewer than k pieces of each class k) first-fit by falling length."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("class", "ascending"), ("rank", "ascending")])
        room: list[int] = []
        chosen = []
        open_from = 0  # sequences before it are full
        for length in group.column("length").to_pylist():
            while open_from < len(room) and not room[open_from]:
                open_from += 1
            for at in range(open_from, len(room)):
                if room[at] >= length:
                    break
            else:
                at = len(room)
                room.append(capacity)
            room[at] -= length
            chosen.append(at)
        group = group.append_column("sequence_id", pa.array(chosen, pa.int64()))
        return group.drop_columns(["all"])

    return (
        leftover.select(*COLUMNS, F.lit(0).alias("all"))
        .groupBy("all")
        .applyInArrow(run, PIECES + ", sequence_id long")
    )


def packed(documents: DataFrame, source: bytes, pattern: str | None = None) -> DataFrame:
    """``pieces`` and ``pack`` with the contract's columns."""
    out = pack(pieces(documents, source, pattern))
    return out.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
        F.col("class").alias("piece_class"),
    )
