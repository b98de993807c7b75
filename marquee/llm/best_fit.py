"""Packing whole documents into as few sequences as possible: dominance reduction, then best fit.

Only documents longer than a sequence are cut. What matters to a packing is how many pieces there
are of each length, and lengths are at most the capacity, so the instance is a histogram of at most
``capacity`` numbers however many documents there are:

1. Martello and Toth's reduction (``reduced``): a set of up to three lengths that some best packing
   may hold as a sequence of its own, because any other sequence with its longest piece could swap
   its other pieces for those of the set, is fixed as often as the lengths occur, and taken out.
2. The remainder is packed best fit by falling length (``best_fit``). Sequences of equal room are
   numbered one after another and filled together, so a step is one line of the plan whatever the
   number of sequences.

A line of the plan says which ranks of a length go where. The pieces of a length are numbered over
the whole table from numbers within (map task, length) and one count per task and length; a piece
finds its line by binary search. Nothing is sorted, collected or grouped by sequence. The plan is
bounded by the capacity: sequences of equal room are split at most twice per length, and a sequence
holds at most 63 different lengths of a capacity of 2048.

Cases: null text is an empty document (the end id alone); empty text likewise; longer documents are
cut into pieces of the capacity and a shorter last one; repeated rows are packed once each; a null id
stays null; an empty table gives no rows; extra columns are ignored, clashing names included.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import saved, spread

CAPACITY = 2048
END_ID = 0
REMEMBERED = 400_000  # chunks of text whose ids a worker keeps
CHUNK = 48  # longer chunks are not kept
BLOCK_CHARS = 1 << 24  # text whose new chunks are encoded together
PLAIN = re.compile(r"([a-z]+)([.,;:!?]*)")  # a word, and a run of marks after it

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
)
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _schema(fields: str) -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32()}
    return pa.schema([(name, types[kind]) for name, kind in map(str.split, fields.split(", "))])


class Encoder:
    """Little-endian 32-bit ids of texts by a tokenizer file that drops white space.

    Spaces and line ends never belong to a token and no rule of such a file looks across one, so a
    text's ids are those of its chunks between them. Each different chunk of a block of texts is
    encoded once, if it was not seen before. Where the file takes a plain word and the marks after it
    as two words of its model, which is tried once, they go to the model straight away.
    """

    def __init__(self, source: bytes):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        self.model = Tokenizer.from_str(source.decode())
        self.seen: dict[str, bytes] = {"": b""}
        self.marks: dict[str, bytes] = {}  # runs of up to four marks
        self.plain = True
        tried = ["a", "of", "zqxjkvb", "thereupon", "Wörter"[-3:], "end.", "so...", "Is?!", "x,;:"]
        self.plain = all(self._encode([t]) == [self._whole([t])[0]] for t in tried)

    def _whole(self, chunks: list[str]) -> list[bytes]:
        found = self.model.encode_batch_fast(chunks, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]  # 32 bits, little-endian as all hosts are

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, each a new one."""
        out: list[bytes | None] = []
        tokenize, known, marked = self.model.model.tokenize, self.seen.get, self.marks

        def direct(part: str) -> bytes:
            return array("I", [t.id for t in tokenize(part)]).tobytes()

        for chunk in chunks:
            parts = PLAIN.fullmatch(chunk.lower()) if self.plain and chunk.isascii() else None
            if parts is None:
                out.append(None)
                continue
            word, marks = parts.groups()
            ids = known(word)
            if ids is None:
                ids = direct(word)
            if marks:
                own = marked.get(marks)
                if own is None:
                    own = direct(marks)
                    if len(marks) <= 4:
                        marked[marks] = own
                ids += own
            out.append(ids)
        rest = [at for at, ids in enumerate(out) if ids is None]
        for at, ids in zip(rest, self._whole([chunks[at] for at in rest]), strict=True):
            out[at] = ids
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the texts are taken in blocks."""
        out: list[bytes] = []
        start, size = 0, 0
        for at, text in enumerate(texts, 1):
            size += len(text)
            if size >= BLOCK_CHARS or at == len(texts):
                out += self._block(texts[start:at])
                start, size = at, 0
        return out

    def _block(self, texts: list[str]) -> list[bytes]:
        seen = self.seen
        new: list[str] = []
        out = []
        room = REMEMBERED - len(seen)
        for text in texts:
            chunks = text.replace("\n", " ").split(" ")
            ids = list(map(seen.get, chunks))
            if None in ids:
                unknown = [at for at, found in enumerate(ids) if found is None]
                fresh = list({chunks[at] for at in unknown})
                seen.update(zip(fresh, self._encode(fresh), strict=True))
                new += fresh
                for at in unknown:
                    ids[at] = seen[chunks[at]]
            out.append(b"".join(ids))
        for at, chunk in enumerate(new):
            if at >= room or len(chunk) > CHUNK:
                del seen[chunk]
        return out


_ENCODERS: dict[int, Encoder] = {}


def pieces(documents: DataFrame, source: bytes, capacity: int = CAPACITY) -> DataFrame:
    """One thin row per piece; ranks count from zero within (task, length).

    Task numbers belong to this run of the scan, so the rows must be written before they are used
    (``packed`` does).
    """
    sent = documents.sparkSession.sparkContext.broadcast(source)  # one file of a few megabytes
    schema = _schema(PIECES)
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        key = zlib.crc32(sent.value)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(sent.value)
        encode = _ENCODERS[key]
        task = TaskContext.get().partitionId()
        count: dict[int, int] = defaultdict(int)
        for batch in batches:
            rows = []
            docs = batch.column("doc_id").to_pylist()
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for doc, ids in zip(docs, encode(texts), strict=True):
                ids += end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    length = len(part) // 4
                    rows.append((doc, number, at // 4, length, zlib.crc32(part), task, count[length]))
                    count[length] += 1
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            yield pa.record_batch(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return spread(documents.select("doc_id", "text")).mapInArrow(run, PIECES)


class Histogram:
    """How many pieces of each length are left, with the present lengths as bits of one number."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {length: n for length, n in counts.items() if n}
        self.present = sum(1 << length for length in self.counts)

    def add(self, length: int, n: int) -> None:
        total = self.counts.get(length, 0) + n
        self.counts[length] = total
        self.present = self.present | 1 << length if total else self.present & ~(1 << length)

    def largest(self, limit: int) -> int:
        """The largest length up to a limit, 0 if there is none."""
        return max((self.present & ((2 << limit) - 1)).bit_length() - 1, 0) if limit > 0 else 0

    def above(self, length: int) -> int:
        """The smallest length above a length, 0 if there is none."""
        rest = self.present >> (length + 1)
        return length + (rest & -rest).bit_length() if rest else 0

    def smallest(self, most: int) -> list[int]:
        """The ``most`` smallest pieces."""
        out: list[int] = []
        length = self.above(0)
        while length and len(out) < most:
            out += [length] * min(self.counts[length], most - len(out))
            length = self.above(length)
        return out

    def partner(self, length: int, room: int) -> int:
        """The largest length >= ``length`` that fits into the room with one piece of it."""
        found = self.largest(room - length)
        if found == length and self.counts[length] < 2:
            return 0
        return found if found >= length else 0


def dominating(left: Histogram, length: int, capacity: int = CAPACITY) -> tuple[int, ...] | None:
    """The further lengths of a sequence that dominates all others with one piece of ``length``.

    ``left`` does not hold that piece any more. Sequence A dominates B if the pieces of B can be
    dealt to pieces of A that are each at least as long as what they get: then B's sequence may
    become A's in any packing, and what A's pieces leave behind has room for what B gives up.
    """
    room = capacity - length
    most = left.largest(room)
    if not most or most == room:  # nothing fits, or one piece fills up the room
        return (most,) if most else ()
    small = left.smallest(3)
    if len(small) < 2 or small[0] + small[1] > room:  # no second further piece fits
        return (most,)
    if len(small) == 3 and sum(small) <= room:
        return None
    pairs = []  # the best pair for each smaller length of a pair
    at = small[0]
    while at and 2 * at <= room:
        other = left.partner(at, room)
        if other:
            pairs.append((at, other))
        at = left.above(at)
    if all(low + high <= most for low, high in pairs):
        return (most,)
    low = left.largest(min(room - most, most))
    if low == most and left.counts[most] < 2:
        low = left.largest(most - 1)
    if low and all(a <= low or a + b <= most for a, b in pairs):
        return (most, low)
    return None


def reduced(
    counts: dict[int, int], capacity: int = CAPACITY
) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """([(lengths of a fixed sequence, how often)], the counts that remain).

    A set stays dominating while its lengths last, as fewer pieces offer fewer other sequences.
    """
    left = Histogram(counts)
    fixed = []
    changed = True
    while changed:
        changed = False
        for length in sorted((x for x, n in left.counts.items() if n), reverse=True):
            while left.counts[length]:
                left.add(length, -1)
                others = dominating(left, length, capacity)
                left.add(length, 1)
                if others is None:
                    break
                lengths = (length, *others)
                times = min(left.counts[x] // lengths.count(x) for x in lengths)
                for x in lengths:
                    left.add(x, -times)
                fixed.append((lengths, times))
                changed = True
    return fixed, {x: n for x, n in left.counts.items() if n}


def best_fit(counts: dict[int, int], capacity: int = CAPACITY, first: int = 0):
    """Best fit by falling length: ([(length, pieces, per sequence, first sequence, offset)], next).

    A sequence that takes a piece has least room of those that can, and keeps it while more fit, so
    sequences of equal room are filled one after another with as many as fit.
    """
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: [(first sequence, how many)]
    present = 0
    lines = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fitting = present >> length
            if fitting:
                room = length - 1 + (fitting & -fitting).bit_length()
                at, many = rooms[room].pop()
                if not rooms[room]:
                    present &= ~(1 << room)
            else:
                room, at, many = capacity, first, -(-left // (capacity // length))
                first += many
            per = room // length
            whole = min(many, left // per)
            taken = [(at, whole, per)] if whole else []
            if whole < many and left % per and whole == left // per:
                taken.append((at + whole, 1, left % per))
            for start, n, each in taken:
                lines.append((length, n * each, each, start, capacity - room))
                left -= n * each
                rooms[room - each * length].append((start, n))
                present |= 1 << (room - each * length)
            used = sum(n for _, n, _ in taken)
            if used < many:
                rooms[room].append((at + used, many - used))
                present |= 1 << room
    return lines, first


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """(rows of length, first rank, per sequence, first sequence, offset; number of sequences)."""
    fixed, rest = reduced(counts, capacity)
    lines = []
    first = 0
    for lengths, times in fixed:
        at = 0
        for length in dict.fromkeys(lengths):
            each = lengths.count(length)
            lines.append((length, times * each, each, first, at))
            at += length * each
        first += times
    more, first = best_fit(rest, capacity, first)
    rank: dict[int, int] = defaultdict(int)
    out = []
    for length, n, each, start, at in lines + more:
        out.append((length, rank[length], each, start, at))
        rank[length] += n
    return np.array(sorted(out), np.int64).reshape(-1, 5), first


def packed(documents: DataFrame, source: bytes, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Sequence numbers are gapless from 0, offsets gapless in the sequence.
    """
    made = saved(pieces(documents, source, capacity), "pieces")
    counts = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    histogram = counts.groupBy("length").agg(F.sum("n")).collect()  # at most ``capacity`` rows
    lines, _ = plan({r[0]: r[1] for r in histogram}, capacity)
    sent = documents.sparkSession.sparkContext.broadcast(lines)  # bounded by the capacity
    schema = _schema(PLACED)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = sent.value
        starts = np.searchsorted(lines[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            line = np.empty(len(length), np.int64)
            for x in np.unique(length):
                mine = length == x
                ranks = lines[starts[x] : starts[x + 1], 1]
                line[mine] = starts[x] + np.searchsorted(ranks, rank[mine], "right") - 1
            _, first_rank, per, first, offset = lines[line].T
            number = rank - first_rank
            yield pa.record_batch(
                [*(batch.column(c) for c in schema.names[:5]), pa.array(first + number // per),
                 pa.array(offset + number % per * length)], schema=schema,
            )

    return made.join(before, ["length", "task"]).mapInArrow(place, PLACED)
