"""Document fingerprints by randomised edit embedding.

A walk reads a text: at step j it looks at the character under its pointer and a random bit, shared
by all texts and fixed by (j, character), says whether the pointer moves on. Two texts walk together
while they agree, and after an edit they fall into step again, so edit distance turns into Hamming
distance between the sequences of characters read. The walk covers the whole text (about two steps
a character). The sequence is sampled at fixed steps: every octave of steps [2**k, 2**(k+1)) has
``SAMPLES`` of them, chosen once by chance; the fingerprint holds, per octave reached, one byte for
each: a hash of the ``GRAM`` characters from the pointer on.

``likeness`` is the share of agreeing samples, octaves weighed by the steps they stand for up to the
end of the longer walk; samples beyond the end of one walk disagree. ``bands`` groups samples of the
last octaves into keys, for candidates among many fingerprints, and ``near_pairs`` verifies them.

All texts of a batch walk in lockstep (one array operation per step for thousands of texts), in
groups of about ``GROUP`` characters.

Cases: null text is the empty text; the empty text's fingerprint is empty, and two empty ones have
likeness 1; equal texts have equal fingerprints; very long texts walk to their end; rows that share
an id are neighbours in the order of their text's hash; with one row the next document is itself;
null ids come last in falling order; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import partitions
from marquee.llm.ngrams import code_points

SAMPLES = 32
GRAM = 3
SEED = 5
GROUP = 8 << 20  # characters that walk together
PAD = 32  # characters a walk may overrun before its end is noticed
FIRST = 4  # the first octave, [0, 2**FIRST)
CLASSES = 64
BUCKET_BYTES = 24 << 20
BAND = 4


@lru_cache(maxsize=1)
def sampled_steps(limit_bits: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(steps, octave of each), rising."""
    random = np.random.default_rng(SEED)
    steps, octaves = [], []
    for octave in range(FIRST, limit_bits):
        low, high = (0 if octave == FIRST else 1 << (octave - 1)), 1 << octave
        size = min(SAMPLES, high - low)
        # one from each equal part of the octave
        edges = low + (np.arange(size + 1) * (high - low)) // size
        picks = edges[:-1] + (random.random(size) * (edges[1:] - edges[:-1])).astype(np.int64)
        steps.append(picks)
        octaves.append(np.full(size, octave))
    return np.concatenate(steps), np.concatenate(octaves)


def moves(block: int) -> np.ndarray:
    """Random bits for 4096 steps by character class; block ``n`` serves steps 4096 n and on."""
    return np.random.default_rng((SEED, block)).integers(0, 2, (4096, CLASSES), dtype=np.int64)


def fingerprints(texts: list[str]) -> list[bytes]:
    """One byte string per text, as long as the octaves its walk reached."""
    out: list[bytes] = [b""] * len(texts)
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= GROUP):
            size += len(texts[end])
            end += 1
        out[at:end] = _walk(texts[at:end])
        at = end
    return out


def _walk(texts: list[str]) -> list[bytes]:
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    order = order[: np.count_nonzero(lengths)]
    out = [b""] * len(texts)
    if not len(order):
        return out
    points = [code_points(texts[i]) for i in order]
    joined = np.concatenate([*points, np.zeros(PAD, "<u4")])
    hashed = joined * np.uint32(0x9E3779B1)
    kind = (hashed >> np.uint32(26)).astype(np.uint8)  # CLASSES classes of characters
    gram = hashed[: len(joined) - GRAM].copy()
    for i in range(1, GRAM):
        gram = (gram ^ hashed[i : i + len(gram)]) * np.uint32(0x85EBCA6B)
        gram ^= gram >> np.uint32(13)
    symbol = (gram >> np.uint32(24)).astype(np.uint8)
    ends = np.cumsum([len(p) for p in points])
    # runs of characters that cross the end of a text depend on that text alone
    for p, end in zip(points, ends, strict=True):
        for back in range(1, min(GRAM, len(p) + 1)):
            tail = p[len(p) - back :] * np.uint32(0x9E3779B1)
            value = tail[0]
            with np.errstate(over="ignore"):
                for i in range(1, GRAM):
                    value = (value ^ (tail[i] if i < back else np.uint32(0))) * np.uint32(0x85EBCA6B)
                    value ^= value >> np.uint32(13)
            symbol[end - back] = value >> np.uint32(24)
    del joined, hashed, gram
    steps, _ = sampled_steps()
    walking = np.arange(len(order))
    here = (ends - np.array([len(p) for p in points])).astype(np.int64)
    stop = ends.astype(np.int64)
    step, sample = 0, 0
    kept: list[tuple[np.ndarray, np.ndarray]] = []  # per sample: who still walks, what it reads
    while len(walking):
        for bits in moves(step >> 12):
            due = step == steps[sample]
            if due or not step & 15:  # walks past their end go on harmlessly for a few steps
                still = here < stop
                if not still.all():
                    walking, here, stop = walking[still], here[still], stop[still]
                    if not len(walking):
                        break
                if due:
                    kept.append((walking, symbol[here]))
                    sample += 1
            here += bits[kind[here]]
            step += 1
    matrix = np.zeros((len(order), len(kept)), np.uint8)
    reach = np.zeros(len(order), np.int64)
    for column, (who, what) in enumerate(kept):
        matrix[who, column] = what
        reach[who] = column + 1
    for row, index in enumerate(order):
        out[index] = matrix[row, : reach[row]].tobytes()
    return out


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: the part of the longer walk on which both read the same characters."""
    if a == b:
        return 1.0
    size = max(len(a), len(b))
    steps, octaves = sampled_steps()
    octaves = octaves[:size]
    same = np.zeros(size, bool)
    least = min(len(a), len(b))
    same[:least] = np.frombuffer(a[:least], np.uint8) == np.frombuffer(b[:least], np.uint8)
    width = np.where(octaves == FIRST, 1 << FIRST, 1 << (octaves - 1)) / np.where(
        octaves == FIRST, min(SAMPLES, 1 << FIRST), np.minimum(SAMPLES, 1 << (octaves - 1))
    )
    return float((width * same).sum() / width.sum())


def bands(mark: bytes) -> list[str]:
    """Keys of groups of sampled positions: ``BAND`` samples spread over the last full octaves.

    Texts of like length that differ in few samples share a key, whatever the position of the edit.
    """
    per = SAMPLES // BAND
    whole = len(mark) // SAMPLES * SAMPLES
    keys = []
    for low in range(max(0, whole - 2 * SAMPLES), whole, SAMPLES):
        part = mark[low : low + SAMPLES]
        keys += [f"{low}:{i}:{part[i::per].hex()}" for i in range(per)]
    return keys or [f"short:{mark.hex()}"]


def near_pairs(marks: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, likeness): fingerprints (column ``fingerprint``) verified at the threshold against the
    smallest of a bucket of theirs. Equal fingerprints are one; buckets of any size give a pair per
    member."""
    distinct = marks.select("fingerprint").distinct()
    keyed = distinct.select(
        "fingerprint",
        F.explode(F.udf(lambda m: bands(bytes.fromhex(m)), "array<string>")("fingerprint")).alias("key"),
    )
    least = keyed.groupBy("key").agg(F.min("fingerprint").alias("a"))
    pairs = keyed.join(least, "key").where("a != fingerprint")
    pairs = pairs.select("a", F.col("fingerprint").alias("b")).distinct()
    alike = F.udf(lambda a, b: likeness(bytes.fromhex(a), bytes.fromhex(b)), "double")
    return pairs.withColumn("likeness", alike("a", "b")).where(F.col("likeness") >= threshold)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compared(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness (the query's contract).

    Ids are cut at exact ids of the table into ranges of about ``BUCKET_BYTES`` of text, so each
    range is sorted by itself; the rows at a cut are also sent to the range above as its last
    neighbour. Texts are shuffled once.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total, lowest, highest = texts.agg(
        F.sum(F.octet_length("text")), F.min("doc_id"), F.max("doc_id")
    ).first()
    spark = documents.sparkSession
    if lowest is None:
        highest = lowest = -1
    count = max(partitions(spark), int((total or 0) / BUCKET_BYTES) + 1)
    shares = [i / count for i in range(1, count)]
    cuts = []
    if shares:
        found = texts.agg(F.percentile_approx("doc_id", shares, 100 * count)).first()[0] or []
        cuts = sorted({c for c in found if c < highest})
    # bucket 0 has the highest ids; a row at a cut is the first of its bucket in falling order
    falling = cuts[::-1]
    at = F.array(*[F.lit(c).cast("long") for c in falling]) if falling else F.array().cast("array<long>")
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    bucket = F.size(F.filter(at, lambda c: c >= key))
    last = len(falling)
    rows = texts.withColumn("bucket", bucket)
    own = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    above = F.struct((F.col("bucket") - 1).alias("bucket"), F.lit(True).alias("guest"))
    wrap = F.struct(F.lit(last).alias("bucket"), F.lit(True).alias("guest"))
    top = F.col("doc_id") == highest if highest != -1 or lowest != -1 else F.lit(True)
    places = F.array_compact(
        F.array(
            own,
            F.when(F.array_contains(at, F.col("doc_id")), above),
            F.when(F.coalesce(top, F.lit(False)), wrap),
        )
    )
    sent = rows.withColumn("place", F.explode(places)).select(
        F.col("place.bucket").alias("bucket"), F.col("place.guest").alias("guest"), "doc_id", "text"
    )
    dealt = sent.repartition(max(count, 1), "bucket").sortWithinPartitions(
        "bucket", "guest", F.desc_nulls_last("doc_id"), F.md5("text")
    )
    return dealt.mapInArrow(_rows, FIELDS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted buckets, each with the next row; a bucket's guests give its last neighbour."""
    waiting = None  # the last own row of a bucket, until its neighbour comes
    pairs: list[tuple] = []
    size = 0
    for batch in batches:
        for bucket, guest, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if waiting and waiting[0] == bucket:
                pairs.append((waiting[1], waiting[2], text))
                size += len(waiting[2])
                waiting = None
            elif waiting:  # no neighbour but itself
                pairs.append((waiting[1], waiting[2], waiting[2]))
                waiting = None
            if not guest:
                waiting = (bucket, doc, text)
            if size >= GROUP // 2:
                yield _compare(pairs)
                pairs, size = [], 0
    if waiting:
        pairs.append((waiting[1], waiting[2], waiting[2]))
    if pairs:
        yield _compare(pairs)


def _compare(pairs: list[tuple]) -> pa.RecordBatch:
    """Rows of (id, text, next text): neighbours in the list share fingerprints."""
    changed = [edited(text, following) for _, text, following in pairs]
    every = list(dict.fromkeys([*(p[1] for p in pairs), *(p[2] for p in pairs), *changed]))
    marks = dict(zip(every, fingerprints(every), strict=True))
    ids, sizes, shas, own, other, near, nearer = [], [], [], [], [], [], []
    for (doc, text, following), new in zip(pairs, changed, strict=True):
        a, b = marks[text], marks[new]
        ids.append(doc)
        sizes.append(len(text))
        shas.append(hashlib.sha256(new.encode()).hexdigest())
        own.append(a.hex())
        other.append(b.hex())
        near.append(likeness(a, b))
        nearer.append(likeness(a, marks[following]))
    return pa.record_batch(
        [
            pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()),
            pa.array(own, pa.string()), pa.array(other, pa.string()),
            pa.array(near, pa.float64()), pa.array(nearer, pa.float64()),
        ],
        names=[f.split()[0] for f in FIELDS.split(", ")],
    )
