"""Fill-in-middle transformation of whole texts, cut at line ends that are found in 64-bit words.

The UTF-8 bytes of a block of texts are one array of 64-bit words. Arithmetic on whole words marks
every byte that ends a line; the marks of each word are counted (``bitwise_count``) and summed up,
so that

* the lines before a byte are a sum plus the count of a masked word (``before``), and
* the k-th line end is found by binary search of the sums for its word, then by byte-wise prefix
  sums inside the word, again without a loop (``after``).

The same counts over bytes that begin a code point give lengths in code points. All documents of a
block are cut at once. A text of n lines (a last line needs no line end) is cut after two line
counts that its id decides, and its parts are written in one of two orders between sentinels.

Cases: a null or empty text is ``plain`` with no lines and empty output, and so is a text that holds
a sentinel, as it stands, since it could not be taken apart again. Parts may be empty. Texts of any
length are cut whole; a task holds a block of about ``BLOCK_BYTES`` or one text. A null id draws as
an empty one does. Repeated rows each give their row, an empty table none; extra columns are ignored,
clashing names included.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import spread

SENTINELS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix, the middle
LINE_END = 0x0A
SEED = "7"
BLOCK_BYTES = 1 << 24  # text that a task marks at once, or one text if it is longer

ONES = np.uint64(0x0101010101010101)
LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
HIGH = np.uint64(0x8080808080808080)

OUT = "doc_id long, n long, form string, output string, prefix_chars long, middle_chars long"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("output", pa.string()),
     ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
)


def words(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, filled up with zero bytes and one more word of them."""
    padded = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def equal_to(word: np.ndarray, byte: int) -> np.ndarray:
    """The high bit of every byte that equals ``byte``, without carries between bytes."""
    other = word ^ (ONES * np.uint64(byte))
    return ~(((other & LOW) + LOW) | other | LOW)


def begins(word: np.ndarray) -> np.ndarray:
    """The high bit of every byte that begins a code point, that is, is not 10xxxxxx."""
    return ~(word & ~(word << np.uint64(1))) & HIGH


class Marks:
    """Counts of and places after marked bytes."""

    def __init__(self, marked: np.ndarray):
        self.marked = marked
        self.total = np.cumsum(np.bitwise_count(marked), dtype=np.int64)

    def before(self, at: np.ndarray) -> np.ndarray:
        """How many of the bytes before ``at`` are marked."""
        word, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        here = self.marked[word]
        inside = np.bitwise_count(here & ((np.uint64(1) << bits) - np.uint64(1)))
        return self.total[word] - np.bitwise_count(here) + inside

    def after(self, count: np.ndarray) -> np.ndarray:
        """The place right after the ``count``-th marked byte, counted from 1."""
        word = np.searchsorted(self.total, count)
        here = self.marked[word]
        wanted = (count - self.total[word] + np.bitwise_count(here)).astype(np.uint64)
        running = (here >> np.uint64(7)) * ONES  # byte i: marks up to byte i
        reached = ((running | HIGH) - wanted * ONES) & HIGH
        return (word << 3) + 9 - np.bitwise_count(reached).astype(np.int64)


def cuts(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray
) -> tuple[np.ndarray, ...]:
    """(lines, place a, place b, code points before a, code points from a to b) for each text.

    Text i is ``data[starts[i]:ends[i]]``; it is cut after ``first % (lines + 1)`` and
    ``second % (lines + 1)`` lines, the smaller one first.
    """
    word = words(data)
    lines, chars = Marks(equal_to(word, LINE_END)), Marks(begins(word))
    earlier = lines.before(starts)
    closed = lines.before(ends) - earlier
    tail = (ends > starts) & (np.append(data, 0)[ends - 1] != LINE_END)
    count = closed + tail
    draws = np.stack([first % (count + 1), second % (count + 1)])
    places = []
    for units in (draws.min(axis=0), draws.max(axis=0)):
        at = np.where(units > closed, ends, starts)
        ended = (units > 0) & (units <= closed)
        at[ended] = lines.after((earlier + units)[ended])
        places.append(at)
    at_a, at_b = (chars.before(at) for at in places)
    return count, *places, at_a - chars.before(starts), at_b - at_a


def transformed(
    documents: DataFrame,
    rate: int = 100,
    spm_share: int = 50,
    sentinels: tuple[str, str, str] = SENTINELS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars) of every document.

    ``rate`` and ``spm_share`` are per cent: texts that are transformed at all, and those of them in
    the order suffix, prefix, middle (``spm``) instead of prefix, suffix, middle (``psm``). Draws
    come from a hash of the seed and the id alone, so every run gives the same.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = spread(documents.select("doc_id", "text")).withColumn("digest", digest)
    for at in range(4):
        part = F.substring("digest", 8 * at + 1, 8)
        rows = rows.withColumn(f"h{at + 1}", F.conv(part, 16, 10).cast("long"))
    before_prefix, before_suffix, before_middle = (s.encode() for s in sentinels)

    def block(part: pa.RecordBatch) -> pa.RecordBatch:
        text = pc.fill_null(part.column("text"), "").cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        buffer = text.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        data = data[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        h = [part.column(f"h{i}").to_numpy() for i in range(1, 5)]
        count, a, b, prefix, middle = cuts(data, offsets[:-1], offsets[1:], h[0], h[1])
        plain = (offsets[1:] == offsets[:-1]) | (h[2] % 100 >= rate)
        for sentinel in sentinels:
            plain |= pc.match_substring(text, sentinel).to_numpy(zero_copy_only=False)
        form = np.where(plain, "plain", np.where(h[3] % 100 < spm_share, "spm", "psm"))
        whole = memoryview(data)
        out = []
        for kind, at, p, s, end in zip(
            form.tolist(), offsets[:-1].tolist(), a.tolist(), b.tolist(), offsets[1:].tolist(), strict=True
        ):
            if kind == "plain":
                out.append(bytes(whole[at:end]))
                continue
            first, second = (before_prefix, whole[at:p]), (before_suffix, whole[s:end])
            if kind == "spm":
                first, second = second, first
            out.append(b"".join((*first, *second, before_middle, whole[p:s])))
        return pa.record_batch([
            part.column("doc_id").cast(pa.int64()), pa.array(count), pa.array(form.tolist(), pa.string()),
            pa.array(out, pa.binary()).cast(pa.string()), pa.array(prefix, mask=plain),
            pa.array(middle, mask=plain),
        ], schema=ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
            held = np.cumsum(sizes) // BLOCK_BYTES
            edges = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(held)]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if end > start:
                    yield block(batch.slice(start, end - start))

    return rows.drop("digest").mapInArrow(run, OUT)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text that was transformed, from its output and form.

    The text holds no sentinel, so the output is taken apart at the three that were put in.
    """
    parts = F.split(output, "|".join(re.escape(s) for s in sentinels), -1)
    prefix = F.when(form == "psm", F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(2)))
    suffix = F.when(form == "psm", F.get(parts, F.lit(2))).otherwise(F.get(parts, F.lit(1)))
    whole = F.concat(prefix, F.get(parts, F.lit(3)), suffix)
    return F.when(form == "plain", output).otherwise(whole)


def digests(out: DataFrame) -> DataFrame:
    """The columns of ``transformed`` with hashes in place of the texts."""
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
