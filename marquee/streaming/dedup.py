"""Deduplication of an entity stream with state kept by Structured Streaming.

The exact step passes the first row of a key, which spreads a busy identity over its days; the near
step then keeps, per identity, the set of kept days.

Nearly every row has a key of its own, so the exact step makes no call to the state store from Python:
the rows of a micro-batch are reduced to the first of each key, and Spark's own streaming
deduplication remembers the keys. In memory are the new keys of one task in one micro-batch: give
more shuffle partitions to micro-batches of a billion rows.

Both states have an end: an entry that no row has touched for ``ttl_ms`` is forgotten, by the clock of
the stream's arrivals and not by dates in the rows. So no row is lost for being late, as it would be
behind a watermark; what is let in again is a duplicate that comes later than that. Without
``ttl_ms`` nothing is forgotten. A stream with ``ttl_ms`` runs until it is stopped, as time goes on
without rows too: give it a trigger by time, not one that ends when the input does. Spark's
deduplication has no such end, so with ``ttl_ms`` each key of the exact step costs two calls.

Keys of state that Python reads are dealt over ``buckets``, and a bucket is what Spark hands to
Python: a call, a frame in and a frame out cost milliseconds each, which one key with its few rows
would pay alone. State is still read and written by key, so a micro-batch touches the keys it holds
and no others. A checkpoint goes on with the number it was begun with, and one begun when the exact
step had state in buckets without ``ttl_ms`` too is begun anew.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marquee.operators.dedup import with_keys

BUCKETS = 1024
REDUCED_AT = 65_536
EXACT_KEY = ["dedup_key", "dated"]


def _place(seq):
    """Arrival order of a row: a number, a text, or a struct of those."""
    return tuple(seq.values()) if isinstance(seq, dict) else tuple(seq) if isinstance(seq, (tuple, list)) else (seq,)


def _winners(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """Of the rows of each key the first in arrival order; rows without a place in it come last."""
    thin = pa.Table.from_batches([batch.select([*EXACT_KEY, "seq"]) for batch in batches])
    seq = thin.column("seq")
    parts = seq.flatten() if pa.types.is_struct(seq.type) else [seq]
    places = pa.table(parts, names=[str(number) for number in range(len(parts))])
    order = pc.sort_indices(places, sort_keys=[(name, "ascending") for name in places.column_names]).to_numpy()
    rank = np.empty(thin.num_rows, np.int64)
    rank[order] = np.arange(thin.num_rows)
    keyed = thin.select(EXACT_KEY).append_column("rank", pa.array(rank))
    won = np.zeros(thin.num_rows, bool)
    won[order[keyed.group_by(EXACT_KEY).aggregate([("rank", "min")])["rank_min"].to_numpy()]] = True
    ends = np.cumsum([batch.num_rows for batch in batches])
    chosen = (batch.filter(pa.array(mine)) for batch, mine in zip(batches, np.split(won, ends[:-1]), strict=True))
    return [batch for batch in chosen if batch.num_rows]


def _first_of_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each key in the rows of a task.

    In memory are at most twice as many rows as there are keys, or ``REDUCED_AT``.
    """
    held, rows, most = [], 0, REDUCED_AT
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > most:
            held = _winners(held)
            rows = sum(batch.num_rows for batch in held)
            most = max(REDUCED_AT, 2 * rows)
    if rows:
        yield from _winners(held)


class _FirstOfKey(StatefulProcessor):
    """Passes the rows of a bucket, one a key, whose key has passed none yet."""

    def __init__(self, ttl_ms: int) -> None:
        self._ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        key = T.StructType([T.StructField("dedup_key", T.StringType()), T.StructField("dated", T.BooleanType())])
        mark = T.StructType([T.StructField("passed", T.BooleanType())])
        self._passed = handle.getMapState("passed_keys", key, mark, self._ttl)

    def _known(self, key: tuple) -> bool:
        known = self._passed.containsKey(key)
        self._passed.updateValue(key, (True,))  # a key that comes again is remembered on
        return known

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            keys = zip(*(chunk[name] for name in EXACT_KEY), strict=True)
            yield chunk[np.array([not self._known(key) for key in keys], bool)]

    def close(self) -> None:
        pass


class _KeptDays(StatefulProcessor):
    """Keeps a row when no kept day of its identity is the same day or one next to it.

    The kept days of an identity lie in spans of days, so a row touches two of them at most and most
    rows of an identity touch the same.
    """

    SPAN = 64

    def __init__(self, ttl_ms: int | None) -> None:
        self._ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        span = T.StructType([T.StructField("identity", T.StringType()), T.StructField("span", T.LongType())])
        days = T.StructType([
            T.StructField("days", T.ArrayType(T.LongType())), T.StructField("kept_at", T.ArrayType(T.LongType()))
        ])
        self._kept = handle.getMapState("kept_spans", span, days, self._ttl)

    def _days(self, span: tuple, now: int) -> dict[int, int]:
        """Kept days of a span, with the time they were kept at; a span is as old as its last day."""
        found = self._kept.getValue(span) if self._kept.containsKey(span) else None
        days = {} if found is None else dict(zip(found[0], found[1], strict=True))
        return days if self._ttl is None else {day: at for day, at in days.items() if at + self._ttl > now}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # the exact step leaves two rows per identity and day at most, so the bucket is small
        batch = pd.concat(list(rows), ignore_index=True)
        now = 0 if self._ttl is None else timerValues.getCurrentProcessingTimeInMs()
        places: dict[str, list[tuple]] = {}
        columns = (batch[name] for name in ("identity", "seq", "day", "dated"))
        for at, (identity, seq, day, dated) in enumerate(zip(*columns, strict=True)):
            places.setdefault(identity, []).append((_place(seq), at, day, dated))
        chosen = []
        for identity, arrivals in places.items():
            spans, changed = {}, set()
            for _, at, day, dated in sorted(arrivals, key=lambda arrival: arrival[0]):
                if pd.isna(day):  # text that is no date: its own key decides
                    chosen.append(at)
                    continue
                day = int(day)
                near = (day, day - 1, day + 1) if dated else (day,)
                for span in {d // self.SPAN for d in near} - spans.keys():
                    spans[span] = self._days((identity, span), now)
                if not any(d in spans[d // self.SPAN] for d in near):
                    spans[day // self.SPAN][day] = now
                    changed.add(day // self.SPAN)
                    chosen.append(at)
            for span in changed:
                self._kept.updateValue((identity, span), (list(spans[span]), list(spans[span].values())))
        yield batch.iloc[chosen]

    def close(self) -> None:
        pass


def _sent_by_value() -> None:
    """The process that sets the state up on the driver cannot import this package: send what it needs."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _stateful(
    entities: DataFrame, keys: list[str], processor: StatefulProcessor, ttl_ms: int | None, buckets: int
) -> DataFrame:
    _sent_by_value()
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("state_bucket")
    return entities.select("*", bucket).groupBy("state_bucket").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=entities.schema,
        outputMode="Append",
        timeMode="None" if ttl_ms is None else "ProcessingTime",
    )


def exact_stream(entities: DataFrame, ttl_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """First row per deduplication key, however late it comes.

    Spark's deduplication passes any row of a key of a micro-batch, so it is given one.
    """
    _sent_by_value()
    keyed = with_keys(entities)
    first = keyed.repartition(*EXACT_KEY).mapInArrow(_first_of_key, keyed.schema)
    if ttl_ms is None:
        return first.dropDuplicates(EXACT_KEY)
    return _stateful(first, EXACT_KEY, _FirstOfKey(ttl_ms), ttl_ms, buckets)


def near_stream(entities: DataFrame, ttl_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows of an entity stream that duplicate no earlier row, with their key columns.

    Arrival order is the order of micro-batches, and of ``seq`` (a number, a text, or a struct)
    within one. Use `incremental.dedup_batch` where copies of a row in one micro-batch may come in
    great numbers: it reduces them before the shuffle.
    """
    return _stateful(exact_stream(entities, ttl_ms, buckets), ["identity"], _KeptDays(ttl_ms), ttl_ms, buckets)
