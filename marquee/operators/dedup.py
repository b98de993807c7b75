"""Exact and one-day-apart duplicates.

Rows are taken in arrival order (``seq``). A row is a duplicate when its key was kept before, or
when a row with the same identity one calendar day earlier or later was kept before. A row without
a date only compares its own key.

The rule is order-dependent, but it needs no fold over a group. Per identity the first row of each
day decides for its day, and a day only depends on neighbours that arrived earlier. Walking from a
day towards ever earlier arrivals on one side ends at a day that is certainly kept, and kept and
dropped days alternate on the way. So a day is kept exactly when that walk has even length on both
sides, which two running windows count. The windows see one row per identity and day, whatever
number of copies there are: copies are reduced on the map side before the first shuffle, and a
group can never exceed the number of calendar days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.binding import computed
from marquee.functions.keys import key_parts

KEY_COLUMNS = ["dedup_key", "identity", "day", "dated"]


def with_keys(entities: DataFrame) -> DataFrame:
    """Add dedup_key, identity, day and dated; rows that have all four keep them."""
    if set(KEY_COLUMNS) <= set(entities.columns):
        return entities
    return (
        computed(entities, {"_key": key_parts()})
        .withColumns({name: F.col("_key")[name] for name in KEY_COLUMNS})
        .drop("_key")
    )


def first_per_key(entities: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """First arrival per key. The rank filter runs before the shuffle as well as after it."""
    order = Window.partitionBy(*keys).orderBy(seq)
    return (
        entities.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def exact_dedup(entities: DataFrame, seq: str = "seq") -> DataFrame:
    """First arrival per deduplication key."""
    return first_per_key(with_keys(entities), ["dedup_key"], seq)


def _walk(order: Window, step: int) -> Column:
    """Length of the walk towards earlier arrivals on one side."""

    def beside(name: str) -> Column:
        return F.lag(name).over(order)

    touching = F.coalesce(beside("day") == F.col("day") + step, F.lit(False))
    # a neighbour kept whatever its own neighbours are ends the walk one step away
    certain = touching & (
        F.coalesce(beside("held"), F.lit(False))
        | F.coalesce(beside("undated_seq") < F.col("dated_seq"), F.lit(False))
    )
    goes_on = touching & ~certain & F.coalesce(
        beside("dated_seq") < F.col("dated_seq"), F.lit(False)
    )
    return F.when(~goes_on, certain.cast("int"))


def near_dedup(
    entities: DataFrame, seq: str = "seq", kept_before: DataFrame | None = None
) -> DataFrame:
    """Rows that are no duplicates of an earlier row, with their key columns.

    ``kept_before`` holds (identity, day) of rows kept by earlier batches; they count as arrived
    before everything in ``entities`` and are not returned.

    ``seq`` is unique. Only it and the key's parts go through the windows; what is kept is then a
    list of arrivals, by which the rows themselves are picked.
    """
    keyed = with_keys(entities)
    arrivals = keyed.select("identity", "day", *[
        F.when(dated, F.col(seq)).alias(name)
        for dated, name in ((F.col("dated"), "_d"), (~F.col("dated"), "_u"))
    ], F.lit(False).alias("_held"))
    if kept_before is not None:
        arrivals = arrivals.unionByName(
            kept_before.select("identity", "day", F.lit(True).alias("_held")),
            allowMissingColumns=True,
        )
    days = arrivals.groupBy("identity", "day").agg(
        F.min("_d").alias("dated_seq"), F.min("_u").alias("undated_seq"), F.max("_held").alias("held")
    )
    sides = {
        "left": (Window.partitionBy("identity").orderBy("day"), -1),
        "right": (Window.partitionBy("identity").orderBy(F.desc("day")), 1),
    }
    lengths = {}
    for side, (order, step) in sides.items():
        days = days.withColumns(
            {f"_{side}_end": _walk(order, step), f"_{side}_at": F.row_number().over(order)}
        )
        end = F.when(
            F.col(f"_{side}_end").isNotNull(),
            F.struct(F.col(f"_{side}_at").alias("at"), F.col(f"_{side}_end").alias("steps")),
        )
        days = days.withColumn(
            f"_{side}_from",
            F.last(end, ignorenulls=True).over(
                order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        start = F.col(f"_{side}_from")
        lengths[side] = F.col(f"_{side}_at") - start["at"] + start["steps"]
    undated_first = F.coalesce(F.col("undated_seq") < F.col("dated_seq"), F.lit(False))
    keep_dated = (
        F.col("dated_seq").isNotNull()
        & ~F.col("held")
        & ~undated_first
        & (lengths["left"] % 2 == 0)
        & (lengths["right"] % 2 == 0)
    )
    keep_undated = (
        F.col("undated_seq").isNotNull() & ~F.col("held") & ~(keep_dated & ~undated_first)
    )
    kept = F.array_compact(
        F.array(
            F.when(keep_dated, F.col("dated_seq")), F.when(keep_undated, F.col("undated_seq"))
        )
    )
    chosen = days.select(F.explode(kept).alias(seq))
    return keyed.join(chosen, seq, "left_semi")


def duplicate_counts(entities: DataFrame, kept: DataFrame, by: str = "source_id") -> DataFrame:
    """Rows, kept rows and duplicates per source."""
    seen = entities.groupBy(by).agg(F.count("*").alias("rows_seen"))
    new = kept.groupBy(by).agg(F.count("*").alias("rows_new"))
    return seen.join(new, by, "left").select(
        by,
        "rows_seen",
        F.coalesce("rows_new", F.lit(0)).alias("rows_new"),
        (F.col("rows_seen") - F.coalesce("rows_new", F.lit(0))).alias("duplicates"),
    )
