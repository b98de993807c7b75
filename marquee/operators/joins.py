"""Joins of a large table with one that is usually small, safe for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
PIECES = 8  # a heavy key is cut into pieces of a mean task's rows over this


def measured_bytes(table: DataFrame) -> int:
    """Size of a table as text: one aggregate over it."""
    size = table.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    return size or 0


def heavy_keys(table: DataFrame, key: str, tasks: int) -> DataFrame:
    """(key, _pieces): keys with more rows than a mean task, and into how many pieces each is cut.

    One aggregate over the keys alone. There are fewer such keys than tasks, so the result is bounded
    by them whatever the table.
    """
    counts = table.groupBy(key).agg(F.count("*").alias("_n"))
    mean = max((counts.agg(F.sum("_n")).first()[0] or 0) / tasks, 1.0)
    return counts.filter(F.col("_n") > mean).select(
        key, F.ceil(F.col("_n") * PIECES / F.lit(mean)).cast("long").alias("_pieces")
    )


def join_small(
    large: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    *,
    spread_by: str,
    limit: int = BROADCAST_BYTES,
    measure: DataFrame | None = None,
) -> DataFrame:
    """``large`` joined with ``small``, each row of ``large`` staying in its task while it can.

    The small side is measured (or ``measure``, a cheaper stand-in) and broadcast below ``limit``.
    Above it both sides are shuffled. Keys that hold more rows of ``large`` than a mean task are cut
    into pieces by the value of ``spread_by``, in proportion to their share, and the rows of ``small``
    with such a key are repeated for each piece; all other keys stay whole.
    """
    if measured_bytes(small if measure is None else measure) <= limit:
        return large.join(F.broadcast(small), key, how)
    tasks = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(large.filter(F.col(key).isNotNull()), key, tasks)

    def cut(table: DataFrame, piece: Column) -> DataFrame:
        # fewer rows than tasks: see heavy_keys
        return table.join(F.broadcast(heavy), key, "left").withColumn("_piece", piece).drop("_pieces")

    # a row without a key meets nothing and may lie anywhere
    pieces = F.when(F.col(key).isNull(), F.lit(tasks * PIECES)).otherwise(F.coalesce("_pieces", F.lit(1)))
    own = F.pmod(F.xxhash64(spread_by), pieces)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1).cast("long")) - 1))
    return cut(large, own).join(cut(small, every), [key, "_piece"], how).drop("_piece")
