"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash of its id and never changes. Bytes and rows are summed per slot, and the
map from slots to shards, a table of ``SLOTS`` rows, is all that rebalancing edits: each shard keeps
its largest slots up to the mean, the others go, largest first, to the shard with the least. Maps
are stored by version; a version is never rewritten. ``grow`` edits a map for one more shard by
giving up slots to it alone.

Everything is DataFrame expressions. Tables with one row per slot are the only ones that meet in one
task, and their size is fixed.

Cases: null text counts 16 bytes and hashes as no bytes; a null id takes its slot from the text's
checksum; repeated rows share a slot and have places of their own; an empty table gives no rows;
a single slot above the mean stays whole on one shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import md5_fraction

SLOTS = 8192
SHARDS = 40
OVERHEAD = 16


def slot_of(doc_id: Column, checksum: Column, slots: int = SLOTS) -> Column:
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("n"), checksum.cast("string")))
    return F.floor(md5_fraction(F.lit("slot"), name) * slots).cast("int")


def records(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot): what sharding needs of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = documents.select(
        "doc_id",
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return thin.withColumn(
        "virtual_slot", slot_of(F.col("doc_id"), F.col("text_crc32"), slots)
    )


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, shard): slots dealt out in turn."""
    slot = F.col("id").cast("int")
    return spark.range(0, slots, 1, 1).select(
        slot.alias("virtual_slot"), (slot % shards).cast("int").alias("shard")
    )


def loads(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes, rows) of every slot, empty ones too."""
    used = rows.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")
    )
    every = rows.sparkSession.range(0, slots, 1, 1).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(used, "virtual_slot", "left").na.fill(0, ["bytes", "rows"])


def rebalanced(old: DataFrame, load: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The map edited so that bytes per shard are nearly equal; slots move only where they must."""
    have = old.join(load.select("virtual_slot", "bytes"), "virtual_slot")
    order = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    running = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))
    mean = F.sum("bytes").over(Window.partitionBy()) / shards
    placed = have.select("*", ((F.col("bytes") == 0) | (running <= mean)).alias("stays"))
    kept = F.array(*[
        F.coalesce(F.sum(F.when(F.col("stays") & (F.col("shard") == s), F.col("bytes"))), F.lit(0))
        for s in range(shards)
    ])
    moving = F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("less"), "virtual_slot")))
    state = placed.agg(kept.alias("kept"), F.array_sort(moving).alias("moving"))  # fixed size

    def place(at: Column, slot: Column) -> Column:
        least = F.array_position(at["kept"], F.array_min(at["kept"])).cast("int") - 1
        return F.struct(
            F.transform(
                at["kept"], lambda v, i: F.when(i == least, v - slot["less"]).otherwise(v)
            ).alias("kept"),
            F.concat(at["to"], F.array(least)).alias("to"),
        )

    start = F.struct(F.col("kept"), F.array().cast("array<int>").alias("to"))
    done = state.select("moving", F.aggregate("moving", start, place)["to"].alias("to"))
    moved = done.select(F.explode(F.arrays_zip("moving", "to")).alias("m")).select(
        F.col("m.moving.virtual_slot").alias("virtual_slot"), F.col("m.to").alias("shard")
    )
    return placed.where("stays").select("virtual_slot", "shard").union(moved)


def grow(old: DataFrame, load: DataFrame, shards: int) -> DataFrame:
    """The map for ``shards`` + 1: every shard gives up slots of about a 1 / (shards + 1) share."""
    have = old.join(load.select("virtual_slot", "bytes"), "virtual_slot")
    order = Window.partitionBy("shard").orderBy("bytes", "virtual_slot")
    running = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))
    share = F.sum("bytes").over(Window.partitionBy()) / (shards * (shards + 1))
    goes = (F.col("bytes") > 0) & (running <= share)
    return have.select(
        "virtual_slot", F.when(goes, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard")
    )


def write_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Store a version; one that exists is never overwritten."""
    slot_map.coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(virtual_slot, shard, version) of a version, the latest one by default."""
    versions = spark.read.parquet(path)
    wanted = versions.agg(F.max("version")).first()[0] if version is None else version
    return versions.where(F.col("version") == wanted).select("virtual_slot", "shard", "version")


def sharded(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Each record's shard and its place there, gapless from 0.

    The place is the rows of the shard in slots before plus the number within the slot, so no shard
    is sorted as a whole.
    """
    counts = slot_map.join(rows.groupBy("virtual_slot").agg(F.count("*").alias("n")), "virtual_slot", "left")
    order = Window.partitionBy("shard").orderBy("virtual_slot")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("virtual_slot", "shard", "version", before.alias("before"))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("number", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(starts), "virtual_slot").select(  # one row per slot
        "doc_id", "size", "text_crc32", "shard",
        (F.col("before") + F.col("number")).cast("long").alias("slot"),
        "virtual_slot", F.col("version").alias("map_version"),
    )
