"""Mixing sources to target weights by systematic sampling.

Targets: sources weigh ``weights`` in turn by code point (null last) and share the size of the whole
table; none may exceed ``most`` times its source, the excess going to the others by weight until
none is above. That is a water level: sources are capped in order of (cap / weight).

Within a source every document expects the same number of copies, target / size of the source. The
prefix sums of these expectations run over the documents by (size, salt, doc_id); one random offset
per source is added and a document is emitted once per integer boundary its interval crosses. In
order of size the words taken follow the words expected closely, since neighbours are alike.

A document's prefix sum is its rank times the expectation. The rank comes from counts per (source,
size, salt), a running sum over those counts, and a number within the group: a source, or a size
that a third of all rows share, is never sorted as a whole.

Cases: null text has size 0 and is still a document; a source of size 0 has target 0 and takes
nothing; null sources form one source, last; a null doc_id sorts first in its group; repeated rows
are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import keeps_columns, md5_fraction, saved

WEIGHTS = (1, 2, 3)
MOST = 3
SALTS = 256
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> adds weight and target; one row per source."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighed = sources.select("source", "source_size", weight.cast("double").alias("weight"))
    whole = Window.partitionBy()
    by_cap = Window.orderBy("ratio", F.col("source").isNull(), F.col("source").cast("binary"))
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    cap = (most * F.col("source_size")).cast("double")
    level = weighed.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    level = level.select(
        "*",
        F.sum("source_size").over(whole).cast("double").alias("total"),
        F.sum("weight").over(whole).alias("weights"),
        F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)).alias("weight_before"),
    ).withColumn(
        "level",
        (F.col("total") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before")),
    )
    # the water level: what the first source left below its cap gets for each unit of weight
    reached = F.min(F.when(F.col("ratio") > F.col("level"), F.col("ratio"))).over(whole)
    found = F.max(F.when(F.col("ratio") == F.col("reached"), F.col("level"))).over(whole)
    return (
        level.withColumn("reached", reached)
        .withColumn("water", found)
        .select(
            "source",
            "source_size",
            "weight",
            F.when(F.col("ratio") > F.col("water"), F.col("water") * F.col("weight"))
            .otherwise(F.col("cap"))
            .alias("target"),
        )
    )


def copies(documents: DataFrame, seed: str = SEED, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken) for every row of ``documents``.

    ``extra`` names further columns to carry. Copies of a document are at most ceil(``MOST``).
    """
    thin = documents.select("doc_id", "source", size_of(F.col("text")).alias("size"), *extra)
    salt = F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(SALTS)).cast("int")
    thin = thin.withColumn("salt", salt)
    group = ["source", "size", "salt"]
    counts = thin.groupBy(*group).agg(F.count("*").alias("n"))
    counts = saved(counts, "mix-counts")  # at most one row per size and salt of a source
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aimed = targets(sources)
    before = _running(counts)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in group]
    within = Window.partitionBy(*group).orderBy("doc_id")
    numbered = thin.withColumn("number", F.row_number().over(within))
    ranked = numbered.alias("a").join(before.alias("b"), same[0] & same[1] & same[2])
    ranked = ranked.select("a.*", (F.col("b.before") + F.col("a.number")).alias("rank"))
    joined = ranked.alias("a").join(
        aimed.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))
    )
    named = F.concat(F.lit("s"), F.coalesce(F.col("a.source"), F.lit("")))
    named = F.when(F.col("a.source").isNull(), F.lit("n")).otherwise(named)
    offset = md5_fraction(F.lit(seed), named)
    expected = F.when(
        F.col("b.source_size") > 0, F.col("b.target") / F.col("b.source_size").cast("double")
    ).otherwise(F.lit(0.0))
    crossed = F.floor(F.col("a.rank").cast("double") * F.col("expected") + F.col("offset")) - F.floor(
        (F.col("a.rank") - 1).cast("double") * F.col("expected") + F.col("offset")
    )
    return (
        joined.withColumn("expected", expected)
        .withColumn("offset", offset)
        .select(
            *[F.col(f"a.{c}") for c in ("doc_id", "size", "source", *extra)],
            "b.source_size",
            "b.target",
            crossed.cast("long").alias("copies"),
        )
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def _running(counts: DataFrame) -> DataFrame:
    """Rows of the source before each (source, size, salt): first by size, then by salt in a size.

    Two levels keep every window small: sizes of a source, and salts of a size.
    """
    sizes = counts.groupBy("source", "size").agg(F.sum("n").alias("of_size"))
    by_size = Window.partitionBy("source").orderBy("size")
    earlier = F.sum("of_size").over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("source", "size", F.coalesce(earlier, F.lit(0)).alias("smaller"))
    by_salt = Window.partitionBy("source", "size").orderBy("salt")
    before = F.sum("n").over(by_salt.rowsBetween(Window.unboundedPreceding, -1))
    salts = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    return (
        salts.alias("a")
        .join(
            sizes.alias("b"),
            F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size")),
        )
        .select("a.source", "a.size", "a.salt", (F.col("a.before") + F.col("b.smaller")).alias("before"))
    )


@keeps_columns
def mixed(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixture itself: every row of ``documents`` as often as its copies, all columns kept.

    Numbers of copies are decided on thin columns and meet the rows by (doc_id, source, text hash),
    the only shuffle of texts. Rows alike in all three share their copies evenly.
    """
    key = F.md5(F.coalesce(F.col("text"), F.lit("")))
    hashed = documents.select("doc_id", "text", "source", key.alias("_text"))
    per_key = copies(hashed, seed, ("_text",)).groupBy("doc_id", "source", "_text").agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_rows")
    )
    rows = documents.withColumn("_text", key)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("doc_id", "source", "_text")]
    joined = rows.alias("a").join(per_key.alias("b"), same[0] & same[1] & same[2])
    place = F.row_number().over(Window.partitionBy("a.doc_id", "a.source", "a._text").orderBy("a._text"))
    each = F.floor(F.col("_copies") / F.col("_rows")) + F.when(
        place <= F.col("_copies") % F.col("_rows"), 1
    ).otherwise(0)
    counted = joined.select(*[f"a.`{c}`" for c in documents.columns], each.cast("int").alias("_each"))
    return (
        counted.where("_each > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_each"))))
        .drop("_each", "_copy")
    )
