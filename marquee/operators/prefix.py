"""Joining URLs to the sources whose base URL they start with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.joins import join_small

SITE = r"\A([^/?#]*//[^/?#]*)"


def _site(url: Column, closed: bool) -> Column:
    """Scheme and host of a URL; of a prefix only where something after it says that it is whole."""
    return F.regexp_extract(url, SITE + ("[/?#]" if closed else ""), 1)


def first_prefix_match(
    urls: DataFrame, sources: DataFrame, prefix: str = "base_url", order: str = "row_no"
) -> DataFrame:
    """Each distinct URL with the first source in registry order whose prefix it starts with.

    A URL is cut to the lengths that prefixes of its own site have (and those few that end inside a
    host name), so the match is a plain equality join and no pair is formed that does not match.
    Only the number of the first source goes through the aggregate; ``order`` is unique.
    """
    columns = [name for name in sources.columns if name != order]
    known = sources.filter(F.length(prefix) >= 0)
    closed = _site(F.col(prefix), closed=True)
    firsts = known.groupBy(prefix).agg(F.min(order).alias("_order"))
    # at most as many lengths of a site as its longest prefix has characters
    some = F.collect_set(F.length(prefix)).alias("_lengths")
    lengths = known.filter(closed != "").groupBy(closed.alias("_site")).agg(some)
    everywhere = known.filter(closed == "").agg(some).scalar()
    distinct = urls.select("url").distinct()
    sited = join_small(
        distinct.withColumn("_site", _site(F.col("url"), closed=False)),
        lengths, "_site", "left", spread_by="url", measure=sources,
    )
    own = F.coalesce("_lengths", F.array().cast("array<int>"))
    cut = (
        sited.withColumn("_open", everywhere)
        .select("url", F.explode(F.array_union(own, "_open")).alias("_n"))
        .filter(F.col("_n") <= F.length("url"))
        .select("url", F.left("url", F.col("_n")).alias(prefix))
    )
    found = join_small(cut, firsts, prefix, spread_by="url", measure=sources)
    first = found.groupBy("url").agg(F.min("_order").alias("_order"))
    details = known.select(F.col(order).alias("_order"), F.struct(*columns).alias("_source"))
    named = join_small(first, details, "_order", spread_by="url", measure=sources)
    return distinct.join(named, "url", "left").select(
        "url", F.col("_source").isNotNull().alias("matched"),
        *[F.col("_source")[name].alias(name) for name in columns],
    )
