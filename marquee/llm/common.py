"""What the operators share: written intermediate tables, grouped streaming, row fillers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import checkpoint_dir, ship_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(frame: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: lineage ends here, and a lost executor
    costs only the tasks of later steps."""
    spark = frame.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Tasks for a shuffle whose per-row work is heavy, so that small bytes are not coalesced."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )


def spread(scan: DataFrame) -> DataFrame:
    """Deal a small table out over all cores when its files give fewer tasks than a quarter of
    them; larger tables are left as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * 4 <= cores else scan


def map_groups(
    frame: DataFrame,
    keys: list[str],
    apply: Callable[[pd.DataFrame], Iterable[pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """``apply`` for the rows of each key (keys must not be null), one group in memory at a time.

    Like ``applyInPandas`` but streamed through a partition, which is much cheaper for very many
    small groups. Callers bound the size of a group.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            codes = [batch[k].to_numpy() for k in keys]
            change = np.zeros(len(batch), bool)
            for values in codes:
                change[1:] |= values[1:] != values[:-1]
            starts = [0, *np.flatnonzero(change), len(batch)]
            for at, end in zip(starts[:-1], starts[1:], strict=True):
                key = tuple(values[at] for values in codes)
                if key != last and held:
                    yield from apply(pd.concat(held, ignore_index=True))
                    held = []
                last = key
                held.append(batch.iloc[at:end])
        if held:
            yield from apply(pd.concat(held, ignore_index=True))

    dealt = frame.repartition(partitions(frame.sparkSession), *keys)
    return dealt.sortWithinPartitions(*keys).mapInPandas(run, schema)


def md5_fraction(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 8 hex digits of an md5, the same in any SQL engine."""
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_columns(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For a stage from documents to documents: further columns, whatever their names, travel in one
    column of a name drawn for the call and come back as they were."""

    @wraps(stage)
    def run(documents: DataFrame, *args, **options) -> DataFrame:
        own = [name for name in documents.columns if name not in DOCUMENT]
        if not own:
            return stage(documents, *args, **options)
        box = f"box_{uuid.uuid4().hex}"
        boxed = documents.select(
            *[name for name in documents.columns if name in DOCUMENT],
            F.struct(*[F.col(f"`{name}`") for name in own]).alias(box),
        )
        out = stage(boxed, *args, **options)
        return out.select(
            *[
                F.col(f"{box}.`{name}`").alias(name) if name in own else F.col(name)
                for name in documents.columns
            ]
        )

    return run
