"""The corpus pipeline: language, near-duplicates, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir), calls one operator of ``marquee.llm`` on all its predecessor
kept, and returns a DataFrame that is written as Parquet and reread as the next stage's docs.

* ``language`` drops documents whose language is ``und`` (null text, or no letter);
* ``near_duplicates`` keeps the document with the smallest id of each group;
* ``secrets`` replaces secrets in the texts, keeping every document;
* ``mixture`` repeats or leaves out documents so that sources meet their targets;
* ``packing`` returns pieces in sequences instead of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import mixing, order_minhash, packing, queries, secrets, string_kernel
from marquee.session import checkpoint_dir, ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return string_kernel.recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return order_minhash.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs, secrets.train(secrets.labelled_findings(spark)))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.packed(docs, *queries.vocabulary())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixture", mixture),
    ("packing", pack),
]

#: Learned models, alignments and tokens are beyond SQL; tests/llm holds the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
