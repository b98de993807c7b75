"""One query per operator over its whole table with production parameters, and SQL where it can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import (
    best_fit,
    edit_embedding,
    fill_middle,
    hard_negatives,
    html_text,
    itq,
    mixing,
    order_minhash,
    packing,
    secrets,
    sharding,
    string_kernel,
    weak_labels,
)
from marquee.llm.common import saved, table
from marquee.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def vocabulary() -> tuple[bytes, str]:
    """The rank file of the byte_bpe_50k vocabulary (same ids as its tokenizer file, whose added
    tokens come with it) and pattern."""
    import public_tokenizers

    return (
        packing.with_added_tokens(
            packing.tokenizer_file(public_tokenizers.path("byte_bpe_50k.tiktoken")),
            packing.tokenizer_file(public_tokenizers.path("byte_bpe_50k.json")),
        ),
        public_tokenizers.PATTERN,
    )


@query
def op1_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), *vocabulary())


@query
def op6_systematic_mixing(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing.copies(table(spark, folder, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op6_systematic_mixing"] = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    CAST(((coalesce(doc_id, 0) % 256) + 256) % 256 AS INTEGER) AS salt
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, CAST(1 + (row_number() OVER (
    ORDER BY source IS NULL, encode(source)) - 1) % 3 AS DOUBLE) AS weight FROM s),
l AS (
  SELECT *, cap / weight AS ratio,
    (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER earlier, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM w WINDOW earlier AS (ORDER BY cap / weight, source IS NULL, encode(source)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (
  SELECT source, source_size, CASE WHEN ratio > water THEN water * weight ELSE cap END AS target
  FROM l, (SELECT max(level) AS water FROM l WHERE ratio = (
    SELECT min(ratio) FROM l WHERE ratio > level))),
e AS (
  SELECT d.doc_id, d.size, a.source_size, a.target,
    CASE WHEN a.source_size > 0 THEN a.target / CAST(a.source_size AS DOUBLE) ELSE 0.0 END AS expected,
    CAST(row_number() OVER (PARTITION BY d.source
      ORDER BY d.size, d.salt, d.doc_id NULLS FIRST) AS DOUBLE) AS rank,
    CAST('0x' || substr(md5('mix-1|' || CASE WHEN d.source IS NULL THEN 'n' ELSE 's' || d.source END),
      1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS start
  FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
  CAST(floor(rank * expected + start) - floor((rank - 1) * expected + start) AS BIGINT) * size AS taken
FROM e
"""


@query
def op10_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.records(table(spark, folder, "documents"))
    load = saved(sharding.loads(rows), "slot-loads")  # one row per slot
    path = f"{checkpoint_dir(spark)}/llm-slot-map-{uuid.uuid4().hex}"
    sharding.write_map(sharding.first_map(spark), path, 1)
    sharding.write_map(sharding.rebalanced(sharding.read_map(spark, path, 1), load), path, 2)
    return sharding.sharded(rows, sharding.read_map(spark, path)).select(
        "*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op2_itq_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return itq.near_links(table(spark, folder, "embeddings"))


@query
def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, folder, "documents"))


@query
def op8_weak_label_quality(spark: SparkSession, folder: str) -> DataFrame:
    return weak_labels.judged(table(spark, folder, "documents"))


@query
def op9_string_kernel_language(spark: SparkSession, folder: str) -> DataFrame:
    learnable = string_kernel.not_held_out()
    out = string_kernel.predicted(table(spark, folder, "documents"), learnable)
    return out.select("doc_id", (~learnable).alias("held_out"), "lang_pred", "score")


@query
def op7_edit_embedding(spark: SparkSession, folder: str) -> DataFrame:
    return edit_embedding.compared(table(spark, folder, "documents"))


@query
def op5_forest_secrets(spark: SparkSession, folder: str) -> DataFrame:
    model = secrets.train(secrets.labelled_findings(spark))
    return secrets.findings(table(spark, folder, "documents"), model)


@query
def op3_html_layout(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extracted(table(spark, folder, "pages"))


@query
def op11_swar_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transformed(table(spark, folder, "documents")))


ORACLES["op11_swar_fill_middle"] = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
c AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
p AS (
  SELECT doc_id, t, n,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
        OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
    array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '')
      AS middle,
    array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suffix
  FROM c)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


@query
def op12_dominance_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    source = packing.tokenizer_file(public_tokenizers.path("word_bpe_49k.json"))
    return best_fit.packed(table(spark, folder, "documents"), source)


@query
def op13_box_tree_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(
        rows.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0
    )


ORACLES["op13_box_tree_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = e.label AS same, e.vec_id,
    CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
  FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (
      PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
