"""Language identification with string kernels.

The kernel of two texts is the number of n-grams present in both, of 1 to 4 letters blended, over
the geometric mean of their numbers (lower case, every other character a space, n-grams hashed into
2**16). Landmark texts of each language span a Nyström feature space; one kernel ridge regression
per language, one against the rest, is solved in it. As the kernel is linear in presence, landmarks
and regressions fold into one matrix, and texts are scored in batches by one matrix product.

Learned from at most about ``PER_LANGUAGE`` distinct texts of each language, drawn by md5 over all
rows that may be learned from, with ``LANDMARKS`` of them as landmarks. Predictions see the text
alone.

Cases: null text, or text without a letter: ``und`` with score 0; no learned language at all
likewise; ties go to the language first by name; repeated rows are alike; an empty table gives no
rows; extra columns are ignored by ``predicted`` and kept by ``recognised``, whatever their names;
every whole text is read, in slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from marquee.llm.common import keeps_columns, spread
from marquee.llm.ngrams import presence

LENGTHS = (1, 2, 3, 4)
BITS = 16
PER_LANGUAGE = 300
LANDMARKS = 50
RIDGE = 1e-2
UNKNOWN = "und"


def learn(sample: list[tuple[str, np.ndarray]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, weights, bias) from (language, presence) pairs."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return [], np.zeros((1 << BITS, 0), np.float32), np.zeros(0)
    by_language = {lang: [p for name, p in sample if name == lang] for lang in languages}
    landmarks = np.zeros((sum(min(LANDMARKS, len(v)) for v in by_language.values()), 1 << BITS), np.float32)
    at = 0
    for found in by_language.values():
        for ids in found[:LANDMARKS]:
            landmarks[at, ids] = 1 / np.sqrt(len(ids))
            at += 1
    kernel = np.array([
        landmarks[:, ids].sum(axis=1) / np.sqrt(len(ids)) for lang in languages for ids in by_language[lang]
    ], np.float64)
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    keep = values > 1e-6 * values[-1]
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ whiten
    target = np.zeros((len(features), len(languages)))
    weight = np.empty(len(features))
    row = 0
    for column, lang in enumerate(languages):
        size = len(by_language[lang])
        target[row : row + size, column] = 1
        weight[row : row + size] = 1 / size  # languages count alike
        row += size
    weight /= weight.sum()
    centre, mean = weight @ features, weight @ target
    left = (features - centre) * weight[:, None]
    solved = np.linalg.solve(
        left.T @ (features - centre) + RIDGE * np.eye(features.shape[1]) / len(features),
        left.T @ (target - mean),
    )
    folded = landmarks.T @ (whiten @ solved).astype(np.float32)
    return languages, folded, mean - centre @ solved


def sample_of(documents: DataFrame, learnable) -> list[tuple[str, np.ndarray]]:
    """Presence of a bounded draw of distinct texts per language; equal texts are drawn once."""
    rows = documents.where(learnable & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", F.md5(F.col("text").cast("binary")).alias("key"))
    totals = rows.select("lang", "key").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    draw = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    # one row per language
    drawn = rows.join(F.broadcast(totals), "lang").where(draw < F.lit(PER_LANGUAGE) / F.col("n"))
    texts = drawn.groupBy("lang", "key").agg(F.any_value("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scratch = np.zeros(1 << BITS, np.uint8)
        for batch in batches:
            ids = [presence(t, LENGTHS, BITS, scratch).astype("int32") for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "key": batch["key"], "ids": ids})

    found = texts.mapInPandas(run, "lang string, key string, ids array<int>").collect()
    found.sort(key=lambda r: (r["lang"], r["key"]))
    return [(r["lang"], np.array(r["ids"])) for r in found]


def predicted(documents: DataFrame, learnable, extra: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``extra`` columns, the text's lang_pred and score for every row.

    ``learnable`` is the condition for rows that may be learned from.
    """
    spark = documents.sparkSession
    model = spark.sparkContext.broadcast(learn(sample_of(documents, learnable)))
    schema = documents.select(*extra).schema
    block = 64

    def judged(texts: list[str | None], scratch: np.ndarray, matrix: np.ndarray) -> tuple[list, list]:
        languages, weights, bias = model.value
        names, scores = [], []
        for start in range(0, len(texts), block):
            part = texts[start : start + block]
            ids = [presence(t, LENGTHS, BITS, scratch) if t else () for t in part]
            for row, found in enumerate(ids):
                if len(found):
                    matrix[row, found] = 1 / np.sqrt(len(found))
            values = matrix[: len(part)] @ weights + bias
            for row, found in enumerate(ids):
                if len(found):
                    matrix[row, found] = 0
                # a text of spaces alone has the n-grams of spaces only
                known = len(found) > len(LENGTHS) or bool(part[row]) and any(map(str.isalpha, part[row]))
                if not known or not languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                each = np.maximum(values[row], 0)
                best = int(values[row].argmax())
                names.append(languages[best])
                scores.append(float(min(1.0, each[best] / each.sum())) if each.sum() > 0 else 0.0)
        return names, scores

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = np.zeros(1 << BITS, np.uint8)
        matrix = np.zeros((block, 1 << BITS), np.float32)
        for batch in batches:
            names, scores = judged(batch.column("_read").to_pylist(), scratch, matrix)
            kept = [batch.column(f.name) for f in schema]  # as they came
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*schema.names, "lang_pred", "score"],
            )

    sent = documents.select(*[F.col(c) for c in extra], F.col("text").alias("_read"))
    fields = StructType([*schema, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return spread(sent).mapInArrow(run, fields)


@keeps_columns
def recognised(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose text is in a language."""
    columns = documents.columns
    out = predicted(documents, not_held_out(), tuple(columns))
    return out.where(F.col("lang_pred") != UNKNOWN).select(*columns)


def not_held_out():
    """Rows that may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 4 != 2
