"""Quality of documents from weak labels.

Nine heuristic labellers look at a text and vote good, bad, or abstain; they overlap and err. A
latent-class model takes each as independent given the true class, and expectation-maximisation
estimates the prior and each labeller's accuracy in either class. All a run needs of
the corpus is how often each combination of votes occurs, counted over all documents (3**9
combinations at most, whatever the input). The posterior of a combination labels its documents, and
a linear scorer on hashed character n-grams learns those soft labels from at most about ``SAMPLE``
distinct texts, so that it judges content rather than the rules' borders. All texts are then scored
whole.

Texts of under 20 words only get the votes that hold for any length.

Cases: null text and text without a word get no votes, score from an empty vector;
repeated rows are alike; with no rows there is no model and no result rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import saved, spread
from marquee.llm.ngrams import counts

SAMPLE = 1_500
LENGTHS = (1, 2, 3)
BITS = 13
KEEP = 0.3


def _vote(value: Column, bad: Column, good: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0).cast("int")


def measures(text: Column) -> dict[str, Column]:
    """Counts that the labellers judge, each read from the text once."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(x) > 0)

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    return {
        "_chars": F.length(text),
        "_visible": F.length(text) - count(r"\s"),
        "_words": count(r"\S+"),
        "_symbols": count(r"[^\p{L}\p{N}\s.,;:!?'\"()\-]"),
        "_digits": count(r"\p{N}"),
        "_capitals": count(r"\p{Lu}"),
        "_short": count(r"(?<!\S)\p{L}{1,3}(?!\S)"),
        "_twice": count(r"(?<!\S)(\S{1,64})\s+(?=\1(?!\S))"),
        "_stops": count(r"[\p{L}\p{N}\"')][.!?](?=\s|$)"),
        "_glued": count(r"\p{L}[^\p{L}\p{N}\s.,;:!?'\"()\-]{2,}"),
        "_lines": F.size(lines),
        "_distinct": F.size(F.array_distinct(lines)),
    }


def votes() -> dict[str, Column]:
    """The labellers over ``measures``: 1 good, -1 bad, 0 abstains."""
    chars, words = F.nullif("_chars", F.lit(0)), F.nullif("_words", F.lit(0))

    def enough(value: Column) -> Column:
        """Shares over a few words say nothing: abstain."""
        return F.when(F.col("_words") >= 20, value)

    symbols, digits = F.col("_symbols") / chars, F.col("_digits") / chars
    capitals, mean = enough(F.col("_capitals") / chars), enough(F.col("_visible") / words)
    short, twice = enough(F.col("_short") / words), enough(F.col("_twice") / words)
    stops, glued = enough(F.col("_stops") / words), F.col("_glued") / words
    repeated = F.when(F.col("_lines") >= 4, 1 - F.col("_distinct") / F.col("_lines"))
    return {
        "repeated_words": _vote(twice, twice > 0.1, twice < 0.02),
        "symbols": _vote(symbols, symbols > 0.05, symbols < 0.02),
        "digits": _vote(digits, digits > 0.15, digits < 0.03),
        "capitals": _vote(capitals, capitals > 0.2, capitals < 0.06),
        "word_length": _vote(mean, (mean < 3) | (mean > 11), (mean >= 4) & (mean <= 8)),
        "short_words": _vote(short, short < 0.1, short >= 0.2),
        "repeated_lines": _vote(repeated, repeated > 0.2, repeated == 0),
        "sentences": _vote(stops, stops < 0.01, (stops >= 0.03) & (stops <= 0.2)),
        "glued": _vote(glued, glued > 0.1, glued < 0.01),
    }


def estimate(patterns: np.ndarray, weight: np.ndarray, rounds: int = 200):
    """(prior, chances[class, labeller, bad or good vote], posterior of good per pattern) by EM.

    An abstention is a missing vote and says nothing about the class.
    Starts from the balance of votes, which fixes which class is the good one.
    """
    balance = patterns.sum(axis=1) / np.maximum(np.abs(patterns).sum(axis=1), 1)
    good = np.clip(0.5 + 0.45 * balance, 0.02, 0.98)
    one_hot = np.stack([patterns == v for v in (-1, 1)], axis=2).astype(float)
    for _ in range(rounds):
        mass = np.stack([(1 - good) * weight, good * weight])
        prior = (mass.sum(axis=1) + 1) / (mass.sum() + 2)
        seen = np.einsum("cp,plv->clv", mass, one_hot) + 0.5
        chances = seen / seen.sum(axis=2, keepdims=True)
        logs = np.log(prior)[:, None] + np.einsum("plv,clv->cp", one_hot, np.log(chances))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return prior, chances, good


def vector(text: str | None) -> np.ndarray:
    found = np.log1p(counts(text or "", LENGTHS, BITS))
    size = np.linalg.norm(found)
    return (found / size if size else found).astype(np.float32)


def learn(features: np.ndarray, target: np.ndarray, steps: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated full gradients."""
    features, target = features.astype(np.float32), target.astype(np.float32)
    weights, bias = np.zeros(features.shape[1], np.float32), np.float32(0)
    velocity = np.zeros_like(weights)
    for _ in range(steps):
        ahead = weights + np.float32(0.9) * velocity
        error = 1 / (1 + np.exp(-(features @ ahead + bias))) - target
        slope = features.T @ error / np.float32(len(target)) + np.float32(1e-5) * ahead
        velocity = np.float32(0.9) * velocity - np.float32(2) * slope
        weights = weights + velocity
        bias -= np.float32(0.5) * error.mean()
    return weights, bias


def judged(documents: DataFrame) -> DataFrame:
    """(doc_id, weak_label, quality, kept) for every row.

    ``weak_label`` is the posterior of the votes, ``quality`` the linear scorer's probability.
    """
    spark = documents.sparkSession
    named = votes()
    names = list(named)
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    measured = spread(documents.select("doc_id", "text")).select(
        "doc_id", key.alias("key"), *[v.alias(k) for k, v in measures(F.col("text")).items()]
    )
    voted = saved(measured.select("doc_id", "key", *[v.alias(k) for k, v in named.items()]), "votes")
    table = voted.groupBy(*names).count().collect()  # at most 3 ** labellers rows
    if not table:
        return voted.select(
            "doc_id", F.lit(0.0).alias("weak_label"), F.lit(0.0).alias("quality"), F.lit(False).alias("kept")
        )
    patterns = np.array([[r[n] for n in names] for r in table])
    _, _, good = estimate(patterns, np.array([r["count"] for r in table], float))
    posterior = spark.createDataFrame(
        [(*map(int, p), float(g)) for p, g in zip(patterns, good, strict=True)],
        ", ".join(f"{n} int" for n in names) + ", weak_label double",
    )
    labelled = voted.join(F.broadcast(posterior), names)  # at most 3 ** labellers rows
    distinct = voted.agg(F.approx_count_distinct("key")).first()[0]
    share = min(1.0, SAMPLE / max(distinct, 1))
    draw = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") < share * 2**32
    some = labelled.where(draw).groupBy("key").agg(F.any_value("weak_label").alias("weak_label"))
    texts = documents.select("text", key.alias("key")).where(draw).groupBy("key").agg(F.any_value("text").alias("text"))
    rows = texts.join(some, "key").collect()  # about SAMPLE distinct texts
    rows.sort(key=lambda r: r["key"])
    model = spark.sparkContext.broadcast(
        learn(np.array([vector(r["text"]) for r in rows]), np.array([r["weak_label"] for r in rows]))
        if rows else (np.zeros(1 << BITS), 0.0)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, bias = model.value
        for batch in batches:
            scores = [float(1 / (1 + np.exp(-(vector(t) @ weights + bias)))) for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "quality": scores})

    # quality depends on the text alone: thin rows meet by its hash
    scored = spread(documents.select("text", key.alias("key"))).mapInPandas(
        run, "key string, quality double"
    )
    quality = scored.groupBy("key").agg(F.max("quality").alias("quality"))
    return labelled.join(quality, "key").select(
        "doc_id", "weak_label", "quality", (F.col("quality") >= KEEP).alias("kept")
    )
