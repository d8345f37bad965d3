"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary documents, give every word and every pair
of neighbouring words a probability. As usual for this smoothing, counts are
numbers of contexts, here of documents; every count is discounted, and what the
discounts free up is handed out by a backoff distribution over the counts of
both classes together. The discount is what chance explains: the count that the
backoff distribution leads to expect, and five standard deviations. So an
expression that is rare, or no more frequent in one class than in the other,
has its probability from the shared counts and is about as likely in either
class, while one that marks a class stands out.

A document's log-likelihoods under the two models are compared expression by
expression. Expressions that are more likely in ordinary documents count as
even, for no amount of ordinary text takes an insult back. The differences are
divided by the document's length. Models are learned from either half of the
labelled rows; a logistic curve is fitted to what the rows of one half get from
the other half's models, and a text is scored by the mean of both.

Expressions are hashed into a fixed number of buckets, which bounds the models
that are handed to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refsync.llm.common import (
    fold,
    free_name,
    hashed_words,
    materialize,
    mix,
    python_tasks,
    text_of,
)
from refsync.operators.joins import fits_broadcast

BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
# Rows that the logistic curve is fitted to.
SAMPLE_ROWS = 20_000
# Added to a document's length, so that a few words do not decide alone.
PRIOR_WORDS = 10
LEAST_DISCOUNT = 0.75
DEVIATIONS = 5.0
_MASK = np.uint64(BUCKETS - 1)
_COUNTS = ["ordinary0", "toxic0", "ordinary1", "toxic1"]


def expressions(text: str) -> np.ndarray:
    """Buckets of the words, then of the pairs of neighbours in a range of their own."""
    words = hashed_words(text)
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    return np.concatenate([words & _MASK, (pairs & _MASK) + np.uint64(BUCKETS)]).astype(np.int64)


@dataclass
class Model:
    """Per bucket what the toxic log-likelihood exceeds the ordinary one by, at least 0."""

    difference: np.ndarray

    def compare(self, text: str) -> tuple[float, float]:
        """Square roots of the length-normalised differences over words and over pairs."""
        found = expressions(text)
        n = (len(found) + 1) // 2
        values = self.difference[found]
        length = n + PRIOR_WORDS
        return (
            float(np.sqrt(values[:n].sum(dtype=np.float64) / length)),
            float(np.sqrt(values[n:].sum(dtype=np.float64) / length)),
        )


def fit_model(ordinary: np.ndarray, toxic: np.ndarray) -> Model:
    """Both models, for words and for pairs, from the documents per bucket."""
    difference = np.zeros(2 * BUCKETS, np.float32)
    for start in (0, BUCKETS):
        part = slice(start, start + BUCKETS)
        shared = ordinary[part] + toxic[part] + 0.5
        shared = shared / shared.sum()
        logs = []
        for counts in (ordinary[part].astype(np.float64), toxic[part].astype(np.float64)):
            total = counts.sum()
            if not total:
                logs.append(np.log(shared))
                continue
            expected = total * shared
            chance = np.maximum(LEAST_DISCOUNT, expected + DEVIATIONS * np.sqrt(expected))
            freed = np.minimum(counts, chance).sum() / total
            logs.append(np.log(np.maximum(counts - chance, 0) / total + freed * shared))
        difference[part] = np.maximum(logs[1] - logs[0], 0)
    return Model(difference)


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``body``, ``toxic`` and ``half`` of the rows to learn from.

    Folds 1 to 4 of the rows with a label. If a document's labels disagree, it
    counts as toxic. Labels are made unique and stored first, so that beyond a
    broadcast a hot document id is split by the re-plan.
    """
    known = materialize(
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("label_id"))
        .agg(F.max(F.when(F.col(label) == 1, 1).otherwise(0)).alias("toxic")),
        "labels",
    )
    rows = docs.where(fold(key) != 0).select(
        F.col(key).alias("id"),
        text_of(text).alias("body"),
        F.pmod(F.floor(F.crc32(F.col(key).cast("string")) / 5), F.lit(2)).cast("int").alias("half"),
    )
    selected = known.where(F.col("toxic").isin(0, 1))
    # Most documents may have no label. As long as the ids fit a broadcast, no text moves.
    if fits_broadcast(selected)[0]:
        selected = F.broadcast(selected)
    return rows.join(selected, F.col("id") == F.col("label_id")).select("body", "toxic", "half")


def counts_of(rows: DataFrame) -> list[np.ndarray]:
    """Documents per half and class for every bucket.

    A task adds up its rows in arrays of fixed size and reports the buckets it
    has seen; the sums, one row per bucket, come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((4, 2 * BUCKETS), np.int32)
        for batch in batches:
            which = np.array(batch.column("half")) * 2 + np.array(batch.column("toxic"))
            for cell, body in zip(which.tolist(), batch.column("body").to_pylist(), strict=True):
                seen[cell][np.unique(expressions(body))] += 1
        buckets = np.flatnonzero(seen.any(axis=0))
        for start in range(0, len(buckets), 200_000):
            part = buckets[start : start + 200_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), *(pa.array(line[part]) for line in seen)],
                ["bucket", *_COUNTS],
            )

    kinds = ", ".join(f"{name} int" for name in ["bucket", *_COUNTS])
    # At most 2 * BUCKETS rows of 36 bytes: 72 MB.
    summed = (
        rows.mapInArrow(count, kinds)
        .groupBy("bucket")
        .agg(*(F.sum(name).alias(name) for name in _COUNTS))
        .toArrow()
    )
    at = summed.column("bucket").to_numpy()
    totals = []
    for name in _COUNTS:
        line = np.zeros(2 * BUCKETS, np.int64)
        line[at] = summed.column(name).to_numpy()
        totals.append(line)
    return totals


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights and bias by Newton's method with a little ridge."""
    scale = np.append(x.std(axis=0) + 1e-9, 1.0)
    x = np.column_stack([x, np.ones(len(x))]) / scale
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (p - y) + ridge @ w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge
        move = np.linalg.solve(bend, slope)
        w -= move * min(1.0, 5.0 / (np.abs(move).max() + 1e-9))
        if np.abs(move).max() < 1e-8:
            break
    return w / scale


class Scorer:
    """A model and the logistic weights for what it compares."""

    def __init__(self, model: Model, weights: np.ndarray):
        self.model, self.weights = model, weights

    def score(self, text: str) -> float:
        value = self.weights[:2] @ self.model.compare(text) + self.weights[2]
        return float(1 / (1 + np.exp(-np.clip(value, -35, 35))))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Scorer:
    """Learn both models from all labelled rows of the folds 1 to 4.

    The logistic curve is fitted to at most ``sample_rows`` of them, drawn by a
    hash, each compared by the models of the other half. Without any labelled
    row of either class every score is the share of toxic rows, or 0.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    rows = labelled(docs, labels, key, text, label)
    ordinary0, toxic0, ordinary1, toxic1 = counts_of(rows)
    others = [fit_model(ordinary1, toxic1), fit_model(ordinary0, toxic0)]
    # The curve is fitted to differences of models of one half, so it must be given such.
    whole = Model((others[0].difference + others[1].difference) / 2)
    # Two arrays of 2 * BUCKETS floats, 16 MB.
    halves = spark.sparkContext.broadcast(others)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                halves.value[half].compare(body)
                for half, body in zip(
                    batch.column("half").to_pylist(), batch.column("body").to_pylist(), strict=True
                )
            ]
            x = np.array(found, np.float64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column("toxic")],
                ["words", "pairs", "toxic"],
            )

    known = docs.where(fold(key) != 0).select(F.col(key).alias("id"))
    marked = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("id")).distinct()
    total = known.join(marked, "id", "left_semi").count()
    share = F.lit(min(1.0, sample_rows / max(1, total)) * 1e6)
    drawn = rows.where(F.pmod(F.xxhash64("body"), F.lit(1_000_000)) < share)
    # The limit is the documented bound; it only bites if copies share the hash drawn.
    sample = (
        drawn.limit(2 * sample_rows)
        .mapInArrow(compare, "words double, pairs double, toxic int")
        .toArrow()
    )
    x = np.column_stack([sample.column("words").to_numpy(), sample.column("pairs").to_numpy()])
    y = sample.column("toxic").to_numpy().astype(np.float64)
    if len(set(y)) < 2:
        return Scorer(whole, np.array([0.0, 0.0, 35.0 if len(y) and y[0] else -35.0]))
    return Scorer(whole, logistic(x, y))


def scorer(spark, fitted: Scorer):
    """Function from a text column to its score."""
    # One array of 2 * BUCKETS floats, 8 MB.
    shared = spark.sparkContext.broadcast(fitted)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(text) for text in texts], dtype="float64")

    return score


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """Per row: the key, ``held_out``, ``score`` and ``predicted``.

    Learns from the labels of the folds 1 to 4 and scores every whole text from
    the text alone. A null text is an empty one, which gets the score of a text
    without evidence. A null key is held out. Labels that are null take no
    part; if a document has several, one of toxic wins. Other columns, whatever
    their names, take no part. An empty table gives an empty result.
    """
    score = scorer(docs.sparkSession, fit(docs, labels, key, text, label))
    return docs.select(
        F.col(key).alias("doc_id"),
        (fold(key) == 0).alias("held_out"),
        score(text_of(text)).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def ordinary_documents(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = 0.5,
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    score = scorer(docs.sparkSession, fit(docs, labels, key, text, label))
    mark = free_name(docs.columns, "score")
    return (
        docs.withColumn(mark, score(text_of(text))).where(F.col(mark) < threshold).drop(mark)
    )
