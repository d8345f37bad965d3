"""Quality by compression: which dictionary serves a text better.

Two zstandard dictionaries are built, from pieces of texts that are labelled
good and of those labelled bad. A text is cut into pieces, so that it cannot
become a dictionary of its own, and every piece is compressed with either. What
the bad dictionary needs beyond the good one, divided by the text's length, is
positive for good texts. A logistic curve makes a score of it; it is fitted to
other labelled texts than those in the dictionaries. The curve also takes the
mean of both sizes per byte: the less a text holds, the smaller the difference
that there can be, and endless repetition has next to none.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refsync.llm.common import fold, materialize, python_tasks, text_of
from refsync.llm.toxicity import logistic

# A text is cut into pieces of about equal length, of this many bytes at most.
PIECE = 512
DICTIONARY_BYTES = 112_640
LEVEL = 3
# Labelled documents of each class that are learned from, one half for the
# dictionaries and the other for the curve.
SAMPLE_ROWS = 12_000
# Pieces of each class that its dictionary is built from, drawn from all of the sample's.
SAMPLE_PIECES = 16_000
# Added to a text's length, so that a few bytes do not decide alone.
PRIOR_BYTES = 64


def pieces(raw: bytes) -> Iterator[bytes]:
    """The whole text in pieces of about equal length."""
    count = -(-len(raw) // PIECE)
    step = -(-len(raw) // count) if count else 1
    for start in range(0, len(raw), step):
        yield raw[start : start + step]


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of what the samples share; their text itself where they are too few."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Compressor:
    """Sizes of pieces compressed with a dictionary."""

    def __init__(self, content: bytes):
        options = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        known = None
        if len(content) >= 8:
            known = zstandard.ZstdCompressionDict(content)
            known.precompute_compress(compression_params=options)
        self.compressor = zstandard.ZstdCompressor(compression_params=options, dict_data=known)

    def size(self, piece: bytes) -> int:
        return len(self.compressor.compress(piece))


@functools.lru_cache(maxsize=4)
def compressor(content: bytes) -> Compressor:
    """One per dictionary and process: their tables are megabytes that no garbage count sees."""
    return Compressor(content)


@dataclass
class Model:
    """Both dictionaries, and the weights and the bias of the curve."""

    good: bytes
    bad: bytes
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def compare(self, text: str) -> tuple[float, float]:
        """By how much the bad dictionary's size exceeds the good one's, and their mean; per byte."""
        good, bad = compressor(self.good), compressor(self.bad)
        raw = text.encode("utf-8", "replace")
        with_good = with_bad = 0
        for piece in pieces(raw):
            with_good += good.size(piece)
            with_bad += bad.size(piece)
        length = len(raw) + PRIOR_BYTES
        return (with_bad - with_good) / length, (with_bad + with_good) / (2 * length)

    def score(self, text: str) -> float:
        value = self.weights[2]
        if any(self.weights[:2]):
            difference, mean = self.compare(text)
            value += self.weights[0] * difference + self.weights[1] * mean
        return float(1 / (1 + np.exp(-np.clip(value, -35, 35))))


def sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int
) -> tuple[DataFrame, dict[int, int]]:
    """``class``, ``half``, ``spot`` and ``body`` of at most ``rows`` documents of each class.

    Drawn by a hash of the id from the labels of the folds 1 to 4, so that texts
    are read once and never shuffled. A document with contradicting labels takes
    no part. Also returns the number of labelled documents of each class.
    """
    known = materialize(
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & (fold(key) != 0))
        .groupBy(F.col(key).alias("id"))
        .agg(F.min(label).cast("int").alias("class"), F.max(label).cast("int").alias("highest"))
        .where(F.col("class") == F.col("highest"))
        .select("id", "class"),
        "labelled",
    )
    counts = {r["class"]: r["count"] for r in known.groupBy("class").count().collect()}
    spot = F.xxhash64(F.lit("quality"), F.col("id").cast("string"))
    place = F.pmod(spot, F.lit(1_000_000))
    drawn = None
    for value, count in sorted(counts.items()):
        share = min(1e6, 1.05e6 * rows / count)
        # Ids only, at most ``rows`` of them, and the same ones in every run.
        mine = known.where((F.col("class") == value) & (place < share)).orderBy(spot).limit(rows)
        drawn = mine if drawn is None else drawn.unionByName(mine)
    if drawn is None:
        drawn = known.limit(0)
    # Twice ``rows`` ids of a few bytes each.
    chosen = materialize(
        drawn.select(
            F.col("id").alias("label_id"),
            "class",
            F.pmod(F.shiftright(spot, 24), F.lit(2)).cast("int").alias("half"),
            spot.alias("spot"),
        ),
        "chosen",
    )
    texts = docs.select(F.col(key).alias("doc"), text_of(text).alias("body"))
    found = texts.join(F.broadcast(chosen), F.col("doc") == F.col("label_id"))
    return found.select("class", "half", "spot", "body"), counts


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = SAMPLE_ROWS,
    most_pieces: int = SAMPLE_PIECES,
) -> Model:
    """Dictionaries from one half of a bounded sample, the curve from the other.

    The curve is fitted to the classes in the proportion they have among all
    labels. Without any labelled document of either class every score is the
    share of good ones, or 0 if there are no labels at all.
    """
    python_tasks(docs.sparkSession)
    found, counts = sample(docs, labels, key, text, label, rows)
    found = materialize(found, "sample")
    length = F.octet_length("body")
    totals = {
        r["class"]: r["pieces"]
        for r in found.where(F.col("half") == 0)
        .groupBy("class")
        .agg(F.sum(F.ceil(length / PIECE)).alias("pieces"))
        .collect()
    }
    dictionaries = [
        dictionary(_drawn_pieces(found, value, totals.get(value) or 0, most_pieces))
        for value in (0, 1)
    ]
    model = Model(good=dictionaries[1], bad=dictionaries[0])
    good = counts.get(1, 0)
    if not good or not counts.get(0):
        return Model(model.good, model.bad, (0.0, 0.0, 35.0 if good else -35.0))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [model.compare(body) for body in batch.column("body").to_pylist()]
            x = np.array(values, np.float64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("spot"), pa.array(x[:, 0]), pa.array(x[:, 1])],
                ["class", "spot", "difference", "mean"],
            )

    # A few numbers a document; an id that has several texts counts once.
    seen = (
        found.where(F.col("half") == 1)
        .mapInArrow(compare, "class int, spot long, difference double, mean double")
        .groupBy("class", "spot")
        .agg(F.min(F.struct("difference", "mean")).alias("x"))
        .select("class", "spot", "x.*")
        .orderBy("class", "spot")
        .limit(2 * rows)
        .toArrow()
    )
    y = seen.column("class").to_numpy().astype(np.float64)
    if len(set(y)) < 2:
        return Model(model.good, model.bad, (0.0, 0.0, float(np.log(good / counts[0]))))
    x = np.column_stack([seen.column(name).to_numpy() for name in ("difference", "mean")])
    weights = logistic(x, y)
    # From the proportion in the sample to that among all labels.
    shift = np.log(good / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return Model(model.good, model.bad, (*map(float, weights[:2]), float(weights[2] + shift)))


def _drawn_pieces(found: DataFrame, value: int, total: int, most: int) -> list[bytes]:
    """About ``most`` pieces of a class, drawn evenly from all pieces of its whole texts."""
    if not total:
        return []
    step = max(1.0, total / most)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots, kept = batch.column("spot").to_pylist(), []
            for spot, body in zip(spots, batch.column("body").to_pylist(), strict=True):
                # Every ``step``-th piece, from a start that differs between texts.
                at, wanted = 0, (spot % 1_000_003) / 1_000_003 * step
                for piece in pieces(body.encode("utf-8", "replace")):
                    if at >= wanted:
                        kept.append((spot, at, piece))
                        wanted += step
                    at += 1
            columns = list(zip(*kept, strict=True)) if kept else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                 pa.array(columns[2], pa.binary())],
                ["spot", "at", "piece"],
            )

    half = found.where((F.col("half") == 0) & (F.col("class") == value)).select("spot", "body")
    # A bounded number of pieces of a bounded length: about 8 MB.
    drawn = half.mapInArrow(cut, "spot long, at int, piece binary").limit(2 * most)
    return [bytes(r["piece"]) for r in sorted(drawn.collect())]


def scorer(spark, model: Model):
    """Function from a text column to its score."""
    # Two dictionaries of 112 KB.
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(text) for text in texts], dtype="float64")

    return score


def quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = 0.3,
) -> DataFrame:
    """Per row: the key, ``held_out``, ``score`` and ``predicted``.

    Learns from the labels of the folds 1 to 4 and scores every whole text from
    the text alone. A null text is an empty one, which gets the score of a text
    without evidence. A null key is held out. Labels that are null take no part,
    nor do documents whose labels contradict each other. Equal texts get equal
    scores. Other columns, whatever their names, take no part. An empty table
    gives an empty result.
    """
    score = scorer(docs.sparkSession, fit(docs, labels, key, text, label))
    return docs.select(
        F.col(key).alias("doc_id"),
        (fold(key) == 0).alias("held_out"),
        score(text_of(text)).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
