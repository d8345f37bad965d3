"""Language identification in two steps: family first, then the languages within it.

Texts become counts of character n-grams, hashed into a fixed number of
buckets. Linear support vector machines tell the families apart, one against
the rest; within the family found, one machine per pair of languages votes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refsync.llm.common import fold, free_name, python_tasks, text_of

UNKNOWN = "und"
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
# Labelled rows to learn from, shared equally by the languages, and the least of one.
SAMPLE_ROWS = 3000
LEAST_ROWS = 50
MOST_LANGUAGES = 200

# Families of related languages, by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "indic": "bn gu hi mr ne pa ur",
    "turkic": "az kk ky tr tt uz",
    "semitic": "am ar he mt",
    "malayic": "id ms",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    """The family of a language code; a code without one is a family of its own."""
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"={lang}")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


_LETTER = np.zeros(256, bool)
_LETTER[128:] = True
for _first in (65, 97):
    _LETTER[_first : _first + 26] = True
_GRAM_BYTES = 1 << 20


def features(text: str) -> np.ndarray:
    """Square roots of the counts of 2-, 3- and 4-byte grams with a letter, of length one."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(BUCKETS, np.float64)
    for start in range(0, len(raw), _GRAM_BYTES):
        part = raw[start : start + _GRAM_BYTES + 3]
        letter = _LETTER[part]
        codes = np.where(letter, part, 32).astype(np.uint32)
        gram, any_letter = codes, letter
        for n in (2, 3, 4):
            if len(part) < n:
                break
            gram = gram[:-1] * np.uint32(0x01000193) + codes[n - 1 :]
            any_letter = any_letter[:-1] | letter[n - 1 :]
            bucket = (gram[any_letter] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
            counts += np.bincount(bucket, minlength=BUCKETS)
    counts = np.sqrt(counts)
    length = np.linalg.norm(counts)
    return counts / length if length else counts


def machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 200) -> np.ndarray:
    """Weights and bias of a linear support vector machine, both classes weighing the same.

    Squared hinge loss, minimised by accelerated gradient steps; rows of ``x``
    have length one, which bounds the curvature.
    """
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, b = np.zeros(x.shape[1]), 0.0
    ahead, ahead_b, step = w, b, 1 / (4 + penalty)
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead + ahead_b)) * y * weight
        new = ahead - step * (penalty * ahead - 2 * (slack @ x))
        new_b = ahead_b + step * 2 * slack.sum()
        push = t / (t + 3)
        ahead, ahead_b = new + push * (new - w), new_b + push * (new_b - b)
        w, b = new, new_b
    return np.append(w, b)


@dataclass
class Model:
    """Machines per family, and per pair of languages of a family."""

    members: dict[str, list[str]] = field(default_factory=dict)
    families: dict[str, np.ndarray] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: the least certain of the decisions that led to it."""
        if not self.members or text is None or not has_letter(text):
            return UNKNOWN, 0.0
        x = np.append(features(text), 1.0)
        sure = [1.0]
        if len(self.families) > 1:
            margins = {name: float(w @ x) for name, w in self.families.items()}
            chosen = max(sorted(margins), key=margins.get)
            others = max(v for name, v in margins.items() if name != chosen)
            sure.append(_probability((margins[chosen] - others) / 2))
        else:
            chosen = next(iter(self.members))
        votes: dict[str, list[float]] = {lang: [] for lang in self.members[chosen]}
        for a, b in combinations(self.members[chosen], 2):
            margin = float(self.pairs[a, b] @ x)
            votes[a].append(margin)
            votes[b].append(-margin)
        best = max(
            sorted(votes), key=lambda lang: (sum(m > 0 for m in votes[lang]), sum(votes[lang]))
        )
        sure += [_probability(margin) for margin in votes[best]]
        return best, min(sure)


def _probability(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(4 * margin, -60, 60))))


def fit(
    docs: DataFrame,
    learn: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """Learn from at most ``sample_rows`` texts with a language, of the rows ``learn`` admits.

    The sample is drawn by a hash of the text, different texts only, as many of
    every language; each gets ``LEAST_ROWS`` at least, so beyond 60 languages
    there are more. Of more than ``MOST_LANGUAGES`` those with most different
    texts are learned. The sample alone comes to the driver.
    """
    python_tasks(docs.sparkSession)
    rows = docs.where(learn) if learn is not None else docs
    rows = (
        rows.select(
            F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("body")
        )
        .where(F.col("lang").isNotNull() & F.col("body").rlike(r"\p{L}"))
        .withColumn("h", F.xxhash64("body"))
    )
    # Texts are drawn by their hash, so copies do not count.
    different = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    largest = different.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    sizes = {r["lang"]: max(1, r["n"]) for r in largest.collect()}
    if not sizes:
        return Model()
    quota = max(LEAST_ROWS, sample_rows // len(sizes))
    share = F.create_map(
        *(F.lit(v) for name, n in sizes.items() for v in (name, min(1.0, 1.5 * quota / n)))
    )
    # A language of a few texts is taken whole.
    drawn = rows.where(
        F.pmod("h", F.lit(1_000_000)) < F.get(F.array(share), F.lit(0))[F.col("lang")] * 1e6
    ).dropDuplicates(["lang", "h"])
    first = Window.partitionBy("lang").orderBy("h")
    sample = drawn.withColumn("n", F.row_number().over(first)).where(F.col("n") <= quota)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [
                features(t).astype(np.float16).tobytes() for t in batch.column("body").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("h"), pa.array(vectors, pa.binary())],
                ["lang", "h", "x"],
            )

    found = sorted(
        sample.select("lang", "h", "body").mapInArrow(describe, "lang string, h long, x binary").collect()
    )
    if not found:
        return Model()
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in found]).astype(np.float64)
    return _learn(x, np.array([r["lang"] for r in found], object))


def _learn(x: np.ndarray, langs: np.ndarray) -> Model:
    model = Model(members=defaultdict(list))
    for lang in sorted(set(langs)):
        model.members[family(lang)].append(lang)
    model.members = dict(model.members)
    homes = np.array([family(lang) for lang in langs], object)
    for name, members in model.members.items():
        model.families[name] = machine(x, np.where(homes == name, 1.0, -1.0))
        for a, b in combinations(members, 2):
            rows = (langs == a) | (langs == b)
            model.pairs[a, b] = machine(x[rows], np.where(langs[rows] == a, 1.0, -1.0))
    return model


def predictor(spark, model: Model):
    """Function from a text column to a struct of ``lang_pred`` and ``score``."""
    # A few machines of 4,096 weights each.
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(text) for text in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return predict


def identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Per row: the key, ``held_out``, ``lang_pred`` and ``score``.

    Learns from the folds 1 to 4 and predicts every whole text from the text
    alone. A null text or one without a letter is ``und`` with score 0, and so
    is every text if there is nothing to learn from. A null key is held out.
    Rows with a null language are predicted, not learned from. Other columns,
    whatever their names, take no part. An empty table gives an empty result.
    """
    model = fit(docs, fold(key) != 0, text=text, lang=lang)
    predict = predictor(docs.sparkSession, model)
    return (
        docs.select(
            F.col(key).alias("doc_id"),
            (fold(key) == 0).alias("held_out"),
            predict(text_of(text)).alias("p"),
        )
        .select("doc_id", "held_out", "p.lang_pred", "p.score")
    )


def identified(
    docs: DataFrame, least_score: float, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``least_score``."""
    predict = predictor(docs.sparkSession, fit(docs, fold(key) != 0, text=text, lang=lang))
    mark = free_name(docs.columns, "language")
    return (
        docs.withColumn(mark, predict(text_of(text)))
        .where((F.col(mark)["lang_pred"] != UNKNOWN) & (F.col(mark)["score"] >= least_score))
        .drop(mark)
    )
