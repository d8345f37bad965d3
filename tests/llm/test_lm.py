from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from refsync.llm import lm
from refsync.llm.common import hashed_words


def brute(docs, target, least_share):
    """Both models as dictionaries."""
    sides = [
        [hashed_words(t or "").tolist() for t in texts] for texts in ([t for _, t in docs], target)
    ]
    totals = [sum(map(len, side)) for side in sides]
    words = Counter(w for text in sides[0] for w in text)
    known = {w for w, n in words.items() if n >= least_share * totals[0]}
    sides = [[[w if w in known else "unknown" for w in text] for text in side] for side in sides]
    unigram = [Counter(w for text in side for w in text) for side in sides]
    history = [Counter(w for text in side for w in ["start", *text]) for side in sides]
    pair = [Counter(p for text in side for p in zip(["start", *text], text)) for side in sides]

    def word(side, w):
        shared = (unigram[0][w] + unigram[1][w] + 1e-9) / (sum(totals) + 1e-9)
        return (unigram[side][w] + lm.WORD_PRIOR * shared) / (totals[side] + lm.WORD_PRIOR)

    def loss(side, h, w):
        return -np.log(
            (pair[side][h, w] + lm.PAIR_PRIOR * word(side, w)) / (history[side][h] + lm.PAIR_PRIOR)
        )

    out = []
    for (doc_id, _), text in zip(docs, sides[0]):
        differences = [loss(0, h, w) - loss(1, h, w) for h, w in zip(["start", *text], text)]
        out.append((doc_id, len(text), float(np.mean(differences)) if text else 0.0))
    return sorted(out, key=repr)


def check(docs, target, least_share=lm.LEAST_SHARE):
    found = sorted(map(tuple, lm.cross_entropy_difference(docs, target, least_share).collect()), key=repr)
    expected = brute(
        [(r.doc_id, r.text) for r in docs.collect()],
        [r.text for r in target.collect()],
        least_share,
    )
    assert [f[:2] for f in found] == [e[:2] for e in expected]
    assert [f[2] for f in found] == pytest.approx([e[2] for e in expected], abs=1e-4)


def test_awkward_documents(spark, awkward):
    check(awkward, awkward.where("lang = 'de'"))


def test_real_documents_in_many_chunks_and_groups(spark, sample, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BITS", 4)
    monkeypatch.setattr(lm, "WORDS_PER_GROUP", 20_000)
    monkeypatch.setattr(lm, "_MERGE_ROWS", 5_000)
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    check(sample.repartition(3).persist(), target, 1e-4)


def test_rare_words_of_the_target_are_known(spark):
    """However large the background, a word of which it has one counts as itself."""
    common = " ".join(f"w{i % 1000}" for i in range(400_000))
    rows = [(0, common), (1, common), (2, "w1 ferrite w2"), (3, "w1 gabbro w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([("w1 ferrite w2",)] * 20, "text string")
    assert 1 < 2e-6 * 800_000
    scores = {r.doc_id: r.score for r in lm.cross_entropy_difference(docs, target).collect()}
    assert scores[2] > scores[3] + 0.1
    check(docs, target)


def test_empty_tables(spark, nothing, sample):
    assert lm.cross_entropy_difference(nothing, sample).collect() == []
    check(sample.limit(20).persist(), nothing)


def test_documents_like_the_target_score_higher(spark, sample):
    target = sample.where("lang = 'de'")
    scores = lm.cross_entropy_difference(sample, target).join(sample, "doc_id")
    means = {r.lang: r.m for r in scores.groupBy("lang").agg(F.mean("score").alias("m")).collect()}
    assert max(means, key=means.get) == "de"
