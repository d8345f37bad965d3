"""A pipeline from documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refsync.llm import language, mixing, packing, simhash, toxicity
from refsync.llm.common import materialize, table
from refsync.session import name_local_folder

# A language is taken as known from this score; below, the classes are about even.
LEAST_LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; junk without letters goes."""
    return language.identified(docs, LEAST_LANGUAGE_SCORE)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learned from ``labels`` takes for ordinary."""
    return toxicity.ordinary_documents(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near-duplicates: five words, similarity 0.8."""
    return simhash.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixture(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.packed_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("toxicity", not_toxic),
    ("near_duplicates", without_near_duplicates),
    ("source_mix", mixed_sources),
    ("packing", packed),
]

# No SQL expresses the stages; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to the written result of the one before."""
    docs = table(name_local_folder(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    _, last = STAGES[-1]
    return last(spark, docs, sf_dir)
