"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refsync.llm import (
    centroids,
    language,
    lm,
    mixing,
    negatives,
    neighbours,
    packing,
    quality,
    sharding,
    simhash,
    tokens,
    topk,
    toxicity,
)
from refsync.llm.common import table, tokenizer_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(
        table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = sharding.tree(40)
    return sharding.shard(
        table(spark, sf_dir, "documents"), regions, more=sharding.grown(regions, 40)
    )


def op9_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.cross_entropy_difference(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_language_id": op3_language_id,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_source_mix": op5_source_mix,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_token_counts": op7_token_counts,
    "op8_sharding": op8_sharding,
    "op9_cross_entropy": op9_cross_entropy,
    "op10_toxicity": op10_toxicity,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_quality": op12_quality,
    "op13_hard_negatives": op13_hard_negatives,
}
