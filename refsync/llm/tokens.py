"""Token counts through a digest cache.

The cache is a table of (tokenizer digest, content digest, tokens). A text is
encoded only if no row of the cache has its digest under the same version of
the tokenizer, and only once however many documents have it; the new counts are
appended, and every document then finds its count by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.llm.common import materialize, new_shared_path, python_tasks, text_of

CACHE_SCHEMA = "tokenizer binary, content binary, n_tokens long"
LIMIT = 4096

_encoders: dict[str, object] = {}


def tokenizer_digest(path: str) -> bytes:
    """Digest of the tokenizer's file and of the library version that reads it."""
    import sentencepiece
    import tokenizers

    library = sentencepiece if path.endswith(".model") else tokenizers
    version = f"{library.__name__} {library.__version__}".encode()
    return hashlib.sha256(Path(path).read_bytes() + version).digest()


def counter(path: str):
    """Function from texts to their numbers of tokens, by the library for the file."""
    if path not in _encoders:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _encoders[path] = lambda texts: [len(i) for i in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            whole.no_truncation()
            whole.no_padding()
            _encoders[path] = lambda texts: [
                len(e.ids) for e in whole.encode_batch(texts, add_special_tokens=False)
            ]
    return _encoders[path]


def content_digest(text: Column) -> Column:
    """SHA-256 of the normalised content: the text itself, empty for null.

    Nothing else is folded, since any other change may change the count.
    """
    return F.unhex(F.sha2(text, 256))


def read_cache(spark: SparkSession, cache: str, version: bytes) -> DataFrame:
    """One row per content digest, also where two runs appended the same one."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return (
        stored.where(F.col("tokenizer") == F.lit(version))
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )


def add_misses(docs: DataFrame, cache: str, tokenizer: str, text: str = "text") -> None:
    """Encode each text of ``docs`` that the cache lacks once, and append its count.

    Copies meet as one row per task before they are shuffled, so that a text
    held by a third of all rows is no hot key.
    """
    spark = docs.sparkSession
    python_tasks(spark)
    version = tokenizer_digest(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            numbers = count(batch.column("body").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array(numbers, pa.int64())], ["content", "n_tokens"]
            )

    body = text_of(text)
    distinct = (
        docs.select(body.alias("body"))
        .withColumn("content", content_digest(F.col("body")))
        .groupBy("content")
        .agg(F.first("body").alias("body"))
    )
    missing = distinct.join(read_cache(spark, cache, version), "content", "left_anti")
    (
        missing.select("content", "body")
        .mapInArrow(encode, "content binary, n_tokens long")
        .select(F.lit(version).alias("tokenizer"), "content", "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str | None = None,
    limit: int = LIMIT,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Tokens of every whole text: the key, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``cache`` names the table of counts, which grows by this call; without it
    a new one is made in the shared folder. ``tokenizer`` is a file that every
    executor has at the same path.

    A null text counts as empty and has 0 tokens; null and repeated keys keep
    their rows. Other columns, whatever their names, take no part. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    cache = cache or new_shared_path(spark, "token-cache")
    add_misses(docs, cache, tokenizer, text)
    body = text_of(text)
    asked = docs.select(
        F.col(key).alias("doc_id"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        content_digest(body).alias("content"),
    )
    # Stored, so that the join sees it as a plain table and splits a hot digest.
    known = materialize(read_cache(spark, cache, tokenizer_digest(tokenizer)), "token-counts")
    return asked.join(known, "content", "left").select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
