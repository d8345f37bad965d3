import sentencepiece

from refsync.llm import tokens
from refsync.llm.common import new_shared_path, tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


def expected(rows):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = []
    for r in rows:
        text = r.text or ""
        n = len(model.encode(text))
        out.append((r.doc_id, len(text.encode()), n, n > 4096))
    return sorted(out, key=repr)


def test_counts(spark, awkward):
    found = tokens.token_counts(awkward, PATH).collect()
    assert sorted(map(tuple, found), key=repr) == expected(awkward.collect())


def test_empty_table(spark, nothing):
    assert tokens.token_counts(nothing, PATH).collect() == []


def test_only_distinct_misses_are_encoded(spark, awkward, sample):
    cache = new_shared_path(spark, "cache")
    tokens.add_misses(awkward, cache, PATH)
    texts = {r.text or "" for r in awkward.collect()}
    assert spark.read.parquet(cache).count() == len(texts)
    tokens.add_misses(awkward, cache, PATH)
    assert spark.read.parquet(cache).count() == len(texts)
    both = awkward.select("doc_id", "text").unionAll(sample.select("doc_id", "text"))
    found = tokens.token_counts(both, PATH, cache).collect()
    assert sorted(map(tuple, found), key=repr) == expected(both.collect())
    assert spark.read.parquet(cache).count() == len({r.text or "" for r in both.collect()})


def test_another_tokenizer_shares_no_counts(spark, awkward):
    cache = new_shared_path(spark, "cache")
    tokens.add_misses(awkward, cache, PATH)
    once = spark.read.parquet(cache).count()
    other = tokenizer_path("byte_bpe_50k.json")
    tokens.add_misses(awkward, cache, other)
    assert spark.read.parquet(cache).count() == 2 * once


def test_counts_appended_twice_are_read_once(spark, awkward):
    cache = new_shared_path(spark, "cache")
    tokens.add_misses(awkward, cache, PATH)
    spark.read.parquet(cache).write.mode("append").parquet(cache)
    assert tokens.token_counts(awkward, PATH, cache).count() == awkward.count()
