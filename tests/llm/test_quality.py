import zlib

import pytest

from refsync.llm import quality


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def labels_of(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int, body string")


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r.predicted for r in rows if r.quality]
    bad = [r.predicted for r in rows if not r.quality]
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / len(bad) < 0.1
    # Calibrated: the scores add up to about the number of good documents.
    assert abs(sum(r.score for r in rows) / len(rows) - sum(r.quality for r in rows) / len(rows)) < 0.03


def test_reruns_agree(spark, sample):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    one, two = (sorted(map(tuple, quality.quality(d, labels).collect()))
                for d in (sample, sample.repartition(7)))
    assert one == two


def test_awkward_documents(spark, awkward):
    labels = labels_of(
        spark,
        [(1, 1, 0, "b"), (2, 1, 1, "b"), (2, 0, 0, "b"), (3, 0, 1, "b"), (6, 1, 0, "b"),
         (7, 0, None, "b"), (8, None, 0, "b"), (None, 1, 1, "b"), (99, 0, 1, "b")],
    )
    rows = quality.quality(awkward, labels).collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted(
        (r.doc_id for r in awkward.collect()), key=repr
    )
    for r in rows:
        assert r.held_out == held_out(r.doc_id)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[3] == by_id[4]  # null and empty


@pytest.mark.parametrize("value, expected", [(1, 1), (0, 0)])
def test_one_class_only(spark, awkward, value, expected):
    labels = labels_of(spark, [(i, value, 0, "b") for i in range(12)])
    assert {r.predicted for r in quality.quality(awkward, labels).collect()} == {expected}


def test_without_labels_or_rows(spark, awkward, nothing):
    none = labels_of(spark, [])
    assert {r.predicted for r in quality.quality(awkward, none).collect()} == {0}
    assert quality.quality(nothing, none).collect() == []
    assert quality.quality(nothing, labels_of(spark, [(1, 1, 0, "b"), (2, 0, 0, "b")])).count() == 0


def test_copies_of_one_text(spark):
    """A class that is one repeated text is learned like any other."""
    rows = [(i, "*** !!! ###" if i % 2 else "a plain sentence of words") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast((doc_id + 1) % 2 as int) as quality")
    found = quality.quality(docs, labels).collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in found)


def test_repeated_rows_and_a_hot_id(spark):
    """One id with most of the rows costs nothing but its texts."""
    docs = spark.createDataFrame(
        [(1, "words in a row " * 20)] * 3000 + [(i, "### " * 40) for i in range(2, 40)],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame(
        [(i, int(i == 1), 0) for i in range(1, 40)], "doc_id long, quality int, toxic int"
    )
    assert quality.quality(docs, labels).count() == 3038


def test_pieces_are_the_whole_text():
    for size in (0, 1, 511, 512, 513, 5000, 1 << 20):
        raw = bytes(i % 251 for i in range(size))
        cut = list(quality.pieces(raw))
        assert b"".join(cut) == raw and all(len(p) <= quality.PIECE for p in cut)


def test_sizes_are_those_of_the_library():
    """A piece's size with a dictionary is undone by the library with that dictionary."""
    import zstandard

    content = quality.dictionary([f"some words {i} about nothing".encode() for i in range(5000)])
    piece = b"some words 17 about nothing at all"
    frame = quality.Compressor(content).compressor.compress(piece)
    known = zstandard.ZstdCompressionDict(content)
    assert zstandard.ZstdDecompressor(dict_data=known).decompress(
        frame, max_output_size=1000
    ) == piece
    assert len(frame) < quality.Compressor(b"").size(piece)
