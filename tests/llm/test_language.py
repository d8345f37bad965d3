import zlib

import pytest

from refsync.llm import language


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.identify(docs).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) / len(out) > 0.98


def test_awkward_documents(spark, awkward):
    rows = language.identify(awkward).collect()
    assert len(rows) == awkward.count()
    learned = {"en", "de"}
    found = {}
    for r in rows:
        assert r.lang_pred in learned | {"und"} and 0 <= r.score <= 1
        assert r.held_out == held_out(r.doc_id)
        found.setdefault(r.doc_id, r.lang_pred)
    assert all(found[i] == "und" for i in (3, 4, 5, 8))
    assert all(found[i] != "und" for i in (1, 2, 6, 7, 9, 10, None))


def test_the_language_column_is_no_input(spark, sample):
    model = language.fit(sample)
    predict = language.predictor(spark, model)
    rows = sample.select("lang", predict("text").alias("p"))
    shuffled = {r.lang: r.p for r in rows.collect()}
    assert shuffled and all(p.lang_pred == lang for lang, p in shuffled.items())


def test_nothing_to_learn_from(spark, awkward, nothing):
    assert language.identify(nothing).collect() == []
    unknown = awkward.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in language.identify(unknown).collect()} == {("und", 0.0)}


def test_filter_keeps_rows_and_columns(spark, awkward):
    kept = language.identified(awkward, 0.0)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (r.doc_id for r in awkward.collect() if r.text and any(map(str.isalpha, r.text))), key=repr
    )


@pytest.mark.parametrize(
    "code, name", [("de", "germanic"), ("pt-BR", "romance"), ("xx", "=xx"), ("EN", "germanic")]
)
def test_families(code, name):
    assert language.family(code) == name


def test_long_texts_are_counted_whole():
    unit = "ab cd " * 10
    short, long = language.features(unit * 1000), language.features(unit * 60_000)
    assert abs(short - long).max() < 1e-2


def test_pairs_within_a_family_are_told_apart(spark):
    """Three languages of one family and one of another."""
    kinds = {
        "de": "der die das und ein schön weiß",
        "nl": "het een van ij oo goed zijn",
        "sv": "och ett är på å det som",
        "fr": "le la les des où été",
    }
    rows = [
        (i, " ".join(words.split()[(i + j) % 6] for j in range(5)), lang, "s", 1)
        for lang, words in kinds.items()
        for i in range(60)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = language.fit(docs)
    assert set(model.pairs) == {("de", "nl"), ("de", "sv"), ("nl", "sv")}
    assert set(model.families) == {"germanic", "romance"}
    assert all(model.predict(text)[0] == lang for _, text, lang, _, _ in rows)


def test_a_language_of_copies_is_learned(spark):
    """The share drawn is one of different texts, however often each is there."""
    rows = [(i, "the quick brown fox jumps over the lazy dog", "en") for i in range(4000)]
    rows += [(4000 + i, "der schnelle braune fuchs springt", "de") for i in range(3000)]
    rows += [(9000 + i, f"le renard brun numero {i} saute par dessus le chien", "fr") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify(docs).groupBy("lang_pred").count().collect()
    assert {r.lang_pred: r["count"] for r in found} == {"en": 4000, "de": 3000, "fr": 300}
    only = language.identify(docs.where("lang = 'en'")).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in only] == ["en"]


def test_languages_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    rows = [(i, f"the text number {i}", "en") for i in range(40)]
    rows += [(100 + i, f"der fuchs nummer {i}", "de") for i in range(30)]
    rows += [(200 + i, f"odd {i}", f"x{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(language.fit(docs).members["germanic"]) == {"de", "en"}
