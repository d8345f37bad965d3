import importlib.util
import re
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from refsync.llm import toxicity
from refsync.llm.common import materialize
from refsync.llm.oracle import statements
from refsync.llm.queries import QUERIES
from test_mixing import targets, words
from test_packing import check as check_packing
from test_simhash import shingles

FOLDER = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[2]


def ids(rows):
    return Counter(r.doc_id for r in rows)


@pytest.fixture(scope="module")
def stages(spark):
    """Input and rows of every stage over the small documents and some planted ones."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    clean = docs.where("length(text) > 1500").orderBy("doc_id").limit(5)
    planted = (
        clean.withColumn("doc_id", F.col("doc_id") + 100_000)
        .unionAll(
            clean.withColumn("doc_id", F.col("doc_id") + 200_000).withColumn(
                "text", F.concat("text", F.lit(" one more end"))
            )
        )
        .unionAll(
            clean.limit(1)
            .withColumn("doc_id", F.lit(300_000).cast("long"))
            .withColumn("text", F.lit("123 456 -- !"))
        )
    )
    docs = materialize(docs.unionAll(planted), "documents")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        result = materialize(stage(spark, docs, FOLDER), name)
        found.append((name, docs, result))
        docs = result
    return {name: (before, after) for name, before, after in found}


def test_all_but_the_last_return_the_columns_of_documents(stages):
    names = list(stages)
    assert len(names) == 5
    for name in names[:-1]:
        before, after = stages[name]
        assert after.columns == before.columns


def test_language_stage_drops_what_has_no_letter_and_nothing_clean(stages):
    before, after = (s.collect() for s in stages["language_id"])
    expected = [r for r in before if r.text and any(map(str.isalpha, r.text))]
    assert ids(after) == ids(expected)


def test_toxicity_stage_drops_what_scores_high(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = toxicity.toxicity(before, labels).collect()
    assert ids(after.collect()) == Counter(r.doc_id for r in scored if not r.predicted)


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before, after = (s.collect() for s in stages["near_duplicates"])
    sets = {r.doc_id: frozenset(shingles(r.text, 5)) for r in before}
    kept = set(ids(after))
    near = defaultdict(set)
    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and (x == y or len(x & y) >= 0.8 * len(x | y)):
                near[a].add(b)
                near[b].add(a)
    # Nothing goes without a near-duplicate, and exact copies and small edits never stay both.
    assert all(near[doc_id] for doc_id in sets if doc_id not in kept)
    for a, others in near.items():
        for b in others:
            if len(sets[a] & sets[b]) >= 0.92 * len(sets[a] | sets[b]):
                assert not (a in kept and b in kept)
    assert not any(doc_id >= 100_000 for doc_id in kept)


def test_mix_stage_repeats_documents(stages):
    before, after = (s.collect() for s in stages["source_mix"])
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += words(r.text)
    for r in after:
        taken[r.source] += words(r.text)
    assert max(ids(after).values()) <= 2
    wanted = targets(sizes)
    assert sum(abs(taken[s] - wanted[s]) for s in sizes) < 0.05 * sum(wanted.values())


def test_packing_stage_packs_every_copy(stages):
    before, after = (s.collect() for s in stages["packing"])
    check_packing([(r.doc_id, r.text) for r in before], after)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER), name)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, FOLDER)
    assert Counter(map(tuple, run.select(*columns).collect())) == Counter(
        map(tuple, docs.select(*columns).collect())
    )


def _entry():
    spec = importlib.util.spec_from_file_location("entry", REPO / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_queries_are_registered():
    entry = _entry()
    names = set(entry.queries())
    assert {re.match(r"op\d+", n)[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(statements()) <= set(entry.oracle_sql())


def test_the_rest_works_without_this_package(tmp_path):
    """A copy of the repository without the package still imports."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'refsync.llm') or name.startswith('refsync.llm.'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op') for n in e.queries())\n"
        "assert 'pipeline' not in e.queries() and e.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_equals_sql(spark, name):
    from helpers import duck, sorted_rows

    result = QUERIES[name](spark, FOLDER)
    cursor = duck(FOLDER).execute(statements()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert sorted_rows(result.collect(), result.columns) == sorted_rows(cursor.fetchall(), columns)
