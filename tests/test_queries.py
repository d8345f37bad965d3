import importlib.util
from pathlib import Path

import pytest

import workload.queries
from helpers import DUCK_TYPES, duck, sorted_rows

FOLDER = "/root/testdata/sf0.001"


def _entry():
    path = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


ENTRY = _entry()
# The training-data queries have tests of their own.
QUERIES, SQL = ENTRY.WORKLOAD, ENTRY.statements()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    result = ENTRY.entry(spark)
    assert result.columns == ["action", "target_id", "code", "payload"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = con.execute(SQL[name])
    columns = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    assert sorted(columns) == sorted(result.columns)
    assert {n: DUCK_TYPES.get(t, t) for n, t in result.dtypes} == types
    assert sorted_rows(result.collect(), result.columns) == sorted_rows(
        cursor.fetchall(), columns
    )


def test_logged_changes_are_written_by_all_tasks_and_are_one_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(
        workload.queries, "new_shared_path", lambda _, label: str(tmp_path / label)
    )
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    orders.repartition(3).write.parquet(str(tmp_path / "in/orders.parquet"))
    found = QUERIES["changelog_stream_log"](spark, str(tmp_path / "in"))
    assert found.count() == 1
    assert len(list((tmp_path / "log").glob("part-*"))) == 3
