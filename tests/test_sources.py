import re

import pytest
from pyspark.sql import functions as F

from refsync.session import shared_dir
from refsync.operators.validate import rejects, valid_records
from refsync.sources.incoming import read_facility_records
from refsync.sources.tables import CatalogSource, FileSource, JdbcSource, uuid_splits


@pytest.mark.parametrize("partitions", [1, 2, 7, 64])
def test_uuid_splits_cover_every_row_once(spark, partitions):
    ids = spark.range(2000).select(F.expr("uuid()").alias("id")).union(
        spark.sql(
            "select * from values ('00000000-0000-0000-0000-000000000000'),"
            " ('ffffffff-ffff-ffff-ffff-ffffffffffff'), (null)"
        )
    )
    splits = uuid_splits("id", partitions)
    assert len(splits) == partitions
    hits = sum((F.coalesce(F.expr(s), F.lit(False)).cast("int") for s in splits), F.lit(0))
    assert [row[0] for row in ids.select(hits.alias("h")).distinct().collect()] == [1]


def test_uuid_splits_use_whole_uuids():
    for split in uuid_splits("id", 16):
        for bound in re.findall("'([^']*)'", split):
            assert re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", bound)
    with pytest.raises(ValueError):
        uuid_splits("id", 0)


def test_file_and_catalog_sources(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "referencedata.lots"))
    assert FileSource(spark, str(tmp_path)).table("referencedata.lots").count() == 3
    declared = FileSource(spark, str(tmp_path), schemas={"referencedata.lots": "id bigint, x int"})
    assert declared.table("referencedata.lots").columns == ["id", "x"]
    spark.range(2).createOrReplaceTempView("stored_lots")
    source = CatalogSource(spark, {"referencedata.lots": "stored_lots"})
    assert source.table("referencedata.lots").count() == 2


def test_records_keep_the_declared_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"code": "1", "services": [{"name": "n", "code": "c"}], "unknown": 1}\n{"name": "x"}\n'
    )
    df = read_facility_records(spark, str(tmp_path))
    assert len(df.columns) == 17 and df.columns[-1] == "raw_record"
    found = {row.code: row for row in df.collect()}
    assert found["1"].services[0].code == "c"
    assert found[None].is_deleted is None


def test_unreadable_records_keep_their_text(spark, tmp_path):
    lines = [
        '{"code": "ok", "name": "n", "municipality": "m", "province": "p", "latitude": "1",'
        ' "longitude": "2"}',
        '{"code": "type", "name": "n", "municipality": "m", "province": "p", "is_deleted": "true"}',
        '{"code": "broken", ',
        "[1, 2]",
        '"text"',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    found = read_facility_records(spark, str(tmp_path))
    assert [row.code for row in valid_records(found).collect()] == ["ok"]
    rejected = {row.raw: row.reason for row in rejects(found).collect()}
    assert rejected == {
        lines[1]: "bad_type", lines[2]: "bad_json", lines[3]: "bad_json", lines[4]: "bad_json"
    }


def test_records_in_one_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n {"code": "1"},\n {"code": "2"}\n]')
    assert read_facility_records(spark, str(tmp_path), multi_line=True).count() == 2


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class RecordedReader:
    """Stands in for a reader, as the tests start no database."""

    def __init__(self):
        self.asked = {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def option(self, key, value):
        self.asked[key] = value
        return self

    def options(self, **given):
        self.asked.update(given)
        return self

    def load(self):
        return self.asked

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "dbtable": table, "predicates": predicates, **properties}


class RecordedSession:
    @property
    def read(self):
        return RecordedReader()


def test_jdbc_reads():
    splits = {"fulfillment.orders": uuid_splits("id", 4)}
    source = JdbcSource(RecordedSession(), "jdbc:x", {"user": "u", "driver": "d"}, splits)
    common = {"url": "jdbc:x", "user": "u", "driver": "d"}
    jdbc = {"format": "jdbc", **common}
    assert source.table("referencedata.lots") == {**jdbc, "dbtable": "referencedata.lots"}
    assert source.query("select 1") == {**jdbc, "query": "select 1"}
    split = source.table("fulfillment.orders")
    assert (split["dbtable"], len(split["predicates"])) == ("fulfillment.orders", 4)
    assert source.ranged("t", "id", 1, 9, 3) == {
        **jdbc,
        "dbtable": "t",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "9",
        "numPartitions": "3",
    }
