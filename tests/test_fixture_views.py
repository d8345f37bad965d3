"""Counts known for the stand-in views of FIXTURES.md at scale 0.01."""

import re
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from refsync.functions.text import is_coordinate
from refsync.operators.changelog import changes_since
from refsync.operators.facilities import match_existing
from refsync.operators.validate import rejects, valid_records
from refsync.plans.facility_import import ReferenceTables

FOLDER = "/root/testdata/sf0.01"
TEXT = (Path(__file__).resolve().parent.parent / "FIXTURES.md").read_text()
VIEWS = re.findall(r"```sql\n-- D\d+ (\w+)\n(.*?)```", TEXT, re.S)


@pytest.fixture(scope="module")
def views(spark):
    for name in ("region", "nation", "customer", "orders", "events"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").createOrReplaceTempView(name)
    for name, sql in VIEWS:
        spark.sql(sql).createOrReplaceTempView(name)
    return spark.table


def test_all_views_are_there():
    assert len(VIEWS) == 10


def test_split(views):
    supported = views("fx_supported").withColumn("startdate", F.lit(None).cast("date"))
    tables = ReferenceTables(
        views("fx_existing"), supported, views("fx_programs"), views("fx_zones"),
        views("fx_levels"), views("fx_types"),
    )
    matched = match_existing(valid_records(views("fx_incoming")), tables.existing())
    assert rows(matched.groupBy("action").count()) == [
        ("create", 403),
        ("disable", 47),
        ("update", 812),
        (None, 83),
    ]


def test_rejects_and_kept_make_the_input(views):
    incoming = views("fx_incoming")
    dropped = rejects(incoming).filter("reason = 'missing_mandatory'").count()
    assert dropped + valid_records(incoming).count() == 1500
    assert incoming.filter(~is_coordinate(F.col("latitude"))).count() == 332


def test_changes_due(views):
    due = changes_since(views("fx_changes"), views("fx_sync_logs"))
    counts = due.groupBy("table_name").count()
    assert sorted(row["count"] for row in counts.collect()) == [21, 73, 120, 1818, 1820]
