import json
import time as clock
from datetime import datetime, timedelta, timezone

import pytest
from helpers import rows
from pyspark.sql import functions as F

from refsync.operators.changelog import (
    change_envelopes,
    change_outcomes,
    change_rejects,
    changes_since,
    last_success,
    last_sync,
    mapped_changes,
    retained_changes,
    sync_log_row,
)
from refsync.plans.export import due_changes
from refsync.sources.registry import CHANGE_LOG
from refsync.sources.schemas import DATA_CHANGES, SYNC_LOGS


def at(day, second=0):
    return datetime(2024, 1, day, 0, 0, second)


def change(number, table, time, data="{}", schema="fulfillment", operation="U"):
    return (number, schema, table, operation, time, data)


def log(number, resource, time, success=True):
    return (str(number), resource, "full", "S", time, success, None, None)


def frames(spark, changes, logs):
    return spark.createDataFrame(changes, DATA_CHANGES), spark.createDataFrame(logs, SYNC_LOGS)


def test_changes_must_be_strictly_newer_than_both_marks(spark):
    changes, logs = frames(
        spark,
        [
            change(1, "orders", at(5)),
            change(2, "orders", at(5, 1)),
            change(3, "order_line_items", at(3)),
            change(4, "order_line_items", at(2)),
            change(5, "order_line_items", at(2, 1)),
        ],
        [log(1, "fulfillment.orders", at(5)), log(2, CHANGE_LOG, at(2))],
    )
    assert rows(changes_since(changes, logs), "id") == [(2,), (3,), (5,)]


def test_without_any_log_everything_is_due(spark):
    changes, logs = frames(spark, [change(1, "orders", at(1))], [])
    assert rows(changes_since(changes, logs), "id") == [(1,)]
    due, sync_type = due_changes(changes, logs)
    assert (due.count(), sync_type) == (1, "full")


def test_failed_run_moves_the_mark_unless_told_otherwise(spark):
    changes, logs = frames(
        spark,
        [change(1, "orders", at(3))],
        [
            log(1, "fulfillment.orders", at(2)),
            log(2, "fulfillment.orders", at(4), success=False),
        ],
    )
    assert changes_since(changes, logs).count() == 0
    assert changes_since(changes, logs, successful_only=True).count() == 1
    assert rows(last_sync(logs)) == [("fulfillment.orders", at(4))]
    assert last_success(logs, "fulfillment.orders").first().id == "1"


def test_failed_sync_of_the_log_does_not_make_it_incremental(spark):
    changes, logs = frames(
        spark, [change(1, "orders", at(1))], [log(1, CHANGE_LOG, at(2), success=False)]
    )
    assert due_changes(changes, logs)[1] == "full"
    logs = logs.union(spark.createDataFrame([log(2, CHANGE_LOG, at(3))], SYNC_LOGS))
    due, sync_type = due_changes(changes, logs)
    assert (due.count(), sync_type) == (0, "change")


LEVEL = '{"id": "1", "code": "c", "levelnumber": 2, "name": null, "extra": [1]}'


def test_rows_are_mapped_with_their_json_types(spark):
    changes, _ = frames(
        spark,
        [change(1, "geographic_levels", at(1, 9), LEVEL, "referencedata", "I")],
        [],
    )
    row = change_envelopes(change_outcomes(mapped_changes(changes))).first()
    assert (row.table_name, row.operation) == ("geographic_level", "I")
    assert row.change_time == "2024-01-01T00:00:09Z"
    assert json.loads(row.row_data) == {"id": "1", "code": "c", "level": 2, "name": None}


def test_nested_and_large_values_survive(spark):
    data = json.dumps(
        {"id": 12345678901234567890, "code": {"a": [1, "é"]}, "levelnumber": 0.1, "name": True}
    )
    changes, _ = frames(
        spark, [change(1, "geographic_levels", at(1), data, "referencedata")], []
    )
    mapped = json.loads(change_envelopes(change_outcomes(mapped_changes(changes))).first().row_data)
    assert mapped == {
        "id": 12345678901234567890,
        "code": {"a": [1, "é"]},
        "level": 0.1,
        "name": True,
    }


def test_unmappable_changes_are_rejected_with_a_reason(spark):
    changes, _ = frames(
        spark,
        [
            change(1, "geographic_levels", at(1), LEVEL, "referencedata"),
            change(2, "geographic_levels", at(1), '{"id": "1", "code": "c"}', "referencedata"),
            change(3, "unknown", at(1), LEVEL, "referencedata"),
            change(4, "geographic_levels", at(1), "not json", "referencedata"),
            change(5, "geographic_levels", at(1), "[1]", "referencedata"),
            change(6, "geographic_levels", at(1), None, "referencedata"),
            change(7, "geographic_levels", at(1), LEVEL, None),
        ],
        [],
    )
    mapped = change_outcomes(mapped_changes(changes))
    assert rows(change_rejects(mapped), "id", "reason", "missing") == [
        (2, "missing_key", ["levelnumber", "name"]),
        (3, "unmapped_table", None),
        (4, "bad_json", None),
        (5, "bad_json", None),
        (6, "bad_json", None),
        (7, "unmapped_table", None),
    ]
    assert change_envelopes(mapped).count() == 1


def test_changes_after_the_snapshot_stay(spark):
    changes, _ = frames(
        spark, [change(1, "orders", at(2)), change(2, "orders", at(2, 1))], []
    )
    assert rows(retained_changes(changes, at(2).replace(tzinfo=timezone.utc)), "id") == [(2,)]


def test_log_row(spark):
    time = at(3).replace(tzinfo=timezone.utc)
    row = sync_log_row(spark, "fulfillment.orders", "full", False, time, "failed", "why")
    assert row.columns == spark.createDataFrame([], SYNC_LOGS).columns
    found = row.first()
    assert (found.operation, found.success) == ("S", False)
    assert found.timestamp.astimezone(timezone.utc) == time
    with pytest.raises(ValueError):
        sync_log_row(spark, "fulfillment.orders", "full", True, at(3))


def test_log_times_do_not_depend_on_the_drivers_zone(spark, monkeypatch):
    """East of UTC the wall clock is ahead; a mark taken from it would skip changes."""
    monkeypatch.setenv("TZ", "Asia/Tokyo")
    clock.tzset()
    try:
        now = datetime(2024, 1, 5, 21, tzinfo=timezone(timedelta(hours=9)))
        row = sync_log_row(spark, CHANGE_LOG, "change", True, now)
        stored = row.select(F.col("timestamp").cast("string")).first()[0]
        assert stored == "2024-01-05 12:00:00"
        changes = spark.range(2).select(
            "id",
            F.lit("fulfillment").alias("schema_name"),
            F.lit("orders").alias("table_name"),
            F.lit("U").alias("operation"),
            F.element_at(
                F.array(F.lit("2024-01-05 11:59:59"), F.lit("2024-01-05 12:00:01")),
                (F.col("id") + 1).cast("int"),
            ).cast("timestamp").alias("change_time"),
            F.lit("{}").alias("row_data"),
        )
        assert changes_since(changes, row).select("id").collect() == [(1,)]
    finally:
        monkeypatch.undo()
        clock.tzset()


def test_log_mark_reaches_the_scan(spark, tmp_path, capsys):
    changes, logs = frames(
        spark, [change(1, "orders", at(1))], [log(1, CHANGE_LOG, at(2))]
    )
    changes.write.parquet(str(tmp_path / "changes"))
    stored = spark.read.parquet(str(tmp_path / "changes"))
    changes_since(stored, logs).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(change_time,2024-01-02" in plan and "subquery" not in plan.lower()


def test_marks_of_known_tables_reach_the_scan(spark, tmp_path, capsys):
    """Literals per table in the filter, and no join."""
    changes, logs = frames(
        spark,
        [
            change(1, "orders", at(3)),
            change(2, "orders", at(3, 1)),
            change(3, "users", at(2, 1), schema="referencedata"),
            change(4, "orders", at(2, 1), schema="referencedata"),
            change(5, "not_mapped", at(2, 1)),
            change(6, None, at(2, 1)),
            change(7, "orders", at(2, 1), schema=None),
            change(8, "users", at(2), schema="referencedata"),
        ],
        [log(1, "fulfillment.orders", at(3)), log(2, CHANGE_LOG, at(2)),
         log(3, "fulfillment.lots", at(1))],
    )
    changes.write.parquet(str(tmp_path / "changes"))
    stored = spark.read.parquet(str(tmp_path / "changes"))
    known = logs.filter("resource <> 'fulfillment.lots'")
    due = changes_since(stored, known)
    assert rows(due, "id") == [(2,), (3,), (4,), (5,), (6,), (7,)]
    due.explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualTo(table_name,orders)" in pushed and "GreaterThan(change_time,2024-01-03" in pushed
    assert "Join" not in plan
    # A mark of a table that the registry does not name is joined.
    others = logs.unionByName(
        spark.createDataFrame([log(9, "fulfillment.not_mapped", at(9))], SYNC_LOGS)
    )
    assert rows(changes_since(stored, others), "id") == [(2,), (3,), (4,), (6,), (7,)]


def test_a_row_is_parsed_once(spark, capsys):
    changes, _ = frames(spark, [change(1, "orders", at(1))], [])
    change_envelopes(change_outcomes(mapped_changes(changes))).explain("extended")
    physical = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert physical.count("Generate explode") == 1
    assert "from_json" not in physical.replace("Generate explode", "\0").split("\0")[0]
