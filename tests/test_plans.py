import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from helpers import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from refsync.functions.changes import watched_fields
from refsync.operators.envelope import map_resource
from refsync.operators.facilities import FacilityRules
from refsync.plans.export import export_changes, export_full
from refsync.plans.facility_import import ReferenceTables, run_import
from refsync.plans.runs import committed_runs, read_run, run_rows
from refsync.sinks import write_envelopes
from refsync.sources.change_log import ChangeLog
from refsync.sources.registry import CHANGE_LOG, RESOURCES
from refsync.sources.schemas import DATA_CHANGES, SYNC_LOGS
from refsync.sources.tables import FileSource
from test_changelog import LEVEL, at, change
from test_reference import levels, programs, zones

AT = datetime(2024, 6, 1, tzinfo=timezone.utc)
SPECS = RESOURCES[:3]


def source(spark, root, skip=()):
    for spec in SPECS:
        if spec.name not in skip:
            columns = ", ".join(f"cast(id as string) as {name}" for name in spec.sources)
            spark.range(3).selectExpr(*columns.split(", ")).write.parquet(f"{root}/{spec.name}")
    return FileSource(spark, str(root))


def sent(spark, out):
    return spark.read.json(f"{out}/run=20240601T000000.000000")


def log(spark, path):
    return spark.read.schema(SYNC_LOGS).parquet(path)


def test_full_export_and_its_repetition(spark, tmp_path):
    out, logs = str(tmp_path / "out"), str(tmp_path / "log")
    tables = source(spark, tmp_path / "in")
    for _ in range(2):
        export_full(spark, tables, out, logs, AT, SPECS)
    counts = sent(spark, out).groupBy("table_name").count()
    assert rows(counts) == [("facility", 3), ("geographic_level", 3), ("geographic_zone", 3)]
    levels = sent(spark, out).filter("table_name = 'geographic_level'")
    assert rows(levels, "row_data.level") == [("0",), ("1",), ("2",)]
    assert log(spark, logs).filter("success and sync_type = 'full'").count() == 3


def test_full_export_stops_at_the_first_failure(spark, tmp_path):
    out, logs = str(tmp_path / "out"), str(tmp_path / "log")
    tables = source(spark, tmp_path / "in", skip=["referencedata.geographic_zones"])
    changes = ChangeLog(spark, str(tmp_path / "changes"))
    changes.append(spark.createDataFrame([change(1, "orders", at(1))], DATA_CHANGES))
    with pytest.raises(AnalysisException):
        export_full(spark, tables, out, logs, AT, SPECS, changes)
    found = rows(log(spark, logs), "resource", "success")
    assert found == [
        ("referencedata.geographic_levels", True),
        ("referencedata.geographic_zones", False),
    ]
    # Nobody sees what was written before the failure, and nothing is taken out of the log.
    assert committed_runs(spark, out) == []
    with pytest.raises(LookupError):
        read_run(spark, out)
    assert changes.read().count() == 1

    # The cause removed, the same run completes.
    spec = SPECS[1]
    spark.range(3).selectExpr(*(f"cast(id as string) as {n}" for n in spec.sources)).write.parquet(
        f"{tmp_path}/in/{spec.name}"
    )
    export_full(spark, tables, out, logs, AT, SPECS, changes)
    assert read_run(spark, out).count() == 9
    assert run_rows(spark, out, committed_runs(spark, out)[0]) == {s.target: 3 for s in SPECS}
    assert changes.read().count() == 0


def test_failures_among_parallel_writes_keep_the_order(spark, tmp_path):
    """The first in registry order is reported, whichever came to an end first."""
    tables = source(spark, tmp_path / "in", skip=[SPECS[0].name, SPECS[2].name])
    for parallel in (1, 3):
        logs = str(tmp_path / f"log{parallel}")
        with pytest.raises(AnalysisException, match="geographic_levels"):
            export_full(spark, tables, str(tmp_path / "out"), logs, AT, SPECS, parallel=parallel)
        assert rows(log(spark, logs), "resource", "success") == [(SPECS[0].name, False)]


def test_complete_run_is_not_written_again(spark, tmp_path):
    out, logs = str(tmp_path / "out"), str(tmp_path / "log")
    tables = source(spark, tmp_path / "in")
    export_full(spark, tables, out, logs, AT, SPECS)
    before = {f: f.stat().st_mtime_ns for f in Path(out).rglob("*.json")}
    export_full(spark, tables, out, logs, AT, SPECS)
    assert {f: f.stat().st_mtime_ns for f in Path(out).rglob("*.json")} == before


def test_exported_files_are_compressed_and_bounded(spark, tmp_path):
    """Names and constants repeat in every row, so whole exports would not fit a disk as they are."""
    table = spark.range(0, 5000, numPartitions=1).selectExpr(
        *(f"cast(id as string) as {name}" for name in SPECS[0].sources)
    )
    out = tmp_path / "out"
    envelopes = map_resource(table, SPECS[0], AT)
    assert write_envelopes(envelopes, str(out), "1", "level", rows_per_file=2000) == 5000
    files = [f for f in out.rglob("part-*")]
    assert len(files) == 3 and all(f.name.endswith(".json.gz") for f in files)
    read = spark.read.json(f"{out}/run=1")
    texts = sum(len(line[0]) + 1 for line in read.select(F.to_json(F.struct("*"))).collect())
    assert sum(f.stat().st_size for f in files) * 4 < texts
    assert read.count() == read.select("row_data.name").distinct().count() == 5000


def test_latest_complete_run_is_read(spark, tmp_path):
    out, logs = str(tmp_path / "out"), str(tmp_path / "log")
    tables = source(spark, tmp_path / "in")
    for day in (1, 3, 2):
        export_full(spark, tables, out, logs, AT.replace(day=day), SPECS[:1])
    assert {r.change_time for r in read_run(spark, out).collect()} == {"2024-06-03T00:00:00Z"}


def test_full_export_clears_what_it_covers(spark, tmp_path):
    changes = ChangeLog(spark, str(tmp_path / "changes"))
    changes.append(
        spark.createDataFrame(
            [change(1, "orders", datetime(2024, 5, 31)), change(2, "orders", datetime(2024, 6, 2))],
            DATA_CHANGES,
        )
    )
    tables, out, logs = source(spark, tmp_path / "in"), tmp_path / "out", str(tmp_path / "log")
    export_full(spark, tables, str(out), logs, AT, SPECS, changes)
    assert rows(changes.read(), "id") == [(2,)]
    # What follows sends the later change only.
    export_changes(spark, changes, log(spark, logs), str(tmp_path / "sent"), logs, AT.replace(day=5))
    written = spark.read.parquet(str(tmp_path / "sent/run=20240605T000000.000000"))
    assert rows(written, "change_id") == [(2,)]


def test_change_export_then_incremental(spark, tmp_path):
    out, logs = str(tmp_path / "out"), str(tmp_path / "log")
    changes = spark.createDataFrame(
        [
            change(1, "geographic_levels", at(1), LEVEL, "referencedata"),
            change(2, "nowhere", at(1), LEVEL, "referencedata"),
        ],
        DATA_CHANGES,
    )
    empty = spark.createDataFrame([], SYNC_LOGS)
    export_changes(spark, changes, empty, out, logs, AT)
    found = spark.read.parquet(f"{out}/run=20240601T000000.000000")
    assert rows(found, "status", "table_name", "change_id", "reason") == [
        ("rejected", "unmapped", 2, "unmapped_table"),
        ("sent", "geographic_level", 1, None),
    ]
    assert rows(log(spark, logs), "resource", "sync_type") == [(CHANGE_LOG, "full")]

    later = changes.union(
        spark.createDataFrame(
            [change(3, "geographic_levels", datetime(2024, 7, 1), LEVEL, "referencedata")],
            DATA_CHANGES,
        )
    )
    second = datetime(2024, 7, 2, tzinfo=timezone.utc)
    export_changes(spark, later, log(spark, logs), out, logs, second)
    again = spark.read.parquet(f"{out}/run=20240702T000000.000000")
    assert rows(again, "change_time") == [("2024-07-01T00:00:00Z",)]
    assert rows(log(spark, logs), "sync_type") == [("change",), ("full",)]


def import_tables(spark):
    facilities = spark.createDataFrame(
        [("f1", "One", "c1", True, True, "t1", "w1"), ("f2", "Two", "c2", True, True, "t1", "w1")],
        "id string, name string, code string, active boolean, enabled boolean, typeid string,"
        " geographiczoneid string",
    )
    supported = spark.createDataFrame(
        [("f1", "g1", True, False, None), ("f2", "g2", None, True, None)],
        "facilityid string, programid string, active boolean, locallyfulfilled boolean,"
        " startdate date",
    )
    types = spark.createDataFrame(
        [("t1", "Clinic", 1)], "id string, name string, displayorder int"
    )
    return ReferenceTables(
        facilities, supported, programs(spark), zones(spark), levels(spark), types
    )


def import_records(spark):
    return spark.createDataFrame(
        [
            ("c1", "One new", "Ward", "North", "Clinic", False, True, "1", "2", [("B", "B")]),
            ("c9", "Nine", "Rio", "Évora", "Post", False, True, "x", "2", [("S", "s")]),
            ("c8", "", "Rio", "Évora", "Post", False, True, "1", "2", None),
        ],
        "code string, name string, municipality string, province string, category string,"
        " is_deleted boolean, is_operational boolean, latitude string, longitude string,"
        " services array<struct<name: string, code: string>>",
    )


def test_import_run(spark, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        run_import(
            import_records(spark), import_tables(spark), out, disable_missing=True, supplement=True
        )
    found = spark.read.parquet(f"{out}/actions")
    assert rows(found, "action", "code", "target_id") == [
        ("create", "c9", None),
        ("create_municipality", "gz-rio-m", None),
        ("create_municipality", "gz-ward-m", None),
        ("create_program", "s", None),
        ("create_province", "gz-evora-p", None),
        ("create_type", "post", None),
        ("disable", "c2", "f2"),
        ("update", "c1", "f1"),
    ]
    assert rows(spark.read.parquet(f"{out}/rejects"), "code", "reason") == [
        ("c1", "unknown_municipality"),
        ("c8", "missing_mandatory"),
        ("c9", "bad_coordinate"),
        ("c9", "unknown_municipality"),
        ("c9", "unknown_province"),
    ]
    assert spark.read.parquet(f"{out}/report").first().lines == 2
    metrics = dict(tuple(row) for row in spark.read.parquet(f"{out}/metrics").collect())
    assert (metrics["incoming"], metrics["invalid"], metrics["create"]) == (3, 1, 1)
    # As written: the absent facility and the created reference rows too.
    assert (metrics["disable"], metrics["create_municipality"], metrics["create_type"]) == (1, 2, 1)


@pytest.mark.parametrize(
    "programs_sent, expected", [("existing", ["g1"]), ("merged", ["g1", "g2"])]
)
def test_programs_are_sent_whichever_way_they_are_read(spark, tmp_path, programs_sent, expected):
    """With the fields watched by default programs are read after the decision, else before."""
    found = []
    for name, watched in (("late", None), ("early", watched_fields())):
        rules = FacilityRules(programs=programs_sent, watched=watched)
        out = str(tmp_path / name)
        run_import(import_records(spark), import_tables(spark), out, rules, disable_missing=True)
        found.append(rows(spark.read.parquet(f"{out}/actions"), "action", "code", "payload"))
    assert found[0] == found[1]
    sent = {code: json.loads(payload)["supportedPrograms"] for _, code, payload in found[0]}
    assert [program["id"] for program in sent["c1"]] == expected
    assert sent["c2"] == [
        {
            "id": "g2",
            "supportActive": None,
            "supportLocallyFulfilled": True,
            "supportStartDate": None,
        }
    ]
    assert sent["c9"] == []


def test_errors_are_logged_whole_and_runs_never_share_a_folder(spark, tmp_path):
    class Broken:
        def table(self, name):
            raise RuntimeError("x" * 5000)

    logs = str(tmp_path / "log")
    for at in (AT, AT + timedelta(milliseconds=1)):
        with pytest.raises(RuntimeError):
            export_full(spark, Broken(), str(tmp_path / "out"), logs, at, SPECS)
    found = log(spark, logs).collect()
    assert [len(row.details) for row in found] == [5000, 5000]
    assert len({row.timestamp for row in found}) == 2


def test_a_run_needs_a_time_with_a_zone(spark, tmp_path):
    with pytest.raises(ValueError):
        export_full(
            spark, source(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log"),
            datetime(2024, 6, 1), SPECS,
        )


def test_deliveries_pair_pages_with_recipients(spark, tmp_path):
    out = str(tmp_path / "out")
    addresses = spark.createDataFrame([("a@x",), ("b@x",)], "email string")
    run_import(import_records(spark), import_tables(spark), out, addresses=addresses)
    assert rows(spark.read.parquet(f"{out}/deliveries")) == [("a@x", 1), ("b@x", 1)]


def test_records_are_computed_once_however_many_results_read_them(spark, tmp_path):
    computed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    records = import_records(spark)
    records = records.mapInArrow(counted, records.schema)
    run_import(
        records, import_tables(spark), str(tmp_path / "out"), disable_missing=True,
        supplement=True, digests=str(tmp_path / "digests"),
    )
    assert computed.value == 3
