import pytest
from helpers import rows

from refsync.operators.changelog import (
    change_envelopes,
    change_outcomes,
    change_rejects,
    changes_since,
    mapped_changes,
)
from refsync.sources.incoming import stream_facility_records
from refsync.sources.registry import CHANGE_LOG
from refsync.sources.schemas import DATA_CHANGES, FACILITY_RECORD, SYNC_LOGS
from refsync.plans import facility_import
from refsync.plans.facility_import import ReferenceTables
from refsync.streaming import changes as changes_stream
from refsync.streaming import imports, read_change_stream, run_change_stream, run_import_stream
from test_changelog import LEVEL, at, change, log
from test_reference import levels, programs, zones


def level_change(number, day):
    return change(number, "geographic_levels", at(day), LEVEL, "referencedata")


def append(spark, path, *changes):
    spark.createDataFrame(changes, DATA_CHANGES).write.mode("append").parquet(path)


def test_stream_equals_batch_and_goes_on_where_it_stopped(spark, tmp_path):
    path, out, logs = (str(tmp_path / n) for n in ("changes", "out", "log"))
    append(spark, path, *[level_change(n, n) for n in range(1, 9)], change(9, "nope", at(9)))
    marks = spark.createDataFrame([log(1, CHANGE_LOG, at(3))], SYNC_LOGS)

    def written():
        return spark.read.parquet(f"{out}/changes")

    def run():
        stream = read_change_stream(spark, path)
        run_change_stream(
            stream, f"{out}/changes", f"{out}/checkpoint", marks, logs
        ).awaitTermination()
        return rows(change_envelopes(written()), "id", "change_time", "row_data")

    first = run()
    due = changes_since(spark.read.parquet(path), marks)
    batch = change_envelopes(change_outcomes(mapped_changes(due)))
    assert first == rows(batch, "id", "change_time", "row_data")
    assert len(first) == 5
    assert rows(change_rejects(written()), "id", "reason") == [(9, "unmapped_table")]

    assert run() == first
    append(spark, path, level_change(20, 20))
    assert len(run()) == 6
    assert spark.read.schema(SYNC_LOGS).parquet(logs).count() == 2


def test_stream_in_bounded_batches(spark, tmp_path):
    path, out = str(tmp_path / "changes"), str(tmp_path / "out")
    for n in range(1, 4):
        append(spark, path, level_change(n, n))
    stream = read_change_stream(spark, path, max_bytes=1)
    run_change_stream(stream, f"{out}/changes", f"{out}/checkpoint").awaitTermination()
    found = spark.read.parquet(f"{out}/changes")
    assert found.select("batch").distinct().count() == 3
    assert found.count() == 3


def test_import_stream(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    facilities = spark.createDataFrame(
        [("f1", "One", "c1", True, True, "t1", "w1")],
        "id string, name string, code string, active boolean, enabled boolean, typeid string,"
        " geographiczoneid string",
    )
    supported = spark.createDataFrame(
        [], "facilityid string, programid string, active boolean, locallyfulfilled boolean,"
        " startdate date",
    )
    types = spark.createDataFrame([("t1", "Clinic", 1)], "id string, name string, displayorder int")
    tables = ReferenceTables(
        facilities, supported, programs(spark), zones(spark), levels(spark), types
    )

    def run():
        stream = stream_facility_records(spark, str(landing))
        assert stream.columns[:-1] == spark.createDataFrame([], FACILITY_RECORD).columns
        run_import_stream(stream, lambda: tables, f"{out}/imports", f"{out}/checkpoint")
        found = spark.read.parquet(f"{out}/imports/actions")
        return rows(found, "action", "code")

    line = (
        '{"code": "%s", "name": "%s", "municipality": "Bela", "province": "North",'
        ' "category": "Clinic", "is_deleted": false, "is_operational": true}\n'
    )
    (landing / "1.json").write_text(line % ("c7", "Seven"))
    assert run() == [("create", "c7"), ("create", "c7")]  # two zones share the name
    (landing / "2.json").write_text(line % ("c1", "Renamed"))
    assert run() == [("create", "c7")] * 2 + [("update", "c1")]
    assert run() == [("create", "c7")] * 2 + [("update", "c1")]


def import_tables(spark):
    facilities = spark.createDataFrame(
        [(f"f{n}", f"Name {n}", f"c{n}", True, True, "t1", "w1") for n in (1, 2, 3)],
        "id string, name string, code string, active boolean, enabled boolean, typeid string,"
        " geographiczoneid string",
    )
    supported = spark.createDataFrame(
        [], "facilityid string, programid string, active boolean, locallyfulfilled boolean,"
        " startdate date",
    )
    types = spark.createDataFrame([("t1", "Clinic", 1)], "id string, name string, displayorder int")
    return ReferenceTables(
        facilities, supported, programs(spark), zones(spark), levels(spark), types
    )


LINE = (
    '{"code": "%s", "name": "%s", "municipality": "Nowhere", "province": "Neverland",'
    ' "category": "Post A", "is_deleted": false, "is_operational": true,'
    ' "services": [{"name": "New", "code": "new"}]}\n'
)
EXPECTED = [
    ("create", "c9", None),
    ("create_municipality", "gz-nowhere-m", None),
    ("create_program", "new", None),
    ("create_province", "gz-neverland-p", None),
    ("create_type", "post a", None),
    ("disable", "c3", "f3"),
    ("update", "c1", "f1"),
    ("update", "c2", "f2"),
]


@pytest.mark.parametrize("max_bytes", [1, 1 << 30])
def test_a_delivery_is_decided_once_however_it_is_cut(spark, tmp_path, max_bytes):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    for code in ("c1", "c2", "c9"):
        (landing / f"{code}.json").write_text(LINE % (code, f"Renamed {code}"))
    tables = import_tables(spark)

    def run():
        return run_import_stream(
            stream_facility_records(spark, str(landing), max_bytes),
            lambda: tables, f"{out}/imports", f"{out}/checkpoint",
            disable_missing=True, supplement=True,
        )

    assert run() == "delivery=0"
    written = lambda: rows(
        spark.read.parquet(f"{out}/imports/actions"), "action", "code", "target_id"
    )
    assert written() == EXPECTED
    assert run() is None
    assert written() == EXPECTED


def test_an_import_that_fails_halfway_leaves_each_action_once(spark, tmp_path, monkeypatch):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    for code in ("c1", "c2"):
        (landing / f"{code}.json").write_text(LINE % (code, f"Renamed {code}"))
    tables = import_tables(spark)

    def run():
        return run_import_stream(
            stream_facility_records(spark, str(landing), 1),
            lambda: tables, f"{out}/imports", f"{out}/checkpoint",
            disable_missing=True, supplement=True,
        )

    with monkeypatch.context() as broken:
        # The actions are written, what follows is not.
        broken.setattr(facility_import, "import_rejects", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    (landing / "c9.json").write_text(LINE % ("c9", "Renamed c9"))
    assert run() == "delivery=0"
    found = rows(spark.read.parquet(f"{out}/imports/actions"), "action", "code", "target_id")
    assert found == EXPECTED


def test_a_batch_that_fails_while_staging_is_staged_again(spark, tmp_path, monkeypatch):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    for code in ("c1", "c2", "c9"):
        (landing / f"{code}.json").write_text(LINE % (code, f"Renamed {code}"))
    tables, calls = import_tables(spark), []
    write = imports.write_rows

    def run():
        return run_import_stream(
            stream_facility_records(spark, str(landing), 1),
            lambda: tables, f"{out}/imports", f"{out}/checkpoint",
            disable_missing=True, supplement=True,
        )

    def flaky(df, path):
        write(df, path)
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(imports, "write_rows", flaky)
        with pytest.raises(Exception, match="lost"):
            run()
    assert run() == "delivery=0"
    found = rows(spark.read.parquet(f"{out}/imports/actions"), "action", "code", "target_id")
    assert found == EXPECTED


def test_stream_log_has_the_latest_change_and_failures(spark, tmp_path, monkeypatch):
    path, out, logs = (str(tmp_path / n) for n in ("changes", "out", "log"))
    append(spark, path, level_change(1, 3), level_change(2, 7))

    def run():
        run_change_stream(
            read_change_stream(spark, path), f"{out}/changes", f"{out}/checkpoint", log=logs
        ).awaitTermination()

    with monkeypatch.context() as broken:
        long = "x" * 5000
        broken.setattr(changes_stream, "write_changes", lambda *_: _fail(long))
        with pytest.raises(Exception, match="xxx"):
            run()
    failed = spark.read.schema(SYNC_LOGS).parquet(logs).collect()
    assert [row.success for row in failed] == [False] and long in failed[0].details
    run()
    run()
    found = spark.read.schema(SYNC_LOGS).parquet(logs)
    assert rows(found, "resource", "success", "timestamp") == [(CHANGE_LOG, True, at(7))]
    # Nothing that arrived meanwhile is below the mark.
    append(spark, path, level_change(3, 8))
    due = changes_since(spark.read.parquet(path), found.drop("run"))
    assert rows(due, "id") == [(3,)]


def _fail(message):
    raise RuntimeError(message)
