import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from refsync.functions.changes import Watched
from refsync.functions.programs import merge_programs, program_list, programs_from_json
from refsync.operators.facilities import (
    FacilityRules,
    absent_facilities,
    actions,
    decide,
    match_existing,
    report_rows,
    with_program_ids,
)
from refsync.sources.schemas import PROGRAM_MAP

RULES = FacilityRules(fallback_zone="zf", fallback_type="tf")

RECORD = {
    "code": "c", "name": "n", "is_deleted": False, "is_operational": True,
    "municipality_id": "m", "municipality_name": "Muni", "type_id": "t", "type_name": "Type",
}
RECORD_SCHEMA = (
    "code string, name string, is_deleted boolean, is_operational boolean,"
    " municipality_id string, municipality_name string, type_id string, type_name string,"
    f" program_ids {PROGRAM_MAP}"
)
EXISTING = {
    "id": "f", "code": "c", "name": "n", "active": True, "enabled": True,
    "geographiczoneid": "m", "typeid": "t",
}
EXISTING_SCHEMA = (
    "id string, code string, name string, active boolean, enabled boolean,"
    f" geographiczoneid string, typeid string, supported_programs {PROGRAM_MAP}"
)


def record(spark, programs=None, **changes):
    row = (*{**RECORD, **changes}.values(), programs or {})
    return spark.createDataFrame([row], RECORD_SCHEMA)


def facility(spark, programs=None, **changes):
    row = (*{**EXISTING, **changes}.values(), programs or {})
    return spark.createDataFrame([row], EXISTING_SCHEMA)


def decided(spark, new=None, old=None, rules=RULES, **programs):
    left = record(spark, programs.get("new_programs"), **(new or {}))
    right = facility(spark, programs.get("old_programs"), **(old or {}))
    return decide(match_existing(left, right), rules)


@pytest.mark.parametrize(
    "deleted, code, action",
    [
        (True, "c", "disable"),
        (True, "other", None),
        (False, "other", "create"),
        (False, "c", "update"),
        (None, "c", None),
        (None, "other", None),
    ],
)
def test_split(spark, deleted, code, action):
    matched = match_existing(record(spark, is_deleted=deleted, code=code), facility(spark))
    assert matched.first().action == action


@pytest.mark.parametrize(
    "new, old, parity, null_safe",
    [
        ({}, {}, False, False),
        ({"name": "x"}, {}, True, True),
        ({"is_operational": False}, {}, True, True),
        ({}, {"enabled": False}, True, True),
        # A null on one side makes the whole comparison unknown.
        ({"name": "x", "is_operational": None}, {}, False, True),
        ({"name": "x"}, {"active": None}, False, True),
        ({"is_operational": None}, {"active": None}, False, False),
        # Zone and type: a new value counts, the fallback does not.
        ({"municipality_id": "m2"}, {}, True, True),
        ({"type_id": "t2"}, {}, True, True),
        ({"municipality_id": None}, {}, False, False),
        ({"municipality_id": None}, {"geographiczoneid": None}, False, False),
        ({"municipality_id": "zf"}, {}, False, False),
        ({"type_id": "tf"}, {"typeid": "t3"}, False, False),
    ],
)
def test_any_change(spark, new, old, parity, null_safe):
    assert decided(spark, new, old).first().any_change is parity
    rules = FacilityRules("zf", "tf", null_safe=True)
    assert decided(spark, new, old, rules).first().any_change is null_safe


def test_without_a_fallback_a_differing_zone_is_unknown(spark):
    rules = FacilityRules()
    assert decided(spark, {"municipality_id": "m2"}, rules=rules).first().any_change is False
    # An equal zone is known not to differ, whatever the fallback.
    assert decided(spark, {"name": "x"}, rules=rules).first().any_change is True
    assert (
        decided(spark, {"name": "x", "municipality_id": "m2"}, rules=rules).first().any_change
        is False
    )


def test_changed_fields(spark):
    row = decided(spark, {"name": "x", "municipality_id": "m2"}, {"enabled": False}).first()
    assert row.changed == ["name", "enabled", "openLmisAccessible", "geographicZone"]


def test_own_watched_fields(spark):
    rules = FacilityRules(watched=[Watched("active")])
    assert decided(spark, {"name": "x"}, rules=rules).first().any_change is False
    rules = FacilityRules(watched=())
    assert decided(spark, {"name": "x"}, rules=rules).first().any_change is False


def payload(df):
    return json.loads(
        actions(df).select(F.to_json("payload", {"ignoreNullFields": "false"})).first()[0]
    )


SUPPORT = {"a": ("1", None, True, "2024-01-01"), "c": ("7", True, False, None)}


def test_create_payload(spark):
    df = decided(
        spark, {"code": "new", "municipality_id": None, "type_id": None},
        new_programs={"a": ("1", True, False, None)},
    )
    assert payload(df) == {
        "id": None,
        "code": "new",
        "name": "n",
        "geographicZone": {"id": "zf"},
        "type": {"id": "tf"},
        "active": True,
        "enabled": True,
        "openLmisAccessible": True,
        "supportedPrograms": [],
    }


def test_update_payload_keeps_existing_programs(spark):
    added = {"a": ("9", True, False, None), "b": ("2", True, False, None)}
    df = decided(spark, {"name": "x"}, new_programs=added, old_programs=SUPPORT)
    sent = payload(df)
    assert sent["id"] == "f"
    assert [p["id"] for p in sent["supportedPrograms"]] == ["1", "7"]
    assert sent["supportedPrograms"][0] == {
        "id": "1",
        "supportActive": None,
        "supportLocallyFulfilled": True,
        "supportStartDate": "2024-01-01",
    }
    merged = FacilityRules("zf", "tf", programs="merged")
    df = decided(spark, {"name": "x"}, rules=merged, new_programs=added, old_programs=SUPPORT)
    assert [p["id"] for p in payload(df)["supportedPrograms"]] == ["1", "7", "2"]


def test_disable_payload(spark):
    sent = payload(decided(spark, {"is_deleted": True, "is_operational": True}))
    assert (sent["active"], sent["enabled"], sent["openLmisAccessible"]) == (True, False, False)
    # Already disabled: nothing to send.
    assert actions(decided(spark, {"is_deleted": True}, {"enabled": False})).count() == 0


def test_merge_keeps_existing_entries(spark):
    df = spark.createDataFrame(
        [({"a": ("1",) + (None,) * 3, "c": ("7",) + (None,) * 3},
          {"a": ("9",) + (None,) * 3, "b": ("2",) + (None,) * 3})],
        f"old {PROGRAM_MAP}, new {PROGRAM_MAP}",
    )
    merged = df.select(merge_programs(F.col("old"), F.col("new"))).first()[0]
    assert {code: support.id for code, support in merged.items()} == {"a": "1", "b": "2", "c": "7"}


def test_programs_from_json(spark):
    text = json.dumps(
        {
            "x": {"id": "1"},
            "y": {"id": "2", "supportActive": None, "supportLocallyFulfilled": True},
            "z": {"supportActive": True},
            "w": {"id": None, "supportStartDate": "2024-01-01", "supportActive": False},
        }
    )
    df = spark.createDataFrame([(text,), ("{}",)], "t string")
    listed = df.select(program_list(programs_from_json(F.col("t")))).collect()
    assert [[tuple(entry) for entry in row[0]] for row in listed] == [
        [("1", True, False, None), ("2", None, True, None), (None, False, False, "2024-01-01")],
        [],
    ]


@pytest.mark.parametrize("few", [True, False])
def test_program_ids_both_ways(spark, few):
    records = spark.createDataFrame(
        [
            (1, None), (2, []), (3, [("A", "a")]), (4, [("X", "x")]),
            (5, [("B", "b"), ("A", "a"), ("A2", "a"), ("X", "x"), ("N", None)]),
        ],
        "n int, services array<struct<name: string, code: string>>",
    )
    programs = spark.createDataFrame(
        [("1", "a"), ("2", "b"), ("3", None), ("0", "a")], "id string, code string"
    )
    found = with_program_ids(records, programs, few=few)
    ids = {row.n: {c: v.id for c, v in row.program_ids.items()} for row in found.collect()}
    assert ids == {1: {}, 2: {}, 3: {"a": "1"}, 4: {}, 5: {"a": "1", "b": "2"}}


def test_rules_name_the_programs_to_send():
    with pytest.raises(ValueError):
        FacilityRules(programs="all")


def test_absent_facilities(spark):
    existing = facility(spark).union(facility(spark, id="g", code="d")).union(
        facility(spark, id="h", code="e", enabled=False)
    )
    found = absent_facilities(existing, record(spark), RULES)
    assert rows(found, "action", "target_id", "code") == [("disable", "g", "d")]
    assert found.first().payload.enabled is False


def test_report_rows(spark):
    created = report_rows(decided(spark, {"code": "new", "municipality_name": None, "type_name": ""}))
    assert rows(created) == [("n", "new", "UNDEFINED", "UNDEFINED", "CREATE")]
    disabled = decided(spark, {"is_deleted": True})
    assert report_rows(disabled).count() == 0
    assert report_rows(disabled, with_disabled=True).first().operation == "DELETE"


def test_decisions_without_any_broadcast(spark):
    """Reference tables beyond the broadcast bounds give the same decisions."""
    from refsync.operators.reference import Small
    from refsync.plans.facility_import import ReferenceTables, decisions
    from test_reference import levels, programs, zones

    facilities = spark.createDataFrame(
        [(f"f{n}", f"N{n}", f"c{n}", True, n % 3 > 0, "t1", ["w1", "z0"][n % 2]) for n in range(9)],
        "id string, name string, code string, active boolean, enabled boolean, typeid string,"
        " geographiczoneid string",
    )
    supported = spark.createDataFrame(
        [(f"f{n}", ["g1", "g2", "lost"][n % 3], True, False, None) for n in range(9)],
        "facilityid string, programid string, active boolean, locallyfulfilled boolean,"
        " startdate date",
    )
    types = spark.createDataFrame([("t1", "Clinic")], "id string, name string")
    incoming = spark.createDataFrame(
        [
            (f"c{n}", f"N{n % 7}", ["Bela", "Rio"][n % 2], ["North", "South", "East"][n % 3],
             ["Clinic", None][n % 2], n % 5 == 0, n % 4 > 0, "1", "2",
             [("A", "AA"), ("B", "B"), ("N", "new")][: n % 4])
            for n in range(12)
        ],
        "code string, name string, municipality string, province string, category string,"
        " is_deleted boolean, is_operational boolean, latitude string, longitude string,"
        " services array<struct<name: string, code: string>>",
    )

    def run(**fixed):
        tables = ReferenceTables(
            facilities, supported, programs(spark), zones(spark), levels(spark), types
        )
        tables.__dict__.update(fixed)
        return decisions(incoming, tables, RULES).select(
            "code", "action", "any_change", "existing_id", "merged_programs",
            F.to_json("payload").alias("payload"), "changed",
        )

    usual = rows(run())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = run(small=Small(False, False, False, False, False))
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert rows(shuffled) == usual
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {row[1] for row in usual} == {"create", "update", "disable", None}
