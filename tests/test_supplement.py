from helpers import rows

from refsync.operators.reference import zone_hierarchy
from refsync.operators.supplement import (
    missing_municipalities,
    missing_programs,
    missing_provinces,
    missing_types,
    records_missing_zone,
)
from test_reference import levels, programs, records, zones


def places(spark):
    return spark.createDataFrame(
        [
            ("c1", "a", "Bela", "North"),
            ("c2", "b", "Água", "North"),
            ("c3", "c", "Água", "North"),
            ("c4", "d", "Rio", "Évora"),
            ("c5", "e", "Água", "Évora"),
        ],
        "code string, name string, municipality string, province string",
    )


def test_missing_zones(spark):
    hierarchy = zone_hierarchy(zones(spark), levels(spark))
    provinces = missing_provinces(places(spark), hierarchy, levels(spark))
    assert rows(provinces, "code", "name", "level.id", "parent.id") == [
        ("gz-evora-p", "Évora", "l2", "z0")
    ]
    found = missing_municipalities(places(spark), hierarchy, levels(spark), provinces)
    assert rows(found, "code", "level.id", "parent.id", "parent_code", "reason") == [
        ("gz-agua-m", "l3", "p1", None, None),
        ("gz-agua-m", "l3", None, "gz-evora-p", None),
        ("gz-rio-m", "l3", None, "gz-evora-p", None),
    ]
    alone = missing_municipalities(places(spark), hierarchy, levels(spark))
    assert rows(alone, "name", "reason") == [
        ("Rio", "unknown_province"),
        ("Água", "unknown_province"),
        ("Água", None),
    ]
    assert records_missing_zone(places(spark), hierarchy, 3).count() == 4


def test_missing_types_continue_the_display_order(spark):
    types = spark.createDataFrame([("A", 3), ("B", 12)], "name string, displayorder int")
    named = spark.createDataFrame(
        [("A",), ("Zé",), ("Zé",), ("C",), (None,)], "category string"
    )
    assert rows(missing_types(named, types)) == [("c", "C", 13, True), ("ze", "Zé", 14, True)]
    assert rows(missing_types(named, types.limit(0)), "displayOrder") == [(1,), (2,), (3,)]


def test_missing_programs(spark):
    assert rows(missing_programs(records(spark), programs(spark))) == [("new", "N", "N", True)]
