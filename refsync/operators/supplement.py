"""Reference rows that incoming records name and that do not exist yet.

Names are reduced to distinct ones before anything is joined, so a name that
many records share is looked up once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refsync.functions.text import fold, zone_code
from refsync.operators.joins import lookup_join
from refsync.operators.numbering import running_total
from refsync.operators.reference import (
    MUNICIPALITY,
    PROVINCE,
    Small,
    level_id,
    root_zone_id,
    zones_at,
)
from refsync.session import materialize

_LEVEL_COLUMN = {PROVINCE: "province", MUNICIPALITY: "municipality"}


def missing_names(
    records: DataFrame, hierarchy: DataFrame, level: int, small: Small | None = None
) -> DataFrame:
    """Distinct zone names (with their province) that no zone of the level has."""
    column = _LEVEL_COLUMN[level]
    named = records.select(*dict.fromkeys([column, "province"])).distinct()
    known = zones_at(hierarchy, level).select(F.col("name").alias(column))
    return lookup_join(named, known, column, "left_anti", small=small and small.zones)


def records_missing_zone(
    records: DataFrame, hierarchy: DataFrame, level: int, small: Small | None = None
) -> DataFrame:
    """The records behind ``missing_names``, for a report."""
    column = _LEVEL_COLUMN[level]
    known = zones_at(hierarchy, level).select(F.col("name").alias(column))
    return (
        lookup_join(records, known, column, "left_anti", small=small and small.zones)
        .select("code", "name", column, "province")
        .distinct()
    )


def missing_provinces(
    records: DataFrame, hierarchy: DataFrame, levels: DataFrame, small: Small | None = None
) -> DataFrame:
    """Provinces to create below the country."""
    name = F.col("province")
    return missing_names(records, hierarchy, PROVINCE, small).select(
        *_zone(
            zone_code(name, "province"),
            name,
            level_id(levels, PROVINCE),
            root_zone_id(hierarchy),
        )
    )


def missing_municipalities(
    records: DataFrame,
    hierarchy: DataFrame,
    levels: DataFrame,
    new_provinces: DataFrame | None = None,
    small: Small | None = None,
) -> DataFrame:
    """Municipalities to create below their province.

    A province created in the same run has no id yet; ``parent_code`` refers to
    it by code. ``reason`` marks a municipality whose province is unknown.
    """
    name = F.col("municipality")
    parents = (
        zones_at(hierarchy, PROVINCE)
        .groupBy(F.col("name").alias("province"))
        .agg(F.min("id").alias("_parent"))
        .withColumn("_parent_code", F.lit(None).cast("string"))
    )
    if new_provinces is not None:
        # No province is both known and new.
        created = new_provinces.select(
            F.col("name").alias("province"),
            F.lit(None).cast("string").alias("_parent"),
            F.col("code").alias("_parent_code"),
        )
        parents = parents.unionByName(created)
    # A province may hold a large share of the names. With both sides stored, the re-plan
    # can split its partition.
    placed = materialize(missing_names(records, hierarchy, MUNICIPALITY, small), "placed-names")
    fits = False if small and not small.zones else None
    placed = lookup_join(placed, materialize(parents, "parents"), "province", small=fits)
    parent_code = F.col("_parent_code")
    unknown = F.col("_parent").isNull() & F.col("parent_code").isNull()
    return (
        placed.withColumn("parent_code", parent_code)
        .select(
            *_zone(
                zone_code(name, "municipality"),
                name,
                level_id(levels, MUNICIPALITY),
                F.col("_parent"),
            ),
            "parent_code",
            F.when(unknown, "unknown_province").alias("reason"),
        )
        .distinct()
    )


def _zone(code: Column, name: Column, level: Column, parent: Column) -> list[Column]:
    return [
        code.alias("code"),
        name.alias("name"),
        F.struct(level.alias("id")).alias("level"),
        F.struct(parent.alias("id")).alias("parent"),
    ]


def missing_types(
    records: DataFrame, types: DataFrame, small: Small | None = None
) -> DataFrame:
    """Facility types to create, displayed after the existing ones.

    Records without a category name no type.
    """
    named = records.select("category").filter(F.col("category").isNotNull()).distinct()
    known = types.select(F.col("name").alias("category"))
    missing = lookup_join(named, known, "category", "left_anti", small=small and small.types)
    highest = types.agg(F.coalesce(F.max("displayorder"), F.lit(0))).scalar()
    numbered = running_total(missing, ["category"], column="position")
    return numbered.select(
        fold(F.col("category")).alias("code"),
        F.col("category").alias("name"),
        (highest + F.col("position") + 1).cast("int").alias("displayOrder"),
        F.lit(True).alias("active"),
    )


def missing_programs(
    records: DataFrame, programs: DataFrame, small: Small | None = None
) -> DataFrame:
    """Programs to create for services whose code is unknown."""
    services = records.select(F.explode("services").alias("service"))
    named = services.select("service.name", "service.code").distinct()
    known = programs.select("code")
    missing = lookup_join(named, known, "code", "left_anti", small=small and small.programs)
    return missing.select(
        "code", "name", F.col("name").alias("description"), F.lit(True).alias("active")
    )
