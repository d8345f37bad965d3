"""Reference tables joined into the shapes a sync compares against."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refsync.functions.programs import no_programs, ordered_map
from refsync.operators.joins import fits_broadcast, lookup_join, measured
from refsync.sources.schemas import PROGRAM_MAP, PROGRAM_SUPPORT

# Level numbers of the zone hierarchy.
COUNTRY, PROVINCE, MUNICIPALITY = 1, 2, 3

# Beyond this many programs, service codes are joined instead of searched.
MAP_ROWS = 1000

_UNKNOWN_PROGRAM = "undefined"


@dataclass(frozen=True)
class Small:
    """Which reference tables were found to fit a broadcast.

    What is filtered out of a small table, or projected from it, is small too.
    ``program_map`` says that the programs are few enough to be searched one by
    one, as a lookup in a map value does.
    """

    zones: bool
    levels: bool
    types: bool
    programs: bool
    program_map: bool


def measure(zones: DataFrame, levels: DataFrame, types: DataFrame, programs: DataFrame) -> Small:
    """Check all tables in one job, by the columns that lookups take from them."""
    sizes = measured(
        zones.select("id", "name", "levelid", "parentid"),
        levels.select("id", "levelnumber"),
        types.select("id", "name"),
        programs.select("id", "code"),
    )
    fits = [size.broadcastable() for size in sizes]
    return Small(*fits, program_map=sizes[3].rows <= MAP_ROWS)


def zone_hierarchy(
    zones: DataFrame, levels: DataFrame, small: Small | None = None
) -> DataFrame:
    """Zones with their level number and the name of their parent."""
    numbers = levels.select(F.col("id").alias("levelid"), "levelnumber")
    parents = zones.select(F.col("id").alias("parentid"), F.col("name").alias("parentname"))
    fits = (small.levels, small.zones) if small else fits_broadcast(numbers, parents)
    named = lookup_join(zones, numbers, "levelid", small=fits[0])
    named = lookup_join(named, parents, "parentid", small=fits[1])
    return named.select(*zones.columns, "levelnumber", "parentname")


def zones_at(hierarchy: DataFrame, level: int) -> DataFrame:
    return hierarchy.filter(F.col("levelnumber") == level)


def level_id(levels: DataFrame, number: int) -> Column:
    """The id of a level as a scalar; the smallest if several share the number."""
    return levels.filter(F.col("levelnumber") == number).agg(F.min("id")).scalar()


def root_zone_id(hierarchy: DataFrame) -> Column:
    return zones_at(hierarchy, COUNTRY).agg(F.min("id")).scalar()


def facility_programs(
    supported: DataFrame, programs: DataFrame, small: Small | None = None
) -> DataFrame:
    """``(facilityid, programs)``: the supported programs of each facility as a map.

    Rows of one facility and code are combined before they are collected, so a
    group holds at most one entry per program. A facility without any known
    program gets an empty map; beside known ones, unknown programs share the
    key ``undefined``.
    """
    codes = programs.select(F.col("id").alias("programid"), "code")
    # The id is that of the program found, null if there is none.
    found = codes.withColumn("id", F.col("programid"))
    fits = small.programs if small else None
    entries = lookup_join(supported, found, "programid", small=fits).select(
        "facilityid",
        F.coalesce("code", F.lit(_UNKNOWN_PROGRAM)).alias("code"),
        F.col("code").isNotNull().alias("known"),
        F.struct(
            "id",
            F.col("active").alias("supportActive"),
            F.col("locallyfulfilled").alias("supportLocallyFulfilled"),
            F.col("startdate").cast("string").alias("supportStartDate"),
        )
        .cast(PROGRAM_SUPPORT)
        .alias("support"),
    )
    unique = entries.groupBy("facilityid", "code").agg(
        F.max("support").alias("support"), F.max("known").alias("known")
    )
    grouped = unique.groupBy("facilityid").agg(
        F.max("known").alias("known"),
        F.collect_list(F.struct("code", "support")).alias("entries"),
    )
    programs_map = F.when(F.col("known"), ordered_map(F.col("entries"))).otherwise(no_programs())
    return grouped.select("facilityid", programs_map.alias("programs"))


def placed_facilities(
    facilities: DataFrame, zones: DataFrame, small: Small | None = None
) -> DataFrame:
    """Known facilities with the parent of their own zone, without programs.

    The parent is reported because facilities are assigned to wards, while the
    records to compare with name municipalities.
    """
    parents = zones.select(
        F.col("id").alias("geographiczoneid"), F.col("parentid").alias("_parent")
    )
    known = zones.select(F.col("id").alias("_parent"), F.col("id").alias("zone"))
    fits = small.zones if small else fits_broadcast(parents)[0]
    placed = lookup_join(facilities, parents, "geographiczoneid", small=fits)
    placed = lookup_join(placed, known, "_parent", small=fits)
    return placed.select(
        "id",
        "name",
        "code",
        "active",
        "enabled",
        "typeid",
        F.col("zone").alias("geographiczoneid"),
        no_programs().alias("supported_programs"),
    )


def existing_facilities(
    facilities: DataFrame,
    supported: DataFrame,
    programs: DataFrame,
    zones: DataFrame,
    small: Small | None = None,
) -> DataFrame:
    """Known facilities, placed and with their programs."""
    placed = placed_facilities(facilities, zones, small)
    maps = facility_programs(supported, programs, small).withColumnRenamed("facilityid", "id")
    return placed.join(maps, "id", "left").select(
        *[name for name in placed.columns if name != "supported_programs"],
        F.coalesce("programs", no_programs()).cast(PROGRAM_MAP).alias("supported_programs"),
    )


def contact_details(
    role_rights: DataFrame, role_assignments: DataFrame, contacts: DataFrame
) -> DataFrame:
    """Contacts of every user with every right given by one of the user's roles."""
    held = role_assignments.select("roleid", F.col("userid").alias("referencedatauserid"))
    rights = role_rights.select("roleid", "rightid")
    return (
        lookup_join(held, rights, "roleid", "inner")
        .join(contacts, "referencedatauserid", "inner")
        .select("rightid", *contacts.columns)
    )
