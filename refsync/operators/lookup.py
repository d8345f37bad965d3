"""Lookups of single rows and small sets by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refsync.operators.joins import fits_broadcast, lookup_join


def by_id(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col("id") == value).limit(1)


def by_code(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col("code") == value).limit(1)


def by_codes(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows whose code is among ``codes``, however many those are."""
    return lookup_join(df, codes.select("code"), "code", "left_semi")


def supported_program(supported: DataFrame, facility_id: str, program_id: str) -> DataFrame:
    return supported.filter(
        (F.col("facilityid") == facility_id) & (F.col("programid") == program_id)
    ).limit(1)


def supported_programs(
    supported: DataFrame,
    programs: DataFrame,
    facilities: DataFrame,
    program_code: str | None = None,
    facility_code: str | None = None,
) -> DataFrame:
    """Supported programs of a program, of a facility, or of both, by code.

    Keys are filtered first, so only the rows of one code take part.
    """
    if program_code is not None:
        wanted = programs.filter(F.col("code") == program_code)
        supported = lookup_join(
            supported, wanted.select(F.col("id").alias("programid")), "programid", "inner"
        )
    if facility_code is not None:
        wanted = facilities.filter(F.col("code") == facility_code)
        supported = lookup_join(
            supported, wanted.select(F.col("id").alias("facilityid")), "facilityid", "inner"
        )
    return supported


def facility_details(
    facilities: DataFrame, zones: DataFrame, operators: DataFrame, types: DataFrame
) -> DataFrame:
    """Facilities with the rows their zone, operator and type refer to."""
    attached = [
        ("geographiczoneid", "geographic_zone", zones),
        ("operatedbyid", "operated_by", operators),
        ("typeid", "type", types),
    ]
    sides = [
        table.select(F.col("id").alias(key), F.struct(*table.columns).alias(name))
        for key, name, table in attached
    ]
    result = facilities
    for (key, _, _), side, small in zip(attached, sides, fits_broadcast(*sides)):
        result = lookup_join(result, side, key, small=small)
    return result
