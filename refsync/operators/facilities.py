"""Incoming facility records against the facilities already known."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refsync.functions.changes import (
    Watched,
    any_change,
    changed_fields,
    differences,
    watched_fields,
)
from refsync.functions.programs import merge_programs, no_programs, program_list, support_entry
from refsync.functions.text import present_or
from refsync.operators.joins import fits_broadcast, lookup_join, measured
from refsync.operators.reference import (
    MAP_ROWS,
    MUNICIPALITY,
    PROVINCE,
    Small,
    facility_programs,
    zones_at,
)
from refsync.session import materialize
from refsync.sources.schemas import PROGRAM_MAP

CREATE_ACTION, UPDATE_ACTION, DISABLE_ACTION = "create", "update", "disable"

# How a report names the operations.
_OPERATION = {CREATE_ACTION: "CREATE", UPDATE_ACTION: "UPDATE", DISABLE_ACTION: "DELETE"}

_UNDEFINED = "UNDEFINED"


@dataclass(frozen=True)
class FacilityRules:
    """What to assume and what to count as a change.

    ``programs`` says which ones an update sends: the ``existing`` ones, or
    those ``merged`` with the programs of the record. ``watched`` replaces the
    fields that are compared.
    """

    fallback_zone: str | None = None
    fallback_type: str | None = None
    null_safe: bool = False
    programs: str = "existing"
    watched: Sequence[Watched] | None = None

    def __post_init__(self) -> None:
        if self.programs not in ("existing", "merged"):
            raise ValueError("programs must be 'existing' or 'merged'")

    def compared(self) -> Sequence[Watched]:
        if self.watched is not None:
            return self.watched
        return watched_fields(self.fallback_zone, self.fallback_type)


def enrich(
    records: DataFrame,
    hierarchy: DataFrame,
    types: DataFrame,
    programs: DataFrame,
    by_province: bool = False,
    small: Small | None = None,
) -> DataFrame:
    """Valid records with the zones, type and programs their names refer to.

    A municipality is looked up by name alone, so one that exists in several
    provinces repeats the record; ``by_province`` looks up both names instead.
    """
    municipalities = zones_at(hierarchy, MUNICIPALITY).select(
        F.col("name").alias("municipality"),
        F.col("id").alias("municipality_id"),
        F.col("name").alias("municipality_name"),
        *([F.col("parentname").alias("province")] if by_province else []),
    )
    provinces = zones_at(hierarchy, PROVINCE).select(
        F.col("name").alias("province"), F.col("id").alias("province_id")
    )
    categories = types.select(
        F.col("name").alias("category"),
        F.col("id").alias("type_id"),
        F.col("name").alias("type_name"),
    )
    if small:
        fits = [small.zones, small.zones, small.types]
    else:
        fits = fits_broadcast(municipalities, provinces, categories)

    place = ["municipality", "province"] if by_province else ["municipality"]
    found = lookup_join(records, municipalities, place, small=fits[0])
    found = lookup_join(found, provinces, "province", small=fits[1])
    found = lookup_join(found, categories, "category", small=fits[2])
    return with_program_ids(found, programs, few=small.program_map if small else None)


def with_program_ids(
    records: DataFrame, programs: DataFrame, few: bool | None = None
) -> DataFrame:
    """Add ``program_ids``: the services whose code is a known program, as a map.

    A few programs become one constant map, and no record moves. Beyond that,
    the distinct service lists are resolved by a join and joined back.
    """
    codes = programs.filter(F.col("code").isNotNull()).select("code", "id")
    if few is None:
        few = measured(codes)[0].rows <= MAP_ROWS
    wanted = F.array_sort(
        F.array_distinct(F.coalesce(F.transform("services", lambda s: s["code"]), F.array()))
    ).cast("array<string>")
    # One id per code, the largest if a code occurs twice.
    ids = codes.groupBy("code").agg(F.max("id").alias("id"))
    if few:
        table = ids.agg(F.map_from_entries(F.collect_list(F.struct("code", "id"))))
        known = F.filter(
            wanted, lambda code: code.isNotNull() & F.map_contains_key(F.col("_ids"), code)
        )
        entries = F.transform(
            known, lambda code: F.struct(code, support_entry(F.element_at(F.col("_ids"), code)))
        )
        return (
            records.withColumn("_ids", table.scalar())
            .withColumn("program_ids", F.map_from_entries(entries).cast(PROGRAM_MAP))
            .drop("_ids")
        )
    keyed = records.withColumn("_wanted", wanted)
    lists = keyed.select("_wanted").distinct()
    # Most records share a few lists. Stored, so that the join below sees two plain
    # tables and the re-plan can split the partition of a hot list.
    resolved = materialize(
        lists.select("_wanted", F.explode("_wanted").alias("code"))
        .join(ids, "code")
        .groupBy("_wanted")
        .agg(
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct("code", support_entry(F.col("id")))))
            ).alias("program_ids")
        ),
        "service-lists",
    )
    return (
        keyed.join(resolved, "_wanted", "left")
        .withColumn("program_ids", F.coalesce("program_ids", no_programs()).cast(PROGRAM_MAP))
        .drop("_wanted")
    )


def match_existing(records: DataFrame, existing: DataFrame) -> DataFrame:
    """Records beside the facility that has their code, and the action that follows.

    Deleted records nobody knows, and records that do not say whether they are
    deleted, get no action.
    """
    known = existing.select(
        "code",
        F.col("id").alias("existing_id"),
        F.col("name").alias("existing_name"),
        F.col("active").alias("existing_active"),
        F.col("enabled").alias("existing_enabled"),
        F.col("geographiczoneid").alias("existing_zone"),
        F.col("typeid").alias("existing_type"),
        F.col("supported_programs").alias("existing_programs"),
    )
    exists = F.col("existing_id").isNotNull()
    deleted = F.col("is_deleted")
    action = (
        F.when(deleted & exists, DISABLE_ACTION)
        .when(~deleted & ~exists, CREATE_ACTION)
        .when(~deleted & exists, UPDATE_ACTION)
    )
    return records.join(known, "code", "left").withColumn("action", action)


def payload(
    facility_id: Column,
    name: Column,
    code: Column,
    zone: Column,
    facility_type: Column,
    programs: Column,
    active: Column,
    enabled: Column,
    rules: FacilityRules,
) -> Column:
    """The facility as the receiving system takes it."""

    def reference(value: Column, fallback: str | None) -> Column:
        return F.struct(present_or(value, F.lit(fallback).cast("string")).alias("id"))

    return F.struct(
        facility_id.alias("id"),
        code.alias("code"),
        name.alias("name"),
        reference(zone, rules.fallback_zone).alias("geographicZone"),
        reference(facility_type, rules.fallback_type).alias("type"),
        active.alias("active"),
        enabled.alias("enabled"),
        enabled.alias("openLmisAccessible"),
        program_list(programs).alias("supportedPrograms"),
    )


def decide(matched: DataFrame, rules: FacilityRules = FacilityRules()) -> DataFrame:
    """Payload, change flag and changed fields of every record.

    Creations count as changed, records without an action never do. Updates and
    disablings are compared with the facility as it is: with its own code, its
    programs, and its enabled flag also for accessibility.
    """
    acting = F.col("action").isNotNull()
    creating = F.col("action") == CREATE_ACTION
    merged = merge_programs(
        F.coalesce("existing_programs", no_programs()), F.col("program_ids")
    )
    sent = merged if rules.programs == "merged" else F.col("existing_programs")

    new = payload(
        F.col("existing_id"),
        F.col("name"),
        F.col("code"),
        F.coalesce("municipality_id", "existing_zone"),
        F.coalesce("type_id", "existing_type"),
        F.when(creating, no_programs()).otherwise(sent),
        F.col("is_operational"),
        F.col("action") != DISABLE_ACTION,
        rules,
    )
    old = payload(
        F.col("existing_id"),
        F.col("existing_name"),
        F.col("code"),
        F.col("existing_zone"),
        F.col("existing_type"),
        F.col("existing_programs"),
        F.col("existing_active"),
        F.col("existing_enabled"),
        rules,
    )
    both = matched.withColumn("merged_programs", merged).withColumns(
        {"payload": new, "old_payload": old}
    )
    found = differences(
        F.col("payload"), F.col("old_payload"), rules.compared(), rules.null_safe
    )
    differs, fields = any_change(found), changed_fields(found)
    nothing = F.array().cast("array<string>")
    return both.withColumns(
        {
            "any_change": F.when(creating, True).when(acting, differs).otherwise(False),
            "changed": F.when(acting & ~creating, fields).otherwise(nothing),
        }
    )


def absent_facilities(
    existing: DataFrame, records: DataFrame, rules: FacilityRules = FacilityRules()
) -> DataFrame:
    """Decisions that disable enabled facilities which no record mentions."""
    listed = records.select("code").distinct()
    gone = existing.filter("enabled").join(listed, "code", "left_anti")
    return gone.select(
        F.lit(DISABLE_ACTION).alias("action"),
        F.col("id").alias("target_id"),
        "code",
        payload(
            F.col("id"),
            F.col("name"),
            F.col("code"),
            F.col("geographiczoneid"),
            F.col("typeid"),
            F.col("supported_programs"),
            F.col("active"),
            F.lit(False),
            rules,
        ).alias("payload"),
    )


def actions(decided: DataFrame, *extra: str) -> DataFrame:
    """``(action, target_id, code, payload)`` of everything that has to be sent."""
    return decided.filter("any_change").select(
        "action", F.col("existing_id").alias("target_id"), "code", "payload", *extra
    )


def with_facility_programs(
    acts: DataFrame,
    supported: DataFrame,
    programs: DataFrame,
    rules: FacilityRules = FacilityRules(),
    small: Small | None = None,
) -> DataFrame:
    """Put the programs of the facilities into actions decided without them.

    Only programs of facilities that are acted on are read into maps, which
    spares the others where few facilities change. Creations have no programs
    and are not joined.
    """
    creating = F.col("action") == CREATE_ACTION
    acting = acts.filter(~creating)
    ids = acting.select(F.col("target_id").alias("facilityid"))
    needed = lookup_join(supported, ids, "facilityid", "left_semi")
    maps = facility_programs(needed, programs, small).withColumnRenamed("facilityid", "target_id")
    own = F.coalesce("programs", no_programs())
    sent = merge_programs(own, F.col("program_ids")) if rules.programs == "merged" else own
    filled = acting.join(maps, "target_id", "left").withColumn(
        "payload", F.col("payload").withField("supportedPrograms", program_list(sent))
    )
    return acts.filter(creating).unionByName(filled.select(*acts.columns))


def report_rows(decided: DataFrame, with_disabled: bool = False) -> DataFrame:
    """One line per created or updated facility; disabled ones on request."""
    operation = F.element_at(
        F.create_map(*[F.lit(x) for pair in _OPERATION.items() for x in pair]), F.col("action")
    )
    reported = decided.filter("any_change")
    if not with_disabled:
        reported = reported.filter(F.col("action") != DISABLE_ACTION)
    return reported.select(
        "name",
        "code",
        present_or(F.col("municipality_name"), F.lit(_UNDEFINED)).alias("municipality"),
        present_or(F.col("type_name"), F.lit(_UNDEFINED)).alias("type"),
        operation.alias("operation"),
    )
