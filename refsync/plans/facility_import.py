"""The facility import: from delivered records to action, reject and report tables."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from refsync.functions.programs import no_programs
from refsync.functions.text import is_coordinate
from refsync.operators.digests import DigestStore, compared, merged, record_digests
from refsync.operators.facilities import (
    CREATE_ACTION,
    DISABLE_ACTION,
    UPDATE_ACTION,
    FacilityRules,
    absent_facilities,
    actions,
    decide,
    enrich,
    match_existing,
    report_rows,
    with_facility_programs,
)
from refsync.operators.reference import (
    MUNICIPALITY,
    PROVINCE,
    Small,
    existing_facilities,
    measure,
    placed_facilities,
    zone_hierarchy,
)
from refsync.operators.report import deliveries, recipients, report_pages
from refsync.operators.supplement import (
    missing_municipalities,
    missing_programs,
    missing_provinces,
    missing_types,
    records_missing_zone,
)
from refsync.operators.validate import is_valid, rejects, valid_records
from refsync.session import configure, materialize, scratch_tables
from refsync.sinks import write_actions, write_rows
from refsync.sources.known import store_by_key
from refsync.sources.tables import TableSource

# The kinds of action that a run may write.
ACTIONS = (
    CREATE_ACTION,
    UPDATE_ACTION,
    DISABLE_ACTION,
    "create_province",
    "create_municipality",
    "create_type",
    "create_program",
)

# What later steps need of a decided record.
_DECIDED = (
    "action",
    "existing_id",
    "code",
    "name",
    "municipality_name",
    "type_name",
    "payload",
    "program_ids",
    "any_change",
    "changed",
)


@dataclass(frozen=True)
class ReferenceTables:
    """What a delivery is compared with.

    ``known`` are the facilities as ``placed`` gives them, stored by their code
    (``with_known``); an import then joins them where they lie.
    """

    facilities: DataFrame
    supported_programs: DataFrame
    programs: DataFrame
    zones: DataFrame
    levels: DataFrame
    types: DataFrame
    known: DataFrame | None = None

    @classmethod
    def read(cls, source: TableSource) -> ReferenceTables:
        return cls(
            facilities=source.table("referencedata.facilities"),
            supported_programs=source.table("referencedata.supported_programs"),
            programs=source.table("referencedata.programs"),
            zones=source.table("referencedata.geographic_zones"),
            levels=source.table("referencedata.geographic_levels"),
            types=source.table("referencedata.facility_types"),
        )

    @cached_property
    def small(self) -> Small:
        """Measured once for all joins of a run."""
        return measure(self.zones, self.levels, self.types, self.programs)

    def hierarchy(self) -> DataFrame:
        return zone_hierarchy(self.zones, self.levels, self.small)

    def placed(self) -> DataFrame:
        if self.known is not None:
            return self.known
        return placed_facilities(self.facilities, self.zones, self.small)

    def with_known(self, name: str, path: str, buckets: int | None = None) -> ReferenceTables:
        """The same tables, with the facilities stored by code as table ``name`` below ``path``.

        To be repeated when facilities or zones have changed.
        """
        made = replace(self, known=store_by_key(self.placed(), name, path, "code", buckets))
        made.__dict__["small"] = self.small
        return made

    def existing(self) -> DataFrame:
        return existing_facilities(
            self.facilities, self.supported_programs, self.programs, self.zones, self.small
        )


def report_recipients(source: TableSource, right_id: str) -> DataFrame:
    """Addresses of the users who hold a right, for the report of a run."""
    return recipients(
        source.table("referencedata.role_rights"),
        source.table("referencedata.role_assignments"),
        source.table("notification.user_contact_details"),
        right_id,
    )


def enriched(
    records: DataFrame, tables: ReferenceTables, by_province: bool = False
) -> DataFrame:
    """Valid records with what their names refer to."""
    return enrich(
        valid_records(records),
        tables.hierarchy(),
        tables.types,
        tables.programs,
        by_province,
        tables.small,
    )


def decisions(
    records: DataFrame,
    tables: ReferenceTables,
    rules: FacilityRules = FacilityRules(),
    by_province: bool = False,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Validated, enriched and matched records with what to do about them."""
    if existing is None:
        existing = tables.existing()
    return decide(match_existing(enriched(records, tables, by_province), existing), rules)


def supplement_actions(records: DataFrame, tables: ReferenceTables) -> DataFrame:
    """Creations of the zones, types and programs that valid records name."""
    valid, hierarchy, small = valid_records(records), tables.hierarchy(), tables.small
    # Read by the municipalities as well.
    provinces = materialize(
        missing_provinces(valid, hierarchy, tables.levels, small), "new-provinces"
    )
    municipalities = missing_municipalities(valid, hierarchy, tables.levels, provinces, small)
    created = {
        "create_province": provinces,
        "create_municipality": municipalities.filter(F.col("reason").isNull()).drop("reason"),
        "create_type": missing_types(valid, tables.types, small),
        "create_program": missing_programs(valid, tables.programs, small),
    }
    rows = [
        missing.select(
            F.lit(action).alias("action"),
            F.lit(None).cast("string").alias("target_id"),
            "code",
            F.to_json(F.struct(*missing.columns), {"ignoreNullFields": "false"}).alias("payload"),
        )
        for action, missing in created.items()
    ]
    result = rows[0]
    for more in rows[1:]:
        result = result.unionByName(more)
    return result


def import_rejects(
    records: DataFrame, tables: ReferenceTables, checked: DataFrame | None = None
) -> DataFrame:
    """What the checks found, and the valid records whose zone no table has.

    ``unknown_province`` and ``unknown_municipality`` records stay in the sync.
    ``checked`` takes the place of the records where these are only checked.
    """
    valid, hierarchy = valid_records(records), tables.hierarchy()
    found = rejects(records if checked is None else checked)
    for level, column in ((PROVINCE, "province"), (MUNICIPALITY, "municipality")):
        unknown = records_missing_zone(valid, hierarchy, level, tables.small).select(
            "code",
            F.lit(f"unknown_{column}").alias("reason"),
            F.array(F.lit(column)).alias("columns"),
            F.lit(None).cast("string").alias("raw"),
        )
        found = found.unionByName(unknown)
    return found


def record_gates(records: DataFrame) -> list[Column]:
    """Counts over the records as they come."""
    valid = is_valid(records)
    bad = ~is_coordinate(F.col("latitude")) | ~is_coordinate(F.col("longitude"))
    return [
        F.count(F.lit(1)).alias("incoming"),
        F.count_if(~valid).alias("invalid"),
        F.count_if(valid).alias("valid"),
        F.count_if(valid & bad).alias("bad_coordinate"),
    ]


def decision_gates() -> list[Column]:
    """Counts over decided records; ``matched`` above ``valid`` tells what ambiguous names added."""
    changed = F.col("any_change")
    action = F.col("action")
    return [
        F.count(F.lit(1)).alias("matched"),
        F.count_if(action.isNull()).alias("no_action"),
        F.count_if(action == CREATE_ACTION).alias("create"),
        F.count_if(action == UPDATE_ACTION).alias("update_candidates"),
        F.count_if((action == UPDATE_ACTION) & changed).alias("update"),
        F.count_if(action == DISABLE_ACTION).alias("disable_candidates"),
        F.count_if((action == DISABLE_ACTION) & changed).alias("disable"),
    ]


def action_gates() -> list[Column]:
    """Counts over the actions that are sent, all kinds of them."""
    return [F.count_if(F.col("action") == kind).alias(kind) for kind in ACTIONS]


def run_metrics(records: DataFrame, decided: DataFrame) -> DataFrame:
    """Counts of one run, as ``(metric, value)``; one pass over each input."""
    seen = records.agg(*record_gates(records))
    return _listed(seen).unionByName(_listed(decided.agg(*decision_gates())))


def _listed(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "metric", "value")


def _metrics(spark: SparkSession, *observed: Observation) -> DataFrame:
    """What was counted while writing; where two count the same, the later one holds."""
    counts = {name: value for seen in observed for name, value in seen.get.items()}
    return spark.createDataFrame(list(counts.items()), "metric string, value long")


def run_import(
    records: DataFrame,
    tables: ReferenceTables,
    out: str,
    rules: FacilityRules = FacilityRules(),
    by_province: bool = False,
    disable_missing: bool = False,
    supplement: bool = False,
    report: bool = True,
    stage: bool = False,
    part: str | None = None,
    addresses: DataFrame | None = None,
    digests: str | None = None,
    columnar: bool = False,
) -> None:
    """Write ``decisions``, ``actions``, ``rejects``, ``report`` and ``metrics`` below ``out``.

    ``records`` are a whole delivery: what it does not mention counts as absent.
    ``part``, such as ``delivery=3``, names the partition of each table that this
    run writes; without it the run replaces the tables. Several results read the
    records, so whatever they are computed from is computed once, into a columnar
    copy; ``stage`` keeps it as the table ``records``, and ``columnar`` says that
    they come from such a table already and need none. ``addresses`` (``email``) are to receive
    the report; ``deliveries`` then lists which page goes to whom.

    Decisions are written first and everything else is read back from them, so
    the joins run once however many results follow, and the later steps do not
    depend on executors keeping anything. Metrics are counted while rows are
    written, at the end of a write's last stage, whose tasks Spark counts once.

    ``digests`` names a folder that remembers what was delivered. Records that
    say about a code what the last import was told are then neither matched nor
    compared, on the understanding that what was sent then is in force; without
    it every record is compared with the facility as it is. The payloads of ``actions`` are whole;
    those of ``decisions`` lack the programs of known facilities, unless own
    watched fields may ask for them.
    """
    if digests is not None and rules.watched is not None:
        raise ValueError("own comparisons may look at more than digests stand for")
    spark = configure(records.sparkSession)
    with scratch_tables(spark):
        _write_import(
            records, tables, out, rules, by_province, disable_missing, supplement, report, stage,
            part, addresses, digests, columnar,
        )


def _write_import(
    records: DataFrame,
    tables: ReferenceTables,
    out: str,
    rules: FacilityRules,
    by_province: bool,
    disable_missing: bool,
    supplement: bool,
    report: bool,
    stage: bool,
    part: str | None,
    addresses: DataFrame | None,
    digests: str | None,
    columnar: bool,
) -> None:
    spark = records.sparkSession

    def to(name: str) -> str:
        return f"{out}/{name}/{part}" if part else f"{out}/{name}"

    if stage:
        write_rows(records, to("records"))
        records = spark.read.schema(records.schema).parquet(to("records"))
    elif not columnar:
        records = materialize(records, "records")
    found = enriched(records, tables, by_province)
    store, known, delivered = None, None, None
    if digests is not None:
        store = DigestStore(spark, digests)
        known = store.manifest().latest()
        judged = {
            "zone": rules.fallback_zone, "type": rules.fallback_type, "safe": rules.null_safe,
            "programs": rules.programs, "province": by_province,
        }
        delivered = materialize(
            compared(record_digests(found, judged), store.read(known)), "digests"
        )
        found = found.join(delivered.filter(~F.col("same")).select("code"), "code", "left_semi")
    # The fields watched by default leave programs out, which are then read for changes only.
    late = rules.watched is None
    existing = tables.placed() if late else tables.existing()
    if disable_missing:
        # Needed twice, and costs joins.
        existing = materialize(existing, "existing")
    at_records, at_decisions, at_actions = Observation(), Observation(), Observation()
    decided = decide(match_existing(found, existing), rules).select(*_DECIDED)
    write_rows(decided.observe(at_decisions, *decision_gates()), to("decisions"))
    decided = spark.read.schema(decided.schema).parquet(to("decisions"))

    wanted = actions(decided, "program_ids")
    acting = at_decisions.get["update"] + at_decisions.get["disable"] > 0
    if disable_missing:
        absent = absent_facilities(existing, records, rules)
        wanted = wanted.unionByName(absent.withColumn("program_ids", no_programs()))
        wanted = materialize(wanted, "actions")
        acting = bool(wanted.filter(F.col("action") != CREATE_ACTION).head(1))
    if late and acting:
        wanted = with_facility_programs(
            wanted, tables.supported_programs, tables.programs, rules, tables.small
        )
    wanted = wanted.drop("program_ids").withColumn(
        "payload", F.to_json("payload", {"ignoreNullFields": "false"})
    )
    if supplement:
        wanted = wanted.unionByName(supplement_actions(records, tables))
    write_actions(wanted.observe(at_actions, *action_gates()), to("actions"))
    # The rejects are read from the records without a shuffle, so these are counted there.
    counted = records.observe(at_records, *record_gates(records))
    write_rows(import_rejects(records, tables, counted), to("rejects"))
    if report:
        pages = report_pages(report_rows(decided))
        write_rows(pages, to("report"))
        if addresses is not None:
            written = spark.read.schema(pages.schema).parquet(to("report"))
            write_rows(deliveries(written, addresses), to("deliveries"))
    write_rows(_metrics(spark, at_records, at_decisions, at_actions), to("metrics"))
    if store is not None:
        undecided = decided.filter(F.col("action").isNull())
        store.commit(known, merged(delivered, undecided, store.read(known), disable_missing))
