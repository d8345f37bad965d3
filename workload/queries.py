"""The queries: every operator over the whole test tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.functions.programs import merge_programs, program_list, programs_from_json
from refsync.functions.text import fold, is_coordinate, is_uuid, iso_time, present_or
from refsync.operators.changelog import (
    change_envelopes,
    change_outcomes,
    change_rejects,
    changes_since,
    last_success,
    last_sync,
    mapped_changes,
    retained_changes,
)
from refsync.operators.envelope import map_resource, with_json_rows
from refsync.operators.facilities import (
    FacilityRules,
    absent_facilities,
    actions,
    enrich,
    match_existing,
    report_rows,
    with_facility_programs,
    with_program_ids,
)
from refsync.operators.lookup import (
    by_code,
    by_codes,
    by_id,
    facility_details,
    supported_program,
    supported_programs,
)
from refsync.operators.reference import contact_details, facility_programs, zones_at
from refsync.operators.report import report_pages
from refsync.operators.supplement import (
    missing_municipalities,
    missing_programs,
    missing_provinces,
    missing_types,
    records_missing_zone,
)
from refsync.operators.validate import rejects, valid_records
from refsync.plans.export import due_changes, export_changes, export_full, run_name
from refsync.plans.facility_import import (
    ReferenceTables,
    decisions,
    report_recipients,
    run_import,
    run_metrics,
)
from refsync.plans.runs import read_run, run_rows
from refsync.session import configure, materialize, new_shared_path
from refsync.sources.change_log import ChangeLog
from refsync.sources.incoming import read_facility_records, stream_facility_records
from refsync.sources.inferred import field_types, infer_schema, parsed
from refsync.sources.registry import CHANGE_LOG, RESOURCES
from refsync.sources.schemas import SYNC_LOGS
from refsync.sources.splits import bounds_of, splits_of
from refsync.sources.tables import CatalogSource
from refsync.streaming import read_change_stream, run_change_stream, run_import_stream
from workload.inputs import Tables

Query = Callable[[SparkSession, str], DataFrame]

AT = datetime(2024, 6, 1, tzinfo=timezone.utc)
SNAPSHOT = datetime(2024, 1, 15, tzinfo=timezone.utc)
RULES = FacilityRules(fallback_zone="Z-UNKNOWN", fallback_type="T-UNKNOWN")

QUERIES: dict[str, Query] = {}


def query(build: Callable[[SparkSession, Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(configure(spark), Tables(spark, folder))

    QUERIES[build.__name__] = run
    return run


def as_json(column: str):
    return F.to_json(column, {"ignoreNullFields": "false"})


# --- export ---------------------------------------------------------------------


def _export(spec) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        source = Tables(configure(spark), folder)[f"src_{spec.table}"]
        return with_json_rows(map_resource(source, spec, AT))

    return run


for _resource in RESOURCES:
    QUERIES[f"export_{_resource.table}"] = _export(_resource)


class DerivedSource:
    """The derived tables as a source: ``names`` first, export tables otherwise."""

    def __init__(self, tables: Tables, names: dict[str, str] | None = None):
        self.tables = tables
        self.names = names or {}

    def table(self, name: str) -> DataFrame:
        return self.tables[self.names.get(name, f"src_{name.split('.')[1]}")]


@query
def export_run(spark: SparkSession, t: Tables) -> DataFrame:
    """A full export written out: every envelope as it was sent."""
    out = new_shared_path(spark, "export")
    export_full(spark, DerivedSource(t), f"{out}/batch", f"{out}/log", AT)
    return read_run(spark, f"{out}/batch", run_name(AT)).select(
        "id", "schema_name", "table_name", "operation", "change_time", "row_data"
    )


_LOGGED = ("resource", "sync_type", "operation", "timestamp", "success", "message", "details")


@query
def export_run_log(spark: SparkSession, t: Tables) -> DataFrame:
    """The log that a full export leaves, run twice under the same time."""
    out = new_shared_path(spark, "export")
    for _ in range(2):
        export_full(spark, DerivedSource(t), f"{out}/batch", f"{out}/log", AT)
    return _log(spark, f"{out}/log")


@query
def export_run_counts(spark: SparkSession, t: Tables) -> DataFrame:
    """What a complete run says of itself: its tables and their envelopes."""
    out = new_shared_path(spark, "export")
    export_full(spark, DerivedSource(t), f"{out}/batch", f"{out}/log", AT)
    rows = run_rows(spark, f"{out}/batch", run_name(AT))
    return spark.createDataFrame(sorted(rows.items()), "table_name string, envelopes long")


def _log(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.schema(SYNC_LOGS).parquet(path).select(*_LOGGED)
    return found.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# --- change log -----------------------------------------------------------------


@query
def last_sync_marks(spark: SparkSession, t: Tables) -> DataFrame:
    return last_sync(t["in_sync_logs"])


@query
def last_sync_marks_successful(spark: SparkSession, t: Tables) -> DataFrame:
    return last_sync(t["in_sync_logs"], successful_only=True)


@query
def last_success_row(spark: SparkSession, t: Tables) -> DataFrame:
    return last_success(t["in_sync_logs"], "fulfillment.orders")


@query
def changelog_incremental(spark: SparkSession, t: Tables) -> DataFrame:
    return changes_since(t["in_changes"], t["in_sync_logs"])


@query
def changelog_incremental_successful(spark: SparkSession, t: Tables) -> DataFrame:
    return changes_since(t["in_changes"], t["in_sync_logs"], successful_only=True)


@query
def changelog_first_run(spark: SparkSession, t: Tables) -> DataFrame:
    """Without a successful sync of the log everything is due."""
    logs = t["in_sync_logs"].filter(F.col("resource") != CHANGE_LOG)
    due, sync_type = due_changes(t["in_changes"], logs)
    return due.withColumn("sync_type", F.lit(sync_type))


@query
def changelog_repeated_run(spark: SparkSession, t: Tables) -> DataFrame:
    due, sync_type = due_changes(t["in_changes"], t["in_sync_logs"])
    return due.withColumn("sync_type", F.lit(sync_type))


def order_changes(t: Tables) -> DataFrame:
    """Order changes with the changed row as JSON text."""
    row = {
        "id": F.col("o_orderkey").cast("string"),
        "createdbyid": F.concat(F.lit("u-"), F.col("o_custkey").cast("string")),
        "createddate": F.col("o_orderdate").cast("string"),
        "emergency": F.col("o_orderpriority") == "1-URGENT",
        "facilityid": F.concat(F.lit("fac-"), F.col("o_custkey").cast("string")),
        "ordercode": F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")),
        "programid": F.substring("o_orderpriority", 1, 1),
        "quotedcost": F.floor("o_totalprice"),
        "receivingfacilityid": F.col("o_custkey"),
        "requestingfacilityid": F.col("o_custkey"),
        "status": F.col("o_orderstatus"),
        "supplyingfacilityid": F.lit(None).cast("string"),
        "lastupdateddate": F.col("o_orderdate").cast("string"),
        "lastupdaterid": F.col("o_custkey"),
        "extradata": F.lit("not mapped"),
    }
    full = F.struct(*[value.alias(name) for name, value in row.items()])
    short = F.struct(
        *[value.alias(name) for name, value in row.items() if name not in ("programid", "status")]
    )
    options = {"ignoreNullFields": "false"}
    text = F.when(F.col("o_orderstatus") == "O", F.to_json(short, options)).otherwise(
        F.to_json(full, options)
    )
    return t["in_order_changes"].select(
        "id", "schema_name", "table_name", "operation", "change_time", text.alias("row_data")
    )


@query
def changelog_envelopes(spark: SparkSession, t: Tables) -> DataFrame:
    return change_envelopes(change_outcomes(mapped_changes(order_changes(t))))


@query
def changelog_rejects(spark: SparkSession, t: Tables) -> DataFrame:
    found = change_rejects(change_outcomes(mapped_changes(order_changes(t))))
    return found.withColumn("missing", F.array_join("missing", ","))


def mixed_changes(t: Tables) -> DataFrame:
    """Changes of five mapped tables, each row as its source table has it."""
    tables = ("facilities", "orderables", "programs", "geographic_levels", "users")
    result = None
    for number, table in enumerate(tables):
        source = t[f"src_{table}"]
        schema = next(spec.schema for spec in RESOURCES if spec.table == table)
        changes = source.select(
            F.concat(F.lit(f"{number}-"), F.col("id")).alias("id"),
            F.lit(schema).alias("schema_name"),
            F.lit(table).alias("table_name"),
            F.lit("U").alias("operation"),
            F.lit("2024-06-01").cast("timestamp_ntz").alias("change_time"),
            F.to_json(F.struct(*source.columns), {"ignoreNullFields": "false"}).alias("row_data"),
        )
        result = changes if result is None else result.unionByName(changes)
    return result


@query
def changelog_mixed_tables(spark: SparkSession, t: Tables) -> DataFrame:
    """One log over five mapped tables."""
    return change_envelopes(change_outcomes(mapped_changes(mixed_changes(t))))


@query
def changelog_retained(spark: SparkSession, t: Tables) -> DataFrame:
    return retained_changes(t["in_changes"], SNAPSHOT)


_LOGGED_CHANGES = (
    "id bigint, schema_name string, table_name string, operation string,"
    " change_time timestamp_ntz, row_data string"
)

# Orders have changed before and after it.
MIDDLE = datetime(1995, 6, 1, tzinfo=timezone.utc)


@query
def changelog_after_full_export(spark: SparkSession, t: Tables) -> DataFrame:
    """A full export empties the log it covers; the next change export sends what came later."""
    out = new_shared_path(spark, "export")
    log = ChangeLog(spark, f"{out}/changes", _LOGGED_CHANGES)
    changes, time = order_changes(t), F.col("change_time")
    # Parts that end before the export, hold its time, and begin after it.
    for part in (time < "1994-01-01", time.between("1994-01-01", "1997-01-01"), time > "1997-01-01"):
        log.append(changes.filter(part))
    export_full(spark, DerivedSource(t), f"{out}/full", f"{out}/log", MIDDLE, changes=log)
    sync_logs = spark.read.schema(SYNC_LOGS).parquet(f"{out}/log")
    export_changes(spark, log, sync_logs, f"{out}/sent", f"{out}/log", AT)
    return change_envelopes(spark.read.parquet(f"{out}/sent/run={run_name(AT)}"))


@query
def changelog_cleared_parts(spark: SparkSession, t: Tables) -> DataFrame:
    """What the log still holds, read through the version that clearing it has committed."""
    log = ChangeLog(spark, new_shared_path(spark, "log"), _LOGGED_CHANGES)
    changes, time = t["in_changes"], F.col("change_time")
    for part in (time < "2024-01-10", time >= "2024-01-10"):
        log.append(changes.filter(part))
    log.clear(SNAPSHOT)
    return log.read(since=SNAPSHOT)


@query
def changelog_run(spark: SparkSession, t: Tables) -> DataFrame:
    """A change export written out: what it has sent and rejected."""
    out = new_shared_path(spark, "changes")
    logs = t["in_sync_logs"].filter(F.col("resource") != CHANGE_LOG)
    export_changes(spark, order_changes(t), logs, f"{out}/changes", f"{out}/log", AT)
    found = spark.read.parquet(f"{out}/changes/run={run_name(AT)}")
    return found.select(
        F.col("status").cast("string").alias("status"),
        F.col("table_name").cast("string").alias("table_name"),
        "id",
        "schema_name",
        "operation",
        "change_time",
        "row_data",
        "change_id",
        "source_schema",
        "source_table",
        "reason",
        F.array_join("missing", ",").alias("missing"),
    )


@query
def changelog_stream(spark: SparkSession, t: Tables) -> DataFrame:
    """The log as a stream, taking over where earlier batch runs stopped."""
    log = new_shared_path(spark, "log")
    order_changes(t).write.parquet(log)
    out = new_shared_path(spark, "stream")
    stream = read_change_stream(spark, log, schema=_LOGGED_CHANGES)
    # The order changes are some years older than the events that the logs come from.
    logs = t["in_sync_logs"].withColumn(
        "timestamp", F.col("timestamp") - F.make_interval(years=F.lit(26))
    )
    run_change_stream(stream, f"{out}/changes", f"{out}/checkpoint", logs).awaitTermination()
    return change_envelopes(spark.read.parquet(f"{out}/changes"))


@query
def changelog_stream_log(spark: SparkSession, t: Tables) -> DataFrame:
    """The log that a stream leaves after it was started twice."""
    log = new_shared_path(spark, "log")
    # Any number of files is one batch, up to the bytes that bound one.
    order_changes(t).write.parquet(log)
    out = new_shared_path(spark, "stream")
    for _ in range(2):
        stream = read_change_stream(spark, log, schema=_LOGGED_CHANGES)
        run_change_stream(
            stream, f"{out}/changes", f"{out}/checkpoint", log=f"{out}/log"
        ).awaitTermination()
    return _log(spark, f"{out}/log")


# --- validation -----------------------------------------------------------------


def records(t: Tables) -> DataFrame:
    """Incoming records with their services."""
    services = (
        t["in_services"]
        .groupBy(F.col("facility_code").alias("code"))
        .agg(F.sort_array(F.collect_list(F.struct("name", F.col("code")))).alias("services"))
    )
    return t["in_records"].join(services, "code", "left")


@query
def validate_kept(spark: SparkSession, t: Tables) -> DataFrame:
    return valid_records(t["in_records"]).select(
        "id", "code", "name", "municipality", "province", "latitude_num", "longitude_num"
    )


@query
def validate_rejects(spark: SparkSession, t: Tables) -> DataFrame:
    return rejects(t["in_records"]).withColumn("columns", F.array_join("columns", ","))


@query
def coordinate_flags(spark: SparkSession, t: Tables) -> DataFrame:
    return t["in_records"].select(
        "id",
        is_coordinate(F.col("latitude")).alias("latitude_valid"),
        is_coordinate(F.col("longitude")).alias("longitude_valid"),
    )


@query
def records_from_json(spark: SparkSession, t: Tables) -> DataFrame:
    """Records delivered as JSON files, read with the declared schema."""
    landing = new_shared_path(spark, "landing")
    records(t).write.json(landing)
    return read_facility_records(spark, landing).select(
        "id", "reference_id", "code", "name", "is_deleted", "is_operational", "latitude",
        "longitude", "category", "municipality", "province",
        F.coalesce(as_json("services"), F.lit("[]")).alias("services"), "raw_record",
    )


# --- undeclared records, split reads --------------------------------------------


@query
def fields_inferred(spark: SparkSession, t: Tables) -> DataFrame:
    """The fields that logged rows of two shapes show, and their types."""
    schema = infer_schema(order_changes(t), "row_data")
    return spark.createDataFrame(field_types(schema), "field string, type string")


@query
def records_inferred(spark: SparkSession, t: Tables) -> DataFrame:
    """Logged rows read by the schema they show; one shape lacks two fields."""
    changes = order_changes(t)
    row = parsed(F.col("row_data"), infer_schema(changes, "row_data"))
    return changes.select(F.col("id").alias("change_id"), row.alias("r")).select("change_id", "r.*")


_LINE_KEY = ("l_shipdate", "l_orderkey", "l_linenumber")


@query
def split_bounds(spark: SparkSession, t: Tables) -> DataFrame:
    """Where to cut the line items into 16 even parts; most dates have many of them."""
    return bounds_of(t.base("lineitem"), _LINE_KEY, 16)


@query
def split_bounds_of_few_keys(spark: SparkSession, t: Tables) -> DataFrame:
    """A key of three values, one of them null, makes three parts at most."""
    line = t.base("lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    )
    return bounds_of(line, ("flag",), 16)


@query
def split_reads(spark: SparkSession, t: Tables) -> DataFrame:
    """Orders read part by part, by predicates on a text and a number."""
    orders = t.base("orders").select("o_orderpriority", "o_orderkey")
    splits = splits_of(orders, ("o_orderpriority", "o_orderkey"), 12)
    parts = [
        orders.filter(predicate).select(F.lit(number).cast("long").alias("part"), "*")
        for number, predicate in enumerate(splits.predicates())
    ]
    return reduce(DataFrame.unionAll, parts).groupBy("part").agg(
        F.count(F.lit(1)).alias("orders"),
        F.min(F.struct("o_orderpriority", "o_orderkey")).alias("first"),
    ).select("part", "orders", "first.*")


# --- reference tables -----------------------------------------------------------


_REFERENCE = {
    "referencedata.facilities": "in_facilities",
    "referencedata.supported_programs": "in_supported",
    "referencedata.programs": "in_programs",
    "referencedata.geographic_zones": "in_zones",
    "referencedata.geographic_levels": "in_levels",
    "referencedata.facility_types": "in_types",
    "referencedata.role_rights": "in_role_rights",
    "referencedata.role_assignments": "in_role_assignments",
    "notification.user_contact_details": "in_contacts",
}


def reference_tables(t: Tables) -> ReferenceTables:
    return ReferenceTables.read(DerivedSource(t, _REFERENCE))


@query
def zone_hierarchy(spark: SparkSession, t: Tables) -> DataFrame:
    return reference_tables(t).hierarchy()


@query
def zones_of_level(spark: SparkSession, t: Tables) -> DataFrame:
    return zones_at(reference_tables(t).hierarchy(), 3).select("id", "name", "parentname")


@query
def existing_facilities(spark: SparkSession, t: Tables) -> DataFrame:
    existing = reference_tables(t).existing()
    return existing.withColumn("supported_programs", as_json("supported_programs"))


@query
def program_lists_from_json(spark: SparkSession, t: Tables) -> DataFrame:
    """Programs as they come as JSON text from a source that has joined them."""
    text = reference_tables(t).existing().select("id", as_json("supported_programs").alias("text"))
    listed = text.select("id", program_list(programs_from_json(F.col("text"))).alias("programs"))
    return listed.select("id", as_json("programs").alias("programs"))


@query
def facility_program_entries(spark: SparkSession, t: Tables) -> DataFrame:
    found = facility_programs(t["in_supported"], t["in_programs"])
    return found.select("facilityid", F.explode("programs").alias("code", "support")).select(
        "facilityid", "code", "support.*"
    )


@query
def contacts_by_right(spark: SparkSession, t: Tables) -> DataFrame:
    return contact_details(t["in_role_rights"], t["in_role_assignments"], t["in_contacts"])


@query
def recipients_of_report(spark: SparkSession, t: Tables) -> DataFrame:
    right = hashlib.md5(b"F").hexdigest()
    return report_recipients(DerivedSource(t, _REFERENCE), right)


# --- facilities -----------------------------------------------------------------


def _enriched(t: Tables, **options: bool) -> DataFrame:
    tables = reference_tables(t)
    return enrich(
        valid_records(records(t)), tables.hierarchy(), tables.types, tables.programs,
        small=tables.small, **options,
    )


_ENRICHED = ("id", "code", "municipality_id", "province_id", "type_id", "type_name")


@query
def enrich_records(spark: SparkSession, t: Tables) -> DataFrame:
    return _enriched(t).select(*_ENRICHED, as_json("program_ids").alias("program_ids"))


@query
def enrich_records_by_province(spark: SparkSession, t: Tables) -> DataFrame:
    return _enriched(t, by_province=True).select(*_ENRICHED)


@query
def program_ids_by_join(spark: SparkSession, t: Tables) -> DataFrame:
    """The way taken when there are too many programs for a constant map."""
    found = with_program_ids(records(t), t["in_programs"], few=False)
    return found.select("id", as_json("program_ids").alias("program_ids"))


@query
def split_actions(spark: SparkSession, t: Tables) -> DataFrame:
    matched = match_existing(valid_records(t["in_records"]), reference_tables(t).existing())
    return matched.select("id", "code", "existing_id", "action")


@query
def split_actions_stored(spark: SparkSession, t: Tables) -> DataFrame:
    """Matched with known facilities that are stored in buckets of their code."""
    tables = reference_tables(t).with_known(
        "refsync_known_facilities", new_shared_path(spark, "known")
    )
    matched = match_existing(valid_records(t["in_records"]), tables.placed())
    return matched.select("id", "code", "existing_id", "action")


def _decided(t: Tables, rules: FacilityRules = RULES) -> DataFrame:
    return decisions(records(t), reference_tables(t), rules)


def _actions_of(decided: DataFrame, action: str) -> DataFrame:
    found = actions(decided.filter(F.col("action") == action))
    return found.withColumn("payload", as_json("payload"))


@query
def create_actions(spark: SparkSession, t: Tables) -> DataFrame:
    return _actions_of(_decided(t), "create")


@query
def update_actions(spark: SparkSession, t: Tables) -> DataFrame:
    return _actions_of(_decided(t), "update")


@query
def update_actions_null_safe(spark: SparkSession, t: Tables) -> DataFrame:
    rules = FacilityRules(RULES.fallback_zone, RULES.fallback_type, null_safe=True)
    return _actions_of(_decided(t, rules), "update")


@query
def update_actions_merged(spark: SparkSession, t: Tables) -> DataFrame:
    """The way a run takes: programs are read late, of the facilities that change."""
    rules = FacilityRules(RULES.fallback_zone, RULES.fallback_type, programs="merged")
    tables = reference_tables(t)
    decided = decisions(records(t), tables, rules, existing=tables.placed())
    wanted = materialize(
        actions(decided.filter(F.col("action") == "update"), "program_ids"), "actions"
    )
    found = with_facility_programs(
        wanted, tables.supported_programs, tables.programs, rules, tables.small
    )
    return found.drop("program_ids").withColumn("payload", as_json("payload"))


@query
def update_actions_without_fallback(spark: SparkSession, t: Tables) -> DataFrame:
    """Without a fallback id the zone and type comparisons are unknown: no change."""
    return _actions_of(_decided(t, FacilityRules()), "update")


@query
def disable_actions(spark: SparkSession, t: Tables) -> DataFrame:
    return _actions_of(_decided(t), "disable")


@query
def disable_absent(spark: SparkSession, t: Tables) -> DataFrame:
    found = absent_facilities(reference_tables(t).existing(), t["in_records"], RULES)
    return found.withColumn("payload", as_json("payload"))


@query
def changed_fields(spark: SparkSession, t: Tables) -> DataFrame:
    found = _decided(t).filter(F.col("action") == "update")
    return found.select("id", "any_change", F.array_join("changed", ",").alias("changed"))


@query
def merged_programs(spark: SparkSession, t: Tables) -> DataFrame:
    found = match_existing(
        with_program_ids(valid_records(records(t)), t["in_programs"]),
        reference_tables(t).existing(),
    ).filter(F.col("existing_id").isNotNull())
    merged = merge_programs(F.col("existing_programs"), F.col("program_ids"))
    return found.select("id", F.explode(merged).alias("code", "support")).select(
        "id", "code", "support.id", "support.supportStartDate"
    ).toDF("id", "code", "program_id", "start_date")


@query
def import_metrics(spark: SparkSession, t: Tables) -> DataFrame:
    incoming = records(t)
    return run_metrics(incoming, decisions(incoming, reference_tables(t), RULES))


def _written(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        F.col("action").cast("string").alias("action"), "code", "target_id", "payload"
    )


@query
def import_run(spark: SparkSession, t: Tables) -> DataFrame:
    """A whole import written out, with everything switched on."""
    out = new_shared_path(spark, "import")
    run_import(
        records(t), reference_tables(t), out, RULES, disable_missing=True, supplement=True,
        stage=True,
    )
    return _written(spark, f"{out}/actions")


def _import(spark: SparkSession, t: Tables, **options) -> str:
    out = new_shared_path(spark, "import")
    run_import(
        records(t), reference_tables(t), out, RULES, disable_missing=True, supplement=True,
        **options,
    )
    return out


@query
def import_rejects(spark: SparkSession, t: Tables) -> DataFrame:
    """The rejects that an import has written."""
    out = _import(spark, t, report=False)
    return spark.read.parquet(f"{out}/rejects").withColumn("columns", F.array_join("columns", ","))


@query
def import_run_metrics(spark: SparkSession, t: Tables) -> DataFrame:
    """The metrics that an import has written."""
    return spark.read.parquet(f"{_import(spark, t, report=False)}/metrics")


@query
def import_report(spark: SparkSession, t: Tables) -> DataFrame:
    """The report pages that an import has written."""
    return spark.read.parquet(f"{_import(spark, t)}/report")


@query
def import_deliveries(spark: SparkSession, t: Tables) -> DataFrame:
    """Which page of the report goes to whom."""
    right = hashlib.md5(b"F").hexdigest()
    addresses = report_recipients(DerivedSource(t, _REFERENCE), right)
    return spark.read.parquet(f"{_import(spark, t, addresses=addresses)}/deliveries")


def renamed_records(t: Tables) -> DataFrame:
    """A later delivery, in which every ninth customer has another name."""
    ninth = (F.substring("id", 5, 20).cast("long") % 9 == 0) & (F.col("name") != "")
    name = F.when(ninth, F.concat("name", F.lit(" Novo"))).otherwise(F.col("name"))
    return records(t).withColumn("name", name)


@query
def import_repeated(spark: SparkSession, t: Tables) -> DataFrame:
    """The second import of two, by digests: it acts on what the delivery says anew."""
    out = new_shared_path(spark, "import")
    for number, delivery in enumerate([records(t), renamed_records(t)]):
        run_import(
            delivery, reference_tables(t), f"{out}/{number}", RULES, report=False,
            digests=f"{out}/digests",
        )
    return _written(spark, f"{out}/1/actions")


@query
def import_repeated_metrics(spark: SparkSession, t: Tables) -> DataFrame:
    """What the same delivery leads to when it comes again: nothing but its checks."""
    out = new_shared_path(spark, "import")
    for number in range(2):
        run_import(
            records(t), reference_tables(t), f"{out}/{number}", RULES, report=False,
            digests=f"{out}/digests",
        )
    return spark.read.parquet(f"{out}/1/metrics")


def _stream_import(spark: SparkSession, t: Tables, files: int, **options) -> str:
    out = new_shared_path(spark, "import-stream")
    records(t).repartition(files, "id").write.json(f"{out}/landing")
    tables = reference_tables(t)
    run_import_stream(
        stream_facility_records(spark, f"{out}/landing", **options),
        lambda: tables,
        f"{out}/imports",
        f"{out}/checkpoint",
        RULES,
        disable_missing=True,
        supplement=True,
    )
    return f"{out}/imports"


@query
def import_stream(spark: SparkSession, t: Tables) -> DataFrame:
    """Records delivered as JSON files and imported as they arrive."""
    return _written(spark, f"{_stream_import(spark, t, 1)}/actions")


@query
def import_stream_in_batches(spark: SparkSession, t: Tables) -> DataFrame:
    """The same delivery in several files, each a batch of its own."""
    return _written(spark, f"{_stream_import(spark, t, 3, max_bytes=1)}/actions")


# --- report ---------------------------------------------------------------------


@query
def report_lines(spark: SparkSession, t: Tables) -> DataFrame:
    return report_rows(_decided(t))


@query
def report_parts(spark: SparkSession, t: Tables) -> DataFrame:
    return report_pages(report_rows(_decided(t)))


@query
def report_parts_of_segments(spark: SparkSession, t: Tables) -> DataFrame:
    """Pages over many equal lines: one line for each order of a segment and priority."""
    customers = t.base("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    orders = t.base("orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    rows = orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        F.col("c_mktsegment").alias("name"),
        F.col("o_orderpriority").alias("code"),
        F.lit("UNDEFINED").alias("municipality"),
        F.lit("UNDEFINED").alias("type"),
        F.col("o_orderstatus").alias("operation"),
    )
    return report_pages(rows)


# --- missing reference rows -----------------------------------------------------


@query
def create_provinces(spark: SparkSession, t: Tables) -> DataFrame:
    tables = reference_tables(t)
    found = missing_provinces(
        valid_records(t["in_records"]), tables.hierarchy(), tables.levels, tables.small
    )
    return found.select(
        "code", "name", F.col("level.id").alias("level_id"), F.col("parent.id").alias("parent_id")
    )


@query
def create_municipalities(spark: SparkSession, t: Tables) -> DataFrame:
    tables = reference_tables(t)
    valid, hierarchy = valid_records(t["in_records"]), tables.hierarchy()
    provinces = missing_provinces(valid, hierarchy, tables.levels, tables.small)
    found = missing_municipalities(valid, hierarchy, tables.levels, provinces, tables.small)
    return found.select(
        "code", "name", F.col("level.id").alias("level_id"),
        F.col("parent.id").alias("parent_id"), "parent_code", "reason",
    )


@query
def create_municipalities_only(spark: SparkSession, t: Tables) -> DataFrame:
    """Where provinces are not created, some municipalities have no parent."""
    tables = reference_tables(t)
    found = missing_municipalities(
        valid_records(t["in_records"]), tables.hierarchy(), tables.levels, small=tables.small
    )
    return found.select("code", "name", F.col("parent.id").alias("parent_id"), "reason")


@query
def create_types(spark: SparkSession, t: Tables) -> DataFrame:
    return missing_types(valid_records(t["in_records"]), t["in_types"])


@query
def create_types_of_customers(spark: SparkSession, t: Tables) -> DataFrame:
    """As many missing types as there are customers."""
    named = t.base("customer").select(F.col("c_name").alias("category"))
    return missing_types(named, t["in_types"])


@query
def create_programs(spark: SparkSession, t: Tables) -> DataFrame:
    return missing_programs(valid_records(records(t)), t["in_programs"])


@query
def records_missing_municipality(spark: SparkSession, t: Tables) -> DataFrame:
    tables = reference_tables(t)
    return records_missing_zone(
        valid_records(t["in_records"]), tables.hierarchy(), 3, tables.small
    )


# --- lookups --------------------------------------------------------------------


@query
def lookup_by_id(spark: SparkSession, t: Tables) -> DataFrame:
    return by_id(t["in_facilities"], "fac-8").select("id", "code", "name")


@query
def lookup_by_code(spark: SparkSession, t: Tables) -> DataFrame:
    return by_code(t["in_facilities"], "F8").select("id", "code", "name")


@query
def lookup_by_codes(spark: SparkSession, t: Tables) -> DataFrame:
    listed = t["in_services"].filter(F.col("code") == "1-URGENT").select(
        F.col("facility_code").alias("code")
    )
    return by_codes(t["in_facilities"], listed).select("id", "code", "name")


@query
def supported_pair(spark: SparkSession, t: Tables) -> DataFrame:
    return supported_program(t["in_supported"], "fac-8", "prog-1")


@query
def supported_by_program(spark: SparkSession, t: Tables) -> DataFrame:
    return supported_programs(
        t["in_supported"], t["in_programs"], t["in_facilities"], program_code="2-HIGH"
    )


@query
def supported_by_facility(spark: SparkSession, t: Tables) -> DataFrame:
    return supported_programs(
        t["in_supported"], t["in_programs"], t["in_facilities"], facility_code="F8"
    )


@query
def supported_by_both(spark: SparkSession, t: Tables) -> DataFrame:
    return supported_programs(
        t["in_supported"], t["in_programs"], t["in_facilities"], "2-HIGH", "F8"
    )


@query
def facilities_in_detail(spark: SparkSession, t: Tables) -> DataFrame:
    found = facility_details(
        t["in_facilities"], t["in_zones"], t["in_operators"], t["in_types"]
    )
    return found.select(
        "id",
        F.col("geographic_zone.name").alias("zone_name"),
        F.col("operated_by.code").alias("operator_code"),
        F.col("type.name").alias("type_name"),
        F.col("type.displayorder").alias("type_order"),
    )


@query
def catalog_tables(spark: SparkSession, t: Tables) -> DataFrame:
    """The reference tables as a catalog source gives them."""
    names = {}
    for table in ("in_types", "in_operators", "in_programs", "in_levels"):
        t[table].createOrReplaceTempView(f"refsync_{table}")
        names[f"referencedata.{table[3:]}"] = f"refsync_{table}"
    source = CatalogSource(spark, names)
    rows = [
        source.table(name).select(F.lit(name).alias("source_table"), "id", "name")
        for name in sorted(names)
    ]
    result = rows[0]
    for more in rows[1:]:
        result = result.unionByName(more)
    return result


# --- functions ------------------------------------------------------------------


@query
def accent_fold_documents(spark: SparkSession, t: Tables) -> DataFrame:
    return t.base("documents").select("doc_id", fold(F.col("text")).alias("folded"))


@query
def uuid_check(spark: SparkSession, t: Tables) -> DataFrame:
    """Texts in the accepted forms and near misses, one form per event type."""
    digits = F.md5(F.col("event_id").cast("string"))
    hyphens = F.concat_ws(
        "-",
        *[F.substring(digits, at, length) for at, length in
          ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))],
    )
    text = (
        F.when(F.col("event_type") == "click", digits)
        .when(F.col("event_type") == "view", hyphens)
        .when(F.col("event_type") == "purchase", F.concat(F.lit("urn:uuid:"), hyphens))
        .when(F.col("event_type") == "signup", F.concat(F.lit("{"), hyphens, F.lit("}")))
        .otherwise(F.substring(digits, 1, 31))
    )
    return t.base("events").select("event_id", is_uuid(text).alias("valid"))


@query
def iso_times(spark: SparkSession, t: Tables) -> DataFrame:
    return t.base("events").select("event_id", iso_time(F.col("ts")).alias("iso"))


@query
def present_or_default(spark: SparkSession, t: Tables) -> DataFrame:
    return t["in_records"].select(
        "id",
        present_or(F.col("name"), F.lit("UNDEFINED")).alias("name"),
        present_or(F.col("province"), F.lit("UNDEFINED")).alias("province"),
    )
