"""The change log: what changed since the last sync, mapped for sending."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.functions.text import iso_time, qualified_name
from refsync.operators.envelope import envelope_id, utc
from refsync.operators.joins import lookup_join
from refsync.sources.registry import CHANGE_LOG, RESOURCES, SYNC, TARGET_SCHEMA
from refsync.sources.schemas import ENVELOPE_COLUMNS

_EPOCH = "1970-01-01 00:00:00"
_EPOCH_TIME = datetime(1970, 1, 1, tzinfo=timezone.utc)

SENT, REJECTED = "sent", "rejected"


def last_sync(sync_logs: DataFrame, successful_only: bool = False) -> DataFrame:
    """``(resource, last_change)``: when each resource was last synchronized.

    A failed run moves the mark as well, unless ``successful_only``.
    """
    if successful_only:
        sync_logs = sync_logs.filter("success")
    return sync_logs.groupBy("resource").agg(F.max("timestamp").alias("last_change"))


def last_success(sync_logs: DataFrame, resource: str) -> DataFrame:
    """The latest successful log row of a resource, or no row."""
    return (
        sync_logs.filter(F.col("success") & (F.col("resource") == resource))
        .orderBy(F.col("timestamp").desc(), F.col("id").desc())
        .limit(1)
    )


def _marks(
    sync_logs: DataFrame, successful_only: bool = False
) -> tuple[dict[str | None, str], DataFrame]:
    """The marks of the log and of the tables in the registry, and those of all others.

    The former are as many as there are resources. They come as text, by name;
    under None is the latest of the others, which are left where they are.
    """
    marks = last_sync(sync_logs, successful_only)
    known = F.when(F.col("resource").isin(CHANGE_LOG, *(spec.name for spec in RESOURCES)),
                   F.col("resource"))
    found = marks.groupBy(known.alias("resource")).agg(
        F.max("last_change").cast("string").alias("mark")
    )
    others = marks.filter(known.isNull())
    return {row["resource"]: row["mark"] for row in found.collect() if row["mark"]}, others


def log_mark(sync_logs: DataFrame, successful_only: bool = False) -> datetime | None:
    """When the log itself was last synchronized."""
    found = last_sync(sync_logs, successful_only).filter(F.col("resource") == CHANGE_LOG)
    micros = found.agg(F.max(F.unix_micros(F.col("last_change").cast("timestamp")))).first()[0]
    return None if micros is None else _EPOCH_TIME + timedelta(microseconds=micros)


def changes_since(
    changes: DataFrame, sync_logs: DataFrame, successful_only: bool = False
) -> DataFrame:
    """Changes strictly newer than both marks: the table's own and the log's.

    The marks of the log and of the known tables are a few values. They are
    looked up first, so that they are literals in filters that any source takes:
    files skip old row groups, a database selects by itself. Marks of tables
    that the registry does not name are joined, if there are any.
    """
    found, others = _marks(sync_logs, successful_only)
    logged, time = (
        df.schema[name].dataType
        for df, name in ((sync_logs, "timestamp"), (changes, "change_time"))
    )

    def mark(text: str | None) -> Column:
        return F.lit(text or _EPOCH).cast(logged).cast(time)

    when = F.col("change_time")
    recent = changes.filter(when > mark(found.get(CHANGE_LOG)))
    marked = [(spec, found[spec.name]) for spec in RESOURCES if spec.name in found]
    if marked:
        schema, table = F.col("schema_name"), F.col("table_name")
        # A change of any other table, or of none, is not held back here.
        due = [schema.isNull(), table.isNull()]
        due.append(
            reduce(
                Column.__and__,
                [(schema != spec.schema) | (table != spec.table) for spec, _ in marked],
            )
        )
        due += [
            (schema == spec.schema) & (table == spec.table) & (when > mark(text))
            for spec, text in marked
        ]
        recent = recent.filter(reduce(Column.__or__, due))
    if None not in found:
        return recent
    named = recent.withColumn(
        "resource", qualified_name(F.col("schema_name"), F.col("table_name"))
    )
    last = F.coalesce(F.col("last_change"), F.lit(_EPOCH).cast(logged)).cast(time)
    return lookup_join(named, others, "resource").filter(when > last).select(*changes.columns)


def mapped_changes(changes: DataFrame) -> DataFrame:
    """Each change with its target table, mapped row and, if it has none, the reason.

    One pass over a log that mixes all tables. The resource of a change is
    looked up, its row is parsed once into its keys and values, which keep their
    JSON types, and the mapped row is built from the resource's pairs. So a
    change costs the same however many resources there are.
    """
    # One row per resource.
    found = changes.withColumn(
        "_name", qualified_name(F.col("schema_name"), F.col("table_name"))
    ).join(F.broadcast(_resources(changes.sparkSession)), "_name", "left")
    # Generated, so that filters on the outcome do not parse a second time.
    parsed = found.select(
        *changes.columns,
        "_target",
        "_pairs",
        F.explode(F.array(F.expr("from_json(row_data, 'map<string, variant>')"))).alias("_row"),
    )
    # A key that is absent has no value, whereas a JSON null is one.
    lacking = F.filter(
        F.transform("_pairs", lambda p: p["source"]), lambda key: F.col("_row")[key].isNull()
    )
    reason = (
        F.when(F.col("_target").isNull(), "unmapped_table")
        .when(F.col("_row").isNull(), "bad_json")
        .when(F.size(lacking) > 0, "missing_key")
    )
    row = F.map_from_entries(
        F.transform("_pairs", lambda p: F.struct(p["target"], F.col("_row")[p["source"]]))
    )
    return parsed.select(
        *changes.columns,
        "_target",
        reason.alias("reason"),
        F.when(reason == "missing_key", lacking).alias("missing"),
        F.when(reason.isNull(), F.to_json(row, {"ignoreNullFields": "false"})).alias("_mapped"),
    )


def _resources(spark: SparkSession) -> DataFrame:
    """Name, target and pairs of every resource."""
    return spark.createDataFrame(
        [(spec.name, spec.target, list(spec.columns)) for spec in RESOURCES],
        "_name string, _target string, _pairs array<struct<target: string, source: string>>",
    )


def change_outcomes(mapped: DataFrame, random_ids: bool = False) -> DataFrame:
    """Every change once: as an envelope to send, or as a reject with its reason.

    ``row_data`` is the mapped row of an envelope and the logged row of a reject.
    """
    rejected = F.col("reason").isNotNull()
    time = iso_time(F.col("change_time"))
    identity = (
        F.uuid() if random_ids else envelope_id(F.col("_target"), F.col("id"), time)
    )
    return mapped.select(
        F.when(rejected, REJECTED).otherwise(SENT).alias("status"),
        F.coalesce("_target", F.lit("unmapped")).alias("table_name"),
        F.when(~rejected, identity).alias("id"),
        F.lit(TARGET_SCHEMA).alias("schema_name"),
        "operation",
        time.alias("change_time"),
        F.when(rejected, F.col("row_data")).otherwise(F.col("_mapped")).alias("row_data"),
        F.col("id").alias("change_id"),
        F.col("schema_name").alias("source_schema"),
        F.col("table_name").alias("source_table"),
        "reason",
        "missing",
    )


def change_envelopes(outcomes: DataFrame) -> DataFrame:
    """Envelopes of the changes that could be mapped; ``row_data`` is JSON text."""
    return outcomes.filter(F.col("status") == SENT).select(*ENVELOPE_COLUMNS)


def change_rejects(outcomes: DataFrame) -> DataFrame:
    """Changes that cannot be sent, with the reason and the columns they lack."""
    return outcomes.filter(F.col("status") == REJECTED).select(
        F.col("change_id").alias("id"),
        F.col("source_schema").alias("schema_name"),
        F.col("source_table").alias("table_name"),
        "reason",
        "missing",
        "row_data",
    )


def retained_changes(changes: DataFrame, snapshot: datetime) -> DataFrame:
    """What stays in the log after a full sync: changes later than its snapshot.

    Change times without a zone are wall clock in the session's zone.
    """
    at = F.lit(utc(snapshot)).cast(changes.schema["change_time"].dataType)
    return changes.filter(F.col("change_time") > at)


def sync_log_row(
    spark: SparkSession,
    resource: str,
    sync_type: str,
    success: bool,
    at: datetime,
    message: str | None = None,
    details: str | None = None,
) -> DataFrame:
    """The log row of one run over one resource; ``at`` must have a zone."""
    time = utc(at)
    return spark.range(1).select(
        envelope_id(F.lit(resource), F.lit(sync_type), F.lit(time.isoformat())).alias("id"),
        F.lit(resource).alias("resource"),
        F.lit(sync_type).alias("sync_type"),
        F.lit(SYNC).alias("operation"),
        F.lit(time).alias("timestamp"),
        F.lit(success).alias("success"),
        F.lit(message).cast("string").alias("message"),
        F.lit(details).cast("string").alias("details"),
    )
