"""Rows of a source table as sync envelopes."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from refsync.sources.registry import SYNC, TARGET_SCHEMA, ResourceSpec

_SENT_AS_TEXT = (DateType, DecimalType, TimestampType, TimestampNTZType)


def utc(at: datetime) -> datetime:
    """A run's time in UTC. A time without a zone is refused: it may be anywhere's."""
    if at.tzinfo is None:
        raise ValueError("a run's time must have a zone")
    return at.astimezone(timezone.utc)


def run_time(sync_ts: datetime) -> str:
    """The time of a run as envelopes carry it: in UTC, with a literal Z."""
    return utc(sync_ts).strftime("%Y-%m-%dT%H:%M:%SZ")


def envelope_id(*parts: Column) -> Column:
    """An id that a repeated run gives again, unlike a random one."""
    return F.md5(F.concat_ws("|", *[part.cast("string") for part in parts]))


def row_data(df: DataFrame, spec: ResourceSpec) -> Column:
    """The mapped row; a source column that is missing fails the analysis.

    Dates, timestamps and decimals always go out as text, other columns where
    the resource asks for it.
    """
    types = {field.name.lower(): field.dataType for field in df.schema.fields}

    def value(source: str) -> Column:
        column = df[source]
        if source in spec.text or isinstance(types[source], _SENT_AS_TEXT):
            return column.cast("string")
        return column

    return F.struct(*[value(source).alias(target) for target, source in spec.columns])


def map_resource(
    df: DataFrame, spec: ResourceSpec, sync_ts: datetime, random_ids: bool = False
) -> DataFrame:
    """One envelope per row of a whole table. A projection: nothing moves."""
    time = run_time(sync_ts)
    identity = (
        F.uuid()
        if random_ids
        else envelope_id(F.lit(spec.target), *[df[k] for k in spec.key], F.lit(time))
    )
    return df.select(
        identity.alias("id"),
        F.lit(TARGET_SCHEMA).alias("schema_name"),
        F.lit(spec.target).alias("table_name"),
        F.lit(SYNC).alias("operation"),
        F.lit(time).alias("change_time"),
        row_data(df, spec).alias("row_data"),
    )


def with_json_rows(envelopes: DataFrame) -> DataFrame:
    """``row_data`` as JSON text, the form in which tables can share a batch."""
    return envelopes.withColumn(
        "row_data", F.to_json("row_data", {"ignoreNullFields": "false"})
    )
