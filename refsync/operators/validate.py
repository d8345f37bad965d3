"""Checks on incoming facility records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refsync.functions.text import is_coordinate, is_present
from refsync.sources.incoming import RAW

# Fixed values.
MANDATORY = ("name", "code", "municipality", "province")
COORDINATES = ("latitude", "longitude")


def has_mandatory() -> Column:
    return reduce(Column.__and__, [is_present(F.col(name)) for name in MANDATORY])


def raw_text(df: DataFrame) -> Column:
    """The text of records that could not be read; null for records from elsewhere."""
    return F.col(RAW) if RAW in df.columns else F.lit(None).cast("string")


def is_valid(df: DataFrame) -> Column:
    """Read as declared and with all mandatory fields."""
    return _true(has_mandatory()) & raw_text(df).isNull()


def valid_records(df: DataFrame) -> DataFrame:
    """Readable records with all mandatory fields, coordinates also as numbers.

    A malformed coordinate does not drop the record; its number is null.
    """
    kept = df.filter(is_valid(df))
    for name in COORDINATES:
        number = F.when(is_coordinate(F.col(name)), F.col(name).try_cast("double"))
        kept = kept.withColumn(f"{name}_num", number)
    return kept


def rejects(df: DataFrame) -> DataFrame:
    """``(code, reason, columns, raw)`` of what the checks found, in one pass.

    ``bad_json`` (no JSON object), ``bad_type`` (a value of another type than
    declared) and ``missing_mandatory`` records are dropped from the sync;
    ``bad_coordinate`` records are kept and only reported. ``raw`` is the whole
    text of a record that could not be read.
    """
    raw = raw_text(df)
    missing = F.array_compact(
        F.array(*[F.when(~_true(is_present(F.col(c))), F.lit(c)) for c in MANDATORY])
    )
    malformed = F.array_compact(
        F.array(*[F.when(~is_coordinate(F.col(c)), F.lit(c)) for c in COORDINATES])
    )
    none = F.array().cast("array<string>")
    is_object = F.schema_of_variant(F.try_parse_json(raw)).startswith("OBJECT")
    dropped = ~_true(has_mandatory())
    odd = reduce(Column.__or__, [~is_coordinate(F.col(c)) for c in COORDINATES])
    return df.filter(raw.isNotNull() | dropped | odd).select(
        "code",
        F.when(raw.isNotNull(), F.when(_true(is_object), "bad_type").otherwise("bad_json"))
        .when(dropped, "missing_mandatory")
        .otherwise("bad_coordinate")
        .alias("reason"),
        F.when(raw.isNotNull(), none)
        .when(dropped, missing)
        .otherwise(malformed)
        .alias("columns"),
        raw.alias("raw"),
    )


def _true(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))
