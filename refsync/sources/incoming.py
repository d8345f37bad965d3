"""Facility records delivered by the registry as JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.sources.schemas import FACILITY_RECORD

# A backlog is staged in batches, so that a failure repeats one of them only.
BATCH_BYTES = 1024**4

# The text of a record that could not be read as declared, null for all others.
RAW = "raw_record"

_SCHEMA = f"{FACILITY_RECORD}, {RAW} string"


def read_facility_records(spark: SparkSession, landing: str, multi_line: bool = False) -> DataFrame:
    """All delivered records; keys that a record lacks become null.

    What is no JSON object, or has a value of another type than declared, keeps
    its text in ``raw_record`` and is rejected by the checks. ``multi_line``
    reads files holding one JSON array each. Such a file cannot be split, so
    large deliveries should be one record per line.
    """
    text = spark.read.text(landing, wholetext=multi_line)
    if multi_line:
        elements = F.explode_outer(F.from_json("value", "array<variant>"))
        text = text.select("value", elements.alias("element")).select(
            F.coalesce(F.to_json("element"), "value").alias("value")
        )
    return _records(text)


def stream_facility_records(
    spark: SparkSession, landing: str, max_bytes: int = BATCH_BYTES
) -> DataFrame:
    """The same records as a stream of newly landed files; ``max_bytes`` bounds one batch."""
    return _records(spark.readStream.option("maxBytesPerTrigger", max_bytes).text(landing))


def _records(lines: DataFrame) -> DataFrame:
    """Parsed by an expression, which unlike a scan reads all fields, also those not asked for."""
    record: Column = F.from_json("value", _SCHEMA, {"columnNameOfCorruptRecord": RAW})
    return lines.filter(F.btrim("value") != "").select(record.alias("r")).select("r.*")
