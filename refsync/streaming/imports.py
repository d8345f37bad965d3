"""Facility imports driven by newly delivered files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.operators.facilities import FacilityRules
from refsync.plans.facility_import import ReferenceTables, run_import
from refsync.session import configure
from refsync.sinks import write_rows


def run_import_stream(
    records: DataFrame,
    tables: Callable[[], ReferenceTables],
    out: str,
    checkpoint: str,
    rules: FacilityRules = FacilityRules(),
    **options: bool | DataFrame,
) -> str | None:
    """Import everything delivered since the last completed import, as one delivery.

    Batches of the stream only stage their records, each under its own
    ``staged/batch=<n>``, which a repeated batch replaces. When all files are
    staged, one decision is taken over all batches that no completed import
    covers; how files fall into batches has no influence. Its tables get the
    partition ``delivery=<first batch>``, which is returned; None if there was
    nothing new. An import that failed is repeated by the next start, together
    with what has arrived since, and replaces what the failed one has written.
    """
    spark = configure(records.sparkSession)

    def stage(batch: DataFrame, batch_id: int) -> None:
        write_rows(batch, f"{out}/staged/batch={batch_id}")

    stream = (
        records.writeStream.foreachBatch(stage)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()

    staged = _rows(spark, f"{out}/staged", f"{records_ddl(records)}, batch long")
    done = _rows(spark, f"{out}/completed", "last long, delivery string")
    covered = done.agg(F.coalesce(F.max("last"), F.lit(-1))).first()[0]
    due = staged.filter(F.col("batch") > covered)
    last = due.agg(F.max("batch")).first()[0]
    if last is None:
        return None
    # By its first batch, so that an attempt that failed halfway is replaced.
    delivery = f"delivery={covered + 1}"
    run_import(
        due.drop("batch"), tables(), out, rules, part=delivery, **{"columnar": True, **options}
    )
    mark = spark.range(1).select(F.lit(last).cast("long").alias("last"))
    write_rows(mark, f"{out}/completed/{delivery}")
    return delivery


def records_ddl(records: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema.fields)


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What a folder holds; nothing if it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)
