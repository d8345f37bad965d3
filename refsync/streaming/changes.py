"""Repeated export of the change log as a stream."""

from __future__ import annotations

import zlib
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from refsync.operators.changelog import (
    change_outcomes,
    changes_since,
    mapped_changes,
    sync_log_row,
)
from refsync.session import configure
from refsync.sinks import write_changes, write_sync_log
from refsync.sources.incoming import BATCH_BYTES
from refsync.sources.registry import CHANGE_LOG
from refsync.sources.schemas import DATA_CHANGES

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def read_change_stream(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: str = DATA_CHANGES,
    max_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """The log as a stream of its files; ``max_bytes`` bounds one batch."""
    reader = spark.readStream.format(format).schema(schema)
    return reader.option("maxBytesPerTrigger", max_bytes).load(path)


def run_change_stream(
    changes: DataFrame,
    out: str,
    checkpoint: str,
    sync_logs: DataFrame | None = None,
    log: str | None = None,
) -> StreamingQuery:
    """Export all changes available now, and on the next start those that came since.

    The checkpoint takes the place of the marks. ``sync_logs`` hands over from
    earlier batch runs: what their marks cover is not sent again. A batch that
    is repeated after a failure replaces its own files, ``<out>/batch=<n>``, and
    its own log row.

    The log row of a batch has the latest change time in it, so a batch run that
    goes on from there skips nothing that arrived while the batch was written.
    A failed batch is logged with the time at which the stream was started.
    """
    spark = changes.sparkSession
    configure(spark)
    started = datetime.now(timezone.utc)
    if sync_logs is not None:
        changes = changes_since(changes, sync_logs)
    name = f"stream-{zlib.crc32(checkpoint.encode()):08x}"

    def export(batch: DataFrame, batch_id: int) -> None:
        session, run = batch.sparkSession, f"{name}-{batch_id}"
        try:
            outcomes = change_outcomes(mapped_changes(batch))
            write_changes(outcomes, f"{out}/batch={batch_id}")
            if log is not None:
                time = F.max("change_time").cast("timestamp")
                latest = batch.agg(F.unix_micros(time)).first()[0]
                if latest is not None:
                    mark = _EPOCH + timedelta(microseconds=latest)
                    row = sync_log_row(session, CHANGE_LOG, "change", True, mark)
                    write_sync_log(row, log, run)
        except Exception as error:
            if log is not None:
                failed = sync_log_row(
                    session, CHANGE_LOG, "change", False, started, "failed", str(error)
                )
                write_sync_log(failed, log, run)
            raise

    return (
        changes.writeStream.foreachBatch(export)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
