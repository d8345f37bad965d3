"""Where results are written.

Every write names the run it belongs to and replaces only that run's files, so
a run repeated after a failure leaves each result once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_envelopes(
    envelopes: DataFrame,
    root: str,
    run: str,
    table: str,
    format: str = "json",
    rows_per_file: int = 1_000_000,
) -> int:
    """Envelopes of one table under ``<root>/run=<run>/table_name=<table>``; returns their number.

    The folder names the table, so rows are neither shuffled nor sorted, and
    ``row_data`` stays a nested object. Rows are counted as they are written.
    JSON repeats every name in every row, so it is written compressed; such files
    are read whole by one task, which ``rows_per_file`` bounds.
    """
    seen = Observation()
    counted = envelopes.drop("table_name").observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("overwrite").format(format)
    if format == "json":
        writer = writer.option("ignoreNullFields", "false").option("compression", "gzip")
    writer.option("maxRecordsPerFile", rows_per_file).save(
        f"{root}/run={run}/table_name={table}"
    )
    return seen.get["rows"]


def write_changes(outcomes: DataFrame, path: str) -> None:
    """Sent and rejected changes under ``status=<...>/table_name=<target>``.

    One pass writes both. Rows are first balanced by folder, or every task would
    leave a file in each; folders with many rows are split over several tasks.
    """
    folders = ["status", "table_name"]
    balanced = outcomes.hint("rebalance", *folders)
    balanced.write.mode("overwrite").partitionBy(*folders).parquet(path)


def write_actions(actions: DataFrame, path: str) -> None:
    """``(action, target_id, code, payload)`` with the payload as JSON text."""
    text = F.to_json("payload", {"ignoreNullFields": "false"})
    if dict(actions.dtypes)["payload"] != "string":
        actions = actions.withColumn("payload", text)
    actions.write.mode("overwrite").partitionBy("action").parquet(path)


def write_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_sync_log(row: DataFrame, path: str, run: str) -> None:
    """The log row of a run under ``run=<run>``; the run repeated writes it again."""
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/run={run}")

