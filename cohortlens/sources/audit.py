"""The append-only audit log."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.schemas import AUDIT_LOG
from cohortlens.sources.tables import save_table

SUCCESS, FAILED = "SUCCESS", "FAILED"


@dataclass(frozen=True)
class AuditRow:
    pipeline_name: str
    layer_name: str
    table_name: str
    record_count: int | None
    run_status: str
    error_message: str | None = None


def audit_frame(spark: SparkSession, rows: Iterable[AuditRow], run_id: str, attempt: int) -> DataFrame:
    data = [
        (r.pipeline_name, r.layer_name, r.table_name, r.record_count, r.run_status, r.error_message, run_id, attempt)
        for r in rows
    ]
    return spark.createDataFrame(data, schema=AUDIT_LOG).withColumn("run_timestamp", F.current_timestamp())


def write_audit_log(
    spark: SparkSession, table: str, rows: Iterable[AuditRow], fmt: str = "parquet", run_id: str = ""
) -> None:
    """Appends the rows as one file: one append per layer, not one per table.

    A layer that a run repeats appends its rows under the next attempt; ``committed`` counts
    the last one only, so a retry never counts twice.
    """
    rows, attempt = list(rows), 1
    if spark.catalog.tableExists(table):
        layers = {r.layer_name for r in rows}
        own = spark.table(table).where((F.col("run_id") == run_id) & F.col("layer_name").isin(*layers))
        attempt += own.agg(F.max("attempt")).first()[0] or 0
    save_table(audit_frame(spark, rows, run_id, attempt).coalesce(1), table, mode="append", fmt=fmt)


def committed(log: DataFrame) -> DataFrame:
    """One row per run, layer and table: that of the last attempt."""
    keys = ["run_id", "layer_name", "table_name"]
    last = F.max_by(F.struct(*log.columns), F.struct("attempt", "run_timestamp")).alias("last")
    return log.groupBy(*keys).agg(last).select("last.*")


def audited(pipeline: str, layer: str, table: str, write: Callable[[], int]) -> tuple[AuditRow, Exception | None]:
    """Runs a write and describes its outcome; a failure is recorded, not raised."""
    try:
        return AuditRow(pipeline, layer, table, write(), SUCCESS), None
    except Exception as error:
        return AuditRow(pipeline, layer, table, None, FAILED, str(error)), error


def newest_first(log: DataFrame) -> DataFrame:
    return committed(log).select("layer_name", "table_name", "record_count", "run_status", "run_timestamp").orderBy(
        F.desc("run_timestamp"), "layer_name", "table_name"
    )
