"""The audit table: what each job read, wrote and refused, as rows that the job itself records.

Numbers are observed by the job that writes the data, so nothing is counted twice. A run's rows are one small file,
appended; the newest run of a table and partition is the one that stands.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from closebook.functions.tables import values_table
from closebook.sinks.catalog import register_table

SCHEMA = [
    ("run_id", "string"), ("job", "string"), ("target", "string"), ("partition_id", "string"), ("status", "string"),
    ("metric", "string"), ("value", "bigint"), ("recorded_at", "timestamp_ntz"),
]
# A run without numbers still leaves this row.
STATUS = "runs"


def record_run(
    spark: SparkSession,
    where: tuple[str, str] | None,
    job: str,
    target: str,
    partition: str,
    status: str,
    metrics: Mapping[str, int] | None = None,
    recorded_at: datetime | None = None,
) -> str | None:
    """Append a run's rows, one per metric and one that says that it ran, and register the table. Returns the run's id.

    ``where`` is the table's path and name; without it nothing is recorded.
    """
    if where is None:
        return None
    path, table = where
    run_id, at = uuid.uuid4().hex, recorded_at or datetime.now()
    numbers = {STATUS: 1, **(metrics or {})}
    rows = [(run_id, job, target, partition, status, name, value, at) for name, value in numbers.items()]
    frame = values_table(spark, SCHEMA, rows)
    frame.coalesce(1).write.mode("append").parquet(path)
    register_table(spark, table, frame.schema, path)
    return run_id


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(", ".join(f"{name} {kind}" for name, kind in SCHEMA)).parquet(path)


def latest_runs(audit: DataFrame) -> DataFrame:
    """The rows of each target and partition's last run."""
    last = Window.partitionBy("job", "target", "partition_id").orderBy(F.desc("recorded_at"), F.desc("run_id"))
    newest = audit.where(F.col("metric") == STATUS).withColumn("_age", F.row_number().over(last)).where("_age = 1")
    return audit.join(newest.select("run_id"), "run_id", "left_semi")
