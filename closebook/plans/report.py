"""Run one configured report: SQL text to a partitioned, registered table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from closebook.config import DAILY, MONTHLY, CloseConfig, ReportSpec
from closebook.functions.dates import next_month, partition_id, partition_of, previous_month
from closebook.operators.calendar import nth_business_day
from closebook.operators.readiness import report_readiness
from closebook.session import size_shuffles
from closebook.sinks.audit import record_run
from closebook.sinks.catalog import register_table
from closebook.sinks.daily import publish_daily
from closebook.sinks.files import daily_extract_path, write_daily_extract
from closebook.sinks.tables import PARTITION, clear_partition, write_partitioned
from closebook.workspace import store

JOB = "report"
WRITTEN = "written"
NOT_DUE = "not due"
BLOCKED = "blocked"
EMPTY = "empty"


@dataclass(frozen=True)
class ReportRun:
    table: str
    status: str
    rows: int = 0
    path: str | None = None
    extract: str | None = None


def is_due(date_dim: DataFrame, business_day: int | None, as_of: date) -> bool:
    """Whether ``as_of`` is that business day of its month; a report bound to none is always due."""
    if business_day is None:
        return True
    month = as_of.replace(day=1)
    this_month = date_dim.where((F.col("full_date") >= F.lit(month)) & (F.col("full_date") < F.lit(next_month(month))))
    return not nth_business_day(this_month, [business_day]).where(F.col("full_date") == F.lit(as_of)).isEmpty()


def report_frame(spark: SparkSession, sql: str, month_start: date, month_end: date) -> DataFrame:
    """The report's query. It may use ``:month_start`` and ``:month_end``, the half-open range it reports on."""
    return spark.sql(sql, args={"month_start": month_start, "month_end": month_end})


def shape(result: DataFrame, spec: ReportSpec) -> DataFrame:
    """The result as its table stores it: a text partition, and the configured types of a daily report."""
    if spec.cadence == MONTHLY:
        return result.withColumn(PARTITION, partition_id(F.col("reportmonth")))
    if spec.cadence != DAILY:
        raise ValueError(f"{spec.table}: unknown cadence {spec.cadence}")
    if spec.partition_column != PARTITION:
        raise ValueError(f"{spec.table}: a daily report must be partitioned by {PARTITION}")
    kept = {name: kind for name, kind in spec.dtypes.items() if name in result.columns}
    return result.withColumns(
        {name: F.col(name).cast(kind) for name, kind in kept.items()} | {PARTITION: F.col(PARTITION).cast("string")}
    )


def run_report(
    spark: SparkSession,
    config: CloseConfig,
    table: str,
    as_of: date,
    date_dim: DataFrame | None = None,
    written_at: datetime | None = None,
    runs: DataFrame | None = None,
) -> ReportRun:
    """Run the report for the month before ``as_of`` when it is due on that day and its sources are fresh.

    ``date_dim`` is needed by reports bound to a business day, ``written_at`` by daily reports with an extract, and
    ``runs``, the sources' runs, by reports with configured sources. Every outcome is recorded in the audit table, if
    one is configured.
    """
    spec = config.report(table)
    if spec.business_day is not None and date_dim is None:
        raise ValueError(f"{table} is bound to a business day; pass date_dim")
    if spec.sources and runs is None:
        raise ValueError(f"{table} waits for its sources; pass their runs")
    month = previous_month(as_of)
    if not is_due(date_dim, spec.business_day, as_of):
        run, metrics = ReportRun(table, NOT_DUE), {}
    else:
        checked_at = written_at or datetime.combine(as_of, time.max)
        stale = _stale_sources(runs, spec, checked_at)
        if stale:
            run, metrics = ReportRun(table, BLOCKED), {"n_stale": stale}
        else:
            run = _run_due(spark, config, spec, as_of, written_at)
            metrics = {"rows_out": run.rows}
    record_run(spark, config.audit(), JOB, table, partition_of(month), run.status, metrics)
    return run


def _stale_sources(runs: DataFrame | None, spec: ReportSpec, checked_at: datetime) -> int:
    """How many of the report's sources are not fresh."""
    if not spec.sources:
        return 0
    return report_readiness(runs, {spec.table: spec.sources}, checked_at).first().n_stale


def _run_due(spark: SparkSession, config: CloseConfig, spec: ReportSpec, as_of: date, written_at: datetime | None) -> ReportRun:
    table = spec.table
    sql = spark.read.text(config.sql_path(spec), wholetext=True).first().value
    month = previous_month(as_of)
    result = shape(report_frame(spark, sql, month, next_month(month)), spec)
    path = config.table_path(table)
    mode = spec.mode
    if mode not in ("append", "overwrite"):
        raise ValueError(f"{table}: unknown mode {mode}")
    name = f"{spec.schema_name}.{table}"
    extract = None
    if spec.cadence == DAILY and spec.output_path:
        # Table and extract must hold the same rows, so both read one stored result.
        result = store(result, table)
        if result.isEmpty():
            return ReportRun(table, EMPTY)
        written_at = written_at or datetime.combine(as_of, datetime.min.time())
        extract = daily_extract_path(config.daily_outbox(spec, as_of.replace(day=1)), spec.output_path, written_at)
        if mode == "overwrite":
            size_shuffles(spark, result)
            marker = publish_daily(spark, result, name, path, extract)
            return ReportRun(table, WRITTEN, marker.rows, path, extract)
    counted = Observation("report")
    size_shuffles(spark, result)
    write_partitioned(result.observe(counted, F.count(F.lit(1)).alias("rows")), path, mode)
    rows = counted.get["rows"]
    if rows == 0:
        # A corrected month may turn out empty: what an earlier run wrote for it must go.
        if mode == "overwrite" and spec.cadence == MONTHLY:
            clear_partition(spark, path, partition_of(month))
        return ReportRun(table, EMPTY)
    register_table(spark, name, result.schema, path, [PARTITION])
    if extract:
        write_daily_extract(result, extract)
    return ReportRun(table, WRITTEN, rows, path, extract)
