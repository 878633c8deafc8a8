"""Normalise one processor's files of a month into its table."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Observation, SparkSession, functions as F

from closebook.config import CloseConfig
from closebook.functions.dates import partition_of, previous_month
from closebook.operators.mapping import add_metadata, apply_mapping, failed_casts
from closebook.session import size_shuffles
from closebook.sinks.audit import record_run
from closebook.sinks.catalog import register_table
from closebook.sinks.tables import PARTITION, write_partitioned
from closebook.sources.files import file_headers, read_header_csv
from closebook.sources.storage import filesystem
from closebook.workspace import store

JOB = "processor"
WRITTEN = "written"
NO_INPUT = "no input"


@dataclass(frozen=True)
class ProcessorRun:
    processor: str
    status: str
    files: int = 0
    rows: int = 0
    failed_casts: dict[str, int] = field(default_factory=dict)
    path: str | None = None


def run_processor(spark: SparkSession, config: CloseConfig, processor: str, as_of: date) -> ProcessorRun:
    """One pass over the month's files: rows in, rows out and failed casts are observed while the table is written.

    They are then recorded in the audit table, if one is configured, also for a month without files.
    """
    spec = config.processor(processor)
    month = previous_month(as_of)
    inbox = config.processor_inbox(spec, month)
    database = config.require("nopii_db")

    def recorded(run: ProcessorRun, metrics: dict[str, int]) -> ProcessorRun:
        record_run(spark, config.audit(), JOB, spec.table, partition_of(month), run.status, metrics)
        return run

    fs, folder = filesystem(spark, inbox)
    headers = store(file_headers(spark, inbox), "headers") if fs.exists(folder) else None
    files = headers.count() if headers is not None else 0
    if not files:
        return recorded(ProcessorRun(processor, NO_INPUT), {"files": 0})
    raw = read_header_csv(spark, inbox, headers)
    size_shuffles(spark, raw)
    taken, given = Observation("taken"), Observation("given")
    observed = raw.observe(taken, F.count(F.lit(1)).alias("rows"), *failed_casts(spec.mapping, raw.columns))
    table = add_metadata(apply_mapping(observed, spec.mapping), month).withColumn(
        "etl_timestamp", F.current_timestamp()
    )
    path = config.table_path(spec.table)
    write_partitioned(table.observe(given, F.count(F.lit(1)).alias("rows")), path, rows_per_file=0)
    seen, written = taken.get, given.get
    register_table(spark, f"{database}.{spec.table}", table.schema, path, [PARTITION], [partition_of(month)])
    casts = {name: n for name, n in seen.items() if name.startswith("failed_")}
    failed = {name.removeprefix("failed_"): n for name, n in casts.items() if n}
    run = ProcessorRun(processor, WRITTEN, files, seen["rows"], failed, path)
    return recorded(run, {"files": files, "rows_in": seen["rows"], "rows_out": written["rows"], **casts})
