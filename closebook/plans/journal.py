"""Stage, control table and ledger files of one month."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from closebook.config import CloseConfig
from closebook.functions.dates import partition_of, previous_month
from closebook.operators.journal import (
    BATCH_SIZE,
    billed_amounts,
    control_totals,
    journal_lines,
    reconcile,
    stage_batches,
)
from closebook.session import size_shuffles
from closebook.sinks.audit import record_run
from closebook.sinks.files import name_journal_files, write_journal_files
from closebook.sinks.publish import publish_partitions, publish_whole, vacuum
from closebook.sinks.tables import PARTITION
from closebook.sinks.versions import Version, write_version
from closebook.workspace import store

JOB = "journal"
WRITTEN = "written"
# The names of the two tables.
STAGE_TABLE = "stage_cashrevenue_filebatches"
CONTROL_TABLE = "monthly_rpt_journal_entry_summary_revenue"


@dataclass(frozen=True)
class JournalRun:
    stage: str
    control: str
    files: list[str]
    unmapped_lines: int


def write_stage(batches: DataFrame, root: str) -> Version:
    """The staged batches as an audited version: as many rows and the same money when read back, none without a file."""
    return write_version(
        batches, root, totals={"amount": F.sum("amount")},
        breaches={"no_file": F.col("file_no").isNull(), "no_money": F.coalesce(F.col("amount"), F.lit(0)) == 0},
    )


def write_control(control: DataFrame, root: str) -> Version:
    """The control rows as an audited version, by month: debits equal credits in every file."""
    money = ("journalitemline_debitamount", "journalitemline_creditamount")
    return write_version(
        control, root, (PARTITION,), totals={name: F.sum(name) for name in money},
        breaches={"unbalanced": F.coalesce(F.col("delta"), F.lit(1)) != 0},
    )


def run_journal(
    spark: SparkSession,
    config: CloseConfig,
    revenue: DataFrame,
    products: DataFrame,
    as_of: date,
    batch_size: int = BATCH_SIZE,
) -> JournalRun:
    """Journal entries for the month before ``as_of``. Running it again replaces that month's output.

    Stage and control table are published as audited versions: readers of the catalog see the old rows until then, and
    after a failure.
    """
    month = previous_month(as_of)
    size_shuffles(spark, revenue, products)
    batches = stage_batches(billed_amounts(revenue, report_month=month), batch_size)
    if batches.isEmpty():
        raise ValueError(f"no billed revenue for {month:%Y-%m}")
    database = config.require("nopii_db")
    stage_root = config.table_path(STAGE_TABLE)
    version = write_stage(batches, stage_root)
    stage = version.read(spark)

    # Computed once: checked, written to the files and summed up from the same rows.
    lines = store(journal_lines(stage, products), "journal-lines")
    totals = reconcile(lines).agg(
        F.count_if(F.col("delta") != 0).alias("unbalanced"), F.sum("unmapped_lines").alias("unmapped")
    )
    checked = totals.first()
    if checked.unbalanced:
        raise ValueError(f"{checked.unbalanced} files of {month:%Y-%m} do not balance")
    publish_whole(spark, f"{database}.{STAGE_TABLE}", version)
    outbox = config.journal_outbox(month)
    write_journal_files(lines, outbox)
    files = name_journal_files(spark, outbox)

    # Last, so that an audit row stands for files that balance and are there.
    control = control_totals(lines).withColumn("etl_timestamp", F.current_timestamp())
    control_root = config.table_path(CONTROL_TABLE)
    written = write_control(control, control_root)
    publish_partitions(spark, f"{database}.{CONTROL_TABLE}", control_root, written)
    for table, root in ((STAGE_TABLE, stage_root), (CONTROL_TABLE, control_root)):
        vacuum(spark, f"{database}.{table}", root)
    counts = {"rows_out": version.rows, "files": len(files), "unmapped_lines": checked.unmapped}
    record_run(spark, config.audit(), JOB, STAGE_TABLE, partition_of(month), WRITTEN, counts)
    return JournalRun(version.path, written.path, files, checked.unmapped)
