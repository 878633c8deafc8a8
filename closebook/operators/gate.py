"""Whether reports may run now: bound to their business day, and to sources that are fresh."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from closebook.config import ReportSpec
from closebook.functions.tables import values_table
from closebook.operators.calendar import reports_due
from closebook.operators.readiness import report_readiness

READY, BLOCKED, NOT_DUE = "ready", "blocked", "not due"


def report_gate(
    date_dim: DataFrame,
    reports: Iterable[ReportSpec],
    runs: DataFrame,
    dependencies: Mapping[str, Sequence[str]],
    as_of: datetime,
    **freshness,
) -> DataFrame:
    """``as_of, report, n_sources, n_stale, status`` of every report.

    A report of another business day is ``not due``, whatever its sources are; a due one with a stale source is
    ``blocked``. A report without listed sources waits for none.
    """
    reports = list(reports)
    spark = runs.sparkSession
    today = values_table(spark, [("as_of", "date")], [(as_of.date(),)])
    due = reports_due(today, date_dim, reports)
    known = report_readiness(runs, {r.table: dependencies.get(r.table, []) for r in reports}, as_of, **freshness)
    status = F.when(~F.col("due"), NOT_DUE).when(F.col("n_stale") > 0, BLOCKED).otherwise(READY)
    return due.join(known, "report").select("as_of", "report", "n_sources", "n_stale", status.alias("status"))
