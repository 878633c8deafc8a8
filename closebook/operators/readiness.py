"""Which sources are fresh, and which reports may run on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window, functions as F

from closebook.functions.tables import values_table, wall_clock

LATEST_RUNS = 5
WINDOW = timedelta(hours=24)
SUCCEEDED = "SUCCEEDED"


def source_freshness(
    runs: DataFrame, as_of: datetime, latest: int = LATEST_RUNS, window: timedelta = WINDOW
) -> DataFrame:
    """A source is fresh when one of its latest runs succeeded within the window before ``as_of``.

    Spark keeps only the latest runs of each job before the shuffle, so a job with a huge history costs no more than
    any other.
    """
    newest_first = Window.partitionBy("job_name").orderBy(F.desc("started_on"), F.desc("run_id"))
    done = F.when((F.col("state") == SUCCEEDED) & (F.col("completed_on") <= wall_clock(as_of)), F.col("completed_on"))
    return (
        runs.where(F.col("started_on") <= wall_clock(as_of))
        .select("job_name", "run_id", "state", "started_on", "completed_on")
        .withColumn("_age", F.row_number().over(newest_first))
        .where(F.col("_age") <= latest)
        .groupBy("job_name")
        .agg(F.max(done).alias("last_success"))
        .withColumn("fresh", F.coalesce(F.col("last_success") > wall_clock(as_of - window), F.lit(False)))
    )


def report_readiness(
    runs: DataFrame, dependencies: Mapping[str, Sequence[str]], as_of: datetime, **freshness
) -> DataFrame:
    """A report is ready when each of its sources is fresh; a source that never ran is stale.

    ``dependencies`` lists the sources of each report. Only those sources' runs are read.
    """
    wanted = sorted({source for sources in dependencies.values() for source in sources})
    pairs = values_table(
        runs.sparkSession,
        [("report", "string"), ("job_name", "string")],
        [(report, source) for report, sources in dependencies.items() for source in sources or [None]],
    )
    known = source_freshness(runs.where(F.col("job_name").isin(*wanted)), as_of, **freshness)
    stale = F.col("job_name").isNotNull() & ~F.coalesce("fresh", F.lit(False))
    return (
        pairs.join(known, "job_name", "left")
        .groupBy("report")
        .agg(F.count("job_name").alias("n_sources"), F.count_if(stale).alias("n_stale"))
        .withColumn("ready", F.col("n_stale") == 0)
    )
