"""Parquet tables, partitioned by ``partition_id`` and safe to write again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from closebook.sources.storage import filesystem

PARTITION = "partition_id"
ROWS_PER_FILE = 100_000


def write_partitioned(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = (PARTITION,),
    rows_per_file: int = ROWS_PER_FILE,
    many_partitions: bool = False,
) -> None:
    """Write the table's partitions that occur in ``df``; ``overwrite`` leaves all others as they are.

    Writing the same month again therefore replaces it. An empty frame changes nothing. A run of one month is written
    as it comes. With ``many_partitions`` the rows are first rebalanced by partition, so that each is written by few
    tasks; adaptive execution splits a large one over several. ``rows_per_file`` 0 sets no limit.
    """
    if many_partitions:
        df = df.hint("rebalance", *partition_by)
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_whole(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Replace an unpartitioned table."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def clear_partition(spark: SparkSession, path: str, value: str) -> None:
    """Delete what a partition of the table holds, if it is there."""
    fs, folder = filesystem(spark, f"{path.rstrip('/')}/{PARTITION}={value}")
    fs.delete(folder, True)
