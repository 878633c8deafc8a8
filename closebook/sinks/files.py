"""CSV files that leave the lake: ledger imports and daily extracts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from closebook.functions.dates import partition_id
from closebook.operators.journal import FILE_HEADER, FILE_NAME, LINE_COLUMNS, described, narrow
from closebook.sinks.tables import PARTITION
from closebook.sources.storage import filesystem, list_files

# NULL and empty text both come out blank, as the ledger import expects.
CSV_OPTIONS = {"header": True, "emptyValue": "", "nullValue": ""}


def write_journal_files(lines: DataFrame, folder: str) -> None:
    """One CSV per month and file number below ``folder/partition_id=<month>/file_no=<n>``, summary row first.

    All files are written by one job. A file is one task's output; numbering per month bounds it by the batch size
    and the summary row. Only what the other columns follow from is shuffled and sorted (``narrow``). What an earlier run left in ``folder`` goes, whatever the session's overwrite mode.
    """
    columns = [F.col(f"`{c}`").alias(FILE_HEADER.get(c, c)) for c in LINE_COLUMNS]
    (
        described(
            narrow(lines)
            .withColumn(PARTITION, partition_id(F.col("report_month")))
            .repartition(PARTITION, "file_no")
            .sortWithinPartitions(PARTITION, "file_no", "rk", "sku", "payment_date", "organization_id"),
            PARTITION,
        )
        .select(PARTITION, "file_no", *columns)
        .write.mode("overwrite")
        .options(**CSV_OPTIONS, maxRecordsPerFile=0, partitionOverwriteMode="static")
        .partitionBy(PARTITION, "file_no")
        .csv(folder)
    )


def name_journal_files(spark: SparkSession, folder: str) -> list[str]:
    """Give a month's written files their import names ``Billed_JE_<n>.csv``: renames only, no data is read."""
    fs, _ = filesystem(spark, folder)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def rename(path: str) -> str:
        number = path.rsplit("/file_no=", 1)[1].split("/", 1)[0]
        target = f"{folder.rstrip('/')}/{FILE_NAME}_{number}.csv"
        if not fs.rename(jvm_path(path), jvm_path(target)):
            raise OSError(f"could not rename {path} to {target}")
        fs.delete(jvm_path(path).getParent(), True)
        return target

    written = [path for path in list_files(spark, folder, (".csv",)) if "/file_no=" in path]
    with ThreadPoolExecutor(16) as pool:
        named = list(pool.map(rename, written))
    for emptied in {path.split("/file_no=", 1)[0] for path in written}:
        fs.delete(jvm_path(emptied), True)
    return named


def daily_extract_path(outbox: str, output_path: str, written_at: datetime) -> str:
    return f"{outbox}/{output_path}_{written_at:%m%d%Y_%H}.csv"


def write_daily_extract(df: DataFrame, path: str) -> None:
    """A folder of CSV parts; nothing is squeezed through one task."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
