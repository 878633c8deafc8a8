"""Report tables by catalog name or by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from closebook.functions.dates import partition_of


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a Parquet dataset when the name is a path."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def read_month(spark: SparkSession, name_or_path: str, month) -> DataFrame:
    """One month's partition of a report table."""
    return read_table(spark, name_or_path).where(f"partition_id = '{partition_of(month)}'")


def partition_inventory(table: DataFrame, partition_column: str = "partition_id") -> DataFrame:
    """The partition values that hold rows, with their number of rows."""
    return table.groupBy(partition_column).count().withColumnRenamed("count", "n_rows")


def partition_values(spark: SparkSession, table: str) -> list[str]:
    """All values of the first partition key of a catalog table, from the catalog alone."""
    listed = spark.sql(f"show partitions {table}").toLocalIterator()
    first = (row.partition.split("/")[0].split("=", 1)[1] for row in listed)
    return list(dict.fromkeys(first))
