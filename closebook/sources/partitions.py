"""Partitions as the catalog names them and as storage holds them, and the difference of the two.

All of it is metadata: names of the catalog, file names with their sizes, and row counts of file footers. No column of
any row is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from closebook.sinks.catalog import add_locations, drop_partitions, set_location
from closebook.sinks.versions import VERSIONS
from closebook.sources.storage import filesystem

OK, MISSING, STALE, MOVED = "ok", "missing", "stale", "moved"
# Fixed value: what names the partition of rows without a key.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def _folder(path: Column) -> Column:
    """A file's folder, spelled alike whatever wrote the path."""
    return F.regexp_replace(F.regexp_replace(path, "/[^/]+$", ""), "^file:/+", "file:/")


def _values(spec: Column, keys: Sequence[str]) -> list[Column]:
    """Key values of ``a=1/b=2``; escaped characters as they were before."""
    return [F.url_decode(F.regexp_replace(F.regexp_extract(spec, f"(?:^|/){key}=([^/]*)", 1), r"\+", "%2B")).alias(key) for key in keys]


def catalog_partitions(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """One row per registered partition: its keys, and the folder, files and rows that readers of the table get.

    A partition without files has no folder and 0 files.
    """
    named = spark.sql(f"show partitions {table}").select(*_values(F.col("partition"), keys))
    names = [F.coalesce(F.col(f"`{key}`"), F.lit(NO_KEY)).alias(key) for key in keys]
    files = spark.table(table).groupBy(*names, F.col("_metadata.file_path").alias("_path")).agg(F.count("*").alias("_rows"))
    held = files.groupBy(*keys).agg(
        F.min(_folder(F.col("_path"))).alias("folder"), F.count("*").alias("n_files"), F.sum("_rows").alias("n_rows")
    )
    zero = {"n_files": 0, "n_rows": 0}
    return named.join(held, list(keys), "left").na.fill(zero)


def storage_partitions(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """One row per partition folder below ``root``: its keys, folder, files and bytes. Versions do not count."""
    schema = ", ".join(f"`{key}` string" for key in keys) + ", folder string, n_files long, n_bytes long"
    fs, place = filesystem(spark, root)
    if not fs.exists(place):
        return spark.createDataFrame([], schema)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    files = listed.where(~F.col("path").contains(f"/{VERSIONS}/")).select(_folder(F.col("path")).alias("folder"), "length")
    spec = F.regexp_extract("folder", "/(" + "/".join(f"{key}=[^/]*" for key in keys) + ")$", 1)
    found = files.withColumn("_spec", spec).where("_spec != ''").select(*_values(F.col("_spec"), keys), "folder", "length")
    return found.groupBy(*keys, "folder").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def partition_difference(spark: SparkSession, table: str, root: str, keys: Sequence[str]) -> DataFrame:
    """One row per partition of either side, with ``status``:

    * ``ok``: the catalog names the folder that storage has;
    * ``missing``: storage has files that the catalog does not name;
    * ``stale``: the catalog names a partition that has no files anywhere;
    * ``moved``: the catalog's files lie elsewhere than below ``root``. If ``root`` has a folder for it, too,
      ``storage_folder`` tells it.
    """
    ours = catalog_partitions(spark, table, keys).withColumnsRenamed({"folder": "catalog_folder"}).withColumn("_named", F.lit(True))
    theirs = storage_partitions(spark, root, keys).select(*keys, F.col("folder").alias("storage_folder"))
    both = ours.join(theirs, list(keys), "full")
    status = (
        F.when(F.col("_named").isNull(), MISSING)
        .when(F.col("catalog_folder").isNull(), F.when(F.col("storage_folder").isNull(), STALE).otherwise(MOVED))
        .when(F.coalesce(F.col("catalog_folder") == F.col("storage_folder"), F.lit(False)), OK)
        .otherwise(MOVED)
    )
    return both.select(*keys, status.alias("status"), "catalog_folder", "storage_folder", "n_files", "n_rows")


def reconcile_partitions(spark: SparkSession, table: str, root: str, keys: Sequence[str]) -> dict[str, int]:
    """Make the catalog name what lies below ``root``: add missing partitions, drop stale ones, point moved ones back.

    A moved partition without a folder below ``root`` stays where it is. Returns the changes by kind. Only differing
    partitions come to the driver, some hundreds at a time.
    """
    differing = partition_difference(spark, table, root, keys).where(F.col("status") != OK).collect()
    values = {kind: [r for r in differing if r["status"] == kind] for kind in (MISSING, STALE, MOVED)}
    spec = lambda row: tuple(row[key] for key in keys)
    add_locations(spark, table, keys, ((spec(r), r["storage_folder"]) for r in values[MISSING]))
    drop_partitions(spark, table, keys, (spec(r) for r in values[STALE]))
    back = [r for r in values[MOVED] if r["storage_folder"] is not None]
    for row in back:
        set_location(spark, table, dict(zip(keys, spec(row), strict=True)), row["storage_folder"])
    spark.catalog.refreshTable(table)
    return {MISSING: len(values[MISSING]), STALE: len(values[STALE]), MOVED: len(back)}
