"""Write, audit, publish: a new version of a table is written beside the old one and shown only after its audit.

Readers of the catalog see a version once their table or partition points to it. That is one change of a location per
table or partition: until then, and after any failure, the old rows stay as they are. Old versions stay for readers
that still use them, until ``vacuum`` deletes those that the catalog no longer names.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from closebook.sinks.catalog import add_locations, register_table, set_location
from closebook.sinks.evolution import evolve_table
from closebook.sinks.versions import VERSIONS, Version, stored_versions, version_of
from closebook.sources.storage import filesystem


def publish_whole(spark: SparkSession, table: str, version: Version) -> None:
    """Show the version as the whole table."""
    if version.keys:
        raise ValueError(f"{table} is partitioned; publish its partitions")
    register_table(spark, table, version.schema, version.path)


def publish_partitions(spark: SparkSession, table: str, root: str, version: Version) -> list[str]:
    """Show the partitions that the version holds in place of the table's; all others stay. Returns their values.

    The table may have one key. Its own location is ``root``, where partitions of older jobs may lie.
    """
    (key,) = version.keys
    if spark.catalog.tableExists(table):
        # Columns may have been added or widened since; partitions keep their places.
        evolve_table(spark, table, version.schema, root, version.keys)
    else:
        register_table(spark, table, version.schema, root, version.keys)
    values = [row[0] for row in version.read(spark).select(key).distinct().collect()]
    known = {row[0] for row in spark.sql(f"show partitions {table}").collect()}
    places = {v: f"{version.path}/{key}={v}" for v in sorted(values)}
    add_locations(spark, table, version.keys, [((v,), place) for v, place in places.items() if f"{key}={v}" not in known])
    for v, place in places.items():
        if f"{key}={v}" in known:
            set_location(spark, table, {key: v}, place)
    spark.catalog.refreshTable(table)
    return values


def vacuum(spark: SparkSession, table: str, root: str, keep: int = 1) -> list[str]:
    """Delete versions that the catalog no longer names, but for the ``keep`` newest of them. Returns what went."""
    used = spark.table(table).select(version_of(F.col("_metadata.file_path")).alias("version")).distinct()
    unused = stored_versions(spark, root).join(used, "version", "left_anti")
    old = [row["version"] for row in unused.orderBy(F.desc("written_at"), "version").collect()][keep:]
    for version in old:
        fs, folder = filesystem(spark, f"{root.rstrip('/')}/{VERSIONS}/{version}")
        fs.delete(folder, True)
    return old
