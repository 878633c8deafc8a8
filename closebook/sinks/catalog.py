"""Registration of written Parquet datasets as external tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from closebook.functions.tables import batched, literal

# Catalog calls name this many partitions at once.
TOGETHER = 500


def register_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    location: str,
    partition_by: Iterable[str] = (),
    written: Iterable[str] | None = None,
) -> None:
    """Create the external table, or change its definition in place; the files are never touched.

    A managed table of that name is refused, as dropping or moving it would delete its files. New columns and another
    location are set in place. Only a definition that cannot be reached so (a column gone, another type, other keys)
    is dropped and created anew.

    Partition keys are text and come last, whatever type they have in ``schema``. ``written`` names the values of the
    only key that were just written; a known table then adds these alone instead of listing its whole location.
    """
    keys = list(partition_by)
    fields = [(f.name, f.dataType.simpleString()) for f in schema if f.name not in keys]
    fields += [(key, "string") for key in keys]
    columns = ", ".join(f"`{name}` {kind}" for name, kind in fields)
    partitioned = f"partitioned by ({', '.join(f'`{key}`' for key in keys)})" if keys else ""
    database = table.rpartition(".")[0]
    if database:
        spark.sql(f"create database if not exists {database}")
    exists = spark.catalog.tableExists(table)
    if exists:
        exists = _adapted(spark, table, fields, keys, location)
    if not exists:
        spark.sql(f"create table {table} ({columns}) using parquet {partitioned} location {literal(location)}")
    if exists and keys and written is not None:
        add_partitions(spark, table, location, keys[0], written)
    elif keys:
        spark.sql(f"msck repair table {table}")
    spark.catalog.refreshTable(table)


def described(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table: its kind, its location and so on, by name."""
    return {r.col_name: r.data_type for r in spark.sql(f"describe formatted {table}").collect()}


def _adapted(spark: SparkSession, table: str, fields: list[tuple[str, str]], keys: list[str], location: str) -> bool:
    """Whether the table now is as wanted; if not, it has been dropped."""
    facts = described(spark, table)
    if facts.get("Type", "").upper() != "EXTERNAL":
        raise ValueError(f"{table} is not an external table; drop or rename it first")
    old_keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    old = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema if f.name not in old_keys]
    new = [field for field in fields if field[0] not in keys]
    if old_keys != keys or new[: len(old)] != old:
        spark.sql(f"drop table {table}")
        return False
    if new[len(old) :]:
        added = ", ".join(f"`{name}` {kind}" for name, kind in new[len(old) :])
        spark.sql(f"alter table {table} add columns ({added})")
    if _qualified(spark, facts["Location"]) != _qualified(spark, location):
        # Known partitions still point to the old place.
        for row in spark.sql(f"show partitions {table}").collect() if keys else []:
            parts = ", ".join(f"`{k}` = {literal(v)}" for k, v in (p.split("=", 1) for p in row.partition.split("/")))
            spark.sql(f"alter table {table} drop if exists partition ({parts})")
        spark.sql(f"alter table {table} set location {literal(location)}")
        if keys:
            spark.sql(f"msck repair table {table}")
    return True


def _qualified(spark: SparkSession, location: str) -> str:
    """The location with its file system, so that equal paths in two buckets differ."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    uri, default = path.toUri(), spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem
    if uri.getScheme() is None:
        base = default.getDefaultUri(spark.sparkContext._jsc.hadoopConfiguration())
        return f"{base.getScheme()}://{base.getAuthority() or ''}{uri.getPath()}"
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def add_partitions(spark: SparkSession, table: str, location: str, key: str, values: Iterable[str]) -> None:
    """Register partitions at ``location/key=value`` in one catalog call; known ones are left alone."""
    parts = " ".join(
        f"partition (`{key}` = {literal(value)}) location {literal(f'{location.rstrip("/")}/{key}={value}')}"
        for value in values
    )
    if parts:
        spark.sql(f"alter table {table} add if not exists {parts}")


def partition_clause(keys: Iterable[str], values: Iterable[str]) -> str:
    return f"partition ({', '.join(f'`{key}` = {literal(value)}' for key, value in zip(keys, values, strict=True))})"


def add_locations(spark: SparkSession, table: str, keys: Sequence[str], places: Iterable[tuple[Sequence[str], str]]) -> None:
    """Register partitions, each with the folder it lies in; known ones are left alone."""
    for some in batched(places, TOGETHER):
        parts = " ".join(f"{partition_clause(keys, values)} location {literal(place)}" for values, place in some)
        spark.sql(f"alter table {table} add if not exists {parts}")


def set_location(spark: SparkSession, table: str, values: Mapping[str, str], place: str) -> None:
    """Let one known partition point to another folder."""
    spark.sql(f"alter table {table} {partition_clause(values.keys(), values.values())} set location {literal(place)}")


def drop_partitions(spark: SparkSession, table: str, keys: Sequence[str], gone: Iterable[Sequence[str]]) -> None:
    """Forget partitions of an external table; no file is touched."""
    for some in batched(gone, TOGETHER):
        parts = ", ".join(partition_clause(keys, values) for values in some)
        spark.sql(f"alter table {table} drop if exists {parts}")
