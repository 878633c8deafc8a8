"""Schema evolution of external catalog tables: what changes, and whether files can stay as they are.

A plan lists one step per column and key that differs:

* ``add``: a new column, NULL in the files there are;
* ``widen``: a wider type that readers take from the old files;
* ``reorder``, ``drop``: another order, or a column less; the files keep it;
* ``rewrite``: a type that the old files cannot be read as; rows are cast and written anew, and a cell that does not
  survive the cast stops it;
* ``rekey``: other partition keys; rows are written anew, below their new keys.

``evolve_table`` carries a plan out. Steps of the first three kinds change the definition alone. The others write a
new, audited version, and the table points to it only when it is whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructType,
    TimestampNTZType,
)

from closebook.functions.tables import literal
from closebook.sinks.catalog import add_locations, described
from closebook.sinks.versions import write_version

ADD, WIDEN, REORDER, DROP, REWRITE, REKEY = "add", "widen", "reorder", "drop", "rewrite", "rekey"

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


@dataclass(frozen=True)
class Step:
    action: str
    column: str
    before: str | None = None
    after: str | None = None


def widens(old: DataType, new: DataType) -> bool:
    """Whether files written as ``old`` are read as ``new`` without loss."""
    if type(old) in _WHOLE and type(new) in _WHOLE:
        return _WHOLE.index(type(new)) > _WHOLE.index(type(old))
    if isinstance(old, (ByteType, ShortType, IntegerType, FloatType)) and isinstance(new, DoubleType):
        return True
    if isinstance(old, DateType) and isinstance(new, TimestampNTZType):
        return True
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale and new != old
    return False


def plan_evolution(old: StructType, old_keys: Sequence[str], new: StructType, new_keys: Sequence[str]) -> list[Step]:
    """The steps from one definition to the other; none when they are the same. Keys are compared by name: they are text."""
    steps = []
    before = {f.name: f.dataType for f in old if f.name not in old_keys}
    after = {f.name: f.dataType for f in new if f.name not in new_keys}
    for name, kind in after.items():
        was = before.get(name)
        if was is None:
            # A former key becomes a column: its values are only in the folders' names.
            steps.append(Step(REWRITE if name in old_keys else ADD, name, "string" if name in old_keys else None, kind.simpleString()))
        elif was != kind:
            steps.append(Step(WIDEN if widens(was, kind) else REWRITE, name, was.simpleString(), kind.simpleString()))
    steps += [Step(DROP, name, kind.simpleString()) for name, kind in before.items() if name not in after and name not in new_keys]
    kept = [name for name in after if name in before]
    if kept != [name for name in before if name in after] or list(after)[: len(kept)] != kept:
        steps.append(Step(REORDER, ", ".join(after)))
    if list(old_keys) != list(new_keys):
        steps.append(Step(REKEY, ", ".join(new_keys), ", ".join(old_keys), ", ".join(new_keys)))
    return steps


def table_definition(spark: SparkSession, table: str) -> tuple[StructType, list[str]]:
    keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return spark.table(table).schema, keys


def evolve_table(spark: SparkSession, table: str, schema: StructType, root: str, keys: Sequence[str] = ()) -> list[Step]:
    """Bring an external table to the wanted columns and keys, and return the steps that were taken.

    New versions go below ``root``. Values of new keys come from columns or former keys of that name.
    """
    facts = described(spark, table)
    if facts.get("Type", "").upper() != "EXTERNAL":
        raise ValueError(f"{table} is not an external table; its files would go with its definition")
    old, old_keys = table_definition(spark, table)
    steps = plan_evolution(old, old_keys, schema, keys)
    actions = {step.action for step in steps}
    if actions & {REWRITE, REKEY}:
        _rewrite(spark, table, schema, root, keys)
    elif actions == {ADD}:
        added = ", ".join(f"`{step.column}` {step.after}" for step in steps)
        spark.sql(f"alter table {table} add columns ({added})")
    elif actions:
        places = partition_places(spark, table, old_keys) if keys else []
        _define(spark, table, schema, keys, facts["Location"])
        add_locations(spark, table, keys, places)
    spark.catalog.refreshTable(table)
    return steps


def converted(df: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The rows in the wanted columns: cast where types differ, NULL where a column is new. A lost cell fails the job."""
    columns = []
    for f in schema:
        kind = "string" if f.name in keys else f.dataType.simpleString()
        if f.name not in df.columns:
            columns.append(F.lit(None).cast(kind).alias(f.name))
            continue
        own, cast = F.col(f"`{f.name}`"), F.col(f"`{f.name}`").try_cast(kind)
        lost = F.raise_error(F.lit(f"a value of {f.name} is no {kind}")).cast(kind)
        columns.append(F.when(own.isNotNull() & cast.isNull(), lost).otherwise(cast).alias(f.name))
    return df.select(*columns)


def _rewrite(spark: SparkSession, table: str, schema: StructType, root: str, keys: Sequence[str]) -> None:
    rows = converted(spark.table(table), schema, keys)
    if keys:
        rows = rows.hint("rebalance", *keys)
    version = write_version(rows, root, keys)
    _define(spark, table, schema, keys, version.path)
    if keys:
        spark.sql(f"msck repair table {table}")


def _define(spark: SparkSession, table: str, schema: StructType, keys: Sequence[str], location: str) -> None:
    """Another definition of the same files. Both statements touch the catalog alone."""
    fields = [(f.name, f.dataType.simpleString()) for f in schema if f.name not in keys] + [(key, "string") for key in keys]
    columns = ", ".join(f"`{name}` {kind}" for name, kind in fields)
    partitioned = f"partitioned by ({', '.join(f'`{key}`' for key in keys)})" if keys else ""
    spark.sql(f"drop table {table}")
    spark.sql(f"create table {table} ({columns}) using parquet {partitioned} location {literal(location)}")


def partition_places(spark: SparkSession, table: str, keys: Sequence[str]) -> list[tuple[tuple[str, ...], str]]:
    """Values and folder of every partition that has files. Catalog entries and file names are read, no rows."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]+$", "")
    names = [F.col(f"`{key}`") for key in keys]
    rows = spark.table(table).select(*names, folder.alias("_folder")).distinct().toLocalIterator()
    return [(tuple(row[: len(keys)]), row["_folder"]) for row in rows]

