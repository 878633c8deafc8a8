"""One publish of a daily report's table and its extract, both from the same stored rows.

1. The rows are written twice, where no reader looks: as an audited version of the table, and as a staged extract whose
   rows are counted when it is read back.
2. The marker: one folder below ``<root>/_published``, renamed into place. It names both. This is the commit.
3. The table's partitions are pointed to the version, and the extract is renamed to where it is fetched.

A run that is interrupted before the marker shows neither table nor extract. After it, ``finish_publish`` completes what
is left of step 3, as often as it is called; every run begins by finishing the earlier ones of its table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from closebook.functions.tables import values_table
from closebook.sinks.files import write_daily_extract
from closebook.sinks.publish import publish_partitions
from closebook.sinks.tables import PARTITION
from closebook.sinks.versions import AuditFailed, Version, stored_schema, write_version
from closebook.sources.storage import filesystem

PUBLISHED = "_published"
MARKER = [("run_id", "string"), ("version", "string"), ("staged", "string"), ("extract", "string"), ("rows", "bigint"), ("done", "boolean")]


@dataclass(frozen=True)
class Marker:
    run_id: str
    version: str
    staged: str
    extract: str
    rows: int
    done: bool


def publish_daily(spark: SparkSession, result: DataFrame, table: str, root: str, extract: str) -> Marker:
    """Publish ``result`` as partitions of ``table`` and as the extract. ``result`` must give the same rows twice."""
    finish_publish(spark, table, root, result)
    version = write_version(result, root, (PARTITION,))
    staged = f"{extract.rsplit('/', 1)[0]}/_staged/{uuid.uuid4().hex}"
    write_daily_extract(result, staged)
    found = spark.read.option("header", True).csv(staged).count()
    if found != version.rows:
        raise AuditFailed(f"{extract}: {found} rows of {version.rows}")
    marker = Marker(uuid.uuid4().hex, version.path, staged, extract, version.rows, False)
    _write_marker(spark, root, marker)
    finish_publish(spark, table, root, result)
    return marker


def finish_publish(spark: SparkSession, table: str, root: str, shape: DataFrame) -> int:
    """Carry out step 3 of every marker that is not done; ``shape`` tells the table's columns. Returns how many."""
    open_ones = [m for m in published(spark, root) if not m.done]
    for marker in open_ones:
        version = Version(marker.version, stored_schema(shape.schema, (PARTITION,)), (PARTITION,), marker.rows)
        publish_partitions(spark, table, root, version)
        _place(spark, marker.staged, marker.extract)
        _write_marker(spark, root, Marker(**{**vars(marker), "done": True}))
    return len(open_ones)


def published(spark: SparkSession, root: str) -> list[Marker]:
    """All committed runs of a table; a run is listed once, as done when it is."""
    fs, folder = filesystem(spark, f"{root.rstrip('/')}/{PUBLISHED}")
    if not fs.exists(folder):
        return []
    schema = ", ".join(f"{name} {kind}" for name, kind in MARKER)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).json(folder.toString())
    once = rows.groupBy(*[name for name, _ in MARKER[:-1]]).agg(F.bool_or("done").alias("done"))
    return [Marker(**row.asDict()) for row in once.orderBy("run_id").collect()]


def _write_marker(spark: SparkSession, root: str, marker: Marker) -> None:
    base = f"{root.rstrip('/')}"
    row = tuple(getattr(marker, name) for name, _ in MARKER)
    temporary = f"{base}/_unpublished/{uuid.uuid4().hex}"
    values_table(spark, MARKER, [row]).coalesce(1).write.json(temporary)
    fs, place = filesystem(spark, f"{base}/{PUBLISHED}/{marker.run_id}-{'done' if marker.done else 'committed'}")
    fs.mkdirs(place.getParent())
    if not fs.exists(place) and not fs.rename(filesystem(spark, temporary)[1], place):
        raise OSError(f"could not commit {root}")


def _place(spark: SparkSession, staged: str, extract: str) -> None:
    """The staged extract at its own name, in place of an earlier one of that name; nothing when it is there already."""
    fs, source = filesystem(spark, staged)
    target = filesystem(spark, extract)[1]
    if fs.exists(source):
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise OSError(f"could not rename {staged} to {extract}")
    elif not fs.exists(target):
        raise FileNotFoundError(f"neither {staged} nor {extract} is there")
