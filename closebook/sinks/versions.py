"""Versions of a table: folders of their own below ``<root>/_versions``, audited when they are written.

Readers of ``root`` do not see them. ``closebook.sinks.publish`` shows them to readers of the catalog.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from closebook.sinks.tables import ROWS_PER_FILE
from closebook.sources.storage import filesystem

VERSIONS = "_versions"
ROWS = "rows"


class AuditFailed(ValueError):
    """The written version is not what the job computed, or breaks a rule; nothing was published."""


@dataclass(frozen=True)
class Version:
    path: str
    schema: StructType
    keys: tuple[str, ...] = ()
    rows: int = 0
    metrics: dict[str, object] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def write_version(
    df: DataFrame,
    root: str,
    keys: Sequence[str] = (),
    totals: Mapping[str, Column] | None = None,
    breaches: Mapping[str, Column] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> Version:
    """Write ``df`` as a new version and audit it.

    ``totals`` are aggregates that must be the same when the files are read back, as must be the number of rows;
    ``breaches`` are conditions that no row may meet. Both are observed by the writing job itself.
    """
    spark = df.sparkSession
    totals, breaches = dict(totals or {}), dict(breaches or {})
    seen = Observation("version")
    counted = [F.count_if(F.coalesce(rule, F.lit(False))).alias(f"breach_{name}") for name, rule in breaches.items()]
    observed = df.observe(
        seen, F.count(F.lit(1)).alias(ROWS), *[total.alias(name) for name, total in totals.items()], *counted
    )
    path = f"{root.rstrip('/')}/{VERSIONS}/{uuid.uuid4().hex}"
    writer = observed.write.option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*keys) if keys else writer).parquet(path)
    metrics = seen.get
    version = Version(path, stored_schema(df.schema, keys), tuple(keys), metrics[ROWS], metrics)
    broken = {name: metrics[f"breach_{name}"] for name in breaches if metrics[f"breach_{name}"]}
    if broken:
        raise AuditFailed(f"{root}: rows that break a rule: {broken}")
    again = version.read(spark).agg(F.count(F.lit(1)).alias(ROWS), *[t.alias(name) for name, t in totals.items()]).first()
    differing = {name: (metrics[name], again[name]) for name in (ROWS, *totals) if metrics[name] != again[name]}
    if differing:
        raise AuditFailed(f"{root}: written and read back differ: {differing}")
    return version


def stored_schema(schema: StructType, keys: Sequence[str]) -> StructType:
    """Partition keys are text and come last."""
    kept = StructType([f for f in schema if f.name not in keys])
    for key in keys:
        kept.add(key, "string")
    return kept


def version_of(path: Column) -> Column:
    """The version that a file's path lies in; NULL for files outside any."""
    return F.nullif(F.regexp_extract(path, f"/{VERSIONS}/([0-9a-f]+)/", 1), F.lit(""))


def stored_versions(spark: SparkSession, root: str) -> DataFrame:
    """``version, files, bytes, written_at`` of every version below ``root``; names and sizes alone are read."""
    fs, folder = filesystem(spark, f"{root.rstrip('/')}/{VERSIONS}")
    if not fs.exists(folder):
        return spark.createDataFrame([], "version string, files long, bytes long, written_at timestamp")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    found = listed.load(f"{folder.toString()}").select(version_of(F.col("path")).alias("version"), "length", "modificationTime")
    return found.groupBy("version").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("written_at")
    )
