"""Intermediate tables in the folder that all executors share.

A stored table cuts the lineage: a lost executor costs a re-read, never a recomputation with another outcome.
"""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from closebook.sources.storage import filesystem

_created: list[str] = []
_places: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; without it one below the warehouse, which is shared too."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return (shared or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{folder(spark)}/closebook/{name}-{uuid.uuid4().hex}"
    _created.append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Delete what this process stored. Frames that read it must be done with by then."""
    while _created:
        fs, path = filesystem(spark, _created.pop())
        fs.delete(path, True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of what was written."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    _places[kept] = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete stored tables. Whatever reads them must have been stored by then."""
    for table in tables:
        path = _places.pop(table)
        _created.remove(path)
        fs, place = filesystem(table.sparkSession, path)
        fs.delete(place, True)
