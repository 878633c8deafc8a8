"""Processor files: header CSVs of one report month, every column text."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from closebook.sources.storage import list_files
from closebook.workspace import store

SUFFIXES = (".csv", ".CSV")
OPTIONS = {"recursiveFileLookup": True, "pathGlobFilter": "*.{csv,CSV}"}
# Column orders of one month's files; each is a branch of every column's expression.
MOST_LAYOUTS = 200


def month_files(spark: SparkSession, folder: str) -> list[str]:
    return list_files(spark, folder, SUFFIXES)


def file_headers(spark: SparkSession, places: str | Sequence[str]) -> DataFrame:
    """``path, header`` of every file that has a line, found by tasks: the first line that is not blank.

    ``places`` are folders or files. Only the tasks that hold a file's beginning look for its header.
    """
    lines = spark.read.options(**OPTIONS).text(places)
    lines = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"))
    named = lines.where((F.col("_start") == 0) & (F.trim("value", F.lit(" \t﻿")) != ""))
    # Rows of a file's first block are read in order by one task, so their ids are in order.
    first = named.withColumn("_place", F.monotonically_increasing_id()).groupBy("path").agg(F.min_by("value", "_place").alias("header"))
    return first.select("path", F.regexp_replace(F.rtrim("header", F.lit("\r")), "^﻿", "").alias("header"))


def _layouts(headers: DataFrame) -> list[tuple[str, list[str]]]:
    """The distinct header lines with their column names, in the order of their first files."""
    found = headers.groupBy("header").agg(F.min("path").alias("path")).orderBy("path").limit(MOST_LAYOUTS + 1).collect()
    if len(found) > MOST_LAYOUTS:
        raise ValueError(f"more than {MOST_LAYOUTS} column orders")
    layouts = [(row["header"], next(csv.reader([row["header"]]))) for row in found]
    for header, names in layouts:
        if len({n.lower() for n in names}) < len(names):
            raise ValueError(f"a header names a column twice: {header[:200]}")
    return layouts


def read_header_csv(spark: SparkSession, places: str | Sequence[str], headers: DataFrame | None = None) -> DataFrame:
    """Files joined by column name, in one scan.

    The scan takes cells by their place. Each file's header, found by ``file_headers``, says which column a place is;
    rows meet it by their file's name. A column that a file lacks is NULL in its rows; cells beyond a file's header
    are ignored.
    """
    headers = store(file_headers(spark, places), "headers") if headers is None else headers
    layouts = _layouts(headers)
    if not layouts:
        raise ValueError("no file has a header")
    spelled: dict[str, str] = {}
    for _, names in layouts:
        for name in names:
            spelled.setdefault(name.lower(), name)
    widest = max(len(names) for _, names in layouts)
    cells = spark.read.schema(", ".join(f"_{i} string" for i in range(widest))).options(**OPTIONS, header=True).csv(places)
    if len(layouts) == 1:
        return cells.select(*[F.col(f"_{i}").alias(name) for i, name in enumerate(layouts[0][1])])
    number = F.lit(None).cast("int")
    for i, (header, _) in enumerate(layouts):
        number = F.when(F.col("header") == header, i).otherwise(number)
    # Stored, so that the join knows its size: one row per file.
    known = store(headers.select(F.col("path").alias("_path"), number.alias("_layout")), "layouts")
    rows = cells.select("*", F.col("_metadata.file_path").alias("_path")).join(known, "_path")
    columns = []
    for key, name in spelled.items():
        value = F.lit(None).cast("string")
        for i, (_, names) in enumerate(layouts):
            places_of = [n.lower() for n in names]
            if key in places_of:
                value = F.when(F.col("_layout") == i, F.col(f"_{places_of.index(key)}")).otherwise(value)
        columns.append(value.alias(name))
    return rows.select(*columns)
