"""Processor columns renamed and cast by a configured mapping."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from closebook.config import ColumnMapping
from closebook.functions.dates import partition_of

CAST_TYPES = ("int", "double", "decimal(38,2)", "date")


def typed(value: Column, target_type: str) -> Column:
    """Cast that yields NULL for a bad cell; any type outside the list leaves the text as it is.

    Text of a whole number may have decimals (``2024.0``); they are cut off.
    """
    if target_type == "int":
        return F.coalesce(value.try_cast("int"), _cut(value))
    return value.try_cast(target_type) if target_type in CAST_TYPES else value


def _cut(value: Column) -> Column:
    """The whole part of a number with decimals; NULL for any other text and beyond the range of an int."""
    return F.regexp_extract(value, r"^\s*([+-]?[0-9]+)[.][0-9]*\s*$", 1).try_cast("int")


def apply_mapping(df: DataFrame, mapping: list[ColumnMapping]) -> DataFrame:
    """One projection: mapped columns renamed and cast in place, unmapped ones kept, absent ones skipped."""
    by_source = {m.source: m for m in mapping}
    targets = [by_source[c].target if c in by_source else c for c in df.columns]
    doubled = {t for t in targets if targets.count(t) > 1}
    if doubled:
        raise ValueError(f"mapping gives several columns the name {sorted(doubled)}")
    return df.select(
        *[
            typed(_column(c), by_source[c].target_type).alias(t) if c in by_source else _column(c)
            for c, t in zip(df.columns, targets, strict=True)
        ]
    )


def failed_casts(mapping: list[ColumnMapping], columns: list[str]) -> list[Column]:
    """Aggregates counting, per cast column of the raw frame, the filled cells that became NULL."""
    return [
        F.count_if(_column(m.source).isNotNull() & typed(_column(m.source), m.target_type).isNull()).alias(
            f"failed_{m.target}"
        )
        for m in mapping
        if m.source in columns and m.target_type in CAST_TYPES
    ]


def add_metadata(df: DataFrame, report_month: date) -> DataFrame:
    return df.withColumns(
        {"reportmonth": F.lit(report_month), "partition_id": F.lit(partition_of(report_month))}
    )


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
