"""Report-month arithmetic. Every job takes ``as_of``; nothing reads the clock."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

PARTITION_FORMAT = "yyyy-MM"


def previous_month(as_of: date) -> date:
    """First day of the month before the one ``as_of`` lies in."""
    return date(as_of.year - (as_of.month == 1), (as_of.month - 2) % 12 + 1, 1)


def next_month(month: date) -> date:
    return date(month.year + (month.month == 12), month.month % 12 + 1, 1)


def partition_of(month: date) -> str:
    return f"{month:%Y-%m}"


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def partition_id(month: Column) -> Column:
    return F.date_format(month, PARTITION_FORMAT)


def month_label(month: Column) -> Column:
    """``Mar 2024``"""
    return F.date_format(month, "MMM yyyy")
