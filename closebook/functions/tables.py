"""Literal tables for parameters (rates, holidays, report lists): sized by configuration, never by data."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from datetime import date, datetime
from decimal import Decimal
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def literal(value) -> str:
    """A Spark SQL literal for a Python value."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, Decimal):
        return f"{value:f}BD"
    if isinstance(value, datetime):
        return f"TIMESTAMP_NTZ'{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE'{value:%Y-%m-%d}'"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def wall_clock(moment: datetime) -> Column:
    """A time stamp without time zone, so that neither the session's nor the machine's zone shifts it."""
    return F.expr(literal(moment))


def values_table(spark: SparkSession, schema: Sequence[tuple[str, str]], rows: Iterable[Sequence]) -> DataFrame:
    """A local relation, so Catalyst knows its exact size and may fold or broadcast it."""
    rows = list(rows)
    columns = ", ".join(f"cast(`{name}` as {kind}) as `{name}`" for name, kind in schema)
    names = ", ".join(f"`{name}`" for name, _ in schema)
    tuples = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    if not rows:
        blanks = "(" + ", ".join("NULL" for _ in schema) + ")"
        return spark.sql(f"select {columns} from values {blanks} as v({names}) where false")
    return spark.sql(f"select {columns} from values {tuples} as v({names})")


def batched(values: Iterable, size: int) -> Iterator[list]:
    values = iter(values)
    while some := list(islice(values, size)):
        yield some
