"""Row numbers and ranks over a whole table without gathering it in one task.

The rows are sorted by the full key and stored once, each with its slot: sort partition and place within it. Because
the slots are stored, a lost executor cannot change them. Each sort partition is then described by one small row per
scope in it (a run), and running totals over the runs turn slots into row numbers. A hot scope or a hot leading
sort key spreads over many sort partitions, as the full key tells its rows apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from closebook.workspace import store

_SLOT = "_slot"
_RUN = "_run"
# monotonically_increasing_id keeps the partition above this bit and the row within it below.
_RUN_SHIFT = 33


def sorted_runs(
    df: DataFrame, order_by: Sequence[str | Column], scope: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The stored rows with their slots, and their runs with ``_shift``: row number = ``_slot + _shift``.

    ``order_by`` must order the rows of a scope totally. ``runs`` keeps ``_rows``, so that callers can derive
    further columns per scope from it before joining it back with ``place``.
    """
    ordered = df.orderBy(*scope, *order_by).withColumn(_SLOT, F.monotonically_increasing_id())
    rows = store(ordered, "ordered").withColumn(_RUN, F.shiftright(_SLOT, _RUN_SHIFT))
    earlier = Window.partitionBy(*scope).orderBy(_RUN).rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        rows.groupBy(_RUN, *scope)
        .agg(F.min(_SLOT).alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1)
    )
    return rows, runs


def place(rows: DataFrame, runs: DataFrame, scope: Sequence[str], *extra: str) -> DataFrame:
    """Rows with their row number ``rn`` and the ``extra`` columns of their run.

    ``runs`` has one row per sort partition and scope in it, so its size follows the number of sort tasks and scopes, not
    the number of rows. It is stored as well: Catalyst then knows its true size and broadcasts it only below its
    threshold; with very many scopes the join becomes an ordinary one.
    """
    keys = [_RUN, *scope]
    theirs = store(runs.select(*[F.col(c).alias(f"_of{c}") for c in keys], "_shift", *extra), "runs")
    return rows.join(theirs, _same(keys)).withColumn("rn", F.col(_SLOT) + F.col("_shift"))


def row_numbers(df: DataFrame, order_by: Sequence[str | Column], scope: Sequence[str] = ()) -> DataFrame:
    """``row_number() over (partition by scope order by order_by)`` as column ``rn``."""
    rows, runs = sorted_runs(df, order_by, scope)
    return place(rows, runs, scope).select(*df.columns, "rn")


def ranks(df: DataFrame, value: str, tie_break: Sequence[str], name: str, scope: Sequence[str] = ()) -> DataFrame:
    """``rank() over (partition by scope order by value desc)``: the first row number among equal values."""
    numbered = row_numbers(df, [F.col(value).desc(), *tie_break], scope)
    keys = [*scope, value]
    first = numbered.groupBy(*keys).agg(F.min("rn").alias(name))
    theirs = first.select(*[F.col(c).alias(f"_of{c}") for c in keys], name)
    return numbered.join(theirs, _same(keys)).select(*df.columns, name)


def _same(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in keys])
