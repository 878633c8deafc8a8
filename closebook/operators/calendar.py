"""Business days and the reports due on them."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from closebook.config import ReportSpec
from closebook.functions.dates import month_start, partition_id


def date_dimension(days: DataFrame, day: Column, holidays: Iterable[date]) -> DataFrame:
    """Every date of every month between the first and the last ``day``, with its weekday and holiday flag.

    Columns follow the warehouse's date dimension.
    """
    first, last = F.min(day).cast("date"), F.max(day).cast("date")
    bounds = days.agg(month_start(first).alias("first"), F.last_day(last).alias("last"))
    dates = bounds.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    return dates.select(
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_id"),
        F.month("full_date").alias("month_number"),
        "full_date",
        F.date_format("full_date", "EEEE").alias("day_of_week"),
        F.when(F.col("full_date").isin(*holidays), 1).otherwise(0).alias("holiday_us_federal_reserve"),
    )


def business_days(date_dim: DataFrame) -> DataFrame:
    """Working days numbered within their month. A window holds one month, at most 31 rows."""
    in_month = Window.partitionBy("month_start").orderBy("full_date")
    working = date_dim.where(
        ~F.dayofweek("full_date").isin(1, 7) & (F.col("holiday_us_federal_reserve") == 0)
    )
    return working.select(month_start(F.col("full_date")).alias("month_start"), "full_date").withColumn(
        "business_day", F.row_number().over(in_month).cast("bigint")
    )


def nth_business_day(date_dim: DataFrame, numbers: Iterable[int]) -> DataFrame:
    """The date of business day n of each month. A month with fewer working days has no row for n."""
    return (
        business_days(date_dim)
        .where(F.col("business_day").isin(*numbers))
        .select("month_start", F.col("business_day").alias("n"), "full_date")
    )


def reports_due(as_of_days: DataFrame, date_dim: DataFrame, reports: Iterable[ReportSpec]) -> DataFrame:
    """For each ``as_of`` day, which reports may run: those of that business day, and those bound to none."""
    listed = F.array(
        *[
            F.struct(F.lit(r.table).alias("report"), F.lit(r.business_day).cast("bigint").alias("on_day"))
            for r in reports
        ]
    )
    numbered = business_days(date_dim).select(F.col("full_date").alias("as_of"), "business_day")
    return (
        as_of_days.select("as_of")
        .distinct()
        .join(numbered, "as_of", "left")
        .select("as_of", "business_day", F.inline(listed))
        .select(
            "as_of",
            "report",
            (F.col("on_day").isNull() | F.coalesce(F.col("on_day") == F.col("business_day"), F.lit(False))).alias(
                "due"
            ),
        )
    )


def report_month_windows(days: DataFrame, day: Column) -> DataFrame:
    """For each distinct day a job may run on: the month it reports, as a half-open date range."""
    this_month = month_start(F.col("order_date"))
    return (
        days.select(day.alias("order_date"))
        .distinct()
        .select("order_date", F.add_months(this_month, -1).alias("month_start"), this_month.alias("month_end"))
        .withColumn("partition_id", partition_id(F.col("month_start")))
    )
