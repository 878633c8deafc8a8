from datetime import date

import pytest
from pyspark.sql import functions as F

from closebook.config import ReportSpec
from closebook.functions.tables import values_table
from closebook.operators.calendar import business_days, date_dimension, nth_business_day, reports_due
from closebook.plans.report import is_due


def dim(spark, first, last, holidays=()):
    days = values_table(spark, [("day", "date")], [(first,), (last,)])
    return date_dimension(days, F.col("day"), holidays)


@pytest.fixture(scope="module")
def winter(spark):
    return dim(spark, date(2023, 12, 15), date(2024, 3, 2), [date(2024, 1, 1), date(2024, 1, 15), date(2024, 2, 19)])


def test_dimension_covers_whole_months(winter):
    assert winter.count() == 31 + 31 + 29 + 31
    row = winter.where("full_date = date'2024-02-19'").first()
    assert (row.date_id, row.month_number, row.day_of_week, row.holiday_us_federal_reserve) == (20240219, 2, "Monday", 1)


def test_first_business_days(winter):
    """2024-01-01 is a holiday, 2023-12-01 a Friday, 2024-02-01 a Thursday."""
    days = nth_business_day(winter, [1]).orderBy("month_start").collect()
    assert [d.full_date for d in days] == [date(2023, 12, 1), date(2024, 1, 2), date(2024, 2, 1), date(2024, 3, 1)]


def test_month_starting_on_a_weekend(spark):
    june = dim(spark, date(2024, 6, 10), date(2024, 6, 10))
    assert nth_business_day(june, [1]).first().full_date == date(2024, 6, 3)


def test_months_of_different_years_stay_apart(spark):
    two_years = dim(spark, date(2023, 1, 1), date(2024, 1, 31))
    firsts = business_days(two_years).where("business_day = 1 and month(full_date) = 1").collect()
    assert sorted(d.full_date for d in firsts) == [date(2023, 1, 2), date(2024, 1, 1)]


def test_fewer_days_than_asked(spark):
    month = [date(2024, 2, d) for d in range(1, 30)]
    closed = dim(spark, month[0], month[-1], month[2:])
    assert nth_business_day(closed, [1, 2, 3]).count() == 2
    assert not is_due(closed, 3, date(2024, 2, 5))


def test_reports_due(spark, winter):
    reports = [ReportSpec("first", business_day=1), ReportSpec("second", business_day=2), ReportSpec("any")]
    days = values_table(spark, [("as_of", "date")], [(date(2024, 1, 1),), (date(2024, 1, 2),), (date(2024, 1, 3),)])
    due = {(r.as_of.day, r.report): r.due for r in reports_due(days, winter, reports).collect()}
    assert due == {
        (1, "first"): False,
        (1, "second"): False,
        (1, "any"): True,
        (2, "first"): True,
        (2, "second"): False,
        (2, "any"): True,
        (3, "first"): False,
        (3, "second"): True,
        (3, "any"): True,
    }


def test_day_outside_the_dimension_is_not_due(spark, winter):
    days = values_table(spark, [("as_of", "date")], [(date(2030, 1, 1),)])
    reports = [ReportSpec("first", business_day=1), ReportSpec("any")]
    assert {r.report: r.due for r in reports_due(days, winter, reports).collect()} == {"first": False, "any": True}


def test_gate(winter):
    assert is_due(winter, 1, date(2024, 1, 2))
    assert not is_due(winter, 1, date(2024, 1, 1))
    assert is_due(None, None, date(2024, 1, 1))
