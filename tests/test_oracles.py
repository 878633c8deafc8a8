"""Every registered query against its SQL in a second engine, over the whole test tables."""

import pytest

import __spark_entry__ as entry
from closebook.checks.queries import QUERIES
from tools.compare import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


def test_known_batch_totals(spark):
    """Totals of all months at the ledger's batch size, computed independently beforehand."""
    stage = entry.queries()["je_stage_batches"](spark, SF_DIR)
    totals = stage.groupBy("file_no", "partner").agg({"*": "count", "amount": "sum"}).orderBy("file_no")
    assert [(r[0], r[1], r["count(1)"], str(r["sum(amount)"])) for r in totals.collect()] == [
        (1, "AmEx", 9998, "159883850.75"),
        (2, "AmEx", 1597, "25142185.15"),
        (3, "Non-AmEx", 9998, "163412211.43"),
        (4, "Non-AmEx", 9998, "168583169.43"),
        (5, "Non-AmEx", 9998, "177161802.51"),
        (6, "Non-AmEx", 9998, "170030147.18"),
        (7, "Non-AmEx", 8388, "134551891.38"),
    ]


def test_known_month_totals(spark):
    stage = entry.queries()["je_stage_batches_monthly"](spark, SF_DIR).where("report_month = date'1996-12-01'")
    sizes = stage.groupBy("file_no", "partner").count().orderBy("file_no").collect()
    assert [(r.partner, r["count"]) for r in sizes] == [("AmEx", 100), ("AmEx", 52)] + [("Non-AmEx", 100)] * 6 + [
        ("Non-AmEx", 51)
    ]
    assert [r.file_no for r in sizes] == list(range(1, 10))
