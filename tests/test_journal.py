from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from closebook.operators import journal as j

LINES = (
    "reportmonth date, organization_id bigint, payment_date date, sku bigint, partner_type string,"
    " amount decimal(33,2), partition_id string"
)
M = date(2024, 3, 1)
D = date(2024, 3, 10)


def lines(spark, rows):
    return spark.createDataFrame(
        [(M, org, D, sku, partner, Decimal(amount), "2024-03") for org, sku, partner, amount in rows], LINES
    )


def many(spark, n, partner, first=0):
    return spark.range(first, first + n).select(
        F.lit(M).alias("reportmonth"),
        F.col("id").alias("organization_id"),
        F.lit(D).alias("payment_date"),
        F.lit(5).cast("bigint").alias("sku"),
        F.lit(partner).alias("partner_type"),
        F.lit(Decimal("1.25")).cast("decimal(33,2)").alias("amount"),
        F.lit("2024-03").alias("partition_id"),
    )


def products(spark):
    return spark.createDataFrame(
        [
            (1, "one", "40001", "Subscription Revenue", "SKU100 - one"),
            (2, "two", "40002", "Transaction Revenue", "12-two"),
            (3, "three", "40003", "Other Revenue", "three"),
            (4, "four", "40004", "Other Revenue", None),
            (None, "none", "40005", "Other Revenue", "x-y"),
        ],
        "sku bigint, sku_product_description string, netsuite_gl_account_number string, product_group string,"
        " netsuite_sku string",
    )


def test_filters_and_zero_sums(spark):
    rows = [
        (1, 1, "AmEx", "10.00"),
        (1, 1, "AmEx", "-4.00"),
        (2, 1, "AmEx", "5.00"),
        (2, 1, "AmEx", "-5.00"),
        (3, 1, None, "7.00"),
        (4, None, "Bank", "8.00"),
        (5, 92, "Bank", "9.00"),
        (6, 9999, "AmEx", "9.00"),
        (7, 2, "Bank", "1.00"),
        (7, 2, "Shop", "2.00"),
    ]
    found = {(r.organization_id, r.partner): str(r.amount) for r in j.billed_amounts(lines(spark, rows)).collect()}
    assert found == {(1, "AmEx"): "6.00", (7, "Non-AmEx"): "3.00"}


def test_other_months_are_left_out(spark):
    other = lines(spark, [(1, 1, "AmEx", "1.00")]).withColumns(
        {"reportmonth": F.lit(date(2024, 2, 1)), "partition_id": F.lit("2024-02")}
    )
    both = lines(spark, [(2, 1, "AmEx", "1.00")]).unionByName(other)
    assert [r.organization_id for r in j.billed_amounts(both, report_month=M).collect()] == [2]


@pytest.mark.parametrize(("n", "sizes"), [(9998, [9998]), (9999, [9998, 1])])
def test_full_file_and_one_more(spark, n, sizes):
    stage = j.stage_batches(j.billed_amounts(many(spark, n, "AmEx")))
    assert [r["count"] for r in stage.groupBy("file_no").count().orderBy("file_no").collect()] == sizes


def test_partners_get_their_own_files(spark):
    both = many(spark, 25, "AmEx").unionByName(many(spark, 31, "Bank", 1000))
    stage = j.stage_batches(j.billed_amounts(both), 10)
    files = stage.groupBy("file_no").agg(F.collect_set("partner").alias("p"), F.count("*").alias("n"))
    assert [(r.file_no, r.p, r.n) for r in files.orderBy("file_no").collect()] == [
        (1, ["AmEx"], 10),
        (2, ["AmEx"], 10),
        (3, ["AmEx"], 5),
        (4, ["Non-AmEx"], 10),
        (5, ["Non-AmEx"], 10),
        (6, ["Non-AmEx"], 10),
        (7, ["Non-AmEx"], 1),
    ]


def test_without_card_rows_numbers_start_at_one(spark):
    stage = j.stage_batches(j.billed_amounts(many(spark, 12, "Bank")), 10)
    assert sorted({r.file_no for r in stage.collect()}) == [1, 2]


def test_every_month_starts_at_one(spark):
    march = many(spark, 15, "AmEx").unionByName(many(spark, 5, "Bank", 100))
    april = many(spark, 12, "Bank", 200).withColumn("reportmonth", F.lit(date(2024, 4, 1)))
    stage = j.stage_batches(j.billed_amounts(march.unionByName(april)), 10, per_month=True)
    files = stage.groupBy("report_month", "file_no", "partner").count().orderBy("report_month", "file_no").collect()
    assert [(r.report_month.month, r.file_no, r.partner, r["count"]) for r in files] == [
        (3, 1, "AmEx", 10),
        (3, 2, "AmEx", 5),
        (3, 3, "Non-AmEx", 5),
        (4, 1, "Non-AmEx", 10),
        (4, 2, "Non-AmEx", 2),
    ]


def test_numbering_does_not_depend_on_the_partitioning(spark):
    amounts = j.billed_amounts(many(spark, 500, "AmEx").unionByName(many(spark, 700, "Bank", 5000)))
    first = {(r.organization_id, r.file_no) for r in j.stage_batches(amounts.repartition(3), 64).collect()}
    second = {(r.organization_id, r.file_no) for r in j.stage_batches(amounts.repartition(8), 64).collect()}
    assert first == second
    assert len(first) == 1200


def test_product_codes(spark):
    found = {r.sku: (r.sku_num, r.sku_num_desc) for r in j.product_dimension(products(spark)).collect()}
    assert found == {1: ("SKU100", "SKU100"), 2: ("12", "two"), 3: ("", "three"), 4: (None, None)}


@pytest.fixture(scope="module")
def booked(spark):
    rows = [
        (1, 1, "AmEx", "10.00"),
        (2, 2, "AmEx", "20.00"),
        (3, 3, "AmEx", "30.00"),
        (4, 1, "Bank", "-5.00"),
        (5, 77, "Bank", "8.00"),
    ]
    stage = j.stage_batches(j.billed_amounts(lines(spark, rows)), 10)
    return stage, j.journal_lines(stage, products(spark))


def test_lines(booked):
    _, all_lines = booked
    rows = all_lines.orderBy("file_no", "rk", "sku").collect()
    short = [
        (
            r.file_no,
            r.rk,
            r.journalItemLine_accountRef,
            str(r.journalItemLine_debitAmount),
            str(r.journalItemLine_creditAmount),
            r.journalItemLine_entityRef,
            r["Item Reference"],
        )
        for r in rows
    ]
    assert short == [
        (1, 0, "11181", "60.00", "None", "", ""),
        (1, 1, "45010", "None", "10.00", "1", "SKU-Bank Sub"),
        (1, 1, "45020", "None", "20.00", "2", "SKU-Bank Tran"),
        (1, 1, None, "None", "30.00", "3", None),
        (2, 0, "11181", "3.00", "None", "", ""),
        (2, 1, "40001", "None", "-5.00", "4", "SKU100"),
        (2, 1, None, "None", "8.00", "5", None),
    ]
    assert rows[0].tranid == "Billed Revenue JE 1 - Mar 2024"
    assert rows[0].tranDate == date(2024, 3, 31)
    assert rows[0].journalItemLine_memo == "AmEx Billed Revenue - Mar 2024"
    assert rows[4].journalItemLine_memo == "Billed Revenue - Mar 2024"


def test_reconciliation_counts_unmapped_lines(booked):
    _, all_lines = booked
    found = [(r.file_no, str(r.debit), str(r.credit), r.delta, r.unmapped_lines, r.n_lines) for r in
             j.reconcile(all_lines).orderBy("file_no").collect()]
    assert found == [(1, "60.00", "60.00", 0, 1, 4), (2, "3.00", "3.00", 0, 1, 3)]


def test_reconciliation_sees_a_lost_line(booked):
    _, all_lines = booked
    short = all_lines.where(~((F.col("rk") == 1) & (F.col("sku") == 2)))
    assert {r.file_no: str(r.delta) for r in j.reconcile(short).collect()} == {1: "20.00", 2: "0.00"}


def test_control_totals(booked):
    _, all_lines = booked
    short = all_lines.where(~((F.col("rk") == 1) & (F.col("sku") == 2)))
    assert {r.je_file_no: str(r.delta) for r in j.control_totals(short).collect()} == {1: "20.00", 2: "0.00"}
    rows = j.control_totals(all_lines).orderBy("je_file_no").collect()
    assert [(r.je_file_name, r.je_file_no, str(r.journalitemline_debitamount), r.delta, r.partition_id) for r in rows] == [
        ("Billed_JE", 1, "60.00", 0, "2024-03"),
        ("Billed_JE", 2, "3.00", 0, "2024-03"),
    ]
