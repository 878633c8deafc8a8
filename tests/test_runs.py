"""Header files in bulk, audit rows, gates, exclusions and factors of many periods."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from closebook.config import CloseConfig, ReportSpec
from closebook.functions import money
from closebook.operators import capital
from closebook.operators.calendar import date_dimension
from closebook.operators.exclusions import excluded_by
from closebook.operators.gate import report_gate
from closebook.plans.report import BLOCKED, NOT_DUE, WRITTEN, run_report
from closebook.sinks.audit import latest_runs, read_audit, record_run
from closebook.sources import files as csv_files


def test_ten_thousand_small_files_of_three_orders(spark, tmp_path):
    for i in range(10_000):
        lines = ["a,b,c\n1,x{},3\n", 'c,"a",b\r\n3,1,x{}\r\n', "b,a\nx{},1\nx{},1\n"][i % 3]
        (tmp_path / f"f{i}.{'csv' if i % 2 else 'CSV'}").write_text(lines.replace("{}", str(i)))
    found = csv_files.read_header_csv(spark, str(tmp_path))
    assert found.columns == ["a", "b", "c"]
    rows = {(r.a, r.c): r.n for r in found.groupBy("a", "c").agg(F.count("*").alias("n")).collect()}
    assert rows == {("1", "3"): 6667, ("1", None): 6666}
    assert found.select("b").distinct().count() == 10_000


def test_no_file_is_read_by_the_driver(spark, tmp_path, monkeypatch):
    from closebook.sources import storage

    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n2,1\n")
    monkeypatch.setattr(storage, "first_lines", None)
    assert [tuple(r) for r in csv_files.read_header_csv(spark, str(tmp_path)).collect()] == [("1", "2")] * 2


def test_odd_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n  \n﻿"x, y",Z\n"1, 2",3\n4\n5,6,7\n')
    (tmp_path / "b.csv").write_text("z\n9\n")
    (tmp_path / "header_only.csv").write_text("q\n")
    (tmp_path / "empty.csv").write_text("")
    found = csv_files.read_header_csv(spark, str(tmp_path))
    assert found.columns == ["x, y", "Z", "q"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == [("1, 2", "3", None), ("4", None, None), ("5", "6", None), (None, "9", None)]
    (tmp_path / "twice.csv").write_text("a,A\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        csv_files.read_header_csv(spark, str(tmp_path))


def test_large_files_in_several_blocks(spark, tmp_path):
    for name, header in (("a", "n,text"), ("b", "text,n")):
        order = (lambda i: f"{i},t{i}") if name == "a" else (lambda i: f"t{i},{i}")
        (tmp_path / f"{name}.csv").write_text(header + "\n" + "".join(order(i) + "\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        found = csv_files.read_header_csv(spark, str(tmp_path))
        assert found.where(F.concat(F.lit("t"), "n") == F.col("text")).count() == found.count() == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_audit_rows(spark, tmp_path):
    where = (str(tmp_path / "audit"), "runs_db.audit")
    assert record_run(spark, None, "j", "t", "2024-01", "written") is None
    for hour, status, metrics in ((1, "written", {"rows_out": 5}), (2, "blocked", {}), (3, "written", {"rows_out": 7})):
        record_run(spark, where, "j", "t", "2024-01", status, metrics, datetime(2024, 2, 1, hour))
    record_run(spark, where, "j", "t", "2024-02", "not due", {}, datetime(2024, 3, 1))
    audit = read_audit(spark, where[0])
    assert audit.count() == spark.table("runs_db.audit").count() == 6
    assert sorted((r.partition_id, r.status, r.metric, r.value) for r in latest_runs(audit).collect()) == [
        ("2024-01", "written", "rows_out", 7), ("2024-01", "written", "runs", 1), ("2024-02", "not due", "runs", 1)
    ]


RUNS = "job_name string, run_id long, state string, started_on timestamp_ntz, completed_on timestamp_ntz"


def source_runs(spark, state="SUCCEEDED"):
    return spark.createDataFrame([("src", 1, state, datetime(2024, 2, 1, 3), datetime(2024, 2, 1, 4))], RUNS)


def days(spark):
    frame = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 3, 1),)], "d date")
    return date_dimension(frame, F.col("d"), [date(2024, 1, 1)])


def test_gate(spark):
    reports = [ReportSpec("first", business_day=1), ReportSpec("second", business_day=2), ReportSpec("any"), ReportSpec("free")]
    needs = {"first": ["src"], "second": ["src"], "any": ["src", "never"]}
    found = report_gate(days(spark), reports, source_runs(spark), needs, datetime(2024, 2, 1, 12))
    assert {r.report: (r.n_sources, r.n_stale, r.status) for r in found.collect()} == {
        "first": (1, 0, "ready"), "second": (1, 0, "not due"), "any": (2, 1, "blocked"), "free": (0, 0, "ready")
    }


def test_reports_wait_for_their_sources(spark, tmp_path):
    (tmp_path / "sql").mkdir()
    (tmp_path / "sql" / "r.sql").write_text("select :month_start as reportmonth, 1 as n")
    config = CloseConfig(f"""
[common]
destination_bucketname={tmp_path}/lake
sql_file_path={tmp_path}/sql
parquet_path=reports
nopii_db=gate_db
audit_table=run_audit
day1_tables_list=gated
gated_report=Monthly
gated_sql=r
gated_sources=src
""")
    with pytest.raises(ValueError, match="sources"):
        run_report(spark, config, "gated", date(2024, 2, 1), days(spark))
    good, bad = source_runs(spark), source_runs(spark, "FAILED")
    at = datetime(2024, 2, 1, 6)
    assert run_report(spark, config, "gated", date(2024, 2, 2), days(spark), at, good).status == NOT_DUE
    assert run_report(spark, config, "gated", date(2024, 2, 1), days(spark), at, bad).status == BLOCKED
    assert not spark.catalog.tableExists("gate_db.gated")
    assert run_report(spark, config, "gated", date(2024, 2, 1), days(spark), at, good).status == WRITTEN
    audit = read_audit(spark, config.audit()[0]).orderBy("recorded_at", "metric").collect()
    assert [(r.status, r.metric, r.value) for r in audit] == [
        ("not due", "runs", 1), ("blocked", "n_stale", 1), ("blocked", "runs", 1), ("written", "rows_out", 1), ("written", "runs", 1)
    ]


def test_processors_by_configuration():
    text = "[common]\nprocessor_list=newpay\nvcard_newpay_table=newpay_rows\nvcard_newpay_src_path=new\nnewpay_schema=[('a','string','b','int')]\n"
    config = CloseConfig(text)
    assert sorted(config.processors()) == ["fleetpay", "newpay", "northcard"]
    assert (config.processor("newpay").table, config.processor("newpay").mapping[0].target) == ("newpay_rows", "b")
    with pytest.raises(KeyError, match="vcard_newpay_table"):
        CloseConfig("[common]\nprocessor_list=newpay\n").processors()
    with pytest.raises(ValueError, match="unknown"):
        config.processor("other")


@pytest.mark.parametrize("excluded", [[], [1], [1, None], [None], [1, 1, 2], [7]])
def test_exclusions_are_three_valued(spark, excluded):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 2, 3, None])], "k int, n int")
    keys = spark.createDataFrame([(k, 0) for k in excluded], "x int, n int")
    rows.createOrReplaceTempView("kept_rows")
    keys.createOrReplaceTempView("excluded_keys")
    wanted = spark.sql("select * from kept_rows where k not in (select x from excluded_keys)").collect()
    found = excluded_by(rows, "k", keys, "x")
    assert sorted(found.collect(), key=str) == sorted(wanted, key=str)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("rate", "t"), [("0.15", 100), ("0.01", 1400), ("-0.05", 300), ("9.5", 40), ("-0.9", 20), ("0", 7), ("0.085", 0), ("-0.99999999", 2)]
)
def test_wide_factors(spark, rate, t):
    rate, amount = Decimal(rate), Decimal("-98765.43")
    frame = spark.range(1).select(F.lit(rate).cast(money.RATE).alias("r"), F.lit(t).alias("t"), F.lit(amount).alias("a"))
    row = frame.select(
        money.wide_growth_factor(F.col("r"), F.col("t")).alias("g"), money.wide_discount_factor(F.col("r"), F.col("t")).alias("d"),
        F.when(F.col("t") > 0, money.annuity_factor_at(F.col("r"), F.col("t"))).alias("n"),
    ).first()
    assert row.g.m.scaleb(row.g.e) == money.growth_factor(rate, t)
    assert row.d.m.scaleb(row.d.e) == money.discount_factor(rate, t)
    assert t == 0 or row.n == money.annuity_factor(rate, t)
    for name, factor in (("g", money.growth_factor(rate, t)), ("d", money.discount_factor(rate, t))):
        wide = money.wide_growth_factor if name == "g" else money.wide_discount_factor
        if abs(amount * factor) < 10**23:
            assert frame.select(money.times(F.col("a"), wide(F.col("r"), F.col("t"))).alias("x")).first().x == amount * factor


def test_long_horizons_keep_cents(spark):
    flows = spark.createDataFrame([("a", 100, Decimal("-12.34")), ("b", 1400, Decimal("5.00"))], "option_id string, t int, amount decimal(19,2)")
    found = {r.option_id: r.inflated for r in capital.inflated_cash_flows(flows, Decimal("0.01")).collect()}
    cent = Decimal("0.01")
    assert found == {
        "a": (Decimal("-12.34") * money.growth_factor(cent, 100)).quantize(cent, "ROUND_HALF_UP"),
        "b": (Decimal("5.00") * money.growth_factor(cent, 1400)).quantize(cent, "ROUND_HALF_UP"),
    }


def test_a_large_jobs_task_number_does_not_stay(spark):
    from closebook.session import FIRST_TASKS, configure

    configure(spark, 1 << 40)
    assert int(spark.conf.get(FIRST_TASKS)) > 8
    configure(spark, 1000)
    assert spark.conf.get(FIRST_TASKS, None) is None
    spark.conf.set(FIRST_TASKS, "33")  # one that the caller set stays
    configure(spark, 1000)
    assert spark.conf.get(FIRST_TASKS) == "33"
