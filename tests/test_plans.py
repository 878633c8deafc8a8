import csv
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from closebook.checks.bindings import Bindings
from closebook.config import CloseConfig
from closebook.plans import journal as journal_plan
from closebook.plans.journal import run_journal
from closebook.plans.report import EMPTY, NOT_DUE, WRITTEN, run_report

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture
def config(spark, tmp_path):
    (tmp_path / "sql").mkdir()
    (tmp_path / "sql" / "revenue_v1.sql").write_text((ROOT / "closebook/plans/sql/monthly_revenue.sql").read_text())
    (tmp_path / "sql" / "activity_v1.sql").write_text(
        "select date_format(payment_date, 'yyyy-MM') as partition_id, sku, count(*) as n from statement_lines"
        " where payment_date >= :month_start and payment_date < :month_end group by 1, 2"
    )
    Bindings(spark, SF_DIR).register_report_sources()
    database = "plans_" + tmp_path.name.replace("-", "_")
    return CloseConfig(
        f"""
[common]
destination_bucketname={tmp_path}/lake
finance_bucketname={tmp_path}/finance
sql_file_path={tmp_path}/sql
parquet_path=reports
internal_outbound_path=outbound
nopii_db={database}
day1_tables_list=revenue
revenue_partition_column=None
revenue_report=Monthly
revenue_sql=revenue_v1
activity_partition_column=partition_id
activity_report=Daily
activity_sql=activity_v1
activity_dtype={{"n": "int"}}
activity_output_path=Activity
daily_outbound_path=daily_out
odd_partition_column=sku
odd_report=Daily
odd_sql=activity_v1
"""
    )


@pytest.fixture
def date_dim(spark):
    return Bindings(spark, SF_DIR).date_dim()


def test_report_runs_on_its_business_day_only(spark, config, date_dim):
    assert run_report(spark, config, "revenue", date(1997, 1, 1), date_dim).status == NOT_DUE
    run = run_report(spark, config, "revenue", date(1997, 1, 2), date_dim)
    assert run.status == WRITTEN
    table = spark.table(f"{config.require('nopii_db')}.revenue")
    assert table.count() == run.rows > 0
    assert {(r.reportmonth, r.partition_id) for r in table.collect()} == {(date(1996, 12, 1), "1996-12")}


def test_report_reruns_and_next_months_add_up(spark, config, date_dim):
    first = run_report(spark, config, "revenue", date(1997, 1, 2), date_dim)
    again = run_report(spark, config, "revenue", date(1997, 1, 2), date_dim)
    later = run_report(spark, config, "revenue", date(1997, 2, 3), date_dim)
    assert first.rows == again.rows
    assert spark.table(f"{config.require('nopii_db')}.revenue").count() == first.rows + later.rows


def test_gate_needs_the_calendar(spark, config):
    with pytest.raises(ValueError, match="date_dim"):
        run_report(spark, config, "revenue", date(1997, 1, 2))


def test_daily_report_with_extract(spark, config):
    run = run_report(spark, config, "activity", date(1997, 1, 15), written_at=datetime(1997, 1, 15, 6))
    assert run.status == WRITTEN
    assert run.extract.endswith("/daily_out/1997-01/Activity/Activity_01151997_06.csv")
    extract = spark.read.option("header", True).csv(run.extract)
    table = spark.table("intermediate.activity")
    assert extract.count() == table.count() == run.rows
    assert dict(table.dtypes)["n"] == "int"


def test_empty_daily_report_writes_nothing(spark, config, tmp_path):
    assert run_report(spark, config, "activity", date(2030, 1, 15)).status == EMPTY
    assert not (tmp_path / "lake").exists()
    assert not (tmp_path / "finance").exists()


def test_daily_report_with_another_partition_is_refused(spark, config):
    with pytest.raises(ValueError, match="partitioned by partition_id"):
        run_report(spark, config, "odd", date(1997, 1, 15))


def test_journal_job(spark, config):
    b = Bindings(spark, SF_DIR)
    revenue = b.revenue_lines().withColumn("partition_id", F.date_format("reportmonth", "yyyy-MM"))
    for _ in range(2):
        run = run_journal(spark, config, revenue, b.products(), date(1997, 1, 2), batch_size=20)
    database = config.require("nopii_db")
    stage = spark.table(f"{database}.{journal_plan.STAGE_TABLE}")
    control = spark.table(f"{database}.{journal_plan.CONTROL_TABLE}")
    files = sorted(r.file_no for r in stage.select("file_no").distinct().collect())
    assert files == list(range(1, len(files) + 1))
    assert control.count() == len(files)
    assert all(r.delta == 0 and r.etl_timestamp is not None for r in control.collect())
    assert sorted(Path(p).name for p in run.files) == sorted(f"Billed_JE_{n}.csv" for n in files)
    per_file = {r.file_no: r["count"] for r in stage.groupBy("file_no").count().collect()}
    for path in run.files:
        name = path.split(":", 1)[-1]
        number = int(Path(name).stem.rsplit("_", 1)[1])
        assert len(list(csv.reader(open(name)))) == per_file[number] + 2


def test_journal_without_revenue_fails(spark, config):
    b = Bindings(spark, SF_DIR)
    with pytest.raises(ValueError, match="no billed revenue for 2029-12"):
        run_journal(spark, config, b.revenue_lines(), b.products(), date(2030, 1, 2))
