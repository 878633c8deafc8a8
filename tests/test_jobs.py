"""The command line end to end, from catalog tables and a configuration file to files."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from closebook.__main__ import main, parse
from closebook.checks.bindings import Bindings
from closebook.config import CloseConfig

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


def test_example_configuration_is_complete():
    config = CloseConfig((ROOT / "conf" / "example.conf").read_text())
    assert [r.table for r in config.reports()] == ["monthly_revenue"]
    assert len(config.processor("northcard").mapping) == 6
    assert len(config.processor("fleetpay").mapping) == 10
    assert config.table_path("t") == "s3a://example-lake/finance/reports/t"


def test_arguments():
    options = parse(["report", "--config", "c", "--as-of", "2024-02-01", "--table", "t"])
    assert (options.as_of, options.table) == (date(2024, 2, 1), "t")
    with pytest.raises(SystemExit):
        parse(["report", "--config", "c", "--as-of", "yesterday", "--table", "t"])


def test_report_then_journal(spark, tmp_path, capsys):
    b = Bindings(spark, SF_DIR)
    b.register_report_sources()
    b.date_dim().createOrReplaceTempView("close_dates")
    revenue = b.revenue_lines().withColumn("partition_id", F.date_format("reportmonth", "yyyy-MM"))
    revenue.createOrReplaceTempView("billed")
    (tmp_path / "sql").mkdir()
    (tmp_path / "sql" / "r.sql").write_text((ROOT / "closebook/plans/sql/monthly_revenue.sql").read_text())
    conf = tmp_path / "close.conf"
    conf.write_text(
        f"""
[common]
destination_bucketname={tmp_path}/lake
finance_bucketname={tmp_path}/finance
sql_file_path={tmp_path}/sql
parquet_path=reports
internal_outbound_path=out
nopii_db=jobs_db
date_dim_table=close_dates
revenue_table=billed
day1_tables_list=r
r_partition_column=None
r_report=Monthly
r_sql=r
"""
    )
    for job in (["report", "--table", "r"], ["journal"]):
        main([job[0], "--config", str(conf), "--as-of", "1997-01-02", *job[1:]])
    out = capsys.readouterr().out
    assert "written" in out
    assert sorted(p.name for p in (tmp_path / "finance").rglob("Billed_JE_*.csv")) == ["Billed_JE_1.csv", "Billed_JE_2.csv"]
    assert spark.table("jobs_db.r").count() > 0
