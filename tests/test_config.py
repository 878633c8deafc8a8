from datetime import date

import pytest

from closebook.config import CloseConfig, ColumnMapping, parse_mapping
from closebook.functions.dates import next_month, partition_of, previous_month

TEXT = """
[common]
destination_bucketname=lake
finance_bucketname=/data/finance
code_bucket_name=code
sql_file_path=sql/prod
parquet_path=finance/monthly
internal_outbound_path=out/monthly
nopii_db=books
vcard_northcard_src_path=in/NorthCard
day1_tables_list=billed, refunds
day3_tables_list=abroad
billed_partition_column=None
billed_report=Monthly
billed_sql=billed_v2
activity_partition_column=partition_id
activity_report=Daily
activity_sql=activity_v1
activity_mode=append
activity_dtype={"n": "bigint"}
activity_output_path=Activity
northcard_schema=[("program","string","program","string"),("n","string","count","int")]
fleetpay_schema=[("Year","string","Year",...)]
vcard_fleetpay_src_path=in/FleetPay
"""


@pytest.fixture(scope="module")
def config():
    return CloseConfig(TEXT)


def test_report_properties(config):
    billed = config.report("billed")
    assert (billed.cadence, billed.sql_name, billed.partition_column, billed.mode) == (
        "Monthly",
        "billed_v2",
        None,
        "overwrite",
    )
    assert billed.business_day == 1
    assert billed.schema_name == "books"
    activity = config.report("activity")
    assert (activity.mode, activity.dtypes, activity.output_path) == ("append", {"n": "bigint"}, "Activity")
    assert activity.business_day is None
    assert activity.schema_name == "intermediate"


def test_reports_in_file_order(config):
    assert [r.table for r in config.reports()] == ["billed", "activity"]


def test_day_lists(config):
    assert config.day_list(1) == ["billed", "refunds"]
    assert config.day_list(2) == []
    assert config.business_day("abroad") == 3


def test_missing_keys_are_named(config):
    with pytest.raises(KeyError, match="refunds_report"):
        config.report("refunds")


def test_processors(config):
    spec = config.processor("northcard")
    assert spec.mapping[1] == ColumnMapping("n", "string", "count", "int")
    assert spec.table == "monthly_rpt_northcard_vcard_revenue"
    with pytest.raises(ValueError, match="unknown processor"):
        config.processor("adyen")
    with pytest.raises(ValueError, match="4-tuples"):
        config.processor("fleetpay")


def test_mapping_is_data_not_code():
    with pytest.raises(ValueError):
        parse_mapping("[__import__('os').getcwd()]")


def test_locations(config):
    month = date(2024, 3, 1)
    assert config.table_path("t") == "s3a://lake/finance/monthly/t"
    assert config.processor_inbox(config.processor("northcard"), month) == "/data/finance/in/NorthCard/2024-03"
    assert config.journal_outbox(month) == "/data/finance/out/monthly/2024-03/journal_entry/billed_revenue"
    assert config.sql_path(config.report("billed")) == "s3a://code/sql/prod/billed_v2.sql"


def test_config_is_read_through_spark(spark, tmp_path):
    path = tmp_path / "finance.conf"
    path.write_text(TEXT)
    assert CloseConfig.load(spark, str(path)).require("nopii_db") == "books"


def test_month_arithmetic():
    assert previous_month(date(2024, 1, 31)) == date(2023, 12, 1)
    assert previous_month(date(2024, 3, 1)) == date(2024, 2, 1)
    assert next_month(date(2023, 12, 1)) == date(2024, 1, 1)
    assert partition_of(date(2024, 2, 1)) == "2024-02"
