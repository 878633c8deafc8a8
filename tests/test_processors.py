from datetime import date

import pytest

from closebook.checks.queries import FLEETPAY_MAPPING
from closebook.config import CloseConfig, ColumnMapping
from closebook.operators.mapping import add_metadata, apply_mapping
from closebook.plans.processor import NO_INPUT, WRITTEN, run_processor
from closebook.sources.files import month_files, read_header_csv

AS_OF = date(2024, 2, 5)
MAPPING = [
    ColumnMapping("Card Last 4", "int", "Card_Last_4", "int"),
    ColumnMapping("Spend", "string", "Spend", "double"),
    ColumnMapping("Fee", "string", "Fee", "decimal(38,2)"),
    ColumnMapping("Posted", "string", "posted_on", "date"),
    ColumnMapping("Absent", "string", "absent", "int"),
]


def raw(spark, *rows):
    return spark.createDataFrame(rows, "`Other` string, `Card Last 4` string, `Spend` string, `Fee` string, `Posted` string")


def test_rename_and_cast_in_place(spark):
    df = apply_mapping(raw(spark, ("x", "0042", "1.5", "2.345", "2024-01-31")), MAPPING)
    assert df.dtypes == [
        ("Other", "string"),
        ("Card_Last_4", "int"),
        ("Spend", "double"),
        ("Fee", "decimal(38,2)"),
        ("posted_on", "date"),
    ]
    row = df.first()
    assert (row.Other, row.Card_Last_4, row.Spend, str(row.Fee), row.posted_on) == (
        "x",
        42,
        1.5,
        "2.35",
        date(2024, 1, 31),
    )


@pytest.mark.parametrize("bad", ["1e2", "", "abc", "99999999999", "99999999999.5", "1.2.3"])
def test_bad_whole_numbers_become_null(spark, bad):
    assert apply_mapping(raw(spark, ("x", bad, "1", "1", "2024-01-01")), MAPPING).first().Card_Last_4 is None


@pytest.mark.parametrize(("text", "number"), [("2024.0", 2024), ("7.9", 7), ("-3.7", -3), (" 12. ", 12)])
def test_whole_numbers_with_decimals_are_cut(spark, text, number):
    assert apply_mapping(raw(spark, ("x", text, "1", "1", "2024-01-01")), MAPPING).first().Card_Last_4 == number


def test_bad_amounts_and_dates_become_null(spark):
    row = apply_mapping(raw(spark, ("x", "1", "$5", "1,234.50", "13/45/2024")), MAPPING).first()
    assert (row.Spend, row.Fee, row.posted_on) == (None, None, None)


def test_column_names_match_by_case(spark):
    df = spark.createDataFrame([("1",)], "spend string")
    assert apply_mapping(df, MAPPING).dtypes == [("spend", "string")]


def test_doubled_target_is_refused(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    with pytest.raises(ValueError, match="several columns"):
        apply_mapping(df, [ColumnMapping("a", "string", "b", "int")])


def test_metadata(spark):
    row = add_metadata(spark.range(1), date(2024, 1, 1)).first()
    assert (row.reportmonth, row.partition_id) == (date(2024, 1, 1), "2024-01")


HEADER = "Year,Month,Day,Account,CustID,Card Last 4,Token,Merchant Name,MCC,Spend"


@pytest.fixture
def lake(tmp_path):
    mapping = [(m.source, m.source_type, m.target, m.target_type) for m in FLEETPAY_MAPPING]
    config = CloseConfig(
        f"""
[common]
destination_bucketname={tmp_path}/lake
finance_bucketname={tmp_path}/inbound
parquet_path=reports
nopii_db=books_{tmp_path.name.replace("-", "_")}
vcard_fleetpay_src_path=fleet
fleetpay_schema={mapping}
"""
    )
    inbox = tmp_path / "inbound" / "fleet" / "2024-01"
    inbox.mkdir(parents=True)
    return config, inbox


def test_header_order_missing_and_extra_columns(spark, lake):
    _, inbox = lake
    (inbox / "a.csv").write_text(f"{HEADER}\n2024,1,2,A1,1,0042,t1,Shop,5001,10.5\n")
    (inbox / "b.CSV").write_text("Spend,Card Last 4,Year,Token\n7.25,0007,2024,t2\n")
    (inbox / "sub").mkdir()
    (inbox / "sub" / "c.csv").write_text(f"{HEADER},Net\n2024,1,3,A2,2,0001,t3,Shop,5002,1.0,0.5\n")
    (inbox / "notes.txt").write_text("ignored")
    (inbox / "empty.csv").write_text("")
    paths = month_files(spark, str(inbox))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a.csv", "b.CSV", "c.csv"]
    rows = {r.Token: r for r in read_header_csv(spark, paths).collect()}
    assert (rows["t1"].Year, rows["t1"]["Card Last 4"], rows["t1"].Spend) == ("2024", "0042", "10.5")
    assert (rows["t2"].Year, rows["t2"]["Card Last 4"], rows["t2"].Spend, rows["t2"].Month) == ("2024", "0007", "7.25", None)
    assert (rows["t3"].Net, rows["t1"].Net) == ("0.5", None)


def test_run_twice_gives_one_copy(spark, lake):
    config, inbox = lake
    (inbox / "a.csv").write_text(f"{HEADER}\n2024,1,2,A1,1,0042,t1,Shop,5001,10.5\n2024,x,3,A1,1,0043,t2,Shop,5001,n/a\n")
    first = run_processor(spark, config, "fleetpay", AS_OF)
    assert (first.status, first.files, first.rows) == (WRITTEN, 1, 2)
    assert first.failed_casts == {"Month": 1, "Spend": 1}
    assert run_processor(spark, config, "fleetpay", AS_OF).rows == 2
    table = spark.table(f"{config.require('nopii_db')}.monthly_rpt_fleetpay_vcard_revenue")
    assert table.count() == 2
    assert dict(table.dtypes)["partition_id"] == "string"
    assert {r.partition_id for r in table.collect()} == {"2024-01"}
    assert "etl_timestamp" in table.columns


def test_no_files_is_not_an_error(spark, lake):
    config, _ = lake
    assert run_processor(spark, config, "fleetpay", AS_OF).status == NO_INPUT
    assert run_processor(spark, config, "fleetpay", date(2030, 1, 1)).status == NO_INPUT


def test_other_months_stay(spark, lake):
    config, inbox = lake
    (inbox / "a.csv").write_text(f"{HEADER}\n2024,1,2,A1,1,0042,t1,Shop,5001,10.5\n")
    later = inbox.parent / "2024-02"
    later.mkdir()
    (later / "a.csv").write_text(f"{HEADER}\n2024,2,2,A1,1,0042,t9,Shop,5001,10.5\n")
    run_processor(spark, config, "fleetpay", AS_OF)
    path = run_processor(spark, config, "fleetpay", date(2024, 3, 1)).path
    assert sorted(r.Token for r in spark.read.parquet(path).collect()) == ["t1", "t9"]
