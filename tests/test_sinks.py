import csv
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from closebook.operators import journal as j
from closebook.sinks.catalog import _qualified, add_partitions, register_table
from closebook.sinks.files import daily_extract_path, name_journal_files, write_daily_extract, write_journal_files
from closebook.sinks.tables import clear_partition, write_partitioned, write_whole
from closebook.sources.tables import partition_inventory, partition_values, read_month


def months(spark, *rows):
    return spark.createDataFrame(rows, "partition_id string, n int")


def test_rewriting_a_month_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(months(spark, ("2024-01", 1), ("2024-02", 2)), path)
    write_partitioned(months(spark, ("2024-02", 3)), path)
    write_partitioned(months(spark, ("2024-02", 3)), path)
    assert sorted((r.partition_id, r.n) for r in spark.read.parquet(path).collect()) == [("2024-01", 1), ("2024-02", 3)]
    assert [r.n for r in read_month(spark, path, date(2024, 2, 1)).collect()] == [3]


def test_empty_result_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(months(spark, ("2024-01", 1)), path)
    write_partitioned(months(spark, ("2024-01", 1)).where("false"), path)
    assert spark.read.parquet(path).count() == 1


def test_append_mode(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        write_partitioned(months(spark, ("2024-01", 1)), path, "append")
    assert spark.read.parquet(path).count() == 2


def test_full_dates_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(months(spark, ("2024-01-01", 1)), path)
    assert dict(spark.read.parquet(path).dtypes)["partition_id"] == "string"


def test_rows_per_file(spark, tmp_path):
    path = str(tmp_path / "t")
    write_whole(spark.range(0, 250_000, 1, 1), path)
    assert len(list(Path(path).glob("*.parquet"))) == 3
    write_whole(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_register_update_and_list(spark, tmp_path):
    path, table = str(tmp_path / "t"), "sinks_db.report"
    df = months(spark, ("2024-01", 1), ("2024-02", 2))
    write_partitioned(df, path)
    register_table(spark, table, df.schema, path, ["partition_id"])
    register_table(spark, table, df.schema, path, ["partition_id"])
    assert spark.table(table).count() == 2
    assert partition_values(spark, table) == ["2024-01", "2024-02"]
    wider = df.withColumn("note", F.lit("x"))
    write_partitioned(wider, path)
    register_table(spark, table, wider.schema, path, ["partition_id"])
    assert spark.table(table).columns == ["n", "note", "partition_id"]
    assert {r.partition_id: r.n_rows for r in partition_inventory(spark.table(table)).collect()} == {
        "2024-01": 1,
        "2024-02": 1,
    }


def test_known_table_adds_what_was_written(spark, tmp_path):
    path, table = str(tmp_path / "t"), "sinks_db.monthly"
    for month in ("2024-01", "2024-02", "2024-02"):
        df = months(spark, (month, 1))
        write_partitioned(df, path)
        register_table(spark, table, df.schema, path, ["partition_id"], [month])
        assert spark.table(table).where(f"partition_id = '{month}'").count() == 1
    assert partition_values(spark, table) == ["2024-01", "2024-02"]


def test_replaced_files_are_seen(spark, tmp_path):
    path, table = str(tmp_path / "t"), "sinks_db.stage"
    for n in (3, 5):
        write_whole(spark.range(n), path)
        register_table(spark, table, spark.range(1).schema, path)
        assert spark.table(table).count() == n


def test_add_partitions(spark, tmp_path):
    path, table = str(tmp_path / "t"), "sinks_db.manual"
    df = months(spark, ("2024-01", 1))
    write_partitioned(df, path)
    register_table(spark, table, df.schema, path, ["partition_id"])
    months(spark, ("2024-05", 9)).select("n").write.parquet(f"{path}/partition_id=2024-05")
    assert spark.table(table).count() == 1
    add_partitions(spark, table, path, "partition_id", ["2024-01", "2024-05"])
    assert sorted(r.n for r in spark.table(table).collect()) == [1, 9]


@pytest.fixture(scope="module")
def ledger_lines(spark):
    rows = [
        (date(2024, 3, 1), org, date(2024, 3, 1 + org % 9), org % 3 + 1, "AmEx" if org < 25 else "Bank", Decimal(org + 1))
        for org in range(60)
    ]
    lines = spark.createDataFrame(
        rows,
        "reportmonth date, organization_id bigint, payment_date date, sku bigint, partner_type string, amount decimal(33,2)",
    )
    products = spark.createDataFrame(
        [(1, "one", "40001", "Subscription Revenue", "SKU100 - one"), (2, "two", "40002", "Other Revenue", "SKU200-two")],
        "sku bigint, sku_product_description string, netsuite_gl_account_number string, product_group string, netsuite_sku string",
    )
    return j.journal_lines(j.stage_batches(j.billed_amounts(lines), 10), products)


def test_journal_files(spark, ledger_lines, tmp_path):
    folder = str(tmp_path / "billed_revenue")
    for _ in range(2):
        write_journal_files(ledger_lines, folder)
        named = name_journal_files(spark, folder)
    assert sorted(Path(p).name for p in named) == sorted(f"Billed_JE_{n}.csv" for n in range(1, 8))
    assert sorted(p.name for p in Path(folder).glob("*.csv")) == sorted(f"Billed_JE_{n}.csv" for n in range(1, 8))
    assert not list(Path(folder).glob("file_no=*"))
    seen = 0
    for n in range(1, 8):
        rows = list(csv.reader((Path(folder) / f"Billed_JE_{n}.csv").open()))
        assert rows[0] == ["tranId", *j.LINE_COLUMNS[1:]]
        debit, credit = rows[0].index("journalItemLine_debitAmount"), rows[0].index("journalItemLine_creditAmount")
        assert rows[1][rows[0].index("journalItemLine_accountRef")] == "11181"
        assert sum(Decimal(r[credit]) for r in rows[2:]) == Decimal(rows[1][debit])
        assert all(r[debit] == "" for r in rows[2:])
        seen += len(rows) - 2
    assert seen == 60
    assert '""' not in (Path(folder) / "Billed_JE_1.csv").read_text()


def test_only_what_tells_lines_apart_is_shuffled(spark, ledger_lines):
    rows = j.narrow(ledger_lines)
    assert not {"tranid", "subsidiary", "journalItemLine_memo", "journalItemLine_entityRef", "tranDate"} & set(rows.columns)
    again = j.described(rows)
    assert again.schema == ledger_lines.schema
    assert sorted(map(str, again.collect())) == sorted(map(str, ledger_lines.collect()))


def test_line_numbers_shuffle_no_lines(spark, tmp_path):
    """The first place of each file is known to be little, however large the lines are thought to be."""
    from closebook.checks.bindings import Bindings
    from closebook.checks.queries import _je_file_lines

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60000")
    plan = _je_file_lines(Bindings(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(path" not in plan and "BroadcastHashJoin [path" in plan


def test_rerun_under_dynamic_overwrite_leaves_no_old_file(spark, ledger_lines, tmp_path):
    folder, setting = str(tmp_path / "billed_revenue"), "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(setting, "dynamic")
    try:
        for lines, n in ((ledger_lines, 7), (ledger_lines.where("file_no < 3"), 2)):
            write_journal_files(lines, folder)
            name_journal_files(spark, folder)
            assert len(list(Path(folder).rglob("*.csv"))) == n
    finally:
        spark.conf.unset(setting)


def test_no_ledger_file_is_too_long(spark):
    """Twelve months of many rows: numbering per month keeps every file at the batch size and its summary row."""
    lines = spark.range(12 * 45).selectExpr(
        "add_months(date'2024-01-01', cast(id % 12 as int)) as reportmonth", "id as organization_id",
        "date'2024-01-05' as payment_date", "1L as sku", "'AmEx' as partner_type", "cast(1 as decimal(33,2)) as amount",
    )
    products = spark.createDataFrame(
        [(1, "one", "40001", "Other Revenue", "S-1")],
        "sku bigint, sku_product_description string, netsuite_gl_account_number string, product_group string, netsuite_sku string",
    )
    stage = j.stage_batches(j.billed_amounts(lines), 20, per_month=True)
    sizes = j.journal_lines(stage, products).groupBy("report_month", "file_no").count().collect()
    assert len(sizes) == 36
    assert max(r["count"] for r in sizes) == 21


def test_managed_table_is_refused(spark, tmp_path):
    table = "sinks_db.managed"
    spark.sql("create database if not exists sinks_db")
    spark.range(3).write.mode("overwrite").saveAsTable(table)
    with pytest.raises(ValueError, match="not an external table"):
        register_table(spark, table, months(spark, ("2024-01", 1)).schema, str(tmp_path / "t"), ["partition_id"])
    assert spark.table(table).count() == 3
    spark.sql(f"drop table {table}")


def test_locations_of_two_stores_differ(spark):
    assert _qualified(spark, "s3a://old-lake/t") != _qualified(spark, "s3a://new-lake/t")
    assert _qualified(spark, "/lake/t") == _qualified(spark, "file:///lake/t")


def test_moved_table_reads_the_new_place(spark, tmp_path):
    table = "sinks_db.moved"
    for n, place in ((1, "old"), (2, "new")):
        df = months(spark, ("2024-01", n))
        write_partitioned(df, str(tmp_path / place))
        register_table(spark, table, df.schema, str(tmp_path / place), ["partition_id"], ["2024-01"])
        assert [r.n for r in spark.table(table).collect()] == [n]


def test_emptied_month_is_cleared(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(months(spark, ("2024-01", 1), ("2024-02", 2)), path)
    clear_partition(spark, path, "2024-02")
    clear_partition(spark, path, "2024-03")
    assert [r.n for r in spark.read.parquet(path).collect()] == [1]


def test_daily_extract(spark, tmp_path):
    path = daily_extract_path(str(tmp_path), "Activity", datetime(2024, 3, 5, 7, 30))
    assert path.endswith("/Activity_03052024_07.csv")
    write_daily_extract(spark.createDataFrame([("", None, 1)], "a string, b string, n int").coalesce(1), path)
    assert "".join(p.read_text() for p in Path(path).glob("part-*")) == "a,b,n\n,,1\n"
