"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from decimal import Decimal
from importlib.resources import files
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from closebook.checks.bindings import (
    ALL_MONTHS,
    ASSETS,
    ASSUMPTIONS,
    CASH_FLOWS,
    DAILY,
    EXCLUDED,
    FLEETPAY,
    LINES,
    LONG_FLOWS,
    NORTHCARD,
    SOLD,
    SOURCE_RUNS,
    Bindings,
)
from closebook.config import CloseConfig, ColumnMapping, ReportSpec
from closebook.functions.dates import next_month, partition_id
from closebook.operators import calendar, capital, exclusions, gate, journal, mapping, readiness
from closebook.operators.journal import FILE_HEADER
from closebook.plans.journal import write_control, write_stage
from closebook.plans.processor import run_processor
from closebook.plans.report import report_frame, shape
from closebook.session import configure
from closebook.sinks.audit import read_audit
from closebook.sinks.catalog import drop_partitions, register_table, set_location
from closebook.sinks.daily import publish_daily
from closebook.sinks.evolution import evolve_table
from closebook.sinks.files import write_journal_files
from closebook.sinks.publish import publish_partitions, publish_whole, vacuum
from closebook.sinks.tables import PARTITION, write_partitioned
from closebook.sources.files import read_header_csv
from closebook.sources.partitions import catalog_partitions, partition_difference, reconcile_partitions
from closebook.sources.storage import filesystem, size_of
from closebook.sources.tables import partition_inventory
from closebook.workspace import new_path, store

JOURNAL_BATCH = 100
PROCESSOR_MONTH = date(2024, 1, 1)
RUNS_AS_OF = datetime(2024, 1, 25, 12)
RATE = Decimal("0.085")
GROWTH = Decimal("0.0125")
TAX_RATE = Decimal("0.35")
SCENARIOS = {
    "low": Decimal("0.0425"),
    "after_tax": Decimal("0.05525"),
    "implied": Decimal("0.062228"),
    "base": Decimal("0.085"),
    "high": Decimal("0.12"),
}

REPORTS = [
    ReportSpec("cash_revenue", business_day=1),
    ReportSpec("card_refunds", business_day=1),
    ReportSpec("open_items", business_day=2),
    ReportSpec("foreign_revenue", business_day=3),
    ReportSpec("northern_revenue", business_day=3),
    ReportSpec("usage_fees", business_day=4),
    ReportSpec("partner_summary"),
]

# The columns of the two processors' files.
NORTHCARD_MAPPING = [
    ColumnMapping("program", "string", "program", "string"),
    ColumnMapping("batch_number", "string", "batch_number", "int"),
    ColumnMapping("transaction_token", "string", "transaction_token", "string"),
    ColumnMapping("post_date", "string", "post_date", "date"),
    ColumnMapping("transaction_status", "string", "transaction_status", "string"),
    ColumnMapping("acting_user", "string", "acting_user", "string"),
    ColumnMapping("amount", "string", "amount", "decimal(38,2)"),
]

FLEETPAY_MAPPING = [
    ColumnMapping("Year", "string", "Year", "int"),
    ColumnMapping("Month", "string", "Month", "int"),
    ColumnMapping("Day", "string", "Day", "int"),
    ColumnMapping("Account", "string", "Account", "string"),
    ColumnMapping("CustID", "string", "CustID", "string"),
    ColumnMapping("Card Last 4", "int", "Card_Last_4", "int"),
    ColumnMapping("Token", "string", "Token", "string"),
    ColumnMapping("Merchant Name", "string", "Merchant_Name", "string"),
    ColumnMapping("MCC", "string", "MCC", "int"),
    ColumnMapping("Spend", "string", "Spend", "double"),
]

DEPENDENCIES = {
    "cash_revenue": ["src-1", "src-2", "src-3", "src-4", "src-5", "src-6"],
    "bank_refunds": ["src-7", "src-8", "src-9"],
    "disputes": ["src-10"],
    "card_refunds": ["src-11", "src-12"],
    "partner_summary": ["src-20", "src-21", "src-99999"],
    "ledger_calendar": [],
}


# Moments that reports are gated at.
GATES = [datetime(2024, 1, day, 12) for day in (2, 3, 4, 5, 25)]
LONG_GROWTH = {"steep": (Decimal("0.15"), 101), "monthly": (Decimal("0.01"), 1401)}
LONG_RATES = {"shrinking": Decimal("-0.05"), "monthly": Decimal("0.01"), "steep": Decimal("0.15")}
LONG_PERIODS = 301


def _catalog_name(name: str) -> str:
    """A table of the checks' own database that no other run uses."""
    return f"closebook_checks.{name}_{uuid4().hex}"


def _partition_inventory(b: Bindings) -> DataFrame:
    months = partition_inventory(b.revenue_lines(), "reportmonth")
    return months.select(partition_id(F.col("reportmonth")).alias("partition_id"), "n_rows")


def _report_month_window(b: Bindings) -> DataFrame:
    return calendar.report_month_windows(b.table("orders"), F.col("o_orderdate").cast("date"))


def _monthly_revenue_report(b: Bindings) -> DataFrame:
    b.register_report_sources()
    sql = files("closebook.plans").joinpath("sql/monthly_revenue.sql").read_text()
    return shape(report_frame(b.spark, sql, *ALL_MONTHS), ReportSpec("monthly_revenue"))


def _reports_due(b: Bindings) -> DataFrame:
    as_of = b.table("orders").select(F.col("o_orderdate").cast("date").alias("as_of"))
    return calendar.reports_due(as_of, b.date_dim(), REPORTS)


def _normalize(b: Bindings, view: str, columns: list[ColumnMapping]) -> DataFrame:
    return mapping.add_metadata(mapping.apply_mapping(b.view(view), columns), PROCESSOR_MONTH)


def _stage(b: Bindings) -> DataFrame:
    return journal.stage_batches(journal.billed_amounts(b.revenue_lines()))


def _monthly_stage(b: Bindings) -> DataFrame:
    return journal.stage_batches(journal.billed_amounts(b.revenue_lines()), JOURNAL_BATCH, per_month=True)


def _lines(b: Bindings) -> DataFrame:
    return journal.journal_lines(_monthly_stage(b), b.products())


def _report_table(b: Bindings) -> DataFrame:
    """The report as read back from its partitioned table, after writing it twice."""
    path = new_path(b.spark, "report")
    report = _monthly_revenue_report(b)
    report = store(report, "report")
    for _ in range(2):
        write_partitioned(report, path, many_partitions=True)
    return b.spark.read.parquet(path)


def _processor_table(b: Bindings) -> DataFrame:
    """Header CSVs of a month folder, in two column orders and spellings of the suffix, to the processor's table."""
    inbox, path = new_path(b.spark, "inbox"), new_path(b.spark, "northcard")
    raw = b.view(NORTHCARD)
    odd = F.col("batch_number").cast("int") % 2 == 1
    raw.where(~odd).write.option("header", True).csv(f"{inbox}/2024-01/clean")
    raw.where(odd).select(*reversed(raw.columns)).write.option("header", True).csv(f"{inbox}/2024-01/legacy")
    table = mapping.add_metadata(
        mapping.apply_mapping(read_header_csv(b.spark, f"{inbox}/2024-01"), NORTHCARD_MAPPING), PROCESSOR_MONTH
    )
    write_partitioned(table, path)
    return b.spark.read.parquet(path)


def _je_files(b: Bindings) -> DataFrame:
    """The ledger files as the importer reads them: blanks are NULL."""
    folder = new_path(b.spark, "ledger")
    stage = journal.stage_batches(journal.billed_amounts(b.revenue_lines()), per_month=True)
    lines = journal.journal_lines(stage, b.products())
    write_journal_files(lines, folder)
    kinds = [(FILE_HEADER.get(c, c), dict(lines.dtypes)[c]) for c in journal.LINE_COLUMNS]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in [*kinds, ("partition_id", "string"), ("file_no", "bigint")])
    return b.spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(folder).drop("partition_id")


def _je_file_lines(b: Bindings) -> DataFrame:
    """Every line of the ledger files with its number within its file, as the importer meets it."""
    folder = new_path(b.spark, "ledger")
    stage = journal.stage_batches(journal.billed_amounts(b.revenue_lines()), per_month=True)
    write_journal_files(journal.journal_lines(stage, b.products()), folder)
    lines = b.spark.read.text(folder).select("value", "partition_id", "file_no", F.col("_metadata.file_path").alias("path"))
    # A ledger file has at most 9,999 rows and is read by one task, in order.
    placed = lines.withColumn("place", F.monotonically_increasing_id())
    # Stored: Catalyst then knows that a row for each file is little, and need not shuffle the lines for the join.
    first = store(placed.groupBy("path").agg(F.min("place").alias("first")), "first-lines")
    numbered = placed.join(first, "path").withColumn("line_no", F.col("place") - F.col("first"))
    cells = F.split("value", ",")
    return numbered.where("line_no > 0").select(
        "partition_id", F.col("file_no").cast("bigint").alias("file_no"), "line_no", (F.col("line_no") == 1).alias("is_summary"),
        F.nullif(F.element_at(cells, 1 + journal.LINE_COLUMNS.index("journalItemLine_debitAmount")), F.lit("")).alias("debit"),
    )


def _processor_layouts(b: Bindings) -> DataFrame:
    """Many header CSVs in three column orders, one of them short of a column, in one scan."""
    inbox = new_path(b.spark, "inbox")
    raw = b.view(NORTHCARD)
    kind = F.col("transaction_token").cast("bigint") % 3
    orders = [raw.columns, raw.columns[::-1], [c for c in raw.columns[2:] + raw.columns[:2] if c != "acting_user"]]
    for i, columns in enumerate(orders):
        raw.where(kind == i).repartition(24).select(*columns).write.option("header", True).csv(f"{inbox}/2024-01/kind{i}")
    found = mapping.apply_mapping(read_header_csv(b.spark, f"{inbox}/2024-01"), NORTHCARD_MAPPING)
    return mapping.add_metadata(found, PROCESSOR_MONTH)


def _run_audit(b: Bindings) -> DataFrame:
    """What the processor's job recorded of its run: rows in, rows out and failed casts."""
    root = new_path(b.spark, "audited")
    b.view(FLEETPAY).write.option("header", True).csv(f"{root}/inbound/fleet/2024-01")
    columns = [(m.source, m.source_type, m.target, m.target_type) for m in FLEETPAY_MAPPING]
    config = CloseConfig(f"""
[common]
destination_bucketname={root}/lake
finance_bucketname={root}/inbound
parquet_path=reports
nopii_db=closebook_checks_{uuid4().hex}
audit_table=close_run_audit
vcard_fleetpay_src_path=fleet
fleetpay_schema={columns}
""")
    run_processor(b.spark, config, "fleetpay", next_month(PROCESSOR_MONTH))
    audit = read_audit(b.spark, config.audit()[0])
    return audit.where("metric != 'files'").select("job", "target", "partition_id", "status", "metric", "value")


def _schema_evolution(b: Bindings) -> DataFrame:
    """A catalog table whose columns grow, widen and move to other keys while months arrive, read through the catalog."""
    root, table = new_path(b.spark, "evolving"), _catalog_name("evolving")
    lines = b.view(LINES)
    early = F.month("payment_date") % 2 == 1
    narrow = lines.where(early).withColumn("sku", F.col("sku").cast("int")).drop("return_flag")
    write_partitioned(narrow, root, many_partitions=True)
    register_table(b.spark, table, narrow.schema, root, [PARTITION])
    wide = lines.withColumn("amount", F.col("amount").cast("decimal(33,2)")).select(*narrow.columns, "return_flag")
    evolve_table(b.spark, table, wide.schema, root, [PARTITION])
    write_partitioned(wide.where(~early), root, many_partitions=True)
    register_table(b.spark, table, wide.schema, root, [PARTITION])
    evolve_table(b.spark, table, wide.schema, root, ["year"])
    return b.spark.table(table)


def _months_table(b: Bindings, name: str) -> tuple[str, str, list[str]]:
    """Lines by month, written and registered: the table's name, its folder and its months."""
    root, table = new_path(b.spark, name), _catalog_name(name)
    lines = b.view(LINES)
    write_partitioned(lines, root, many_partitions=True)
    register_table(b.spark, table, lines.schema, root, [PARTITION])
    months = [row[0] for row in b.spark.table(table).select(PARTITION).distinct().collect()]
    return table, root, sorted(months)


def _partition_listing(b: Bindings) -> DataFrame:
    table, _, _ = _months_table(b, "listed")
    return catalog_partitions(b.spark, table, [PARTITION]).select(PARTITION, "n_rows")


def _disordered(b: Bindings) -> tuple[str, str]:
    """A month in five is forgotten by the catalog, one has lost its files, and one lies elsewhere."""
    table, root, months = _months_table(b, "disordered")
    number = {m: 12 * int(m[:4]) + int(m[5:]) for m in months}
    drop_partitions(b.spark, table, [PARTITION], [(m,) for m in months if number[m] % 5 == 0])
    for month in months:
        folder = f"{root}/{PARTITION}={month}"
        fs, place = filesystem(b.spark, folder)
        if number[month] % 5 == 1:
            fs.delete(place, True)
        elif number[month] % 5 == 2:
            elsewhere = f"{root}_moved/{month}"
            target = filesystem(b.spark, elsewhere)[1]
            fs.mkdirs(target.getParent())
            fs.rename(place, target)
            set_location(b.spark, table, {PARTITION: month}, elsewhere)
    b.spark.catalog.refreshTable(table)
    return table, root


def _partition_difference(b: Bindings) -> DataFrame:
    table, root = _disordered(b)
    return partition_difference(b.spark, table, root, [PARTITION]).select(PARTITION, "status", "n_rows")


def _partition_reconcile(b: Bindings) -> DataFrame:
    table, root = _disordered(b)
    reconcile_partitions(b.spark, table, root, [PARTITION])
    return catalog_partitions(b.spark, table, [PARTITION]).select(PARTITION, "n_rows")


def _stage_published(b: Bindings) -> DataFrame:
    """The stage as readers of the catalog see it after two publishes."""
    root, table = new_path(b.spark, "stage"), _catalog_name("stage")
    batches = store(_stage(b), "stage")
    for part in (batches.where("partner = 'AmEx'"), batches):
        publish_whole(b.spark, table, write_stage(part, root))
    vacuum(b.spark, table, root)
    return b.spark.table(table)


def _control_published(b: Bindings) -> DataFrame:
    """The control table as readers of the catalog see it: early months published alone, then all of them."""
    root, table = new_path(b.spark, "control"), _catalog_name("control")
    control = store(journal.control_totals(_lines(b)), "control")
    for part in (control.where("reportmonth < date'1998-01-01'"), control):
        publish_partitions(b.spark, table, root, write_control(part, root))
    vacuum(b.spark, table, root)
    return b.spark.table(table)


def _daily_published(b: Bindings) -> DataFrame:
    """The rows of a daily table and of its extract, published at once."""
    root, table = new_path(b.spark, "daily"), _catalog_name("daily")
    result = store(b.view(DAILY), "daily")
    extract = f"{new_path(b.spark, 'outbox')}/Activity/Activity_01021998_06.csv"
    publish_daily(b.spark, result, table, root, extract)
    kinds = ", ".join(f"{name} {kind}" for name, kind in result.dtypes)
    sent = b.spark.read.schema(kinds).option("header", True).csv(extract)
    ours = b.spark.table(table).select(*result.columns).withColumn("place", F.lit("table"))
    return ours.unionAll(sent.withColumn("place", F.lit("extract")))


def _excluded_products(b: Bindings) -> DataFrame:
    """Lines whose product is not excluded, for a table of exclusions that is whole, holds a NULL, or is empty."""
    excluded = b.view(EXCLUDED)
    tables = {"whole": excluded, "with_null": excluded.unionAll(b.spark.range(1).select(F.lit(None).cast("bigint"))), "empty": excluded.where("false")}
    found = None
    for name, table in tables.items():
        kept = exclusions.excluded_by(b.view(SOLD), "sku", table)
        counted = kept.groupBy("sku").agg(F.count("*").alias("n_lines")).withColumn("exclusions", F.lit(name))
        found = counted if found is None else found.unionAll(counted)
    return found


def _report_gate(b: Bindings) -> DataFrame:
    found, days = None, store(b.run_days(), "days")
    for at in GATES:
        gated = gate.report_gate(days, REPORTS, b.view(SOURCE_RUNS), DEPENDENCIES, at)
        found = gated if found is None else found.unionAll(gated)
    return found


def _long_growth(b: Bindings) -> DataFrame:
    """Flows of many periods at the price level of their period."""
    found = None
    for name, (growth, periods) in LONG_GROWTH.items():
        flows = capital.inflated_cash_flows(b.view(LONG_FLOWS, periods=periods), growth).withColumn("growth_id", F.lit(name))
        found = flows if found is None else found.unionAll(flows)
    return found


def _long_npv(b: Bindings) -> DataFrame:
    return capital.scenario_eac(b.view(LONG_FLOWS, periods=LONG_PERIODS), LONG_RATES)


def _flows(b: Bindings) -> DataFrame:
    return b.view(CASH_FLOWS)


QUERIES: dict[str, Callable[[Bindings], DataFrame]] = {
    "partition_inventory": _partition_inventory,
    "report_month_window": _report_month_window,
    "monthly_revenue_report": _monthly_revenue_report,
    "business_days": lambda b: calendar.business_days(b.date_dim()),
    "nth_business_day": lambda b: calendar.nth_business_day(b.date_dim(), range(1, 5)),
    "reports_due": _reports_due,
    "northcard_normalize": lambda b: _normalize(b, NORTHCARD, NORTHCARD_MAPPING),
    "fleetpay_normalize": lambda b: _normalize(b, FLEETPAY, FLEETPAY_MAPPING),
    "je_stage_batches": _stage,
    "je_stage_batches_monthly": _monthly_stage,
    "je_lines": lambda b: _lines(b).select("file_no", "rk", *[f"`{c}`" for c in journal.LINE_COLUMNS]),
    "je_summary": lambda b: journal.control_totals(_lines(b)),
    "je_reconcile": lambda b: journal.reconcile(_lines(b)),
    "report_table": _report_table,
    "processor_table": _processor_table,
    "je_files": _je_files,
    "je_file_lines": _je_file_lines,
    "je_stage_published": _stage_published,
    "je_control_published": _control_published,
    "processor_layouts": _processor_layouts,
    "run_audit": _run_audit,
    "schema_evolution": _schema_evolution,
    "partition_listing": _partition_listing,
    "partition_difference": _partition_difference,
    "partition_reconcile": _partition_reconcile,
    "daily_published": _daily_published,
    "excluded_products": _excluded_products,
    "report_gate": _report_gate,
    "long_growth": _long_growth,
    "long_npv": _long_npv,
    "sku_dim_parse": lambda b: journal.product_dimension(b.products()),
    "source_freshness": lambda b: readiness.source_freshness(b.view(SOURCE_RUNS), RUNS_AS_OF),
    "report_readiness": lambda b: readiness.report_readiness(b.view(SOURCE_RUNS), DEPENDENCIES, RUNS_AS_OF),
    "npv_by_option": lambda b: capital.npv_by_option(_flows(b), RATE),
    "eac_by_option": lambda b: capital.eac_by_option(_flows(b), RATE),
    "tax_shield_cashflows": lambda b: capital.tax_shield_cash_flows(b.view(ASSETS), TAX_RATE),
    "after_tax_cashflows": lambda b: capital.after_tax_cash_flows(_flows(b), TAX_RATE),
    "inflated_cashflows": lambda b: capital.inflated_cash_flows(_flows(b), GROWTH),
    "typed_assumptions": lambda b: capital.typed_assumptions(b.view(ASSUMPTIONS)),
    "option_ranking": lambda b: capital.rank_options(capital.eac_by_option(_flows(b), RATE)),
    "recommended_options": lambda b: capital.recommended_options(
        _flows(b), capital.typed_assumptions(b.view(ASSUMPTIONS)), TAX_RATE
    ),
    "scenario_npv": lambda b: capital.scenario_npv(_flows(b), SCENARIOS).drop("horizon"),
    "scenario_ranking": lambda b: capital.rank_options(capital.scenario_eac(_flows(b), SCENARIOS)),
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](Bindings(configure(spark, size_of(spark, sf_dir)), sf_dir))
