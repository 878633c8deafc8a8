"""Command line of the three jobs.

    python -m closebook report    --config finance.conf --as-of 2024-02-01 --table monthly_rpt_cash_billed_revenue
    python -m closebook processor --config finance.conf --as-of 2024-02-01 --processor northcard
    python -m closebook journal   --config finance.conf --as-of 2024-02-01

``--as-of`` is the day the job stands for; it reports the month before. Source tables are read from the catalog.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import SparkSession

from closebook.config import CloseConfig
from closebook.plans.journal import run_journal
from closebook.plans.processor import run_processor
from closebook.plans.report import run_report
from closebook.session import configure
from closebook.workspace import clear


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="closebook", description="Month-end close jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    report = jobs.add_parser("report", help="run one configured report")
    report.add_argument("--table", required=True)
    processor = jobs.add_parser("processor", help="normalise one processor's files")
    processor.add_argument("--processor", required=True)
    journal = jobs.add_parser("journal", help="write journal-entry files")
    for job in (report, processor, journal):
        job.add_argument("--config", required=True)
        job.add_argument("--as-of", required=True, type=date.fromisoformat)
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark = configure(SparkSession.builder.appName(f"closebook-{options.job}").getOrCreate())
    try:
        print(_run(spark, options))
    finally:
        clear(spark)


def _run(spark: SparkSession, options: argparse.Namespace):
    config = CloseConfig.load(spark, options.config)
    if options.job == "report":
        gated = config.business_day(options.table) is not None
        dates = spark.table(config.get("date_dim_table", "date_dim")) if gated else None
        waits = config.report(options.table).sources
        runs = spark.table(config.get("runs_table", "source_runs")) if waits else None
        return run_report(spark, config, options.table, options.as_of, dates, datetime.now(), runs)
    if options.job == "processor":
        return run_processor(spark, config, options.processor, options.as_of)
    database = config.require("nopii_db")
    revenue = spark.table(config.get("revenue_table", f"{database}.monthly_rpt_cash_billed_revenue"))
    products = spark.table(config.get("product_table", "product_sku_dim"))
    return run_journal(spark, config, revenue, products, options.as_of)


if __name__ == "__main__":
    main()
