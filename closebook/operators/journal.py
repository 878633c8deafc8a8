"""Journal-entry batches, lines, control totals and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from closebook.functions.dates import month_label, partition_id, partition_of
from closebook.functions.money import ledger_sum
from closebook.functions.text import sku_item_name, sku_number
from closebook.operators.ordering import place, sorted_runs

# Fixed values of the ledger import: one file takes 9,999 rows, one of them the summary row.
BATCH_SIZE = 9998
EXCLUDED_SKUS = (9999, 92)
CARD_PARTNER = "AmEx"
OTHER_PARTNERS = "Non-AmEx"
SUMMARY_ACCOUNT = "11181"
SUBSIDIARY = "Your Company Name"
FILE_NAME = "Billed_JE"


@dataclass(frozen=True)
class LedgerTarget:
    account: str
    item: str


# Account and item of card-partner lines by product group.
CARD_TARGETS = {
    "Subscription Revenue": LedgerTarget("45010", "SKU-Bank Sub"),
    "Transaction Revenue": LedgerTarget("45020", "SKU-Bank Tran"),
}

# The columns of a ledger file, in order.
LINE_COLUMNS = (
    "tranid",
    "subsidiary",
    "currency",
    "exchangerate",
    "postingperiod",
    "tranDate",
    "journalItemLine_accountRef",
    "journalItemLine_debitAmount",
    "journalItemLine_creditAmount",
    "journalItemLine_memo",
    "journalItemLine_entityRef",
    "journalItemLine_startdate",
    "journalItemLine_enddate",
    "journalItemLine_taxCodeRef",
    "Quantity",
    "Item Reference",
)
# Names that differ between the lines and the header of the file.
FILE_HEADER = {"tranid": "tranId"}


def billed_amounts(
    lines: DataFrame, excluded_skus: Sequence[int] = EXCLUDED_SKUS, report_month: date | None = None
) -> DataFrame:
    """Non-zero amounts by month, organisation, payment date, product and partner label.

    One scan serves both partner groups. A missing partner or product is in neither. With ``report_month`` both
    the month and its partition are filtered, so a table partitioned by ``partition_id`` reads one folder.
    """
    if report_month is not None:
        lines = lines.where(F.col("reportmonth") == F.lit(report_month))
        if "partition_id" in lines.columns:
            lines = lines.where(F.col("partition_id") == partition_of(report_month))
    return (
        lines.where(F.col("partner_type").isNotNull() & ~F.col("sku").isin(*excluded_skus))
        .groupBy(
            F.col("reportmonth").alias("report_month"),
            "organization_id",
            F.col("payment_date").cast("date").alias("payment_date"),
            F.when(F.col("partner_type") == CARD_PARTNER, CARD_PARTNER).otherwise(OTHER_PARTNERS).alias("partner"),
            "sku",
        )
        .agg(ledger_sum(F.col("amount")).alias("amount"))
        .where(F.col("amount") != 0)
    )


def stage_batches(amounts: DataFrame, batch_size: int = BATCH_SIZE, per_month: bool = False) -> DataFrame:
    """Number the rows into files of at most ``batch_size``, card-partner files before the others.

    The order within a partner is product, payment date, organisation, then month: a total order, because these are
    the grouping keys. ``per_month`` starts again at file 1 for every report month.
    """
    month = ["report_month"] if per_month else []
    scope = [*month, "partner"]
    rest = ["sku", "payment_date", "organization_id", *([] if per_month else ["report_month"])]
    rows, runs = sorted_runs(amounts, rest, scope)
    card_rows = F.sum(F.when(F.col("partner") == CARD_PARTNER, F.col("_rows"))).over(Window.partitionBy(*month))
    card_files = _div(F.coalesce(card_rows, F.lit(0)) + batch_size - 1, batch_size)
    ahead = F.when(F.col("partner") == CARD_PARTNER, 0).otherwise(card_files)
    return place(rows, runs.withColumn("_ahead", ahead), scope, "_ahead").select(
        "report_month",
        "organization_id",
        "payment_date",
        "partner",
        "sku",
        "amount",
        (_div(F.col("rn") - 1, batch_size) + 1 + F.col("_ahead")).alias("file_no"),
    )


def product_dimension(products: DataFrame) -> DataFrame:
    """Products with the number and the item name taken from the ledger's product code."""
    return products.where(F.col("sku").isNotNull()).select(
        "sku",
        sku_number(F.col("netsuite_sku")).alias("sku_num"),
        sku_item_name(F.col("netsuite_sku"), F.col("sku_product_description")).alias("sku_num_desc"),
        "product_group",
        "netsuite_gl_account_number",
    )


def journal_lines(
    stage: DataFrame, products: DataFrame, card_targets: Mapping[str, LedgerTarget] = CARD_TARGETS
) -> DataFrame:
    """All files' lines in one frame: a debit row per file (``rk`` 0) and a credit row per staged row (``rk`` 1).

    The credit rows' accounts are an own rule; a row without an account is kept, and counted by ``reconcile``.
    The sort keys of the credit rows stay on as helper columns for the file writer.
    """
    keys = ["file_no", "report_month", "partner"]
    debit = (
        stage.groupBy(*keys)
        .agg(F.sum("amount").cast("decimal(38,2)").alias("_debit"))
        .select(
            *keys,
            F.lit(SUMMARY_ACCOUNT).alias("_account"),
            "_debit",
            F.lit(None).cast("decimal(38,2)").alias("_credit"),
            F.lit("").alias("_item"),
            F.lit(0).alias("rk"),
            F.lit(None).cast("bigint").alias("sku"),
            F.lit(None).cast("date").alias("payment_date"),
            F.lit(None).cast("bigint").alias("organization_id"),
        )
    )
    is_card = F.col("partner") == CARD_PARTNER
    group = F.col("product_group")
    credit = stage.join(product_dimension(products), "sku", "left").select(
        *keys,
        F.when(is_card, _pick(group, {k: v.account for k, v in card_targets.items()}))
        .otherwise(F.col("netsuite_gl_account_number"))
        .alias("_account"),
        F.lit(None).cast("decimal(38,2)").alias("_debit"),
        F.col("amount").cast("decimal(38,2)").alias("_credit"),
        F.when(is_card, _pick(group, {k: v.item for k, v in card_targets.items()}))
        .otherwise(F.col("sku_num_desc"))
        .alias("_item"),
        F.lit(1).alias("rk"),
        "sku",
        "payment_date",
        "organization_id",
    )
    return described(debit.unionByName(credit))


def narrow(lines: DataFrame) -> DataFrame:
    """What of ``journal_lines`` the other columns follow from: a shuffle needs no more."""
    keys = ["file_no", "rk", "report_month", "partner", "sku", "payment_date", "organization_id"]
    own = {
        "_account": "journalItemLine_accountRef", "_debit": "journalItemLine_debitAmount",
        "_credit": "journalItemLine_creditAmount", "_item": "Item Reference",
    }
    return lines.select(*keys, *[F.col(f"`{c}`").alias(name) for name, c in own.items()])


def described(rows: DataFrame, *others: str) -> DataFrame:
    """The lines of ``narrow`` rows, with the columns that follow from the month, the file, the partner and the kind of line,
    and ``others`` of the rows."""
    label = month_label(F.col("report_month"))
    memo = F.concat(F.lit("Billed Revenue - "), label)
    values = (
        F.concat(F.lit("Billed Revenue JE "), F.col("file_no").cast("string"), F.lit(" - "), label),
        F.lit(SUBSIDIARY),
        F.lit("USD"),
        F.lit("1"),
        F.col("report_month"),
        F.last_day("report_month"),
        F.col("_account"),
        F.col("_debit"),
        F.col("_credit"),
        F.when(F.col("partner") == CARD_PARTNER, F.concat(F.col("partner"), F.lit(" "), memo)).otherwise(memo),
        F.when(F.col("rk") == 0, "").otherwise(F.col("organization_id").cast("string")),
        F.lit(None).cast("timestamp_ntz"),
        F.lit(None).cast("timestamp_ntz"),
        F.lit(""),
        F.lit(None).cast("double"),
        F.col("_item"),
    )
    return rows.select(
        "file_no",
        "rk",
        *[v.alias(c) for v, c in zip(values, LINE_COLUMNS, strict=True)],
        "report_month",
        "partner",
        "sku",
        "payment_date",
        "organization_id",
        *others,
    )


def control_totals(lines: DataFrame) -> DataFrame:
    """One audit row per month and file, from the lines as emitted. Sinks add the time stamp."""
    return reconcile(lines).select(
        F.col("report_month").alias("reportmonth"),
        F.lit(FILE_NAME).alias("je_file_name"),
        F.col("file_no").alias("je_file_no"),
        F.col("debit").alias("journalitemline_debitamount"),
        F.col("credit").alias("journalitemline_creditamount"),
        "delta",
        partition_id(F.col("report_month")).alias("partition_id"),
    )


def reconcile(lines: DataFrame) -> DataFrame:
    """Debits against credits as emitted, per month and file, with the lines that have no account."""
    debit = F.coalesce(F.sum("journalItemLine_debitAmount"), F.lit(0))
    credit = F.coalesce(F.sum("journalItemLine_creditAmount"), F.lit(0))
    return lines.groupBy("report_month", "file_no").agg(
        debit.cast("decimal(38,2)").alias("debit"),
        credit.cast("decimal(38,2)").alias("credit"),
        (debit - credit).cast("decimal(38,2)").alias("delta"),
        F.count_if(F.col("journalItemLine_accountRef").isNull()).alias("unmapped_lines"),
        F.count(F.lit(1)).alias("n_lines"),
    )


def _div(number: Column, divisor: int) -> Column:
    """Whole-number division of a non-negative bigint; ``/`` would go through a double."""
    return F.call_function("div", number, F.lit(divisor).cast("bigint"))


def _pick(key: Column, choices: Mapping[str, str]) -> Column:
    """The choice for ``key``, NULL when there is none: a lookup small enough to be an expression."""
    picked = F.lit(None).cast("string")
    for name, value in choices.items():
        picked = F.when(key == name, value).otherwise(picked)
    return picked
