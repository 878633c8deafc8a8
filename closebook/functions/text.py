"""Text rules for product codes, assumption values and processor cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sku_number(ledger_sku: Column) -> Column:
    """Text before the first hyphen of the ledger's product code, blanks around the hyphen left out.

    A code without a hyphen gives an empty text, a missing code gives NULL.
    """
    return F.trim(F.regexp_extract(ledger_sku, "^([^-]*)-", 1))


def sku_item_name(ledger_sku: Column, description: Column) -> Column:
    """The number itself, or the product description when the number is too short to be one."""
    number = sku_number(ledger_sku)
    return F.when(F.length(number) <= 3, description).otherwise(number)


_NUMBER = r"([+-]?[0-9][0-9,]*(?:\.[0-9]+)?)"
USD = rf"^\s*([+-]?)\$\s*{_NUMBER}\s*$"
PERCENT = rf"^\s*{_NUMBER}\s*%\s*$"
YEARS = rf"^\s*{_NUMBER}\s*years?\s*$"


def assumption_unit(value: Column) -> Column:
    """``usd``, ``percent`` or ``years``; NULL when the text is none of them."""
    return (
        F.when(F.regexp_like(value, F.lit(USD)), "usd")
        .when(F.regexp_like(value, F.lit(PERCENT)), "percent")
        .when(F.regexp_like(value, F.lit(YEARS)), "years")
    )


def assumption_amount(value: Column) -> Column:
    """The number in the text with its printed magnitude (8.5 for ``8.5%``); NULL without a known unit."""
    digits = F.regexp_replace(value, r"[^0-9.+\-]", "")
    return F.when(assumption_unit(value).isNotNull(), digits.try_cast("decimal(20,6)"))
