"""Cash flows of investment options: after tax, inflated, discounted, annualised and ranked."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from closebook.functions.money import (
    FLOW,
    LEDGER,
    RATE,
    annuity_factor_at,
    required,
    scenario_table,
    times,
    wide_discount_factor,
    wide_growth_factor,
)
from closebook.functions.text import assumption_amount, assumption_unit
from closebook.operators.ordering import ranks

TAX = "decimal(6,4)"
BASE = "base"


def typed_assumptions(assumptions: DataFrame) -> DataFrame:
    """(assumption, value) text to (key, amount, unit)."""
    value = F.col("value")
    return assumptions.select(
        F.col("assumption").alias("key"), assumption_amount(value).alias("amount"), assumption_unit(value).alias("unit")
    )


def flows_by_period(cash_flows: DataFrame) -> DataFrame:
    """One amount per option and period. Sums are exact, so every later factor may be applied to the total."""
    return cash_flows.groupBy("option_id", "t").agg(F.sum("amount").cast(FLOW).alias("amount"))


def _periods(cash_flows: DataFrame) -> DataFrame:
    """Every period that occurs, once: factors are worked out for these and joined."""
    return cash_flows.select("t").distinct()


def inflated_cash_flows(cash_flows: DataFrame, growth: Decimal) -> DataFrame:
    """Each flow with its value at the price level of its period."""
    factors = _periods(cash_flows).withColumn("growth", wide_growth_factor(F.lit(growth).cast(RATE), F.col("t")))
    inflated = times(F.col("amount"), required(F.col("growth"), "a flow without a period from 0 on"))
    return cash_flows.join(factors, "t", "left").select(
        "option_id", "t", "amount", inflated.cast(LEDGER).alias("inflated")
    )


def after_tax_cash_flows(cash_flows: DataFrame, tax_rate: Decimal) -> DataFrame:
    """Each taxable or deductible flow net of tax."""
    kept = F.lit(1 - tax_rate).cast(TAX)
    return cash_flows.withColumn("after_tax", (F.col("amount").cast(FLOW) * kept).cast(LEDGER))


def tax_shield_cash_flows(assets: DataFrame, tax_rate: Decimal) -> DataFrame:
    """Straight-line depreciation over each asset's life, and the tax it saves.

    ``assets`` has asset_id, price and life (years). Cents that do not divide evenly fall into the last year, so the
    depreciation of an asset adds up to its price. An asset without a life of a year or more keeps one row, without a
    year and amounts, so that it is not lost unseen.
    """
    cents = (F.col("price").cast(FLOW) * 100).cast("bigint")
    life = F.col("life").cast("bigint")
    years = F.when(life >= 1, F.sequence(F.lit(1), F.col("life").cast("int")))
    yearly = assets.select("asset_id", cents.alias("_cents"), life.alias("_life"), F.explode_outer(years).alias("t"))
    even = F.expr("_cents div nullif(_life, 0)")
    rest = F.when(F.col("t") == F.col("_life"), F.expr("_cents % _life")).otherwise(F.lit(0))
    depreciation = ((even + rest).cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(20,2)")
    depreciation = F.when(F.col("t").isNotNull(), depreciation)
    return yearly.select("asset_id", "t", depreciation.alias("depreciation")).withColumn(
        "shield", (F.col("depreciation") * F.lit(tax_rate).cast(TAX)).cast(LEDGER)
    )


def _valued(cash_flows: DataFrame, rates: Mapping[str, Decimal] | DataFrame) -> DataFrame:
    """Net present value of every option in every scenario, with the scenario's rate and the option's last period.

    Flows are totalled per option and period first; only these totals meet the scenarios' factors.
    """
    totals = flows_by_period(cash_flows)
    last = totals.agg(F.max("t")).scalar()
    factors = scenario_table(cash_flows.sparkSession, rates).withColumn("t", F.explode(F.sequence(F.lit(0), last)))
    factors = factors.withColumn("factor", wide_discount_factor(F.col("rate"), F.col("t")))
    present = times(F.col("amount"), required(F.col("factor"), "a flow without a period from 0 on"))
    return (
        totals.join(factors, "t", "left")
        .groupBy("scenario_id", "rate", "option_id")
        .agg(F.max("t").alias("horizon"), F.sum(present).cast(LEDGER).alias("npv"))
    )


def scenario_npv(cash_flows: DataFrame, rates: Mapping[str, Decimal] | DataFrame) -> DataFrame:
    """Net present value of every option in every scenario. Scenarios are named rates or a table of them."""
    return _valued(cash_flows, rates).select("scenario_id", "option_id", "horizon", "npv")


def npv_by_option(cash_flows: DataFrame, rate: Decimal) -> DataFrame:
    return scenario_npv(cash_flows, {BASE: rate}).drop("scenario_id")


def scenario_eac(cash_flows: DataFrame, rates: Mapping[str, Decimal] | DataFrame) -> DataFrame:
    """Net present value and its equivalent annual cost; an option without a later period has no annual cost."""
    annual = F.col("npv").cast(FLOW) * annuity_factor_at(F.col("rate"), F.col("horizon"))
    eac = F.when(F.col("horizon") > 0, annual).cast(LEDGER)
    return _valued(cash_flows, rates).select("scenario_id", "option_id", "horizon", "npv", eac.alias("eac"))


def eac_by_option(cash_flows: DataFrame, rate: Decimal) -> DataFrame:
    return scenario_eac(cash_flows, {BASE: rate}).drop("scenario_id")


def assumed_rates(assumptions: DataFrame) -> DataFrame:
    """(scenario_id, rate) of the distinct percentages among typed assumptions, named by their amount."""
    share = (F.col("amount") / 100).cast(RATE)
    percent = assumptions.where("unit = 'percent'").select(share.alias("rate")).distinct()
    return percent.select(F.col("rate").cast("string").alias("scenario_id"), "rate")


def recommended_options(cash_flows: DataFrame, assumptions: DataFrame, tax_rate: Decimal) -> DataFrame:
    """The whole chain: outflows after tax, their value under every assumed rate, the option of least annual cost.

    Ties are all returned. ``assumptions`` are typed; each distinct percentage is a scenario.
    """
    taxed = after_tax_cash_flows(cash_flows, tax_rate).select("option_id", "t", F.col("after_tax").alias("amount"))
    valued = scenario_eac(taxed, assumed_rates(assumptions))
    best = valued.groupBy("scenario_id").agg(F.max("eac").alias("eac"))
    return valued.join(best, ["scenario_id", "eac"]).select("scenario_id", "option_id", "horizon", "npv", "eac")


def rank_options(valued: DataFrame) -> DataFrame:
    """Ranks by net present value among options of one horizon, and by equivalent annual cost among all.

    The best option is the one with the least negative cost. Options are ranked within their scenario when
    ``valued`` has scenarios.
    """
    scenario = [c for c in ("scenario_id",) if c in valued.columns]
    by_npv = ranks(valued, "npv", ["option_id"], "npv_rank", [*scenario, "horizon"])
    return ranks(by_npv, "eac", ["option_id"], "eac_rank", scenario).select(
        *scenario, "option_id", "horizon", "npv_rank", "eac_rank"
    )

