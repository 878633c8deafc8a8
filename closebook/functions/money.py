"""Exact money arithmetic: decimal types and rate factors."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from closebook.functions.tables import values_table

LEDGER = "decimal(33,2)"
# Money and factor types whose product keeps all of its decimals within 38 digits.
FLOW = "decimal(19,2)"
FACTOR = "decimal(18,12)"
# A rate or growth per period, as a share.
RATE = "decimal(9,8)"

_TWELVE = Decimal("0.000000000001")


def ledger_sum(amount: Column) -> Column:
    return F.sum(amount.cast(LEDGER))


def _power(base: Decimal, exponent: int) -> Decimal:
    with localcontext() as context:
        context.prec = 60
        return base**exponent


def _rounded(value: Decimal) -> Decimal:
    """As a factor is kept: twelve decimals, or eighteen digits when it has more than six before the point."""
    more = max(value.adjusted() - 5, 0)
    with localcontext() as context:
        context.prec = 60
        return value.quantize(_TWELVE.scaleb(more), ROUND_HALF_UP)


def discount_factor(rate: Decimal, t: int) -> Decimal:
    return _rounded(_power(1 + rate, -t))


def growth_factor(rate: Decimal, t: int) -> Decimal:
    return _rounded(_power(1 + rate, t))


def annuity_factor(rate: Decimal, periods: int) -> Decimal:
    """The equal yearly payment per unit of present value."""
    with localcontext() as context:
        context.prec = 60
        factor = Decimal(1) / periods if rate == 0 else rate / (1 - (1 + rate) ** -periods)
        return factor.quantize(_TWELVE, ROUND_HALF_UP)


def scenario_table(spark: SparkSession, rates: Mapping[str, Decimal] | DataFrame) -> DataFrame:
    """(scenario_id, rate): a table of scenarios as it is given, or made of named rates."""
    if isinstance(rates, DataFrame):
        return rates.select(F.col("scenario_id").cast("string"), F.col("rate").cast(RATE))
    return values_table(spark, [("scenario_id", "string"), ("rate", RATE)], rates.items())


# A factor while it is compounded: one digit before the point, and a power of ten. No rate or number of periods can leave
# the range of the mantissa.
_MANTISSA = "decimal(29,28)"
_STEP = "decimal(10,8)"
_MOST_SHIFT = 9


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _compounded(t: Column, step) -> Column:
    """``step`` applied t times to 1, as (m, e) standing for m * 10^e, 1 <= m < 10; NULL for a missing or negative t."""
    periods = F.when(t > 0, F.sequence(F.lit(1), t)).when(t == 0, F.array().cast("array<int>"))
    one = F.struct(F.lit(1).cast(_MANTISSA).alias("m"), F.lit(0).alias("e"))
    return F.aggregate(periods, one, lambda now, _: _let(step(now["m"]), lambda value: _normal(value, now["e"])))


def _normal(value: Column, exponent: Column) -> Column:
    """The mantissa brought back to one digit before the point. Most steps leave it as it is: that is asked first."""
    shifts = []
    for k in range(1, _MOST_SHIFT + 1):
        up, down = Decimal(10) ** k, Decimal(1).scaleb(-k)
        larger = F.struct((value * F.lit(down)).cast(_MANTISSA).alias("m"), (exponent + k).alias("e"))
        smaller = F.struct((value.cast("decimal(30,29)") * F.lit(up)).cast(_MANTISSA).alias("m"), (exponent - k).alias("e"))
        shifts.append((value >= F.lit(down), smaller))
        shifts.append((value < F.lit(up * 10), larger))
    # From the least shift on: below one the first power of ten that is not above it, above ten the first that is not.
    below, above = shifts[::2], shifts[1::2]
    same = F.struct(value.cast(_MANTISSA).alias("m"), exponent.alias("e"))
    lower, higher = F.when(*below[0]), F.when(*above[0])
    for condition, moved in below[1:]:
        lower = lower.when(condition, moved)
    for condition, moved in above[1:]:
        higher = higher.when(condition, moved)
    return F.when((value >= 1) & (value < 10), same).when(value < 1, lower).otherwise(higher)


def _factor(compounded: Column) -> Column:
    """(m, e) with m of FACTOR's type: twelve decimals while six digits before the point suffice, then eighteen digits."""
    return _let(compounded, _rounded_at)


def _rounded_at(compounded: Column) -> Column:
    m, e = compounded["m"], compounded["e"]
    value = F.lit(Decimal(0)).cast(FACTOR)
    for k in range(-13, 6):
        power = F.lit(Decimal(1).scaleb(k)).cast(f"decimal({max(k + 1, -k, 1)},{max(-k, 0)})")
        value = F.when(e == k, (m * power).try_cast(FACTOR)).otherwise(value)
    most = F.lit(Decimal("999999.999999999999"))
    large = F.least((m * F.lit(Decimal(100000))).cast("decimal(34,27)"), most).cast(FACTOR)
    small = F.struct(value.alias("m"), F.lit(0).alias("e"))
    return F.when(compounded.isNull(), F.lit(None)).when(e > 5, F.struct(large.alias("m"), (e - 5).alias("e"))).otherwise(small)


def _discounted(rate: Column, t: Column) -> Column:
    return _compounded(t, lambda m: m / (1 + rate).cast(_STEP))


def wide_discount_factor(rate: Column, t: Column) -> Column:
    """(1 + rate)^-t as (m, e), m * 10^e, by repeated division."""
    return _factor(_discounted(rate, t))


def wide_growth_factor(rate: Column, t: Column) -> Column:
    """(1 + rate)^t as (m, e), by repeated multiplication."""
    return _factor(_compounded(t, lambda m: m * (1 + rate).cast(_STEP)))


def times(amount: Column, factor: Column) -> Column:
    """An amount times a wide factor, exactly. A product of 10^24 or more fails the job."""
    product = amount.cast(FLOW) * factor["m"]

    def shifted(pair: Column) -> Column:
        value, power = pair["product"], pair["power"]
        moved = F.concat(value.cast("string"), F.lit("E"), power.cast("string")).cast("decimal(38,14)")
        return F.when((power == 0) | (value == 0), value.cast("decimal(38,14)")).otherwise(moved)

    return _let(F.struct(product.alias("product"), factor["e"].alias("power")), shifted)


def _plain(factor: Column) -> Column:
    """A factor below a million as one decimal; a larger one fails the job."""
    large = F.raise_error(F.lit("a factor of a million or more has no plain form")).cast(FACTOR)
    return _let(factor, lambda f: F.when(f["e"] > 0, large).otherwise(f["m"]))


def discount_factor_at(rate: Column, t: Column) -> Column:
    """(1 + rate)^-t as one decimal."""
    return _plain(wide_discount_factor(rate, t))


def growth_factor_at(rate: Column, t: Column) -> Column:
    """(1 + rate)^t as one decimal."""
    return _plain(wide_growth_factor(rate, t))


def annuity_factor_at(rate: Column, periods: Column) -> Column:
    """The equal yearly payment per unit of present value over ``periods`` of at least one."""
    return _let(_discounted(rate, periods), lambda value: _annuity(rate, periods, value))


def _annuity(rate: Column, periods: Column, value: Column) -> Column:
    m, e = value["m"], value["e"]
    power = F.lit(None).cast("decimal(28,20)")
    for k in range(-20, 8):
        scale = F.lit(Decimal(1).scaleb(k)).cast(f"decimal({max(k + 1, -k, 1)},{max(-k, 0)})")
        power = F.when(e == k, (m * scale).try_cast("decimal(28,20)")).otherwise(power)
    power = F.when(e < -20, F.lit(Decimal(0)).cast("decimal(28,20)")).otherwise(power)
    long = F.lit(None).cast("decimal(28,13)")
    for k in range(8, 14):
        long = F.when(e == k, (m * F.lit(Decimal(10) ** k)).try_cast("decimal(28,13)")).otherwise(long)
    even = F.lit(1).cast("decimal(20,12)") / periods
    # Beyond 10^14 the payment per unit is nothing in twelve decimals.
    return (
        F.when(rate == 0, even.cast(FACTOR))
        .when(e > 13, F.lit(Decimal(0)).cast(FACTOR))
        .when(e > 7, (rate / (1 - long).cast("decimal(29,13)")).cast(FACTOR))
        .otherwise((rate / (1 - power).cast("decimal(28,20)")).cast(FACTOR))
    )


def required(value: Column, message: str) -> Column:
    """``value``, or a failed job when there is none: a missing factor must not drop or blank a row."""
    return F.when(value.isNull(), F.raise_error(F.lit(message))).otherwise(value)
