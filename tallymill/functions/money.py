"""Line arithmetic in exact decimals, returned as doubles of two places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
LANDED_FACTOR = "1.10"
VAT_RATE = "0.16"
LINE_TOLERANCE = 0.01


def amount(c: Column) -> Column:
    """Exact money; NULL for what no amount of the books can be."""
    return c.try_cast("decimal(14,2)")


def _rate(c: Column) -> Column:
    return c.try_cast("decimal(6,4)")


def _units(c: Column) -> Column:
    return c.try_cast("decimal(10,0)")


def cents(c: Column) -> Column:
    return F.round(c, 2).cast("double")


def line_total(qty: Column, price: Column, rate: Column) -> Column:
    return cents(amount(price) * (F.lit(1) - _rate(rate)) * _units(qty))


def line_discount(qty: Column, price: Column, rate: Column) -> Column:
    return cents(amount(price) * _rate(rate) * _units(qty))


def net_price(price: Column, rate: Column) -> Column:
    return cents(amount(price) * (F.lit(1) - _rate(rate)))


def extended(qty: Column, price: Column) -> Column:
    return cents(price.try_cast("decimal(16,4)") * qty.try_cast("decimal(14,4)"))


def scaled(value: Column, factor: str) -> Column:
    return cents(amount(value) * F.lit(factor).cast("decimal(6,4)"))


def landed_cost(value: Column) -> Column:
    return scaled(value, LANDED_FACTOR)


def vat(value: Column) -> Column:
    return scaled(value, VAT_RATE)


def unit_price(value: Column, qty: Column) -> Column:
    """Price per unit, NULL for a zero quantity."""
    return cents(F.try_divide(amount(value), _units(qty)))


def exact_sum(c: Column, scale: int = 2) -> Column:
    """Order-independent sum: decimals add up alike on any partitioning."""
    return F.sum(c.cast(f"decimal(18,{scale})"))


def exact_mean(total: Column, n: Column, places: int = 2) -> Column:
    """A non-negative decimal total over a count, rounded half up without binary error."""
    scaled_total = (total * 10**places).cast("decimal(38,0)")
    units = F.call_function("div", scaled_total * 2 + n, F.nullif(n * 2, F.lit(0).cast("bigint")))
    return units.cast("double") / 10**places


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def real_index(index: Column, inflation: Column) -> Column:
    return F.round(index * F.try_divide(F.lit(100.0), inflation + 100), 2)


def signed(value: Column, positive: Column, negative: Column, otherwise: Column) -> Column:
    """``value`` where ``positive``, its opposite where ``negative``."""
    return F.when(positive, value).when(negative, -value).otherwise(otherwise)
