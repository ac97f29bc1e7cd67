"""Exact money arithmetic on double columns.

Sums of doubles depend on row order, so a retried task or another partitioning
could change the result. Amounts are therefore held as whole numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A revenue is cents x percent, so its unit is a ten-thousandth.
UNITS_PER_WHOLE = 10_000
# Below these a product of units fits a bigint, with room to spare.
PRICE_LIMIT = 10**13
DISCOUNT_LIMIT = 10


def _hundredths(value: Column, name: str, limit: int) -> Column:
    """The value in hundredths. It stops the job unless the double is the one nearest to two decimals."""
    nearest = F.rint(value * 100)
    exact = (nearest / 100 == value) & (F.abs(value) < limit)
    message = F.concat(F.lit(f"{name} is not exact to two decimals or not below {limit}: "), value.cast("string"))
    return F.when(value.isNotNull() & ~exact, F.raise_error(message)).otherwise(nearest.cast("bigint"))


def discounted_units(price: Column, discount: Column) -> Column:
    """price * (1 - discount) in ten-thousandths, for inputs with two decimals."""
    return _hundredths(price, "price", PRICE_LIMIT) * (100 - _hundredths(discount, "discount", DISCOUNT_LIMIT))


def sum_units(units: Column) -> Column:
    """The sum as decimal(30,0), which cannot overflow below 10**11 lines at the limits, in ANSI mode or not."""
    return F.sum(units.cast("decimal(20,0)"))


def to_amount(units: Column) -> Column:
    """A sum of units as a double like the input columns."""
    return (units.cast("decimal(34,4)") / F.lit(UNITS_PER_WHOLE).cast("decimal(5,0)")).cast("double")
