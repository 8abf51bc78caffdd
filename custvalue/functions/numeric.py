"""Money and rounding.

Money sums run on integers (cents, or fractions of them for line values), so a
sum does not depend on the order in which shuffled rows arrive, and stays in
primitive arithmetic.  ANSI mode turns an overflow into an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimals that unit prices have at most, unless a run says otherwise.
PRICE_DIGITS = 4


def round_half_away(value: Column, digits: int = 2) -> Column:
    """Round a double half away from zero."""
    scale = 10.0**digits
    scaled = F.abs(value) * scale
    rounded = F.signum(value) * F.floor(scaled + 0.5) / F.lit(scale)
    # From 2**53 on a double has no such digits, and FLOOR would not fit a BIGINT.
    return F.when(scaled >= 2.0**53, value).otherwise(rounded)


def price_units(unit_price: Column, digits: int = PRICE_DIGITS) -> Column:
    """A price as a whole number of ``10**-digits``; one with more decimals stops the job."""
    scaled = unit_price * 10.0**digits
    whole = F.rint(scaled)
    fits = F.abs(scaled - whole) <= 1e-6 + 1e-12 * F.abs(scaled)
    message = F.concat(F.lit(f"price with more than {digits} decimals: "), unit_price.cast("string"))
    # A NULL price is neither; it stays NULL.
    return F.when(~fits, F.raise_error(message).cast("bigint")).otherwise(whole.cast("bigint"))


def line_units(unit_price: Column, quantity: Column, digits: int = PRICE_DIGITS) -> Column:
    """Value of an order line in ``10**-digits`` of the currency, as BIGINT."""
    return price_units(unit_price, digits) * quantity


def units_to_cents(units: Column, digits: int = PRICE_DIGITS) -> Column:
    """Units of ``10**-digits`` to cents, half away from zero, in integer arithmetic."""
    per_cent = 10 ** (digits - 2)
    whole = F.call_function("div", F.abs(units) + F.lit(per_cent // 2), F.lit(per_cent))
    return F.when(units < 0, -whole).otherwise(whole)


def to_cents(money: Column) -> Column:
    """Cents of a two-decimal money column."""
    return F.rint(money * 100.0).cast("bigint")


def from_cents(cents: Column) -> Column:
    """Money as a double from a BIGINT number of cents."""
    return cents / F.lit(100.0)
