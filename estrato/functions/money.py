"""Amounts, rates and bands. Money stays decimal; only roots and powers use doubles."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
# A total over a whole table grows with the table.
TOTAL = "decimal(38,2)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def total(amount: str) -> Column:
    return F.sum(F.col(amount).cast(TOTAL))


def dec(text: str) -> Column:
    return F.lit(Decimal(text))


def convert(amount: Column, rate: Decimal) -> Column:
    """Amount in another currency at `rate` units per unit of it."""
    return money(money(amount) / F.lit(rate).cast("decimal(18,4)"))


def percent(part: Column, whole: Column, when_zero=None) -> Column:
    """100 * part / whole as DECIMAL(10,2); `when_zero` is returned for an empty whole."""
    ratio = (part.cast("decimal(28,2)") * 100 / F.nullif(whole, F.lit(0)).cast("decimal(28,2)"))
    return F.when(whole == 0, F.lit(when_zero)).otherwise(ratio).cast("decimal(10,2)")


def monthly_rate(annual: Column, exponent: float = 1 / 12) -> Column:
    """Monthly percentage equivalent to an effective annual percentage."""
    growth = F.pow(F.lit(1.0) + annual.cast("double") / F.lit(100.0), F.lit(exponent))
    return ((growth - 1.0) * 100.0).cast("decimal(10,4)")


def band(value: Column, steps: Sequence[tuple[int, object]], above, zero=None) -> Column:
    """Label of the first step whose upper bound covers the value.

    `zero`, when given, labels the exact value 0 before any step is looked at.
    """
    chain = None if zero is None else F.when(value == 0, F.lit(zero))
    for upper, label in steps:
        hit = value <= upper
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain.otherwise(F.lit(above))
