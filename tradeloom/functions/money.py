"""Exact money arithmetic on decimal columns.

A rounded ratio goes through `_half_up`, an integer division, so a result never depends on how many
digits an engine keeps in a decimal quotient. These run on aggregated rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(15,2)"
RATIO = "decimal(25,2)"


def _half_up(numerator: Column, denominator: Column) -> Column:
    """Whole number nearest to numerator / denominator, halves away from zero; null for x / 0."""
    divisor = F.nullif(F.abs(denominator), F.lit(0))
    size = F.call_function("div", 2 * F.abs(numerator) + divisor, 2 * divisor)
    return size * F.signum(numerator).cast("int") * F.signum(denominator).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator at two decimals."""
    hundredths = _half_up(numerator * 100, denominator)
    return (hundredths * F.lit(Decimal("0.01"))).cast(RATIO)


def average(total: Column, count: Column) -> Column:
    """total / count at two decimals, the cheap way, for facts with many rows.

    The quotient keeps at least 14 decimals, and one that is not a tie lies 1 / (20000 * count) or more
    from the nearest tie, so rounding it again is exact for counts below ten billion.
    """
    return F.round(total.cast("decimal(28,4)") / F.nullif(count, F.lit(0)), 2)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 at two decimals."""
    return ratio(part * 100, whole)


def growth_percent(current: Column, previous: Column) -> Column:
    return percent(current - previous, previous)


def whole_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded to an integer."""
    return _half_up(numerator, denominator)


def exact_sum(column: Column | str, decimals: int) -> Column:
    """Sum of a decimal column with the given decimals, added up as whole units in a long.

    A long is updated in place, a wide decimal is not; with many groups that halves the aggregation.
    Sums beyond 9.2e18 units fail, as the session runs in ANSI mode (`session.RUNTIME_SETTINGS`), so this
    is for groups that many rows share out among; `grand_total` is for the others.
    """
    value = F.col(column) if isinstance(column, str) else column
    units = F.sum((value * 10**decimals).cast("bigint"))
    return (units * F.lit(Decimal(1).scaleb(-decimals))).cast(f"decimal(25,{decimals})")


def money_sum(column: Column | str) -> Column:
    return exact_sum(column, 2)


def grand_total(column: Column | str) -> Column:
    """Sum of an amount over many rows in few groups, where whole cents could pass the range of a long.

    Holds up to 10^23; with few groups the wide buffer costs nothing, as map tasks add up first.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value.cast("decimal(28,2)")).cast(RATIO)


def line_amount(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """Unrounded value of an order line. Four decimals are exact; 18 digits stay a JVM long."""
    return (quantity * unit_price * (1 - discount)).cast("decimal(18,4)")


def rate(value: float | str | Decimal) -> Column:
    """A tax or commission rate as a decimal literal."""
    return F.lit(Decimal(str(value)))
