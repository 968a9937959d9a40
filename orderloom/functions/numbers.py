"""Exact decimal arithmetic that yields NULL, never an ANSI error, on bad input.

Every quotient is a decimal, so results do not depend on the order in which
tasks finish, and a zero denominator or an overflowing cast gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed column types. Totals use the natural type of a sum of decimal(12,2)
# values, and averages over orders or days a wide one: they hold the same numbers
# as narrower decimals would, and do not overflow to NULL when one key owns a
# large share of a very large table.
PRICE = "decimal(10,2)"
LINE_MONEY = "decimal(12,2)"
TOTAL = "decimal(22,2)"
AVERAGE = "decimal(10,2)"
WIDE_AVERAGE = "decimal(16,2)"
COUNT = "decimal(20,0)"


def total(amount: Column) -> Column:
    """Sum of money, in the one type used for totals."""
    return F.sum(amount).try_cast(TOTAL)


def distinct_where(column: str, condition: str) -> Column:
    """Distinct values among the rows where ``condition`` holds.

    As a filtered aggregate it shares the distinct groups of a plain
    ``count_distinct`` of the same column instead of expanding the rows again.
    """
    return F.expr(f"count(DISTINCT {column}) FILTER (WHERE {condition})")


def ratio(numerator: Column, denominator: Column, kind: str) -> Column:
    """numerator / denominator rounded half up to ``kind``; NULL when the denominator is 0."""
    return F.try_divide(numerator, denominator.cast(COUNT)).try_cast(kind)


def count_ratio(numerator: Column, denominator: Column, kind: str) -> Column:
    """Like ``ratio`` for two whole numbers."""
    return ratio(numerator.cast(COUNT), denominator, kind)


def percent(part: Column, whole: Column, kind: str) -> Column:
    """100 * part / whole of two whole numbers."""
    return count_ratio(part.cast(COUNT) * 100, whole, kind)


def pct_change(current: Column, previous: Column) -> Column:
    """Change in percent, NULL unless the previous value is positive."""
    change = F.try_divide((current - previous) * 100, previous)
    return F.when(previous > 0, change.try_cast("decimal(8,2)"))


def mean_of(amount_total: Column, amount_count: Column, kind: str) -> Column:
    """Average rebuilt from a sum and a count.

    ``avg`` of a two-digit decimal keeps six digits before any later rounding.
    With 32 integer digits in the dividend the quotient has exactly six as
    well, so an average over pre-aggregated rows equals one over the raw rows.
    """
    return F.try_divide(amount_total.cast("decimal(34,2)"), amount_count.cast(COUNT)).try_cast(kind)


def mean(amount: Column, kind: str) -> Column:
    """Average of a money column."""
    return F.avg(amount).try_cast(kind)


def count_mean(number: Column, digits: int) -> Column:
    """Average of whole numbers rounded half up, given back as a double."""
    return count_ratio(F.sum(number), F.count(number), f"decimal(24,{digits})").cast("double")


def money_mean(amount: Column, digits: int = 2) -> Column:
    """Average of a decimal column in one rounding step, for reports."""
    quotient = F.try_divide(F.sum(amount).cast("decimal(26,2)"), F.count(amount).cast(COUNT))
    return quotient.try_cast(f"decimal(24,{digits})").cast("double")
