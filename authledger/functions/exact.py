"""Exact money and rate arithmetic on double columns.

Sums of doubles depend on the order Spark adds them in, so a rounded mean can
change between two runs. Here amounts are added as decimals and rates as whole
numbers, divided as decimals and rounded half up once. Stored columns are doubles
again.

Raw amounts are rounded to four digits after the point before they are added. A
number that does not fit (an infinity, a NaN, 22 digits before the point of a raw
amount, a sum beyond its column) fails the query, in ANSI mode or not: nothing is left
out or wraps silently. The typed tables keep such numbers out and list them.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Widths that keep at least 14 digits after the point in a Spark decimal division.
AMOUNT = "decimal(26,4)"
SUM = "decimal(28,4)"
COUNT = "decimal(20,0)"
WHOLE = "decimal(20,0)"


def checked(value: Column, made: Column, what: str) -> Column:
    """``made`` from ``value``; fails where it has come out as NULL for a value that is there."""
    kind = F.lit(f"{what} out of range: ")
    return F.when(value.isNotNull(), F.coalesce(made, F.raise_error(F.concat(kind, value.cast("string")))))


def _whole(value: Column, units: int, what: str) -> Column:
    scaled = value * units
    fits = F.when(F.abs(scaled) < 9e18, F.rint(scaled).cast("bigint"))
    return checked(value, fits, what)


def cents(money: Column) -> Column:
    """Money rounded to two digits, as a whole number of cents."""
    return _whole(money, 100, "amount")


def points(rate: Column) -> Column:
    """A rate rounded to four digits, as a whole number of 1/10000."""
    return _whole(rate, 10000, "rate")


def whole_sum(value: Column) -> Column:
    """Sum of a whole number column as a decimal; without ANSI mode a plain one would wrap.

    The low 20 bits, which cannot wrap, and the rest are added up apart, which keeps the
    fast hash aggregate; a sum of doubles beside them tells whether the rest has wrapped.
    """
    high, low = F.shiftright(value, 20), value.bitwiseAND(F.lit((1 << 20) - 1))
    fits = F.abs(F.sum(high.cast("double"))) < 9e18
    total = F.sum(high).cast(WHOLE) * F.lit(Decimal(1 << 20)).cast("decimal(7,0)") + F.sum(low).cast(WHOLE)
    return F.when(fits, total).when(~fits, F.raise_error(F.lit("sum out of range")))


def half_up(value: Column, step: int) -> Column:
    """Whole number / even step, rounded to the nearest whole number, ties away from 0."""
    up = F.call_function("div", F.abs(value) + F.lit(step // 2), F.lit(step))
    return F.when(value < 0, -up).otherwise(up)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Decimal quotient rounded half up once; NULL when the denominator is 0 or NULL."""
    return F.round(F.try_divide(numerator, denominator), digits)


def double(col: Column) -> Column:
    return col.cast("double")


def _scaled(total: Column, unit: str) -> Column:
    return checked(total, (total.try_cast("decimal(28,0)") * F.lit(Decimal(unit))).try_cast(SUM), "sum")


def count_of(n: Column) -> Column:
    return n.cast(COUNT)


# --- aggregates -------------------------------------------------------------


def mean_amount(amount: Column, digits: int) -> Column:
    """Mean of a raw amount column; NULLs are left out."""
    exact = checked(amount, amount.try_cast(AMOUNT), "amount")
    total = F.when(F.count(amount) > 0, F.coalesce(F.sum(exact).try_cast(SUM), F.raise_error(F.lit("sum out of range"))))
    return ratio(total, count_of(F.count(amount)), digits)


def total_cents(money: Column) -> Column:
    """Sum of a cents column as decimal dollars."""
    return _scaled(whole_sum(cents(money)), "0.01")


def mean_cents(money: Column, digits: int) -> Column:
    return ratio(total_cents(money), count_of(F.count(money)), digits)


def total_rate(rate: Column) -> Column:
    return _scaled(F.sum(points(rate)), "0.0001")


def mean_rate(rate: Column, digits: int) -> Column:
    return ratio(total_rate(rate), count_of(F.count(rate)), digits)


def complement_of_mean_rate(rate: Column, digits: int) -> Column:
    """1 - mean of a rate column."""
    n = count_of(F.count(rate))
    return ratio((n - total_rate(rate)).cast(SUM), n, digits)
