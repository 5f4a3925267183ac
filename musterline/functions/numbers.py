"""Exact sums, rounding and pay arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from musterline.fixed_values import BONUS_RATE, HIGH_SCORE, MONTHS_PER_YEAR, TAX_RATE


def money(amount: Column) -> Column:
    """Amount as an exact decimal: sums no longer depend on row order or partitioning.

    Four digits hold the half cent that a median of two amounts can have, and keep the decimal
    within one machine word. Its sum has 28 digits, enough for 10^12 rows of any legal salary.
    An amount of 10^14 or more is unusable: null, so it takes no part in sums and means.
    """
    return amount.try_cast("decimal(18,4)")


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round through a decimal, so that 1.005 becomes 1.01 on every engine; beyond 10^20 there is nothing to round."""
    return F.coalesce(F.round(value.try_cast("decimal(28,8)"), digits).cast("double"), value.cast("double"))


def rounded_sum(amount: Column) -> Column:
    return F.round(F.sum(money(amount)), 2).cast("double")


def exact_mean(amount: Column) -> Column:
    total = F.sum(money(amount)).cast("double")
    return F.try_divide(total, F.count(money(amount)))


def rounded_mean(amount: Column) -> Column:
    return round_half_up(exact_mean(amount))


def integer_mean(value: Column) -> Column:
    return F.try_divide(F.sum(value.cast("bigint")).cast("double"), F.count(value))


def is_high(score: Column) -> Column:
    return score >= F.lit(HIGH_SCORE)


def annual_salary(salary: Column) -> Column:
    return salary * F.lit(float(MONTHS_PER_YEAR))


def annual_bonus(salary: Column) -> Column:
    return annual_salary(salary) * F.lit(BONUS_RATE)


def annual_tax(salary: Column) -> Column:
    return annual_salary(salary) * F.lit(TAX_RATE)


def net_salary(salary: Column) -> Column:
    return annual_salary(salary) + annual_bonus(salary) - annual_tax(salary)


def thousands(value: Column) -> Column:
    """Two decimals with thousands separators."""
    return F.format_number(value, 2)


def short_thousands(value: Column) -> Column:
    """Thousands separators and as few decimals as the value needs, but one at least."""
    return F.regexp_replace(F.format_number(value, 2), "0$", "")
