"""Headcount, pay, performance and tenure metrics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from musterline.functions.numbers import (
    integer_mean,
    is_high,
    money,
    round_half_up,
    rounded_mean,
    rounded_sum,
)
from musterline.functions.text import finite
from musterline.model import SNAKE, RosterColumns
from musterline.operators.quantiles import approximate_quantiles, exact_quantiles

TOTAL_LABEL = "Grand Total"


def top_earners(df: DataFrame, n: int = 5, columns: RosterColumns = SNAKE) -> DataFrame:
    """The ``n`` best paid rows; equal salaries keep input order."""
    c = columns
    return (
        df.orderBy(F.col(c.salary).desc_nulls_last(), F.col(c.ordinal))
        .limit(n)
        .select(
            F.col(c.id).alias("EmployeeID"),
            F.col(c.name).alias("Name"),
            F.col(c.salary).alias("Salary"),
            F.col(c.department).alias("Department"),
        )
    )


def kpis(
    df: DataFrame, columns: RosterColumns = SNAKE, median_rank_error: float | None = None
) -> DataFrame:
    """One row with the ten scalar indicators.

    The median is exact, in two or more scans, unless ``median_rank_error`` allows it to be a value whose
    rank is off by that share of the rows; then all indicators come from one scan.
    """
    c = columns
    salary, score = F.col(c.salary), F.col(c.score)
    high = F.count_if(is_high(score))
    headcount = F.count(F.lit(1))
    scalars = df.agg(
        headcount.alias("Headcount"),
        F.coalesce(rounded_sum(salary), F.lit(0.0)).alias("TotalSalaryExpense"),
        rounded_mean(salary).alias("AverageSalary"),
        round_half_up(F.max(salary)).alias("MaxSalary"),
        round_half_up(F.min(salary)).alias("MinSalary"),
        round_half_up(integer_mean(score)).alias("AveragePerformanceScore"),
        round_half_up(F.avg(c.tenure)).alias("AverageTenureYears"),
        high.alias("HighPerformersCount"),
        F.coalesce(
            round_half_up(F.try_divide(high.cast("double"), headcount) * 100), F.lit(0.0)
        ).alias("HighPerformersRatio"),
    )
    if median_rank_error is None:
        found = exact_quantiles(df, c.salary, [0.5], names=["median"])
    else:
        found = approximate_quantiles(df, c.salary, [0.5], names=["median"], rank_error=median_rank_error)
    median = found.select("median").scalar()
    return scalars.withColumn("MedianSalary", round_half_up(median)).select(
        "Headcount",
        "TotalSalaryExpense",
        "AverageSalary",
        "MedianSalary",
        "MaxSalary",
        "MinSalary",
        "AveragePerformanceScore",
        "AverageTenureYears",
        "HighPerformersCount",
        "HighPerformersRatio",
    )


def kpis_with_top_earners(df: DataFrame, n: int = 5, columns: RosterColumns = SNAKE) -> DataFrame:
    """:func:`kpis` with the best paid rows as an array of structs, best first."""
    top = top_earners(df, n, columns)
    # n rows: the array cannot grow beyond the report's length.
    as_array = top.agg(
        F.array_sort(
            F.collect_list(F.struct("EmployeeID", "Name", "Salary", "Department")),
            lambda a, b: F.when(a["Salary"] > b["Salary"], -1)
            .when(a["Salary"] < b["Salary"], 1)
            .when(a["EmployeeID"] < b["EmployeeID"], -1)
            .otherwise(1),
        ).alias("top")
    )
    return kpis(df, columns).withColumn("Top5Earners", as_array.scalar())


def department_summary(df: DataFrame, columns: RosterColumns = SNAKE, ordered: bool = True) -> DataFrame:
    """Headcount and pay per department, largest first; a null department is a group."""
    c = columns
    summary = df.groupBy(F.col(c.department).alias("Department")).agg(
        F.count(F.lit(1)).alias("Headcount"),
        rounded_sum(F.col(c.salary)).alias("TotalSalary"),
        rounded_mean(F.col(c.salary)).alias("AverageSalary"),
        round_half_up(F.max(c.salary)).alias("MaxSalary"),
    )
    return summary.orderBy(F.desc("Headcount"), "Department") if ordered else summary


def department_summary_with_total(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """The summary and a total row whose average is the plain mean of the department averages."""
    summary = department_summary(df, columns, ordered=False)
    total = summary.agg(
        F.lit(TOTAL_LABEL).alias("Department"),
        F.sum("Headcount").alias("Headcount"),
        rounded_sum(F.col("TotalSalary")).alias("TotalSalary"),
        rounded_mean(F.col("AverageSalary")).alias("AverageSalary"),
        F.max("MaxSalary").alias("MaxSalary"),
    )
    return (
        summary.withColumn("__last", F.lit(0))
        .unionByName(total.withColumn("__last", F.lit(1)))
        .orderBy("__last", F.desc("Headcount"), "Department")
        .drop("__last")
    )


def count_by(df: DataFrame, group: str) -> DataFrame:
    """Rows per group, most frequent first; null groups are left out."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("headcount"))
        .orderBy(F.desc("headcount"), group)
    )


def sum_by(df: DataFrame, group: str, value: str, name: str = "total") -> DataFrame:
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.coalesce(rounded_sum(F.col(value)), F.lit(0.0)).alias(name))
        .orderBy(group)
    )


def mean_by(
    df: DataFrame, group: str, value: str, name: str = "average", descending: bool | None = None
) -> DataFrame:
    """Mean per non-null group, by group or (``descending`` given) by mean."""
    means = (
        df.where(F.col(group).isNotNull()).groupBy(group).agg(rounded_mean(F.col(value)).alias(name))
    )
    if descending is None:
        return means.orderBy(group)
    return means.orderBy(F.col(name).desc() if descending else F.col(name).asc(), group)


def score_distribution(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """Rows per score with their share in percent, by score."""
    counts = (
        df.where(F.col(columns.score).isNotNull())
        .groupBy(columns.score)
        .agg(F.count(F.lit(1)).alias("headcount"))
    )
    total = counts.agg(F.sum("headcount")).scalar()
    share = F.try_divide(F.col("headcount") * F.lit(100.0), total)
    return counts.withColumn("share_percent", round_half_up(share, 1)).orderBy(columns.score)


def high_performers_by(df: DataFrame, group: str, columns: RosterColumns = SNAKE) -> DataFrame:
    """Core and high performers per non-null group, zero where there are none."""
    high = F.coalesce(is_high(F.col(columns.score)), F.lit(False))
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count_if(~high).alias("core_performers"), F.count_if(high).alias("high_performers"))
        .orderBy(group)
    )


def correlation_matrix(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair, as rows (x, y, r), from one aggregation.

    A pair uses the rows in which both values are present. A constant column has no correlation:
    r is null.
    """
    values = {name: finite(F.col(name).cast("double")) for name in names}
    prepared = df.select(*[value.alias(name) for name, value in values.items()])

    def correlation(x: str, y: str) -> Column:
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
        return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))

    pairs = [(x, y) for i, x in enumerate(names) for y in names[i:]]
    wide = prepared.agg(*[correlation(x, y).alias(f"{x}|{y}") for x, y in pairs])

    def cell(x: str, y: str) -> Column:
        column = f"{x}|{y}" if (x, y) in pairs else f"{y}|{x}"
        return F.struct(
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
            round_half_up(F.col(f"`{column}`"), digits).alias("r"),
        )

    return wide.select(F.inline(F.array(*[cell(x, y) for x, y in product(names, names)])))


def distinct_groups(df: DataFrame, group: str) -> DataFrame:
    return df.select(group).distinct()


def first_seen_groups(df: DataFrame, group: str, order: str) -> DataFrame:
    """Distinct groups in the order in which they first appear."""
    return df.groupBy(group).agg(F.min(order).alias("first_seen")).orderBy("first_seen")


def dashboard_tiles(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """The four tiles as one row, zeros when there is no data."""
    c = columns
    headcount = F.count(F.lit(1))
    high = F.count_if(is_high(F.col(c.score))).cast("double")

    def or_zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0.0))

    return df.agg(
        headcount.alias("active_headcount"),
        or_zero(rounded_mean(F.col(c.salary))).alias("average_monthly_salary"),
        or_zero(F.round(F.sum(money(F.col(c.salary))), 2).cast("double")).alias("total_monthly_expense"),
        or_zero(round_half_up(F.try_divide(high, headcount) * 100)).alias("high_performers_percent"),
    )
