"""Rows of the published reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from musterline.fixed_values import KPI_REPORT_ROWS
from musterline.functions.numbers import (
    annual_bonus,
    annual_salary,
    annual_tax,
    is_high,
    net_salary,
    short_thousands,
    thousands,
)
from musterline.model import SNAKE, RosterColumns


def with_compensation(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """Add annual salary, bonus, tax and net pay."""
    salary = F.col(columns.salary)
    return df.withColumns(
        {
            "annual_salary": annual_salary(salary),
            "annual_bonus": annual_bonus(salary),
            "annual_tax": annual_tax(salary),
            "net_salary": net_salary(salary),
        }
    )


def directory_export(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """The eleven directory columns by key."""
    c = columns
    paid = with_compensation(df, c)
    return paid.select(
        *c.base, "annual_salary", "annual_bonus", "annual_tax", "net_salary"
    ).orderBy(c.id)


def csv_rows(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """All fields as the text of the roster file, salary with two decimals."""
    c = columns
    return df.select(
        F.col(c.id).cast("string").alias(c.id),
        c.name,
        c.department,
        c.designation,
        F.format_string("%.2f", F.col(c.salary)).alias(c.salary),
        F.col(c.joining_date).cast("string").alias(c.joining_date),
        F.col(c.score).cast("string").alias(c.score),
    )


def directory_view(df: DataFrame, columns: RosterColumns = SNAKE, currency: str = "₹") -> DataFrame:
    """The six dashboard columns and the badge class of high performers, by key."""
    c = columns
    high = F.coalesce(is_high(F.col(c.score)), F.lit(False))
    return df.select(
        c.id,
        c.name,
        c.department,
        c.designation,
        F.concat(F.lit(currency), thousands(F.col(c.salary))).alias("monthly_salary"),
        F.col(c.score).alias("rating"),
        F.when(high, F.lit("score-high")).otherwise(F.lit("")).alias("badge"),
    ).orderBy(c.id)


def kpi_report(kpi_row: DataFrame) -> DataFrame:
    """Ten (position, metric, value, description) rows from the one KPI row."""
    whole = {"Headcount", "HighPerformersCount"}

    def text(column: str, before: str) -> Column:
        if column in whole:
            return F.col(column).cast("string")
        shown = short_thousands(F.col(column))
        return shown if before else F.replace(shown, F.lit(","), F.lit(""))

    rows = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(metric).alias("metric"),
            F.concat(F.lit(before), text(column, before), F.lit(after)).alias("value"),
            F.lit(description).alias("description"),
        )
        for position, (column, metric, before, after, description) in enumerate(KPI_REPORT_ROWS, 1)
    ]
    return kpi_row.select(F.inline(F.array(*rows)))


def department_report(summary: DataFrame, currency: str = "₹") -> DataFrame:
    """The department summary with pay as text."""

    def pay(name: str) -> Column:
        return F.concat(F.lit(currency), short_thousands(F.col(name))).alias(name)

    return summary.select(
        "Department", "Headcount", pay("AverageSalary"), pay("MaxSalary"), pay("TotalSalary")
    )


def top_earner_report(top: DataFrame, currency: str = "₹") -> DataFrame:
    """The best paid rows with pay as text."""
    return top.select(
        F.col("EmployeeID").alias("ID"),
        "Name",
        "Department",
        F.concat(F.lit(currency), short_thousands(F.col("Salary"))).alias("MonthlySalary"),
    )
