"""Cleaning: keep-first, coercion, imputation, tenure — in that order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F, types as T

from musterline.fixed_values import DATE_DEFAULT, SCORE_DEFAULT
from musterline.functions.dates import tenure_years
from musterline.functions.text import finite, parse_date, parse_number
from musterline.model import SNAKE, RosterColumns
from musterline.operators.dedup import (
    SMALL_KEYS,
    first_values,
    keep_first_given,
    repeated_keys,
)
from musterline.operators.quantiles import exact_quantiles


def coerce_numeric(df: DataFrame, *names: str) -> DataFrame:
    """Numbers as double; text that is not a plain number, NaN and infinities become null."""

    def number(name: str):
        if isinstance(df.schema[name].dataType, T.StringType):
            return finite(parse_number(F.col(name), digit_groups=False))
        return finite(F.col(name).cast("double"))

    return df.withColumns({name: number(name) for name in names})


def coerce_date(df: DataFrame, name: str, default: str | dt.date | None = DATE_DEFAULT) -> DataFrame:
    """Dates from text; what is not a real date becomes ``default`` (None keeps the null)."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        column = parse_date(column)
    if default is not None:
        kind = "date" if isinstance(df.schema[name].dataType, T.StringType) else df.schema[name].dataType
        column = F.coalesce(column, F.lit(default).cast("date").cast(kind))
    return df.withColumn(name, column)


def impute_median(df: DataFrame, name: str, measured: DataFrame | None = None) -> DataFrame:
    """Replace nulls by the exact median of the column over all rows.

    The median reaches the rows as a scalar subquery, so no join takes part. ``measured`` may hold
    the same values in a frame that is cheaper to scan.
    """
    source = df if measured is None else measured
    median = exact_quantiles(source, name, [0.5], names=["median"]).select("median").scalar()
    return df.withColumn(name, F.coalesce(F.col(name), median))


def impute_constant(df: DataFrame, name: str, value: float = SCORE_DEFAULT) -> DataFrame:
    """Replace nulls, and numbers beyond the range of an int, by a constant; truncate the others."""
    whole = F.lit(value).cast("int")
    return df.withColumn(name, F.coalesce(F.col(name).try_cast("int"), whole))


def clean_roster(
    df: DataFrame,
    columns: RosterColumns = SNAKE,
    as_of: str | dt.date | None = None,
    max_rows: int = SMALL_KEYS,
) -> DataFrame:
    """The cleaned roster with tenure. The imputed median is that of the rows kept.

    ``df`` is scanned four times, three of them for two or three narrow columns: pass a stored
    frame rather than an expensive plan.
    """
    c = columns
    repeated = repeated_keys(df, c.id, c.ordinal, max_rows)
    typed = coerce_numeric(df, c.salary, c.score)
    kept = keep_first_given(typed, c.id, c.ordinal, repeated)
    # With many repeated keys the rows are kept by a join; their salaries alone need only an
    # aggregation.
    measured = kept if repeated is not None else first_values(typed, c.id, c.ordinal, c.salary)
    filled = impute_constant(impute_median(kept, c.salary, measured), c.score)
    dated = coerce_date(filled, c.joining_date)
    return dated.withColumn(c.tenure, tenure_years(dated, c.joining_date, as_of))
