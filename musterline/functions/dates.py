"""Tenure in whole days and in years."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from musterline.fixed_values import AS_OF_DEFAULT, DAYS_PER_YEAR


def as_of_date(as_of: str | dt.date | None) -> Column:
    return F.lit(as_of or AS_OF_DEFAULT).cast("date")


def tenure_days(df: DataFrame, since: str, as_of: str | dt.date | None = None) -> Column:
    """Whole days elapsed from ``since`` to midnight of ``as_of``, rounded down.

    A time of day after midnight makes the last day incomplete. The comparison stays within one
    type, so the session time zone plays no part for timestamps without a zone.
    """
    column = F.col(since)
    kind = df.schema[since].dataType
    days = F.date_diff(as_of_date(as_of), column.cast("date"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        midnight = column.cast("date").cast(kind)
        days = days - (column > midnight).cast("int")
    return days


def tenure_years(df: DataFrame, since: str, as_of: str | dt.date | None = None) -> Column:
    return tenure_days(df, since, as_of) / F.lit(DAYS_PER_YEAR)
