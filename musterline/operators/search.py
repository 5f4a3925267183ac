"""Lookups and searches over the roster."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from musterline.functions.numbers import is_high
from musterline.model import SNAKE, RosterColumns
from musterline.operators.small_side import rows_with_keys

# ASCII letters only: the search folds no other letters.
_FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def fold_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def folded_pattern(query: str) -> str:
    """The query as it is compared with folded names."""
    return query.translate(_FOLD)


def name_contains(name: Column, query: str) -> Column:
    """Case-insensitive containment; ``%`` and ``_`` in the query are wildcards, ``\\`` is not."""
    pattern = folded_pattern(query).replace("\\", "\\\\")
    return fold_ascii(name).like(f"%{pattern}%")


def find_by_key(df: DataFrame, key: int, columns: RosterColumns = SNAKE) -> DataFrame:
    """At most one row. The predicate is pushed to the scan."""
    return df.where(F.col(columns.id) == F.lit(key))


def find_by_keys(
    df: DataFrame, keys: DataFrame | Iterable[int], columns: RosterColumns = SNAKE
) -> DataFrame:
    """Rows whose key is among ``keys``: a list of literals, or a frame with the key column."""
    if not isinstance(keys, DataFrame):
        return df.where(F.col(columns.id).isin(list(keys)))
    return rows_with_keys(df, keys, columns.id)


def scan_ordered(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    return df.orderBy(columns.id)


def search(
    df: DataFrame,
    query: str | None = None,
    department: str | None = None,
    min_salary: float | None = None,
    max_salary: float | None = None,
    columns: RosterColumns = SNAKE,
    ordered: bool = True,
) -> DataFrame:
    """Rows that satisfy every given condition, by key.

    An empty ``query`` or ``department`` is no condition; a salary bound of 0 is one.
    """
    c = columns
    conditions: list[Column] = []
    if query:
        conditions.append(name_contains(F.col(c.name), query))
    if department:
        conditions.append(F.col(c.department) == F.lit(department))
    if min_salary is not None:
        conditions.append(F.col(c.salary) >= F.lit(float(min_salary)))
    if max_salary is not None:
        conditions.append(F.col(c.salary) <= F.lit(float(max_salary)))
    for condition in conditions:
        df = df.where(condition)
    return df.orderBy(c.id) if ordered else df


def flag_high_performers(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    return df.withColumn("is_high_performer", F.coalesce(is_high(F.col(columns.score)), F.lit(False)))
