"""Joins with a side that is small only if a check says so."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

SMALL_ROWS = 100_000
SMALL_BYTES = 64 << 20


def fits_in_bytes(df: DataFrame, max_rows: int, max_bytes: int = SMALL_BYTES) -> bool:
    """Whether ``df`` has at most so many rows and bytes of values. Runs ``df`` once; one row of
    sums reaches the driver."""
    width = reduce(
        lambda a, b: a + b,
        [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) for name in df.columns],
    )
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width + 16 * len(df.columns))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def collect_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """``df`` as literal rows when it has at most ``max_rows``, else None.

    Runs ``df`` once and never moves more than ``max_rows + 1`` rows to the driver. As a literal
    relation the result is not computed again by the plans that use it, and its size is known.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def join_statistics(
    df: DataFrame, statistics: DataFrame, on: str | list[str], max_rows: int = SMALL_ROWS
) -> DataFrame:
    """Left join per-group statistics to the rows they describe, treating null groups as equal.

    Statistics within the checked size are broadcast, so ``df`` is not shuffled on its (possibly
    very uneven) groups. Larger ones are joined by shuffle, where adaptive execution splits
    oversized partitions.
    """
    keys = [on] if isinstance(on, str) else list(on)
    small = collect_if_small(statistics, max_rows)
    right = F.broadcast(small) if small is not None else statistics
    return null_safe_join(df, right, keys, "left")


def null_safe_join(df: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join in which null keys equal each other; the keys of ``df`` remain."""
    renamed = right.withColumnsRenamed({key: f"__right_{key}" for key in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"__right_{key}")) for key in keys]
    )
    return df.join(renamed, condition, how).drop(*[f"__right_{key}" for key in keys])


def rows_with_keys(
    df: DataFrame, keys: DataFrame, key: str, max_rows: int = SMALL_ROWS
) -> DataFrame:
    """The rows of ``df`` whose key is among ``keys``.

    Few distinct keys (checked by a job at call time) are broadcast, so a large ``df`` is only
    scanned; many are matched by a shuffle join.
    """
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    small = collect_if_small(wanted, max_rows)
    return df.join(F.broadcast(small) if small is not None else wanted, key, "left_semi")
