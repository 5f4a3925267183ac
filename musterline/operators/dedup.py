"""Keep-first duplicates, by an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from musterline.operators.small_side import collect_if_small

# A repeated key is sent to every task with its lowest order: some 16 bytes.
SMALL_KEYS = 500_000


def _firsts(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("__key")).agg(
        F.min(order).alias("__first"), F.count(F.lit(1)).alias("__rows")
    )


def repeated_keys(
    df: DataFrame, key: str, order: str, max_rows: int = SMALL_KEYS
) -> DataFrame | None:
    """Keys with more than one row and their lowest order, as literals; None if they are many."""
    repeated = _firsts(df, key, order).where("__rows > 1").drop("__rows")
    return collect_if_small(repeated, max_rows)


def _flag_later(
    df: DataFrame, key: str, order: str, flag: str, repeated: DataFrame | None
) -> DataFrame:
    same_key = F.col(key).eqNullSafe(F.col("__key"))
    if repeated is not None:
        joined = df.join(F.broadcast(repeated), same_key, "left")
        later = F.coalesce(
            F.col(order) > F.col("__first"), F.col(order).isNull() & F.col("__first").isNotNull()
        )
    else:
        # No hint: a sort-merge join spills, and adaptive execution hashes what it finds small.
        firsts = _firsts(df, key, order).drop("__rows").withColumn("__is_first", F.lit(True))
        joined = df.join(firsts, same_key & F.col(order).eqNullSafe(F.col("__first")), "left")
        later = F.col("__is_first").isNull()
    return joined.withColumn(flag, later).drop("__key", "__first", "__is_first")


def mark_duplicates(
    df: DataFrame,
    key: str,
    order: str,
    flag: str = "is_duplicate",
    max_rows: int = SMALL_KEYS,
) -> DataFrame:
    """Add ``flag``: true for every row of a key but the one with the lowest ``order``.

    Null keys count as one key. A null ``order`` comes after all others. Rows that tie for the first
    place are all unmarked, so ``order`` should be unique within a key. A window over the key would
    bring all rows of a key into one task; instead the lowest order per key is found by
    aggregation. When few keys repeat (checked by a job at call time) they are broadcast and the
    rows stay where they are. Otherwise rows meet their key's lowest order on (key, order), which
    spreads the rows of any key evenly.
    """
    return _flag_later(df, key, order, flag, repeated_keys(df, key, order, max_rows))


def keep_first_given(
    df: DataFrame, key: str, order: str, repeated: DataFrame | None
) -> DataFrame:
    """:func:`keep_first` with the result of :func:`repeated_keys` at hand."""
    flagged = _flag_later(df, key, order, "__later", repeated)
    return flagged.where(~F.col("__later")).drop("__later")


def keep_first(df: DataFrame, key: str, order: str, max_rows: int = SMALL_KEYS) -> DataFrame:
    """The row with the lowest ``order`` of every key, found like :func:`mark_duplicates`."""
    return keep_first_given(df, key, order, repeated_keys(df, key, order, max_rows))


def first_values(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Per key, ``value`` in the row with the lowest ``order``: one narrow aggregation."""
    return df.groupBy(key).agg(F.min_by(value, order).alias(value))


def one_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The first row of every key by ``order``, exactly one even if ``order`` ties.

    The row-number filter lets Spark limit each key to one row per map task before the shuffle,
    so a key that holds a large share of all rows costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")
