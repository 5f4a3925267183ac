"""Keyed changes: a table frame and a change frame in, the changed table out.

Keys of the table are unique. Every join below is on the key, so no key is hot on the table side;
the change side is reduced to one row per key first. Few changes are broadcast after a check of
their number, and the table is scanned without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from musterline.errors import DuplicateKeyError, MissingKeyError
from musterline.model import SNAKE, RosterColumns
from musterline.operators.contracts import (
    DUPLICATE,
    REASONS,
    TABLE,
    Contract,
    annotate,
    assert_contract,
    present_codes,
)
from musterline.operators.dedup import mark_duplicates, one_per_key
from musterline.operators.small_side import (
    collect_if_small,
    fits_in_bytes,
    join_statistics,
    rows_with_keys,
)
from musterline.session import written

# Whole changed rows, not only keys, are sent to every task: fewer of them count as few.
SMALL_CHANGES = 10_000
PRESENT = "present"


def _shown(frame: DataFrame, key: str) -> str:
    """Some keys for an error message, or '' when there are none."""
    return ", ".join(str(row[0]) for row in frame.select(key).limit(20).collect())


def _held_keys(table: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The keys of ``batch`` that the table holds, once each: a scan of the table's key column."""
    return rows_with_keys(table.select(key), batch, key)


def batch_conflicts(table: DataFrame, batch: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """Keys that keep ``batch`` from being inserted: (key, rows_in_batch, in_table)."""
    key = columns.id
    incoming = batch.groupBy(key).agg(F.count(F.lit(1)).alias("rows_in_batch"))
    held = _held_keys(table, batch, key).withColumn("__in_table", F.lit(True))
    return (
        incoming.join(held, key, "left")
        .select(key, "rows_in_batch", F.coalesce("__in_table", F.lit(False)).alias("in_table"))
        .where((F.col("rows_in_batch") > 1) | F.col("in_table"))
    )


def insert_batch(
    table: DataFrame,
    batch: DataFrame,
    columns: RosterColumns = SNAKE,
    contract: Contract | None = None,
) -> DataFrame:
    """All rows of ``batch`` added, or DuplicateKeyError and nothing added.

    With a ``contract``, rows that break it are a ContractError. The batch is stored first: what is
    checked is what is added.
    """
    batch = written(batch)
    if contract is not None:
        assert_contract(batch, contract.using(columns=columns))
    shown = _shown(batch_conflicts(table, batch, columns), columns.id)
    if shown:
        raise DuplicateKeyError(f"keys repeated or already present: {shown}")
    return table.unionByName(batch)


def new_rows(
    table: DataFrame, batch: DataFrame, columns: RosterColumns = SNAKE, order: str | None = None
) -> DataFrame:
    """The rows of ``batch`` that :func:`insert_batch` would accept one by one.

    Of a repeated key the first row by ``order`` goes in (without it, by a hash of the row); a row
    without a key never does.
    """
    batch = batch.where(F.col(columns.id).isNotNull())
    first = F.col(order) if order else F.xxhash64(*batch.columns)
    batch = one_per_key(batch, columns.id, first).select(*batch.columns)
    return batch.join(_held_keys(table, batch, columns.id), columns.id, "left_anti")


def checked_offers(
    table: DataFrame,
    batch: DataFrame,
    order: str,
    columns: RosterColumns = SNAKE,
    contract: Contract = TABLE,
) -> DataFrame:
    """``batch`` with the ``reasons`` why inserts one by one would refuse a row; empty if accepted.

    The codes of the ``contract`` come first. Among legal rows, later ones of a key (by ``order``,
    unique within a key) get ``duplicate``, and those whose key the table holds get ``present``.
    An illegal row does not use up its key.
    """
    key = columns.id
    checked = annotate(batch, contract.using(columns=columns, quarantine_duplicates=False))
    # Illegal rows take part as rows without a key, and those are not compared.
    legal_key = F.when(F.size(REASONS) == 0, F.col(key))
    checked = mark_duplicates(checked.withColumn("__legal", legal_key), "__legal", order, "__later")
    held = _held_keys(table, batch, key).withColumnRenamed(key, "__legal")
    checked = join_statistics(checked, held.withColumn("__held", F.lit(True)), "__legal")
    legal = F.col("__legal").isNotNull()
    found = present_codes(
        [
            F.when(legal & F.col("__later"), F.lit(DUPLICATE)),
            F.when(legal & F.col("__held"), F.lit(PRESENT)),
        ]
    )
    return checked.withColumn(REASONS, F.concat(F.col(REASONS), found)).drop(
        "__legal", "__later", "__held"
    )


def missing_keys(table: DataFrame, changes: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """Keys addressed by ``changes`` that the table does not hold, once each."""
    key = columns.id
    return changes.select(key).distinct().join(_held_keys(table, changes, key), key, "left_anti")


def apply_updates(
    table: DataFrame, changes: DataFrame, columns: RosterColumns = SNAKE, order: str | None = None
) -> DataFrame:
    """Replace all non-key fields of the rows that ``changes`` addresses; ignore other changes.

    Changes hold each key once, unless ``order`` names the column that says which one is last.
    """
    key = columns.id
    if order is not None:
        changes = one_per_key(changes, key, F.col(order).desc())
    fields = [name for name in table.columns if name != key]
    renamed = changes.select(
        F.col(key).alias("__key"),
        F.lit(True).alias("__changed"),
        *[F.col(name).alias(f"__new_{name}") for name in fields if name in changes.columns],
    )
    few = fits_in_bytes(renamed, SMALL_CHANGES)
    joined = table.join(F.broadcast(renamed) if few else renamed, F.col(key) == F.col("__key"), "left")

    def merged(name: str):
        if name == key or name not in changes.columns:
            return F.col(name)
        return F.when(F.col("__changed"), F.col(f"__new_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(*[merged(name) for name in table.columns])


def update_rows(
    table: DataFrame,
    changes: DataFrame,
    columns: RosterColumns = SNAKE,
    order: str | None = None,
    contract: Contract | None = None,
) -> DataFrame:
    """:func:`apply_updates`, or MissingKeyError if a change addresses no row.

    With a ``contract``, changes that break it are a ContractError. The changes are stored first: what
    is checked is what is applied.
    """
    changes = written(changes)
    if contract is not None:
        assert_contract(changes, contract.using(columns=columns))
    shown = _shown(missing_keys(table, changes, columns), columns.id)
    if shown:
        raise MissingKeyError(f"keys not in the table: {shown}")
    if order is None:
        repeated = changes.groupBy(columns.id).count().where("count > 1")
        shown = _shown(repeated, columns.id)
        if shown:
            raise DuplicateKeyError(f"keys changed more than once: {shown}")
    return apply_updates(table, changes, columns, order)


def apply_deletes(table: DataFrame, keys: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """The table without the rows addressed by ``keys``; other keys are ignored."""
    gone = keys.select(columns.id).distinct()
    small = collect_if_small(gone)
    return table.join(F.broadcast(small) if small is not None else gone, columns.id, "left_anti")


def delete_rows(table: DataFrame, keys: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """:func:`apply_deletes`, or MissingKeyError if a key addresses no row."""
    keys = written(keys.select(columns.id))
    shown = _shown(missing_keys(table, keys, columns), columns.id)
    if shown:
        raise MissingKeyError(f"keys not in the table: {shown}")
    return apply_deletes(table, keys, columns)


def merge_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all sources, matched by column name."""
    for other in others:
        first = first.unionByName(other.select(*first.columns))
    return first
