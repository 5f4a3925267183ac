"""A keyed table as immutable files and a manifest per version.

The manifest names each data file with its rows and its key range. A change finds the files that hold
an addressed key, writes those anew and enters a manifest in which they are replaced; all other files
stay as they are and belong to both versions. Lookups choose files by key range before anything is
opened. A change is entered only if no other version came in between (PublishConflictError), so no
update is lost. The driver holds one manifest row per data file, as Spark's own file listing does.

Below the table's folder: ``files`` (a folder per write), ``manifests`` and ``schemas`` (one per
version), ``checked`` (which files keep which contract), and the ledger of published versions.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from musterline.errors import ContractError, DuplicateKeyError, MissingKeyError
from musterline.model import ROSTER_SCHEMA, SNAKE, RosterColumns
from musterline.operators.changes import apply_deletes, apply_updates, batch_conflicts
from musterline.operators.contracts import Contract, annotate, assert_contract, split
from musterline.operators.small_side import rows_with_keys
from musterline.session import written
from musterline.sources.folders import children, claim, read_mark
from musterline.sources.snapshots import _enter, _last, duplicate_keys

#: With more keys than these, every file counts as one that may hold some.
CHOSEN_KEYS = 100_000
_MANIFEST = "file string, rows bigint, low bigint, high bigint"
_FILE = "__file"


def file_place() -> Column:
    """Of a row read from data files, the file's name as manifests have it."""
    return F.concat_ws("/", F.element_at(F.split("_metadata.file_path", "/"), -2), F.col("_metadata.file_name"))


@dataclass(frozen=True)
class DataFile:
    """A data file below ``files``, its rows, and its lowest and highest key."""

    file: str
    rows: int
    low: int | None
    high: int | None


@dataclass(frozen=True)
class FileTable:
    """A version of a table: what :func:`open_table` found."""

    base: str
    version: int
    files: tuple[DataFile, ...]
    schema: StructType
    columns: RosterColumns = SNAKE

    def read(self, spark: SparkSession, files: Iterable[DataFile] | None = None) -> DataFrame:
        """The rows of all files, or of those given."""
        paths = [f"{self.base}/files/{f.file}" for f in (self.files if files is None else files)]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def may_hold(self, keys: list[int] | None) -> list[DataFile]:
        """The files whose key range covers one of the sorted ``keys``; None stands for any keys."""
        if keys is None:
            return list(self.files)

        def covers(f: DataFile) -> bool:
            at = bisect_left(keys, f.low)
            return at < len(keys) and keys[at] <= f.high

        return [f for f in self.files if f.low is not None and covers(f)]


def open_table(spark: SparkSession, base: str, columns: RosterColumns = SNAKE) -> FileTable | None:
    """The table as last published, or None."""
    last = _last(spark, base)
    if last is None:
        return None
    name = last["snapshot"]
    rows = spark.read.schema(_MANIFEST).parquet(f"{base}/manifests/{name}").orderBy("low", "file").collect()
    schema = StructType.fromJson(json.loads(read_mark(spark, f"{base}/schemas/{name}")))
    return FileTable(base, last["version"], tuple(DataFile(*row) for row in rows), schema, columns)


def _publish(spark: SparkSession, table: FileTable) -> FileTable:
    """Enter ``table`` as the version after its own number."""
    name = uuid.uuid4().hex
    rows = [(f.file, f.rows, f.low, f.high) for f in table.files]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{table.base}/manifests/{name}")
    claim(spark, f"{table.base}/schemas/{name}", table.schema.json())
    version = _enter(spark, table.base, name, sum(f.rows for f in table.files), after=table.version)
    return replace(table, version=version)


def _write_files(df: DataFrame, table: FileTable, parts: int | None = None) -> list[DataFile]:
    """Write ``df`` in key order, ``parts`` files, and describe what is there."""
    spark, key = df.sparkSession, table.columns.id
    name = uuid.uuid4().hex
    path = f"{table.base}/files/{name}"
    df = df.select(*table.schema.names)
    placed = df.repartitionByRange(parts, key) if parts else df.repartitionByRange(key)
    placed.sortWithinPartitions(key).write.parquet(path)
    stored = spark.read.schema(table.schema).parquet(path).select(F.col("_metadata.file_name").alias("file"), key)
    found = stored.groupBy("file").agg(F.count(F.lit(1)), F.min(key), F.max(key)).collect()
    return [DataFile(f"{name}/{row[0]}", *row[1:]) for row in found]


def create_if_missing(
    spark: SparkSession, base: str, schema: StructType = ROSTER_SCHEMA, columns: RosterColumns = SNAKE
) -> FileTable:
    """The table below ``base``, created without rows unless there is one; it is never emptied."""
    return open_table(spark, base, columns) or _publish(spark, FileTable(base, 0, (), schema, columns))


def replace_rows(
    df: DataFrame, base: str, columns: RosterColumns = SNAKE, contract: Contract | None = None, parts: int | None = None
) -> FileTable:
    """Publish ``df`` in place of all rows; repeated keys are a DuplicateKeyError, rows that break the
    ``contract`` a ContractError, and readers keep the old version then."""
    spark = df.sparkSession
    old = open_table(spark, base, columns)
    table = FileTable(base, old.version if old else 0, (), df.schema, columns)
    table = replace(table, files=tuple(_write_files(df, table, parts)))
    stored = table.read(spark)
    repeated = [row[0] for row in duplicate_keys(stored, columns).limit(20).collect()]
    if repeated:
        raise DuplicateKeyError(f"keys repeated: {', '.join(map(str, repeated))}")
    if contract is not None:
        assert_contract(stored, contract.using(columns=columns))
    return _publish(spark, table)


def _sorted_keys(keys: DataFrame, key: str) -> list[int] | None:
    """At most CHOSEN_KEYS distinct keys, in order; None if there are more."""
    rows = keys.where(F.col(key).isNotNull()).select(key).distinct().limit(CHOSEN_KEYS + 1).toArrow()
    return sorted(rows.column(0).to_pylist()) if rows.num_rows <= CHOSEN_KEYS else None


def find(spark: SparkSession, table: FileTable, keys: DataFrame | Iterable[int]) -> DataFrame:
    """The rows with one of ``keys`` (numbers, or a frame with the key column), read from the files
    whose range covers one."""
    key = table.columns.id
    if not isinstance(keys, DataFrame):
        wanted = sorted(set(keys))
        return table.read(spark, table.may_hold(wanted)).where(F.col(key).isin(wanted))
    return rows_with_keys(table.read(spark, table.may_hold(_sorted_keys(keys, key))), keys, key)


def _addressed(spark: SparkSession, table: FileTable, keys: DataFrame) -> list[DataFile]:
    """The files that hold one of ``keys``; MissingKeyError if a key is in none.

    Only the key column of the files in range is read. Spark combines per file before it shuffles, and one
    row per file reaches the driver.
    """
    key = table.columns.id
    near = table.may_hold(_sorted_keys(keys, key))
    rows = table.read(spark, near)
    placed = rows.select(key, (file_place() if near else F.lit(None).cast("string")).alias(_FILE))
    hits = written(rows_with_keys(placed, keys, key))
    shown = keys.select(key).distinct().join(hits.select(key), key, "left_anti").limit(20).collect()
    if shown:
        raise MissingKeyError(f"keys not in the table: {', '.join(str(row[0]) for row in shown)}")
    names = {row[0] for row in hits.select(_FILE).distinct().collect()}
    return [f for f in near if f.file in names]


def _replaced(spark: SparkSession, table: FileTable, old: list[DataFile], rows: DataFrame) -> FileTable:
    if not old:
        return table
    new = _write_files(rows, table, len(old))
    gone = {f.file for f in old}
    return _publish(spark, replace(table, files=(*[f for f in table.files if f.file not in gone], *new)))


def update(
    spark: SparkSession, table: FileTable, changes: DataFrame, order: str | None = None, contract: Contract | None = None
) -> FileTable:
    """The version in which the rows addressed by ``changes`` have its values.

    A key that is in no file is a MissingKeyError; one changed twice a DuplicateKeyError, unless ``order``
    says which change is last; changes that break the ``contract`` are a ContractError. Then nothing is
    published.
    """
    changes = written(changes)
    if contract is not None:
        assert_contract(changes, contract.using(columns=table.columns))
    if order is None:
        repeated = [row[0] for row in duplicate_keys(changes, table.columns).limit(20).collect()]
        if repeated:
            raise DuplicateKeyError(f"keys changed more than once: {', '.join(map(str, repeated))}")
    touched = _addressed(spark, table, changes)
    return _replaced(spark, table, touched, apply_updates(table.read(spark, touched), changes, table.columns, order))


def delete(spark: SparkSession, table: FileTable, keys: DataFrame) -> FileTable:
    """The version without the rows addressed by ``keys``; a key that is in no file is a MissingKeyError."""
    keys = written(keys.select(table.columns.id))
    touched = _addressed(spark, table, keys)
    return _replaced(spark, table, touched, apply_deletes(table.read(spark, touched), keys, table.columns))


def insert(spark: SparkSession, table: FileTable, batch: DataFrame, contract: Contract | None = None) -> FileTable:
    """The version with all rows of ``batch`` in files of their own, or DuplicateKeyError if a key repeats or
    is there; only files in the range of the batch's keys are looked at."""
    batch = written(batch)
    if contract is not None:
        assert_contract(batch, contract.using(columns=table.columns))
    key = table.columns.id
    near = table.read(spark, table.may_hold(_sorted_keys(batch, key)))
    shown = [str(row[0]) for row in batch_conflicts(near, batch, table.columns).select(key).limit(20).collect()]
    if shown:
        raise DuplicateKeyError(f"keys repeated or already present: {', '.join(shown)}")
    return _publish(spark, replace(table, files=(*table.files, *_write_files(batch, table))))


def _contract_id(contract: Contract) -> str:
    return hashlib.sha256(repr(contract).encode()).hexdigest()[:32]


def read_checked(
    spark: SparkSession, table: FileTable, contract: Contract, on_violation: str = "fail"
) -> DataFrame:
    """The rows of the table, checked against ``contract`` again as they are read.

    Rows that break it are a ContractError with ``on_violation='fail'`` and are left out, the others in the
    types of the table, with ``'quarantine'``; :func:`violations` lists them. Files never change, so those
    that once kept a contract are noted and not checked against it again. Keys are unique in a table:
    repeated ones are no concern here.
    """
    if on_violation not in ("fail", "quarantine"):
        raise ValueError(f"on_violation is 'fail' or 'quarantine', not {on_violation!r}")
    rule = contract.using(columns=table.columns, quarantine_duplicates=False)
    good, unknown = _by_check(spark, table, rule)
    if unknown:
        bad = {row[0] for row in _broken(spark, table, unknown, rule).select(_FILE).distinct().collect()}
        kept = [f for f in unknown if f.file not in bad]
        for f in kept:
            claim(spark, f"{table.base}/checked/{_contract_id(rule)}/{f.file.replace('/', '_')}", str(f.rows))
        good, unknown = [*good, *kept], [f for f in unknown if f.file in bad]
    if not unknown:
        return table.read(spark)
    if on_violation == "fail":
        shown = _broken(spark, table, unknown, rule).select(table.columns.id, "reasons").limit(5).collect()
        raise ContractError(f"rows break contract '{rule.name}', for example {', '.join(f'{k}: {r}' for k, r in shown)}")
    clean, _ = split(annotate(table.read(spark, unknown), rule))
    return table.read(spark, good).unionByName(clean.select(*table.schema.names))


def violations(spark: SparkSession, table: FileTable, contract: Contract) -> DataFrame:
    """The rows that break ``contract``, with their ``reasons``; only files not yet known to keep it are read."""
    rule = contract.using(columns=table.columns, quarantine_duplicates=False)
    return _broken(spark, table, _by_check(spark, table, rule)[1], rule).drop(_FILE)


def _by_check(spark: SparkSession, table: FileTable, rule: Contract) -> tuple[list[DataFile], list[DataFile]]:
    """(files known to keep the contract, other files)."""
    noted = set(children(spark, f"{table.base}/checked/{_contract_id(rule)}"))
    known = [f for f in table.files if f.file.replace("/", "_") in noted]
    return known, [f for f in table.files if f.file.replace("/", "_") not in noted]


def _broken(spark: SparkSession, table: FileTable, files: list[DataFile], rule: Contract) -> DataFrame:
    rows = table.read(spark, files)
    rows = rows.withColumn(_FILE, file_place() if files else F.lit(None).cast("string"))
    _, bad = split(annotate(rows, rule))
    return bad
