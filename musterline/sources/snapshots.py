"""A keyed table as numbered parquet or CSV snapshots and a ledger of the published ones."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from musterline.errors import DuplicateKeyError, PublishConflictError
from musterline.model import PASCAL, SNAKE, RosterColumns
from musterline.operators.contracts import Contract, assert_contract
from musterline.sources.folders import age_of, claim
from musterline.sources.roster_files import file_headcount, path_is_missing, read_raw_csv, write_csv

#: How long a publisher may take from the claim of a version to its entry in the ledger.
CLAIM_SECONDS = 3600.0
_LEDGER_SCHEMA = "version bigint, snapshot string, rows bigint, published_at timestamp"


def _ledger(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(_LEDGER_SCHEMA).parquet(f"{base}/published")
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return spark.createDataFrame([], _LEDGER_SCHEMA)


def _last(spark: SparkSession, base: str):
    """The ledger entry of the highest version, or None."""
    return _ledger(spark, base).orderBy(F.desc("version"), "published_at", "snapshot").first()


def _current(spark: SparkSession, base: str) -> str | None:
    last = _last(spark, base)
    return f"{base}/snapshots/{last['snapshot']}" if last else None


def _enter(
    spark: SparkSession, base: str, name: str, rows: int, after: int | None = None, grace: float = CLAIM_SECONDS
) -> int:
    """Make a complete snapshot the current one and return its version, or raise PublishConflictError.

    A version is claimed before it is entered, and a claim cannot be made twice, so of two publishers at
    once one gets the version and the other is told. With ``after``, the snapshot was made from that
    version and may only follow it. A claim whose publisher has not entered it within ``grace`` seconds
    counts as given up; its number is left out.
    """
    last = _ledger(spark, base).agg(F.max("version")).first()[0] or 0
    if after is not None and last != after:
        raise PublishConflictError(f"version {last} was published since version {after} was read")
    version = last + 1
    while not claim(spark, f"{base}/claims/{version}", name):
        entered = _ledger(spark, base).where(F.col("version") >= version).count()
        if entered or age_of(spark, f"{base}/claims/{version}") < grace:
            raise PublishConflictError(f"version {version} was claimed by another job")
        version += 1
    entry = spark.createDataFrame([(version, name, rows)], "version bigint, snapshot string, rows bigint")
    entry.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(
        f"{base}/published"
    )
    return version


def current_snapshot(spark: SparkSession, base: str) -> DataFrame | None:
    """The table as last published, or None."""
    path = _current(spark, base)
    return spark.read.parquet(path) if path else None


def publish_csv(df: DataFrame, base: str, columns: RosterColumns = SNAKE) -> int:
    """Replace the CSV export below ``base`` and return its rows.

    Readers (:func:`current_csv`) see the old files until the new ones are complete. An export
    without rows replaces the old one too.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    path = f"{base}/snapshots/{name}"
    write_csv(df, path, columns)
    rows = file_headcount(spark, path).first()[0]
    _enter(spark, base, name, rows)
    return rows


def current_csv(
    spark: SparkSession, base: str, columns: RosterColumns = PASCAL, multiline: bool = False
) -> DataFrame | None:
    """The export as last published, as text, or None."""
    path = _current(spark, base)
    return read_raw_csv(spark, path, columns, multiline) if path else None


def duplicate_keys(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    return df.groupBy(columns.id).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def full_reload(
    df: DataFrame,
    base: str,
    columns: RosterColumns = SNAKE,
    cluster_by: str | None = None,
    contract: Contract | None = None,
) -> tuple[int, float]:
    """Replace the table by ``df`` and return (rows, seconds).

    The rows are written beside the current snapshot, checked for repeated keys, and only then
    entered in the ledger, so a failure at any point leaves readers on the old snapshot. Without
    rows the table stays as it is and (0, 0.0) is returned. ``cluster_by`` deals the rows out by
    ranges of (that column, key): a file covers few of its values, so readers skip files, and a
    value that many rows share is still split. With a ``contract``, rows that break it are a
    ContractError.
    """
    spark = df.sparkSession
    started = time.perf_counter()
    name = uuid.uuid4().hex
    path = f"{base}/snapshots/{name}"
    if cluster_by:
        place = [cluster_by, columns.id]
        df = df.repartitionByRange(*place).sortWithinPartitions(*place)
    df.write.parquet(path)
    # Counted from the files, not from df: one evaluation, and what is counted is what is there.
    stored = spark.read.schema(df.schema).parquet(path)
    rows = stored.count()
    if rows == 0:
        return 0, 0.0
    repeated = [row[0] for row in duplicate_keys(stored, columns).limit(20).collect()]
    if repeated:
        raise DuplicateKeyError(f"keys repeated: {', '.join(map(str, repeated))}")
    if contract is not None:
        assert_contract(stored, contract.using(columns=columns))
    _enter(spark, base, name, rows)
    return rows, time.perf_counter() - started
