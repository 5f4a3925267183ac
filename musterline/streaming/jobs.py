"""Structured Streaming jobs over landed roster rows and payloads.

Each function starts a query and returns it; the caller chooses the trigger by ``available_now``
and keeps ``checkpoint`` stable between runs.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from musterline.errors import SourceError, StreamOwnerError
from musterline.model import SNAKE, RosterColumns
from musterline.operators.contracts import DUPLICATE, REASONS, Contract, annotate, integer_of
from musterline.operators.flatten import flatten_users
from musterline.operators.metrics import department_summary
from musterline.operators.small_side import join_statistics, rows_with_keys
from musterline.session import written
from musterline.sources.folders import children, claim, marks, read_mark, remove


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


#: A batch opens only the buckets that its keys fall into; merged runs of key files span so many batches.
BUCKETS, RUN = 64, 16
_KEYS = "key bigint, bucket int"


def _query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The identity of the stream that keeps its progress in ``checkpoint``."""
    text = read_mark(spark, f"{checkpoint}/metadata")
    return json.loads(text)["id"] if text else None


def _refuse_foreign(spark: SparkSession, folder: str, checkpoint: str) -> None:
    owner = read_mark(spark, f"{folder}/_owner")
    if owner is not None and owner != _query_id(spark, checkpoint):
        raise StreamOwnerError(f"{folder} holds the output of a stream with another checkpoint")


class KeyLedger:
    """The keys of all batches, in hash buckets, as small sorted files of keys only.

    Batch ``e`` adds the keys that it brings for the first time. Every RUN batches, the files of a bucket are
    merged into one run, so a batch reads at most RUN sets of files, and of these only the buckets that its
    keys fall into. A batch looks at files of earlier batches only, so a replayed one finds what it found
    before, and overwrites its own files. More ``buckets`` make small batches over a long history cheaper.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder, buckets

    def _folders(self, epoch: int) -> list[str]:
        merged = epoch // RUN * RUN
        runs = [f"{self.folder}/until={merged}"] if merged else []
        return runs + [f"{self.folder}/epoch={e}" for e in range(merged, epoch)]

    def _read(self, folders: list[str]) -> DataFrame | None:
        names = set(children(self.spark, self.folder))
        held = [f for f in folders if f.rsplit("/", 1)[1] in names]
        if len(held) < len(folders):
            raise StreamOwnerError(f"keys of earlier batches are missing below {self.folder}")
        # Each is a partitioned table of its own; at most RUN of them.
        tables = [self.spark.read.schema(_KEYS).parquet(f) for f in held]
        return reduce(DataFrame.unionByName, tables) if tables else None

    def bucketed(self, keys: DataFrame) -> DataFrame:
        """(key, bucket) of the distinct keys of a batch, null left out."""
        bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
        return keys.where("key is not null").distinct().withColumn("bucket", bucket)

    def known(self, batch: DataFrame, epoch: int) -> DataFrame:
        """The keys of ``batch`` (key, bucket) that batches before ``epoch`` brought, once each."""
        earlier = self._read(self._folders(epoch))
        if earlier is None:
            return batch.select("key").limit(0)
        touched = [row[0] for row in batch.select("bucket").distinct().collect()]  # at most `buckets` numbers
        return rows_with_keys(earlier.where(F.col("bucket").isin(touched)).select("key"), batch, "key").distinct()

    def add(self, batch: DataFrame, known: DataFrame, epoch: int) -> None:
        self._write(batch.join(known, "key", "left_anti"), f"{self.folder}/epoch={epoch}")
        if (epoch + 1) % RUN == 0:
            merged = self._read(self._folders(epoch) + [f"{self.folder}/epoch={epoch}"])
            self._write(merged, f"{self.folder}/until={epoch + 1}")

    def _write(self, keys: DataFrame, folder: str) -> None:
        # One sorted file per bucket: key files hold 8 bytes a key before packing.
        rows = keys.repartition("bucket").sortWithinPartitions("bucket", "key")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(folder)


def contract_split_stream(
    rows: DataFrame,
    contract: Contract,
    folder: str,
    checkpoint: str,
    available_now: bool = True,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Split each micro-batch into clean and quarantined rows below ``folder``.

    Within a batch the first row of a key is kept; a key of an earlier batch is a duplicate in a
    later one, even if its first row was invalid. Keys of earlier batches come from a
    :class:`KeyLedger`; no earlier row is read. A replayed batch overwrites its own output only. A
    ``folder`` that another checkpoint has written to is refused with StreamOwnerError, so a stream
    whose checkpoint is lost does not start at batch 0 over rows that are already there.
    """
    c: RosterColumns = contract.columns
    _refuse_foreign(rows.sparkSession, folder, checkpoint)

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if epoch == 0:
            claim(spark, f"{folder}/_owner", _query_id(spark, checkpoint) or "")
        annotated = annotate(batch, contract)
        ledger, keys, known = KeyLedger(spark, f"{folder}/keys", buckets), None, None
        if contract.quarantine_duplicates:
            annotated = written(annotated.withColumn("__key", integer_of(annotated, c.id)))
            keys = written(ledger.bucketed(annotated.select(F.col("__key").alias("key"))))
            known = written(ledger.known(keys, epoch))
            seen = known.select(F.col("key").alias("__key"), F.lit(True).alias("__known"))
            repeated = F.array_union(F.col(REASONS), F.array(F.lit(DUPLICATE)))
            annotated = (
                join_statistics(annotated, seen, "__key")
                .withColumn(REASONS, F.when(F.col("__known"), repeated).otherwise(F.col(REASONS)))
                .drop("__key", "__known")
            )
        verdict = F.when(F.size(REASONS) == 0, "clean").otherwise("quarantine")
        (
            annotated.withColumn("verdict", verdict)
            .write.mode("overwrite")
            .partitionBy("verdict")
            .parquet(f"{folder}/rows/epoch={epoch}")
        )
        if keys is not None:
            ledger.add(keys, known, epoch)

    return _start(rows.writeStream.foreachBatch(write), checkpoint, available_now)


def department_summary_stream(
    rows: DataFrame,
    folder: str,
    checkpoint: str,
    columns: RosterColumns = SNAKE,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the department summary of all rows so far; state is one row per department."""
    summary = department_summary(rows, columns, ordered=False)

    def write(result: DataFrame, epoch: int) -> None:
        # One file: it appears at once, and a reader takes the newest that is there.
        result.coalesce(1).write.mode("overwrite").parquet(f"{folder}/epoch={epoch}")
        for name, number in _epochs(result.sparkSession, folder):
            if number < epoch - 1:  # the one before stays for readers that have just chosen it
                remove(result.sparkSession, f"{folder}/{name}")

    return _start(
        summary.writeStream.outputMode("complete").foreachBatch(write), checkpoint, available_now
    )


def _epochs(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    names = [name for name in children(spark, folder) if name.startswith("epoch=")]
    return sorted(((name, int(name.removeprefix("epoch="))) for name in names), key=lambda e: e[1])


def latest_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary written by the last finished epoch.

    Older ones are removed as new ones are written, so one short folder is listed and one file is
    read, however long the stream has run.
    """
    for name, _ in reversed(_epochs(spark, folder)):
        if "_SUCCESS" in marks(spark, f"{folder}/{name}"):
            return spark.read.parquet(f"{folder}/{name}")
    raise SourceError(f"no finished summary below {folder}")


def flatten_stream(
    users: DataFrame, folder: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append annotated roster rows of newly landed users, row by row and without state."""
    annotated = flatten_users(users)
    writer = annotated.writeStream.format("parquet").outputMode("append").option("path", folder)
    return _start(writer, checkpoint, available_now)
