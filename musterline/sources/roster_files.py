"""The roster as CSV files and as a parquet table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from musterline.errors import SourceError
from musterline.model import PASCAL, ROSTER_SCHEMA, SNAKE, RosterColumns
from musterline.operators.contracts import ENTITY, Contract, annotate
from musterline.operators.growth import ROW_BITS, number_rows
from musterline.operators.reports import csv_rows
from musterline.operators.small_side import SMALL_ROWS, collect_if_small, null_safe_join
from musterline.session import written

# Files follow the common CSV rules: a quote inside a quoted field is doubled.
_CSV = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
# All files of a folder share one header; one that differs is an error, not a shifted row.
_SAME_HEADER = {"enforceSchema": False}


def path_is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_raw_csv(
    spark: SparkSession, path: str, columns: RosterColumns = PASCAL, multiline: bool = False
) -> DataFrame:
    """All fields as text, matched by header name, plus the place each row came from.

    No type inference, so no extra pass over the data. A header without one of the fields gives
    nulls; a missing path gives no rows. ``ordinal`` is (file, block offset, row): ascending in
    file order, and taken before any shuffle could change it. ``multiline`` allows line breaks
    inside quoted fields, at the price that a file is no longer split.
    """
    text_schema = T.StructType([T.StructField(name, T.StringType()) for name in columns.base])
    try:
        raw = spark.read.options(**_CSV, **_SAME_HEADER, multiLine=multiline).csv(path)
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        place = T.StructType(
            [
                T.StructField("file", T.StringType()),
                T.StructField("block", T.LongType()),
                T.StructField("row", T.LongType()),
            ]
        )
        return spark.createDataFrame([], text_schema.add(columns.ordinal, place))
    present = set(raw.columns)
    return raw.select(
        *[
            F.col(f"`{name}`") if name in present else F.lit(None).cast("string").alias(name)
            for name in columns.base
        ],
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(columns.ordinal),
    )


def read_checked_csv(
    spark: SparkSession, path: str, contract: Contract = ENTITY, multiline: bool = False
) -> DataFrame:
    """The file's rows annotated with the contract rules they break.

    Finding duplicates compares input orders across jobs, and another job may split the files
    differently when executors have come or gone. The rows are then written first.
    """
    raw = read_raw_csv(spark, path, PASCAL, multiline)
    if contract.quarantine_duplicates:
        raw = with_dense_order(written(raw), PASCAL)
    return annotate(raw, contract.using(columns=PASCAL))


def with_dense_order(stored: DataFrame, columns: RosterColumns = PASCAL, max_places: int = SMALL_ROWS) -> DataFrame:
    """``stored`` with the place of each row as one number that ascends like (file, block, row).

    Aggregations over a number hash, over a struct with a path they sort. Places of input are numbered: one
    row per block of a file, broadcast if they are few. ``stored`` should be written, since it is scanned
    twice; reading it again must not number its rows anew.
    """
    place = F.col(columns.ordinal)
    places = stored.select(place["file"].alias("__file"), place["block"].alias("__block")).distinct()
    small = collect_if_small(places, max_places)
    if small is not None:
        rows = sorted((tuple(row) for row in small.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1] or 0))
        numbered = F.broadcast(
            stored.sparkSession.createDataFrame([(*row, i) for i, row in enumerate(rows)], "__file string, __block bigint, __place bigint")
        )
    else:
        numbered = number_rows(places, ["__file", "__block"], "__place")
    with_keys = stored.withColumns({"__file": place["file"], "__block": place["block"], "__row": place["row"]})
    # The low 33 bits are the row within its task, where the rows of a block are in order.
    order = F.shiftleft("__place", ROW_BITS) + F.col("__row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    joined = null_safe_join(with_keys, numbered, ["__file", "__block"], "inner")
    return joined.withColumn(columns.ordinal, order).select(*stored.columns)


def file_headcount(spark: SparkSession, path: str) -> DataFrame:
    """One row: data rows without the header; 0 when the path is missing."""
    return read_raw_csv(spark, path).agg(F.count(F.lit(1)).alias("headcount"))


def write_csv(df: DataFrame, path: str, columns: RosterColumns = SNAKE) -> None:
    """Export header and rows. The folder is complete once Spark has put _SUCCESS into it."""
    text = csv_rows(df, columns)
    header = dict(zip(columns.base, PASCAL.base))
    text.withColumnsRenamed(header).write.options(
        **_CSV, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def empty_roster(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ROSTER_SCHEMA)


def rename_to_report_columns(df: DataFrame) -> DataFrame:
    """Stored column names to those of files and reports."""
    return df.withColumnsRenamed(dict(zip(SNAKE.base, PASCAL.base)))


def first_available(sources: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """The first source that can be opened and holds a row; SourceError if none does."""
    reasons = []
    for position, source in enumerate(sources, 1):
        try:
            df = source()
        except AnalysisException as error:
            reasons.append(f"source {position}: {error.getCondition()}")
            continue
        if not df.isEmpty():
            return df
        reasons.append(f"source {position}: no rows")
    raise SourceError("; ".join(reasons) or "no sources given")
