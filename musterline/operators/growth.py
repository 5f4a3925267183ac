"""Headcount growth over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from musterline.model import SNAKE, RosterColumns
from musterline.session import written

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def cumulative_headcount(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """Per joining date: rows that joined, and rows that joined until then.

    The window runs over one row per calendar day, a number that does not grow with the data.
    """
    day = F.col(columns.joining_date).cast("date")
    daily = (
        df.where(day.isNotNull())
        .groupBy(day.alias(columns.joining_date))
        .agg(F.count(F.lit(1)).alias("joined"))
    )
    until = Window.orderBy(columns.joining_date).rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cumulative_headcount", F.sum("joined").over(until))


def number_rows(
    df: DataFrame, order: list[str], name: str = "row_number", partitions: int | None = None
) -> DataFrame:
    """Number all rows 1..n by ``order``, which must be unique, without a one-task sort.

    Rows are range partitioned and sorted, and their partition and position are written with them
    (positions must not be computed twice, since range bounds are sampled). The partition sizes
    then give each partition's offset: one row per partition, whatever the number of rows.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn(
            "__position",
            F.monotonically_increasing_id()
            - F.shiftleft(F.spark_partition_id().cast("bigint"), ROW_BITS),
        )
    )
    placed = written(placed)
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    until = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select("__part", (F.sum("__size").over(until) - F.col("__size")).alias("__offset"))
    # One row per range partition: bounded by the partition count set above.
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + F.col("__position") + 1)
        .drop("__part", "__position", "__offset")
    )


def cumulative_headcount_rows(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """Per row, the headcount once that row has joined: by date, then by key."""
    c = columns
    rows = df.where(F.col(c.joining_date).isNotNull()).select(c.id, c.joining_date)
    return number_rows(rows, [c.joining_date, c.id], "cumulative_headcount")
