"""Roster views over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from musterline.fixed_values import AS_OF_DEFAULT
from musterline.functions.dates import tenure_years
from musterline.model import SNAKE
from musterline.operators.contracts import ENTITY, FRAME, TABLE

# The departments of these tables are the market segments.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

SEGMENT_ENTITY = ENTITY.using(departments=SEGMENTS)
SEGMENT_FRAME = FRAME.using(departments=SEGMENTS)
SEGMENT_TABLE = TABLE


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def roster_from_orders(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """One roster row per order; customer and nation are joined without a hint, by their size."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    key = F.col("o_orderkey") + 1
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias(SNAKE.id),
            F.col("c_name").alias(SNAKE.name),
            F.col("c_mktsegment").alias(SNAKE.department),
            F.col("n_name").alias(SNAKE.designation),
            F.col("o_totalprice").alias(SNAKE.salary),
            F.col("o_orderdate").cast("date").alias(SNAKE.joining_date),
            F.substring("o_orderpriority", 1, 1).cast("int").alias(SNAKE.score),
            key.alias(SNAKE.ordinal),
        )
    )


def roster(spark: SparkSession, folder: str) -> DataFrame:
    return roster_from_orders(spark, folder, table(spark, folder, "orders"))


def roster_with_tenure(spark: SparkSession, folder: str) -> DataFrame:
    rows = roster(spark, folder)
    return rows.withColumn(SNAKE.tenure, tenure_years(rows, SNAKE.joining_date, AS_OF_DEFAULT))


def damage(rows: DataFrame) -> DataFrame:
    """The roster with repeated and missing keys, missing numbers, unknown departments and dates
    in a foreign format. ``ordinal`` keeps the undamaged key."""

    def every(n: int) -> Column:
        return F.col(SNAKE.ordinal) % n == 0

    key, joined = F.col(SNAKE.id), F.col(SNAKE.joining_date)
    return rows.withColumns(
        {
            SNAKE.id: F.when(every(37), F.lit(None).cast("bigint"))
            .when(every(13), key - key % 10)
            .otherwise(key),
            SNAKE.department: F.when(every(23), F.lit("UNKNOWN")).otherwise(F.col(SNAKE.department)),
            SNAKE.salary: F.when(~every(17), F.col(SNAKE.salary)),
            SNAKE.joining_date: F.when(every(29), F.date_format(joined, "yyyy/MM/dd")).otherwise(
                F.date_format(joined, "yyyy-MM-dd")
            ),
            SNAKE.score: F.when(~every(19), F.col(SNAKE.score)),
        }
    )


def damaged_roster(spark: SparkSession, folder: str) -> DataFrame:
    return damage(roster(spark, folder))


def text_roster(spark: SparkSession, folder: str) -> DataFrame:
    """The damaged roster as loose text: suffixes, digit groups, blanks and signs in numbers."""

    def every(n: int) -> Column:
        return F.col(SNAKE.ordinal) % n == 0

    rows = damaged_roster(spark, folder)
    amount = F.format_string("%.2f", F.col(SNAKE.salary))
    amount = F.when(F.col(SNAKE.salary).isNotNull(), amount)
    score = F.col(SNAKE.score).cast("string")
    return rows.withColumns(
        {
            SNAKE.id: F.when(every(41), F.concat(F.lit("x"), F.col(SNAKE.id).cast("string")))
            .when(every(43), F.concat(F.lit(" +"), F.col(SNAKE.id).cast("string"), F.lit("\t")))
            .otherwise(F.col(SNAKE.id).cast("string")),
            SNAKE.department: F.when(
                every(47), F.concat(F.lit(" "), F.col(SNAKE.department), F.lit(" "))
            ).otherwise(F.col(SNAKE.department)),
            SNAKE.designation: F.when(every(53), F.lit("   ")).otherwise(F.col(SNAKE.designation)),
            SNAKE.salary: F.when(every(31), F.lit("5d"))
            .when(every(59), F.lit("nan"))
            .when(every(61), F.lit("20_000"))
            .otherwise(amount),
            SNAKE.score: F.when(every(11), F.concat(score, F.lit(".7"))).otherwise(score),
        }
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    """One nested user per event: ids repeat, exceed the accepted range, are negative or no number."""
    return users_from_events(table(spark, folder, "events"))


def users_from_events(events: DataFrame) -> DataFrame:
    event_id = F.col("event_id")

    def every(n: int) -> Column:
        return event_id % n == 0

    number = F.get_json_object("props", "$.k").cast("int")
    user_id = (
        F.when(every(11), F.concat(F.lit("u"), number.cast("string")))
        .when(every(13), (-number).cast("string"))
        .otherwise(number.cast("string"))
    )
    role = (
        F.when(every(3), F.concat(F.upper("event_type"), F.lit(" online MARKETS")))
        .when(every(5), F.lit("a b"))
        .when(every(7), F.lit(""))
        .otherwise(F.concat("event_type", F.lit("-driven growth")))
    )
    company = F.struct(
        F.lit("Company").alias("name"), F.lit("phrase").alias("catchPhrase"), role.alias("bs")
    )
    return events.select(
        user_id.alias("id"),
        F.when(~every(17), F.concat(F.lit("User "), F.col("user_id").cast("string"))).alias("name"),
        F.when(~every(19), company).alias("company"),
        "event_id",
    )


def event_rows(spark: SparkSession, folder: str, key: Column, *more: Column) -> DataFrame:
    """Roster rows made of events, keyed by an expression over them: input for keyed changes."""
    return table(spark, folder, "events").select(
        key.alias(SNAKE.id),
        F.concat(F.lit("Event "), F.col("event_type")).alias(SNAKE.name),
        F.lit("BUILDING").alias(SNAKE.department),
        F.lit("Clerk").alias(SNAKE.designation),
        (F.lit(15000.0) + F.col("value")).alias(SNAKE.salary),
        F.col("ts").cast("date").alias(SNAKE.joining_date),
        (F.col("user_id") % 5 + 1).cast("int").alias(SNAKE.score),
        *more,
    )
