"""Keep-first, coercion, imputation and tenure."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from musterline.functions.dates import tenure_days, tenure_years
from musterline.operators import cleaning
from musterline.operators.dedup import keep_first, mark_duplicates, one_per_key


@pytest.mark.parametrize("max_rows", [100, 0])  # broadcast and shuffle form
def test_mark_duplicates_against_brute_force(spark, max_rows):
    rng = random.Random(1)
    # A third of all rows share one key; others repeat, some are null.
    keys = [7 if rng.random() < 0.34 else rng.choice([None, *range(60)]) for _ in range(900)]
    order = list(range(900))
    rng.shuffle(order)
    rows = list(zip(keys, order))
    first = {}
    for key, position in sorted(rows, key=lambda r: r[1]):
        first.setdefault(key, position)
    expected = {position: position != first[key] for key, position in rows}
    for partitions in (1, 4, 32):
        df = spark.createDataFrame(rows, "k bigint, o bigint").repartition(partitions)
        marked = mark_duplicates(df, "k", "o", max_rows=max_rows)
        assert {r["o"]: r["is_duplicate"] for r in marked.collect()} == expected
        kept = keep_first(df, "k", "o", max_rows=max_rows)
        assert sorted(r["o"] for r in kept.collect()) == sorted(first.values())


def test_shuffle_form_spreads_a_hot_key(spark):
    df = spark.range(20000).select(F.lit(1).alias("k"), F.col("id").alias("o"))
    marked = mark_duplicates(df, "k", "o", max_rows=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [
            r["count"]
            for r in mark_duplicates(df, "k", "o", max_rows=0)
            .groupBy(F.spark_partition_id().alias("p"))
            .count()
            .collect()
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert marked.where("not is_duplicate").count() == 1
    assert len(sizes) == 4 and max(sizes) < 20000 / 3


def test_one_per_key_survives_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 1, "c")], "k int, o int, v string")
    assert one_per_key(df, "k", F.col("o").desc()).groupBy("k").count().where("count > 1").isEmpty()
    plan = one_per_key(df, "k", F.col("o"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("max_rows", [100, 0])
def test_median_is_that_of_the_rows_kept(spark, max_rows):
    rows = [
        (1, "a", "HR", "x", 10.0, "2024-05-01", 5.0, 0),
        (1, "a", "HR", "x", 99.0, "2024-05-01", 5.0, 1),
        (2, "b", "HR", "x", 20.01, "2024/05/01", None, 2),
        (3, "c", "HR", "x", None, None, 2.9, 3),
        (None, "d", "HR", "x", 30.0, "2024-5-7", 1.0, 4),
        (None, "e", "HR", "x", 70.0, "2024-5-7", 1.0, 5),
        (4, "f", "HR", "x", float("nan"), "nonsense", float("nan"), 6),
        (5, "g", "HR", "x", 40.0, "2024-05-01", 4.0, 7),
    ]
    schema = (
        "employee_id bigint, name string, department string, designation string, salary double, "
        "joining_date string, performance_score double, ordinal bigint"
    )
    df = spark.createDataFrame(rows, schema)
    cleaned = cleaning.clean_roster(df, max_rows=max_rows).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in cleaned] == [0, 2, 3, 4, 6, 7]
    # median of 10, 20.01, 30, 40
    median = (20.01 + 30.0) / 2
    assert [r["salary"] for r in cleaned] == [10.0, 20.01, median, 30.0, median, 40.0]
    assert [r["performance_score"] for r in cleaned] == [5, 3, 2, 1, 3, 4]
    default = dt.date(2024, 1, 1)
    assert [r["joining_date"] for r in cleaned] == [
        dt.date(2024, 5, 1), default, default, dt.date(2024, 5, 7), default, dt.date(2024, 5, 1),
    ]
    assert cleaned[1]["tenure_years"] == (dt.date(2026, 7, 9) - default).days / 365.25


def test_all_salaries_missing_stay_missing(spark):
    df = spark.createDataFrame([(1, None)], "id int, salary double")
    assert cleaning.impute_median(df, "salary").first()["salary"] is None


def test_coerce_numeric_text(spark):
    df = spark.createDataFrame([("5d",), ("1_000",), (" 7 ",), ("nan",), ("1e999",)], "v string")
    assert [r[0] for r in cleaning.coerce_numeric(df, "v").collect()] == [None, None, 7.0, None, None]


def test_tenure_rounds_days_down(spark):
    moments = [
        (dt.datetime(2024, 1, 1, 0, 0), 920),
        (dt.datetime(2024, 1, 1, 0, 0, 1), 919),
        (dt.datetime(2024, 1, 1, 23, 59, 59), 919),
        (dt.datetime(2026, 7, 9, 12, 0), -1),
    ]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame([(m,) for m, _ in moments], "at timestamp_ntz")
        df = df.withColumn("at", F.col("at").cast(kind))
        days = [r[0] for r in df.select(tenure_days(df, "at", "2026-07-09")).collect()]
        assert days == [d for _, d in moments]
    dates = spark.createDataFrame([(dt.date(2024, 1, 1),)], "at date")
    assert dates.select(tenure_years(dates, "at", "2024-12-31")).first()[0] == 365 / 365.25
