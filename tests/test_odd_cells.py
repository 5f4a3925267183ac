"""Single odd cells: one answer at every size, and no cell that stops a job."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from musterline.functions.numbers import exact_mean, rounded_sum
from musterline.operators.changes import insert_batch, new_rows
from musterline.operators.cleaning import impute_constant
from musterline.operators.dedup import mark_duplicates
from musterline.operators.flatten import rejected_users, roster_from_users
from musterline.sources.payloads import default_users, resolve_feeds


@pytest.mark.parametrize("max_rows", [0, 100])
def test_a_null_order_is_last_at_every_size(spark, max_rows):
    df = spark.createDataFrame([(1, 1), (1, None), (1, 2), (2, None), (3, 5)], "id int, ordinal int")
    marked = mark_duplicates(df, "id", "ordinal", max_rows=max_rows).collect()
    assert {(r.id, r.ordinal): r.is_duplicate for r in marked} == {
        (1, 1): False,
        (1, None): True,
        (1, 2): True,
        (2, None): False,
        (3, 5): False,
    }


def test_a_19_digit_user_id_is_rejected_alone(spark):
    users = default_users(spark)
    huge = users.limit(1).withColumn("id", F.lit(9223372036854775807).cast(users.schema["id"].dataType))
    both = users.unionByName(huge)
    assert rejected_users(both).count() == rejected_users(users).count() + 1
    assert roster_from_users(both).count() == roster_from_users(users).count()


def test_large_numbers_do_not_stop_a_job(spark):
    df = spark.createDataFrame([(99999999999.0, 10.0), (2.7, 1e15), (None, 20.0)], "score double, salary double")
    assert [r.score for r in impute_constant(df, "score", 3).orderBy("salary").collect()] == [3, 3, 2]
    row = df.agg(rounded_sum(F.col("salary")).alias("total"), exact_mean(F.col("salary")).alias("mean")).first()
    assert (row.total, row.mean) == (30.0, 15.0)


def test_new_rows_keep_the_first_of_a_repeated_key(spark):
    table = spark.createDataFrame([(1, "a")], "employee_id long, name string")
    batch = spark.createDataFrame(
        [(2, "late", 2), (2, "early", 1), (1, "held", 3), (None, "none", 4)], "employee_id long, name string, at int"
    )
    rows = new_rows(table, batch, order="at").drop("at")
    assert [tuple(r) for r in rows.collect()] == [(2, "early")]
    assert insert_batch(table, rows).count() == 2


def test_a_feed_that_does_not_parse_falls_back(spark):
    landed = spark.createDataFrame([("Time", "<html>oops"), ("Weather", '{"a": 1}')], "feed string, data string")
    got = {r.feed: r.status for r in resolve_feeds(landed, ["Time", "Weather"]).collect()}
    assert got == {"Time": "fallback", "Weather": "success"}
