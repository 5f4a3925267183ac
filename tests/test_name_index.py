"""Searches by trigrams find what a scan finds, in fewer rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from musterline.model import ROSTER_SCHEMA
from musterline.operators.search import search
from musterline.sources import file_table as ft, name_index as ni

NAMES = ["Anna Lee", "ANNABEL", "Hannah", "Jo", "", None, "Bob\\ross", "a_n%n", "Ünal Öz", "anan", "nna", "Lee Anna Lee"]


@pytest.fixture
def table(spark, tmp_path):
    rows = [(i, NAMES[i // 3 % 12] if i % 3 == 0 else f"person {i}", "HR", "x", 1.0, dt.date(2024, 1, 1), 3) for i in range(1, 400)]
    return ft.replace_rows(spark.createDataFrame(rows, ROSTER_SCHEMA), f"{tmp_path}/t", parts=6)


def keys(df):
    return sorted(r["employee_id"] for r in df.collect())


QUERIES = ["anna", "ANN%le", "nn", "a_n", "%", "", "zzz", "bob\\r", "Lee Anna", "on 1_3", "ünal", "Öz", "ann%%bel"]


def test_equals_the_scan(spark, table):
    expected = {q: keys(search(table.read(spark), query=q)) for q in QUERIES}
    assert keys(ni.search_names(spark, table, "anna")) == expected["anna"]  # nothing is indexed yet
    assert ni.index_names(spark, table) == len(table.files) and ni.index_names(spark, table) == 0
    assert {q: keys(ni.search_names(spark, table, q)) for q in QUERIES} == expected


def test_few_rows_are_read_and_changes_are_followed(spark, table):
    ni.index_names(spark, table)
    grams = ni.pattern_trigrams("ann%bel")
    assert grams == ["ann", "bel"]
    found, unknown = ni.candidates(spark, table, grams)
    assert unknown == [] and 0 < found.count() < 40
    one = table.read(spark).where("employee_id = 200").withColumn("name", F.lit("Annabel the second"))
    changed = ft.update(spark, table, one)
    for _ in range(2):  # with the new file unindexed, then indexed
        assert 200 in keys(ni.search_names(spark, changed, "ann%bel"))
        assert 200 not in keys(ni.search_names(spark, table, "ann%bel"))
        ni.index_names(spark, changed)
    gone = ft.delete(spark, changed, one)
    assert 200 not in keys(ni.search_names(spark, gone, "ann%bel"))


def test_entries_are_every_three_neighbouring_characters(spark, tmp_path):
    names = ["ab", "abc", "a\nbc d", "x😀yz😀", "aaaa", "", None, "ünal öz"]
    rows = [(i, n, "HR", "x", 1.0, dt.date(2024, 1, 1), 3) for i, n in enumerate(names, 1)]
    table = ft.replace_rows(spark.createDataFrame(rows, ROSTER_SCHEMA), f"{tmp_path}/t", parts=2)
    ni.index_names(spark, table)
    found = spark.read.parquet(f"{table.base}/trigrams/runs").groupBy("key").agg(F.collect_set("trigram").alias("g"))
    expected = {i: {n[j : j + 3] for j in range(len(n) - 2)} for i, n in enumerate(names, 1) if n and len(n) >= 3}
    assert {r["key"]: set(r["g"]) for r in found.collect()} == expected
