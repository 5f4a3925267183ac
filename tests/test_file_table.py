"""Copy-on-write by file: what a change leaves untouched, what a lookup opens, what a re-check skips."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from musterline.errors import ContractError, DuplicateKeyError, MissingKeyError, PublishConflictError
from musterline.model import ROSTER_SCHEMA
from musterline.operators.contracts import ENTITY, TABLE
from musterline.sources import file_table as ft

DAY = dt.date(2024, 1, 1)


def people(spark, keys, salary=50000.0):
    return spark.createDataFrame([(k, f"p{k}", "HR", "x", salary, DAY, 3) for k in keys], ROSTER_SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return ft.replace_rows(people(spark, range(1, 1001)), f"{tmp_path}/t", parts=10)


def test_a_change_of_ten_keys_leaves_other_files(spark, table):
    assert len(table.files) > 5 and sum(f.rows for f in table.files) == 1000
    mine = table.files[3]
    keys = range(mine.low, mine.low + 10)
    new = ft.update(spark, table, people(spark, keys, 60000.0), contract=ENTITY)
    assert new.version == table.version + 1
    assert set(table.files) - set(new.files) == {mine} and len(new.files) == len(table.files)
    assert new.read(spark).where("salary = 60000").count() == 10 and new.read(spark).count() == 1000
    # The old version is still there as it was.
    assert table.read(spark).where("salary = 60000").count() == 0
    assert set(ft.open_table(spark, table.base).files) == set(new.files)
    gone = ft.delete(spark, new, people(spark, keys))
    assert gone.read(spark).count() == 990 and len(set(new.files) & set(gone.files)) == len(new.files) - 1


def test_a_lookup_opens_one_file(spark, table):
    found = ft.find(spark, table, [table.files[2].low, 10**9])
    assert [r["employee_id"] for r in found.collect()] == [table.files[2].low]
    assert len(found.inputFiles()) == 1
    many = ft.find(spark, table, people(spark, [1, 2, 2, 5000]))
    assert sorted(r["employee_id"] for r in many.collect()) == [1, 2] and len(many.inputFiles()) == 1
    assert ft.find(spark, table, []).count() == 0
    # Without a list of keys, every file may hold some.
    assert table.may_hold(None) == list(table.files)


def test_refused_changes_publish_nothing(spark, table):
    with pytest.raises(MissingKeyError, match="5000"):
        ft.update(spark, table, people(spark, [1, 5000]))
    with pytest.raises(MissingKeyError):
        ft.delete(spark, table, people(spark, [5000]))
    with pytest.raises(DuplicateKeyError):
        ft.update(spark, table, people(spark, [1, 1]))
    with pytest.raises(DuplicateKeyError, match="7"):
        ft.insert(spark, table, people(spark, [7, 2000]))
    with pytest.raises(ContractError):
        ft.update(spark, table, people(spark, [1], 1.0), contract=ENTITY)
    with pytest.raises(DuplicateKeyError):
        ft.replace_rows(people(spark, [1, 1]), table.base)
    assert ft.open_table(spark, table.base) == ft.open_table(spark, table.base)
    assert ft.open_table(spark, table.base).version == table.version
    assert ft.update(spark, table, people(spark, [])) == table


def test_of_two_changes_of_one_version_the_second_is_told(spark, table):
    ft.insert(spark, table, people(spark, [2000]))
    with pytest.raises(PublishConflictError):
        ft.insert(spark, table, people(spark, [2001]))
    assert ft.open_table(spark, table.base).read(spark).where("employee_id > 1000").count() == 1


def test_created_once_and_never_emptied(spark, tmp_path):
    base = f"{tmp_path}/new"
    assert ft.open_table(spark, base) is None
    empty = ft.create_if_missing(spark, base)
    assert empty.read(spark).columns == ROSTER_SCHEMA.names and empty.read(spark).count() == 0
    assert ft.find(spark, empty, people(spark, [1])).count() == 0
    filled = ft.insert(spark, empty, people(spark, [1, 2]))
    assert ft.create_if_missing(spark, base).version == filled.version
    all_gone = ft.delete(spark, filled, people(spark, [1, 2]))
    assert all_gone.files == () and all_gone.read(spark).count() == 0


def test_what_was_checked_is_not_checked_again(spark, table, monkeypatch):
    assert ft.read_checked(spark, table, ENTITY).count() == 1000
    looked = []
    real = ft._broken

    def watched(spark, table, files, rule):
        looked.append(len(files))
        return real(spark, table, files, rule)

    monkeypatch.setattr(ft, "_broken", watched)
    assert ft.read_checked(spark, table, ENTITY).count() == 1000 and looked == []
    # A change that the table allows and the entity does not: only its file is looked at.
    worse = ft.update(spark, table, people(spark, [1], 1.0), contract=TABLE)
    with pytest.raises(ContractError, match="1: .*salary"):
        ft.read_checked(spark, worse, ENTITY)
    assert set(looked) == {1}
    assert ft.read_checked(spark, worse, ENTITY, "quarantine").count() == 999
    assert [(r["employee_id"], r["reasons"]) for r in ft.violations(spark, worse, ENTITY).collect()] == [(1, ["salary"])]
    # Another contract is another check.
    looked.clear()
    assert ft.read_checked(spark, worse, TABLE).count() == 1000 and looked == [len(worse.files)]
    with pytest.raises(ValueError):
        ft.read_checked(spark, worse, TABLE, "ignore")


def test_updates_in_order_and_null_keys(spark, table):
    twice = people(spark, [1, 1]).withColumn("salary", F.monotonically_increasing_id().cast("double") + 70000)
    twice = twice.withColumn("at", F.col("salary"))
    new = ft.update(spark, table, twice, order="at")
    highest = twice.agg(F.max("salary")).first()[0]
    assert ft.find(spark, new, [1]).first()["salary"] == highest
