"""Keyed changes and searches."""

from __future__ import annotations

import pytest

from musterline.errors import DuplicateKeyError, MissingKeyError
from musterline.operators import changes, search


def person(key, name="Alice Sharma", department="Engineering", salary=75000.0):
    return (key, department, "Lead", salary, "2024-01-01", 4), name


def build(roster, *people):
    return roster(*[p[0] for p in people], names=[p[1] for p in people]).drop("ordinal")


def ids(df):
    return sorted(r["employee_id"] for r in df.collect())


def test_insert_update_delete(roster):
    table = build(roster, person(1001))
    changed = build(roster, person(1001, "Alice Smith", salary=95000.0))
    updated = changes.update_rows(table, changed).first()
    assert (updated["name"], updated["salary"]) == ("Alice Smith", 95000.0)
    assert changes.delete_rows(table, table.select("employee_id")).isEmpty()


def test_batch_is_all_or_nothing(roster):
    table = build(roster, person(1001))
    assert ids(changes.insert_batch(table, build(roster, person(1002), person(1003)))) == [1001, 1002, 1003]
    with pytest.raises(DuplicateKeyError, match="1001"):
        changes.insert_batch(table, build(roster, person(1002), person(1001)))
    with pytest.raises(DuplicateKeyError, match="1002"):
        changes.insert_batch(table, build(roster, person(1002), person(1002)))
    assert ids(changes.insert_batch(table, table.limit(0))) == [1001]
    assert ids(changes.new_rows(table, build(roster, person(1001), person(1002)))) == [1002]


def test_conflicts_name_the_cause(roster):
    table = build(roster, person(1), person(2))
    batch = build(roster, person(2), person(3), person(3), person(4))
    found = {tuple(r) for r in changes.batch_conflicts(table, batch).collect()}
    assert found == {(2, 1, True), (3, 2, False)}


def test_changes_to_absent_or_repeated_keys_are_errors(roster):
    table = build(roster, person(1))
    with pytest.raises(MissingKeyError, match="9"):
        changes.update_rows(table, build(roster, person(9)))
    with pytest.raises(MissingKeyError, match="9"):
        changes.delete_rows(table, build(roster, person(9), person(9)).select("employee_id"))
    with pytest.raises(DuplicateKeyError):
        changes.update_rows(table, build(roster, person(1), person(1, "Other")))
    assert ids(changes.missing_keys(table, build(roster, person(9), person(9)))) == [9]


def test_last_change_wins_by_order(roster):
    table = build(roster, person(1), person(2))
    ordered = roster(
        (1, "HR", "x", 1, "2024-01-01", 1), (1, "HR", "x", 2, "2024-01-01", 1), names=["a", "b"]
    )
    found = {r["employee_id"]: r["salary"] for r in changes.update_rows(table, ordered, order="ordinal").collect()}
    assert found == {1: 2.0, 2: 75000.0}


def test_update_can_set_null(roster):
    table = build(roster, person(1))
    changed = build(roster, ((1, "HR", "x", None, "2024-01-01", 1), "n"))
    assert changes.update_rows(table, changed).first()["salary"] is None


@pytest.fixture
def three(roster):
    return build(
        roster,
        person(1001, "Alice Sharma", "Engineering", 75000.0),
        person(1002, "Bob Patel", "Engineering", 160000.0),
        person(1003, "Charlie Das", "HR", 45000.0),
    )


def test_searches(three):
    assert ids(search.search(three, query="sharma")) == [1001]
    assert ids(search.search(three, department="Engineering")) == [1001, 1002]
    assert ids(search.search(three, department="engineering")) == []
    assert ids(search.search(three, min_salary=50000, max_salary=100000)) == [1001]
    assert ids(search.search(three, query="", department="")) == [1001, 1002, 1003]
    assert ids(search.search(three, max_salary=0)) == []
    assert ids(search.search(three, query="a", department="HR", min_salary=45000.0)) == [1003]
    assert [r["employee_id"] for r in search.search(three.repartition(3)).collect()] == [1001, 1002, 1003]


def test_wildcards_backslash_and_other_alphabets(roster):
    rows = build(roster, person(1, "a_b"), person(2, "axb"), person(3, "a\\b"), person(4, "ÉVA"))
    assert ids(search.search(rows, query="A_B")) == [1, 2, 3]
    assert ids(search.search(rows, query="a%b")) == [1, 2, 3]
    assert ids(search.search(rows, query="a\\b")) == [3]
    assert ids(search.search(rows, query="\\_")) == [3]
    assert ids(search.search(rows, query="éva")) == []  # only ASCII letters fold
    assert ids(search.search(rows, query="Éva")) == [4]


def test_lookups(spark, three, tmp_path):
    assert ids(search.find_by_key(three, 1002)) == [1002]
    assert search.find_by_key(three, 7).isEmpty()
    assert ids(search.find_by_keys(three, [1001, 1003, 7])) == [1001, 1003]
    keys = spark.createDataFrame([(1001,), (1001,), (5,)], "employee_id bigint")
    assert ids(search.find_by_keys(three, keys)) == [1001]
    path = str(tmp_path / "t")
    three.write.parquet(path)
    stored = search.search(spark.read.parquet(path), department="HR", min_salary=1.0)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(department,HR)" in plan and "GreaterThanOrEqual(salary,1.0)" in plan
    plan = search.find_by_key(spark.read.parquet(path), 3)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(employee_id,3)" in plan


def test_high_performer_flag_leaves_its_input_alone(three):
    assert search.flag_high_performers(three).first()["is_high_performer"] is True
    assert "is_high_performer" not in three.columns
