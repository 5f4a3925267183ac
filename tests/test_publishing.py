"""Replaced exports, clustered files, version ties, and which of two users with one id stays."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from musterline.errors import ContractError, PublishConflictError
from musterline.fixed_values import ROSTER_HEADER
from musterline.operators.contracts import TABLE
from musterline.plans.daily_run import publish_roster
from musterline.sources import payloads, snapshots

SCHEMA = (
    "employee_id bigint, name string, department string, designation string,"
    "salary double, joining_date date, performance_score int"
)


def people(spark, *rows):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(k, n, d, "x", s, day, 3) for k, n, d, s in rows], SCHEMA)


def test_an_export_is_replaced_and_keeps_blanks(spark, tmp_path):
    base = f"{tmp_path}/export"
    assert snapshots.current_csv(spark, base) is None
    snapshots.publish_csv(people(spark, (1, "old", "HR", 1.0), (2, "old", "HR", 1.0)), base)
    assert snapshots.publish_csv(people(spark, (3, "  padded ", "HR", 1.0)), base) == 1
    assert [r["Name"] for r in snapshots.current_csv(spark, base).collect()] == ["  padded "]


def test_clustered_files_cover_few_values(spark, tmp_path):
    base = f"{tmp_path}/table"
    rows = spark.range(0, 4000, 1, 8).select(
        F.col("id").alias("employee_id"), F.concat(F.lit("d"), F.col("id") % 4).alias("department")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        snapshots.full_reload(rows, base, cluster_by="department")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = snapshots.current_snapshot(spark, base).groupBy(F.input_file_name()).agg(
        F.countDistinct("department").alias("n")
    )
    counts = [r["n"] for r in files.collect()]
    assert len(counts) > 2 and max(counts) <= 2


def test_the_later_of_two_publishers_is_told(spark, tmp_path, monkeypatch):
    base = f"{tmp_path}/table"
    rows = people(spark, (1, "a", "HR", 1.0))
    snapshots.full_reload(rows, base)
    seen = snapshots._ledger(spark, base).where("false")
    real, calls = snapshots._ledger, []

    def stale(*args):  # the second publisher read the ledger before the first one wrote to it
        calls.append(args)
        return seen if len(calls) == 1 else real(*args)

    monkeypatch.setattr(snapshots, "_ledger", stale)
    with pytest.raises(PublishConflictError):
        snapshots.full_reload(people(spark, (2, "b", "HR", 1.0)), base)
    assert [r["employee_id"] for r in snapshots.current_snapshot(spark, base).collect()] == [1]


def test_losers_of_a_conflict_are_listed(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    users = [{"id": 1, "name": "First"}, {"id": 1, "name": "Second"}, {"id": 2, "name": "Held"}, {"id": "x", "name": "Bad"}]
    (landing / "a.json").write_text(json.dumps(users))
    csv = tmp_path / "r.csv"
    line = "{},{},HR,Analyst,50000,2024-01-01,3\n"
    csv.write_text(",".join(ROSTER_HEADER) + "\n" + line.format(2002, "Ann") + line.format(1, "Bob") + line.format("01", "Late") + line.format("z", "No"))
    run = publish_roster(spark, str(csv), str(landing), f"{tmp_path}/t", on_conflict="quarantine")
    assert sorted(r["name"] for r in run.roster.collect()) == ["Ann", "Bob", "First"]
    assert sorted((r["Name"], *r["reasons"]) for r in run.rejected_rows.collect()) == [("Late", "duplicate"), ("No", "id")]
    found = {r["name"]: r["reasons"] for r in run.rejected_users.collect()}
    assert found["Second"] == ["duplicate"] and found["Held"] == ["present"] and "Bad" in found and len(found) == 3
    with pytest.raises(ValueError):
        publish_roster(spark, str(csv), str(landing), f"{tmp_path}/t", on_conflict="ignore")


def test_of_publishers_at_once_one_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from musterline.sources import folders

    mark = f"{tmp_path}/claims/1"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: folders.claim(spark, mark, f"job {i}"), range(8)))
    assert won.count(True) == 1 and folders.read_mark(spark, mark) == f"job {won.index(True)}"
    assert folders.read_mark(spark, f"{tmp_path}/none") is None and folders.children(spark, f"{tmp_path}/none") == []

    base = f"{tmp_path}/table"

    def publish(i):
        try:
            return snapshots.full_reload(people(spark, (i, "a", "HR", 1.0)), base)[0]
        except PublishConflictError:
            return None

    with ThreadPoolExecutor(3) as pool:
        rows = list(pool.map(publish, range(3)))
    versions = [r["version"] for r in snapshots._ledger(spark, base).collect()]
    assert len(versions) == len(set(versions)) == rows.count(1) >= 1
    assert snapshots.current_snapshot(spark, base).count() == 1


def test_a_claim_that_was_given_up_is_passed_over(spark, tmp_path):
    from musterline.sources import folders

    base = f"{tmp_path}/table"
    assert folders.claim(spark, f"{base}/claims/1", "crashed")
    with pytest.raises(PublishConflictError):
        snapshots._enter(spark, base, "mine", 1)
    assert snapshots._enter(spark, base, "mine", 1, grace=0.0) == 2
    with pytest.raises(PublishConflictError):
        snapshots._enter(spark, base, "later", 1, after=1)


def test_a_contract_guards_the_reload(spark, tmp_path):
    with pytest.raises(ContractError):
        snapshots.full_reload(people(spark, (1, "a", "HR", -1.0)), f"{tmp_path}/t", contract=TABLE)
    assert snapshots.current_snapshot(spark, f"{tmp_path}/t") is None


def test_the_user_read_first_stays(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    arrays = [[{"id": 1, "name": "First One"}, {"id": 1, "name": "Second One"}], [{"id": 1, "name": "Third One"}]]
    (landing / "a.json").write_text("\n".join(map(json.dumps, [*arrays, "no array"])) + "\n")
    csv = tmp_path / "r.csv"
    csv.write_text(",".join(ROSTER_HEADER) + "\n1,Ann Lee,HR,Analyst,50000,2024-01-01,3\n")
    run = publish_roster(
        spark, str(csv), str(landing), f"{tmp_path}/t", on_conflict="keep_first",
        on_corrupt="quarantine", one_per_line=True,
    )
    assert sorted(r["name"] for r in run.roster.collect()) == ["Ann Lee", "First One"]
    assert "__place" not in run.rejected_users.columns
    placed = payloads.default_users(spark, "p")
    assert [r["p"]["position"] for r in placed.orderBy("p").collect()] == [0, 1, 2, 3, 4]
