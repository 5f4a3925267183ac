"""Streams give what the batch operators give on the same rows."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from musterline.errors import StreamOwnerError
from musterline.model import USER_SCHEMA
from musterline.operators.contracts import FRAME
from musterline.streaming import jobs


def land(df, folder, n):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_contract_split_over_two_batches(spark, roster, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    first = roster(
        (1, "HR", "x", 20000, "2024-01-01", 4),
        (1, "HR", "x", 20000, "2024-01-01", 4),
        (2, "HR", "x", 1, "2024-01-01", 4),
    )
    second = roster(
        (1, "HR", "x", 20000, "2024-01-01", 4),
        (2, "HR", "x", 20000, "2024-01-01", 4),
        (3, "HR", "x", 20000, "2024-01-01", 4),
    ).withColumn("ordinal", F.col("ordinal") + 10)
    for batch in (first, second):
        land(batch, source, 1)
        stream = spark.readStream.schema(first.schema).parquet(source)
        jobs.contract_split_stream(stream, FRAME, out, state).awaitTermination()
    rows = spark.read.parquet(f"{out}/rows").orderBy("ordinal").collect()
    assert [(r["ordinal"], r["verdict"], r["reasons"]) for r in rows] == [
        (0, "clean", []),
        (1, "quarantine", ["duplicate"]),
        (2, "quarantine", ["salary"]),
        (10, "quarantine", ["duplicate"]),
        (11, "quarantine", ["duplicate"]),
        (12, "clean", []),
    ]


def test_summary_keeps_state_between_runs(spark, roster, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    for batch in range(2):
        rows = roster(
            (batch, "HR", "x", 100 * (batch + 1), "2024-01-01", 4),
            (batch + 10, "IT", "x", 50, "2024-01-01", 4),
        )
        land(rows, source, 1)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        jobs.department_summary_stream(stream, out, state).awaitTermination()
    found = {tuple(r) for r in jobs.latest_summary(spark, out).collect()}
    assert found == {("HR", 2, 300.0, 150.0, 200.0), ("IT", 2, 100.0, 50.0, 50.0)}


def test_users_are_flattened_as_they_land(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    for batch in range(2):
        (tmp_path / "in" / f"{batch}.json").write_text(f'{{"id": {batch + 1}, "name": "N"}}\n{{"id": "x"}}\n')
        stream = spark.readStream.schema(USER_SCHEMA).json(source)
        jobs.flatten_stream(stream, out, state).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 4
    assert sorted(r[0] for r in rows.where(F.size("reasons") == 0).select("employee_id").collect()) == [
        2001, 2002,
    ]


def split(spark, batch, source, out, state, **more):
    land(batch, source, 1)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    jobs.contract_split_stream(stream, FRAME, out, state, **more).awaitTermination()


def verdicts(spark, out):
    rows = spark.read.parquet(f"{out}/rows").orderBy("ordinal").collect()
    return [(r["employee_id"], r["verdict"], r["reasons"]) for r in rows]


def test_later_batches_read_keys_only(spark, roster, tmp_path, monkeypatch):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    monkeypatch.setattr(jobs, "RUN", 2)  # runs of two batches are merged
    expected = []
    for epoch in range(5):
        rows = [(7, "HR", "x", 20000, "2024-01-01", 4)] + [
            (100 * epoch + i, "HR", "x", 20000, "2024-01-01", 4) for i in range(20, 40)
        ]
        batch = roster(*rows).withColumn("ordinal", F.col("ordinal") + 100 * epoch)
        split(spark, batch, source, out, state)
        expected += [(r[0], "quarantine" if epoch and r[0] == 7 else "clean", ["duplicate"] if epoch and r[0] == 7 else []) for r in rows]
        if epoch == 3:  # no earlier row is needed from here on
            kept = verdicts(spark, out)
            shutil.rmtree(f"{out}/rows")
    assert kept + verdicts(spark, out) == expected
    # Merged runs, and single batches since the last one.
    assert {"until=2", "until=4", "epoch=4"} <= {p.name for p in (tmp_path / "out" / "keys").iterdir()}


def test_a_batch_opens_the_buckets_of_its_keys(spark, roster, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    split(spark, roster(*[(i, "HR", "x", 20000, "2024-01-01", 4) for i in range(1, 500)]), source, out, state)
    ledger = jobs.KeyLedger(spark, f"{out}/keys")
    keys = ledger.bucketed(spark.createDataFrame([(3,), (3,), (None,), (9999,)], "key long"))
    assert keys.count() == 2
    known = ledger.known(keys, 1)
    assert [r["key"] for r in known.collect()] == [3]
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in scan or "PartitionFilters: [bucket" in scan
    # A replayed first batch knows nothing of itself.
    assert ledger.known(keys, 0).count() == 0


def test_a_lost_checkpoint_does_not_overwrite(spark, roster, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    batch = roster((1, "HR", "x", 20000, "2024-01-01", 4))
    split(spark, batch, source, out, state)
    before = verdicts(spark, out)
    with pytest.raises(StreamOwnerError):
        split(spark, batch, source, out, str(tmp_path / "new state"))
    assert verdicts(spark, out) == before
    split(spark, batch.withColumn("ordinal", F.lit(5).cast("long")), source, out, state)  # the owner goes on
    # The refused call had landed its rows, too: they come in now, after those of the first batch.
    assert sorted(v[1] for v in verdicts(spark, out)) == ["clean", "quarantine", "quarantine"]


def test_old_summaries_are_removed(spark, roster, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    for batch in range(4):
        rows = roster((batch, "HR", "x", 100, "2024-01-01", 4))
        land(rows, source, 1)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        jobs.department_summary_stream(stream, out, state).awaitTermination()
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["epoch=2", "epoch=3"]
    (tmp_path / "out" / "epoch=4").mkdir()  # being written
    assert [r["Headcount"] for r in jobs.latest_summary(spark, out).collect()] == [4]
