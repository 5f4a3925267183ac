"""All registered queries against DuckDB on the smallest tables, and rules for their plans."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as spark_entry  # noqa: E402
from check_oracle import TABLES, sorted_rows  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")

# No row leaves the JVM, no pair of rows is tried, no group is gathered in a buffer.
FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "percentile",
    "collect_set",
)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(n for n in spark_entry.oracle_sql() if not n.startswith("op")))
def test_query_equals_its_sql(spark, database, name):
    df = spark_entry.queries()[name](spark, FOLDER)
    result = database.execute(spark_entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    rows = [tuple(row) for row in df.collect()]
    assert sorted_rows(df.columns, rows) == sorted_rows(names, result.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in plan] == []


def test_every_query_has_its_sql_and_rows():
    # Some corpus queries have no SQL; tests/llm hold those against brute force.
    plain = {n for n in spark_entry.queries() if not n.startswith("op") and n != "pipeline"}
    assert plain <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_the_rest_works_without_the_corpus_part(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    without = shutil.ignore_patterns("llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(f"{root}/musterline", tmp_path / "musterline", ignore=without)
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    told = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    for pipeline in (False, True):  # with the pipeline's file left behind, and without it
        if pipeline and os.path.exists(f"{root}/corpus_pipeline.py"):
            shutil.copy(f"{root}/corpus_pipeline.py", tmp_path)
        run = subprocess.run([sys.executable, "-B", "-c", told], cwd=tmp_path, capture_output=True, text=True, timeout=120)
        assert run.returncode == 0, run.stderr
        names, with_sql = (line.split() for line in run.stdout.splitlines()[-2:])
        assert names == with_sql == sorted(spark_entry.QUERIES)


def test_entry(spark):
    rows = spark_entry.entry(spark).collect()
    assert sum(row["Headcount"] for row in rows) == 1500


def test_summary_reads_only_what_it_needs(spark):
    plan = spark_entry.queries()["dept_summary"](spark, FOLDER)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    assert "SortAggregate" not in text
