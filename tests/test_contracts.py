"""Contract rules, splits and the traps around them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from musterline.errors import ContractError
from musterline.functions.text import (
    parse_date,
    parse_integer,
    parse_number,
    strip,
    valid_date,
    valid_date_shape,
    valid_email,
)
from musterline.operators.contracts import (
    ENTITY,
    FRAME,
    TABLE,
    annotate,
    assert_contract,
    first_violation,
    quarantine_summary,
    split,
    split_counts,
    standardise,
    write_split,
)
from musterline.operators.records import typed_from_text

TEXT = (
    "employee_id string, name string, department string, designation string, salary string, "
    "joining_date string, performance_score string, ordinal bigint"
)


def texts(spark, *rows):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], TEXT)


def evaluate(spark, function, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[1] for row in rows.select("i", function(F.col("v"))).orderBy("i").collect()]


@pytest.fixture
def six_rows(spark):
    return texts(
        spark,
        ("1001", "A", "HR", "Manager", "50000", "2024-01-01", "4"),
        ("1001", "A", "HR", "Manager", "50000", "2024-01-01", "4"),
        ("1002", "B", "Engineering", "Lead", "-1000", "2024-01-02", "3"),
        ("1003", "C", "InvalidDept", "Lead", "80000", "2024-01-03", "4"),
        ("1004", "D", "Sales", "Lead", "75000", "12/12/2024", "3"),
        ("1005", "E", "Marketing", "Lead", "60000", "2024-01-05", "5"),
    )


def reasons(frame):
    return {row["ordinal"]: row["reasons"] for row in frame.collect()}


def test_email(spark):
    values = [
        "john@company.com",
        "jane.doe-work@company.co.in",
        "  ä_ö@firma.de\t",
        "info.company.com",
        "info@com",
        None,
    ]
    assert evaluate(spark, valid_email, values) == [True, True, True, False, False, False]


def test_date_rules_differ(spark):
    values = ["2024-05-15", "1999-12-31", "2024-99-99", "2024-5-1", "15-05-2024", "2024/05/15", "x", None]
    assert evaluate(spark, valid_date_shape, values) == [True] * 3 + [False] * 5
    assert evaluate(spark, valid_date, values) == [True, True, False, True] + [False] * 4
    assert evaluate(spark, valid_date, ["0000-01-01", "12024-01-01", "2023-02-29", " 2024-02-29\n"]) == [
        False, False, False, True,
    ]
    assert str(evaluate(spark, parse_date, ["2024-5-1"])[0]) == "2024-05-01"


def test_guarded_numbers(spark):
    values = ["5d", "1_000", " +7 ", "nan", "inf", "5.0", "1e3", ".5", "", None, "1__0", "0x10"]
    assert evaluate(spark, parse_integer, values) == [
        None, 1000, 7, None, None, None, None, None, None, None, None, None,
    ]
    assert evaluate(spark, parse_number, values) == [
        None, 1000.0, 7.0, None, None, 5.0, 1000.0, 0.5, None, None, None, None,
    ]
    plain = evaluate(spark, lambda c: parse_number(c, digit_groups=False), ["1_000", "12.5", "5."])
    assert plain == [None, 12.5, 5.0]
    assert evaluate(spark, parse_integer, ["99999999999999999999"]) == [None]


def test_strip_removes_all_white_space(spark):
    assert evaluate(spark, strip, ["  a b \x1f"]) == ["a b"]


def test_split_of_six_rows(six_rows):
    annotated = annotate(six_rows, FRAME)
    assert reasons(annotated) == {
        0: [],
        1: ["duplicate"],
        2: ["salary"],
        3: ["department"],
        4: ["joining_date"],
        5: [],
    }
    clean, quarantined = split(annotated)
    assert (clean.count(), quarantined.count()) == (2, 4)
    assert split_counts(annotated).first() == (6, 2, 4)
    assert {tuple(r) for r in quarantine_summary(annotated).collect()} == {
        ("duplicate", 1), ("salary", 1), ("department", 1), ("joining_date", 1),
    }
    typed = standardise(clean).orderBy("ordinal").first()
    assert (typed["employee_id"], typed["salary"], typed["performance_score"]) == (1001, 50000.0, 4)
    assert typed["joining_date"] == "2024-01-01"


def test_invalid_first_row_uses_up_the_key(spark):
    rows = texts(
        spark,
        ("1", "A", "HR", "M", "1", "2024-01-01", "4"),
        ("1", "A", "HR", "M", "50000", "2024-01-01", "4"),
        ("01", "A", "HR", "M", "50000", "2024-01-01", "4"),
    )
    assert reasons(annotate(rows, FRAME)) == {0: ["salary"], 1: ["duplicate"], 2: ["duplicate"]}


def test_nulls_quarantine_and_lose_no_row(spark):
    rows = texts(
        spark,
        (None, None, None, None, None, None, None),
        (None, "A", "HR", "M", "50000", "2024-01-01", "4"),
        ("abc", "A", "HR", "M", "nan", "2024-01-01", "3.7"),
        ("4", "A", "HR", "M", "300000", "2024-99-99", "3.7"),
    )
    for contract in (FRAME, ENTITY, TABLE):
        annotated = annotate(rows, contract)
        clean, quarantined = split(annotated)
        assert clean.count() + quarantined.count() == 4
    found = reasons(annotate(rows, FRAME))
    assert found[0] == ["id", "department", "salary", "joining_date", "performance_score"]
    assert found[1] == ["id"]
    assert found[2] == ["id", "salary"]
    assert found[3] == []
    clean, _ = split(annotate(rows, FRAME))
    assert standardise(clean).first()["performance_score"] == 3


def test_entity_contract_field_by_field(spark):
    good = ("1", "Ann", " HR ", "Lead", "15000", "2024-5-1", "1")
    bad = [
        (0, "-5", "id"),
        (1, "  \t", "name"),
        (2, "R&D", "department"),
        (3, " ", "designation"),
        (4, "12000", "salary"),
        (4, "350000", "salary"),
        (4, "nan", "salary"),
        (5, "15/06/2025", "joining_date"),
        (6, "6", "performance_score"),
        (6, "3.7", "performance_score"),
    ]
    rows = [good] + [tuple(value if i == at else v for i, v in enumerate(good)) for at, value, _ in bad]
    found = reasons(annotate(texts(spark, *rows), ENTITY))
    assert found[0] == []
    assert [found[i + 1] for i in range(len(bad))] == [[code] for _, _, code in bad]


def test_first_violation_follows_declaration_order(spark):
    rows = texts(
        spark,
        ("1", "", "R&D", "Lead", "1", "x", "9"),
        ("1", "Ann", "HR", "Lead", "20000", "2024-01-01", "9"),
        ("1", "Ann", "HR", "Lead", "20000", "2024-01-01", "5"),
    )
    found = first_violation(rows, ENTITY).orderBy("ordinal").collect()
    assert [(r["violation"], r["violating_value"]) for r in found] == [
        ("name", ""), ("performance_score", "9"), (None, None),
    ]


def test_table_contract_accepts_what_entity_refuses(roster):
    rows = roster((1, "R&D", "Lead", 0, "2024-01-01", 1), (2, "HR", "Lead", -1, "2024-01-01", 6))
    assert reasons(annotate(rows, TABLE)) == {0: [], 1: ["salary", "performance_score"]}
    with pytest.raises(ContractError, match="department"):
        assert_contract(rows, ENTITY)
    fine = roster((1, "HR", "Lead", 20000, "2024-01-01", 1))
    assert assert_contract(fine, ENTITY) is fine


def test_infinite_salary_breaks_a_contract_without_upper_bound(roster):
    rows = roster((1, "HR", "L", float("inf"), "2024-01-01", 1), (2, "HR", "L", float("nan"), "2024-01-01", 1))
    assert reasons(annotate(rows, TABLE)) == {0: ["salary"], 1: ["salary"]}


def test_typed_records_tell_missing_from_wrong(spark):
    rows = texts(spark, ("x", "A", None, "M", None, "2024-01-01", "4.0"), ("1", "A", "HR", "M", "1", "d", "4"))
    found = [r["cast_errors"] for r in typed_from_text(rows).orderBy("ordinal").collect()]
    assert found == [
        ["employee_id:type", "department:missing", "salary:missing", "performance_score:type"],
        [],
    ]


def test_empty_input_gives_two_empty_frames(six_rows):
    clean, quarantined = split(annotate(six_rows.limit(0), FRAME))
    assert clean.isEmpty() and quarantined.isEmpty()


def test_write_split_writes_each_row_once(spark, six_rows, tmp_path):
    path = str(tmp_path / "out")
    write_split(annotate(six_rows, FRAME), path)
    counts = {r["verdict"]: r["count"] for r in spark.read.parquet(path).groupBy("verdict").count().collect()}
    assert counts == {"clean": 2, "quarantine": 4}
