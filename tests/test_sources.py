"""Files, payloads, feeds, snapshots and the whole run."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from musterline.errors import ContractError, DuplicateKeyError, PayloadError, SourceError
from musterline.fixed_values import DEFAULT_USERS, ROSTER_HEADER
from musterline.model import SNAKE, USER_SCHEMA
from musterline.operators.contracts import FRAME, annotate, split
from musterline.operators.flatten import flatten_users, rejected_users, roster_from_users
from musterline.plans.daily_run import datasets, publish_roster, write_datasets
from musterline.session import written
from musterline.sources import payloads, roster_files, snapshots

HEADER = ",".join(ROSTER_HEADER)


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def user(key, name="Alice Cooper", **company):
    entry = {"id": key, "name": name}
    if company:
        entry["company"] = company
    return entry


def users_frame(spark, *entries):
    rows = spark.createDataFrame([(json.dumps(e),) for e in entries], "value string")
    return rows.select(F.from_json("value", USER_SCHEMA).alias("u")).select("u.*")


def test_csv_rows_are_checked_not_dropped(spark, tmp_path):
    path = write(
        tmp_path / "r.csv",
        HEADER,
        '1,"Ann ""A"" Lee, Jr.",HR,Lead,20000.5,2024-01-01,4',
        "2,Bob,HR,Lead,20000",
        "x,Cid,HR,Lead,20000,2024-01-01,4",
        "3,Dan,HR,Lead,20000,2024-01-01,4,extra",
        "",
    )
    checked = roster_files.read_checked_csv(spark, path)
    clean, bad = split(checked)
    assert [r["Name"] for r in clean.orderBy("Ordinal").collect()] == ['Ann "A" Lee, Jr.', "Dan"]
    assert {r["EmployeeID"]: r["reasons"] for r in bad.collect()} == {
        "2": ["joining_date", "performance_score"], "x": ["id"],
    }
    assert roster_files.file_headcount(spark, path).first()[0] == 4


def test_csv_columns_go_by_header_name(spark, tmp_path):
    path = write(tmp_path / "r.csv", "Name,EmployeeID,Salary", "Ann,1,20000")
    row = roster_files.read_raw_csv(spark, path).first()
    assert (row["EmployeeID"], row["Name"], row["Department"]) == ("1", "Ann", None)


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "r.csv", HEADER, '1,"Ann\nLee",HR,Lead,20000,2024-01-01,4', "2,Bob,HR,Lead,20000,2024-01-01,4")
    rows = roster_files.read_checked_csv(spark, path, multiline=True).orderBy("Ordinal").collect()
    assert [(r["Name"], r["reasons"]) for r in rows] == [("Ann\nLee", []), ("Bob", [])]


def test_checked_csv_with_duplicates(spark, tmp_path):
    line = "1,Ann,HR,Lead,20000,2024-01-01,4"
    path = write(tmp_path / "r.csv", HEADER, line, line.replace("1,Ann", "01,Other"), line)
    rows = roster_files.read_checked_csv(spark, path, FRAME).orderBy("Ordinal").collect()
    assert [(r["Name"], r["reasons"]) for r in rows] == [
        ("Ann", []), ("Other", ["duplicate"]), ("Ann", ["duplicate"]),
    ]


def test_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", "EmployeeID,Name", "1,Ann")
    write(tmp_path / "in" / "b.csv", "Name,EmployeeID", "Bob,2")
    with pytest.raises(Exception, match="(?i)header"):
        roster_files.read_raw_csv(spark, str(tmp_path / "in")).collect()


def test_missing_csv_is_empty(spark, tmp_path):
    path = str(tmp_path / "none.csv")
    assert roster_files.read_checked_csv(spark, path).isEmpty()
    assert roster_files.file_headcount(spark, path).first()[0] == 0


def test_input_order_survives_splits_and_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [f"{i % 50},N{i},HR,Lead,20000,2024-01-01,4" for i in range(4000)]
    write(tmp_path / "in" / "a.csv", HEADER, *lines[:1000])
    write(tmp_path / "in" / "b.csv", HEADER, *lines[1000:])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        raw = roster_files.read_raw_csv(spark, str(tmp_path / "in"))
        assert raw.select(F.spark_partition_id()).distinct().count() > 4
        names = [r["Name"] for r in raw.orderBy("Ordinal").collect()]
        clean, bad = split(annotate(raw, FRAME.using(columns=roster_files.PASCAL)))
        firsts = sorted(r["Name"] for r in clean.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert names == [f"N{i}" for i in range(4000)]
    # Key 0 is no legal id; of all others the first row stays.
    assert firsts == sorted(f"N{i}" for i in range(1, 50))


def test_csv_export_round_trip(spark, roster, tmp_path):
    path = str(tmp_path / "out")
    roster_files.write_csv(roster((7, "HR", "Lead", 20000.5, "2024-01-01", 4), names=['A "q", b']), path)
    row = roster_files.read_raw_csv(spark, path).first()
    assert tuple(row)[:7] == ("7", 'A "q", b', "HR", "Lead", "20000.50", "2024-01-01", "4")


def test_fallback_order(spark, roster, tmp_path):
    full = roster((7, "HR", "Lead", 1, "2024-01-01", 4))
    missing = lambda: roster_files.read_table(spark, str(tmp_path / "none"))
    chosen = roster_files.first_available([missing, lambda: full.limit(0), lambda: full])
    assert chosen.count() == 1
    with pytest.raises(SourceError, match="PATH_NOT_FOUND"):
        roster_files.first_available([missing])


def test_payload_must_be_an_array(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    write(folder / "good.json", json.dumps([user(1), user(2)], indent=1))
    assert payloads.read_payloads(spark, str(folder)).count() == 2
    write(folder / "object.json", json.dumps(user(3)))
    write(folder / "cut.json", json.dumps([user(4)])[:-3])
    with pytest.raises(PayloadError, match="object.json|cut.json"):
        payloads.read_payloads(spark, str(folder))
    assert payloads.read_payloads(spark, str(folder), on_corrupt="quarantine").count() == 2
    bad = payloads.corrupt_payloads(spark, str(folder)).collect()
    assert sorted(r["file"].rsplit("/", 1)[1] for r in bad) == ["cut.json", "object.json"]


def test_payload_forms_agree(spark, tmp_path):
    entries = [user(1, bs="a"), user("2"), user(3, None)]
    lines = write(tmp_path / "lines.json", *[json.dumps(e) for e in entries])
    arrays = write(tmp_path / "arrays.json", json.dumps(entries[:2]), json.dumps(entries[2:]))
    a = payloads.read_payload_lines(spark, lines)
    b = payloads.read_payloads(spark, arrays, one_per_line=True)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_default_users(spark, tmp_path):
    rows = payloads.users_or_default(spark, str(tmp_path / "none")).collect()
    assert [r["name"] for r in rows] == [u["name"] for u in DEFAULT_USERS]
    assert rows[0]["name"] == "Leanne Graham" and rows[4]["address"]["geo"]["lat"] == "-31.8129"
    flat = {r["employee_id"]: r for r in roster_from_users(payloads.default_users(spark)).collect()}
    assert flat[2003]["designation"] == "E-enable" and flat[2005]["department"] == "HR"


def test_flatten(spark):
    entries = users_frame(
        spark,
        user(1, "Alice Cooper", bs="develop software features"),
        user(2, " Bob Marley", bs="SYNERGIZE corporate campaigns"),
        user("26", bs=""),
        user(5, bs="a b"),
        user(6),
        user(-1, bs="x"),
        user(-2001, bs="longer"),
    )
    rows = {r["employee_id"]: tuple(r)[1:] for r in roster_from_users(entries).collect()}
    date = dt.date
    assert rows == {
        2001: ("Alice Cooper", "Engineering", "Develop", 50000.0, date(2024, 2, 2), 2),
        2002: ("Bob Marley", "Finance", "Synergize", 60000.0, date(2024, 3, 3), 3),
        2026: ("Alice Cooper", "Engineering", "Associate", 300000.0, date(2024, 3, 27), 2),
        2005: ("Alice Cooper", "HR", "Associate", 90000.0, date(2024, 6, 6), 1),
        2006: ("Alice Cooper", "Engineering", "Associate", 100000.0, date(2024, 7, 7), 2),
        1999: ("Alice Cooper", "Marketing", "Associate", 30000.0, date(2024, 12, 28), 5),
    }


def test_flatten_rejects(spark):
    entries = users_frame(spark, user(27), user("abc"), user(None), user(1, None), user(1, "  "))
    found = [r["reasons"] for r in rejected_users(entries).collect()]
    unusable = ["id", "department", "salary", "joining_date", "performance_score"]
    assert found == [["salary"], unusable, unusable, ["name"], ["name"]]
    assert roster_from_users(entries).isEmpty()


def test_feeds(spark):
    landed = spark.createDataFrame(
        [("Weather", '{"t": 1}', 1), ("Weather", '{"t": 2}', 2), ("Noise", "{}", 3), ("Time", None, 4)],
        "feed string, data string, at int",
    )
    rows = payloads.resolve_feeds(landed, ["Weather", "Holidays", "Time", "Other"], epoch=9, order="at")
    found = {r["feed"]: (r["status"], json.loads(r["data"])) for r in rows.collect()}
    assert found == {
        "Weather": ("success", {"t": 2}),
        "Holidays": ("fallback", {"upcoming_holidays_count": 3, "next_holiday": "Republic Day"}),
        "Time": ("fallback", {"timezone": "Asia/Kolkata", "dst": False, "epoch": 9}),
        "Other": ("fallback", {}),
    }
    assert payloads.resolve_feeds(landed.limit(0)).where("status = 'fallback'").count() == 3


def test_reload_publishes_only_what_is_whole(roster, spark, tmp_path):
    base = str(tmp_path / "table")
    assert snapshots.current_snapshot(spark, base) is None
    first = roster((1, "HR", "x", 1, "2024-01-01", 1), (2, "IT", "x", 1, "2024-01-01", 1))
    rows, seconds = snapshots.full_reload(first, base, cluster_by="department")
    assert rows == 2 and seconds > 0
    assert snapshots.full_reload(first.limit(0), base) == (0, 0.0)
    assert snapshots.current_snapshot(spark, base).count() == 2
    with pytest.raises(DuplicateKeyError, match="1"):
        snapshots.full_reload(first.union(first), base)
    broken = first.withColumn("salary", F.raise_error(F.lit("disk gone")).cast("double"))
    with pytest.raises(Exception, match="disk gone"):
        snapshots.full_reload(broken, base)
    assert snapshots.current_snapshot(spark, base).count() == 2
    assert snapshots.full_reload(first.limit(1), base)[0] == 1
    assert snapshots.current_snapshot(spark, base).count() == 1


def test_written_frame_keeps_schema(spark):
    df = spark.range(5).withColumn("s", F.struct("id"))
    again = written(df)
    assert again.schema.simpleString() == df.schema.simpleString() and again.count() == 5


def test_empty_roster_has_the_schema(spark):
    assert roster_files.empty_roster(spark).columns == list(SNAKE.base)
    renamed = roster_files.rename_to_report_columns(roster_files.empty_roster(spark))
    assert renamed.columns == list(ROSTER_HEADER)


def test_whole_run(spark, tmp_path):
    csv = write(
        tmp_path / "r.csv",
        HEADER,
        "1001,John Doe,Engineering,Lead,120000,2023-05-15,4",
        "1002,Jane Roe,HR,Manager,90000,2024-02-10,5",
        "1003,Bad Row,Nowhere,Manager,90000,2024-02-10,5",
    )
    landing = tmp_path / "landing"
    landing.mkdir()
    write(landing / "p.json", json.dumps([user(1, bs="develop software features"), user(40)]))
    result = publish_roster(spark, csv, str(landing), str(tmp_path / "table"))
    assert result.rows == 3
    assert (result.rejected_rows.count(), result.rejected_users.count()) == (1, 1)
    frames = datasets(result.cleaned, result.roster)
    kpi = frames["kpis"].first()
    assert (kpi["Headcount"], kpi["TotalSalaryExpense"]) == (3, 260000.0)
    write_datasets(frames, str(tmp_path / "out"))
    for name in frames:
        assert (tmp_path / "out" / name / "_SUCCESS").exists()
    assert len({name[:8] for name in frames if name.startswith("chart")}) == 16
    # A second run replaces the table, it does not add to it.
    assert publish_roster(spark, csv, str(tmp_path / "none"), str(tmp_path / "table")).rows == 7


def test_run_with_repeated_keys(spark, tmp_path):
    line = "1001,John Doe,Engineering,Lead,120000,2023-05-15,4"
    csv = write(tmp_path / "r.csv", HEADER, line, line.replace("John", "Other"))
    base, none = str(tmp_path / "table"), str(tmp_path / "none")
    with pytest.raises(DuplicateKeyError, match="1001"):
        publish_roster(spark, csv, none, base)
    assert snapshots.current_snapshot(spark, base) is None
    result = publish_roster(spark, csv, none, base, on_conflict="keep_first")
    assert result.rows == 6
    assert result.roster.where("employee_id = 1001").first()["name"] == "John Doe"


def test_the_order_of_file_rows_is_one_number(spark, tmp_path):
    from musterline.operators import dedup
    from musterline.session import written
    from musterline.sources import roster_files

    folder = tmp_path / "many"
    folder.mkdir()
    expected = []
    for name in ("b", "a", "c"):
        lines = [f"{i % 7},{name}{i},HR,x,50000,2024-01-01,3" for i in range(40)]
        (folder / f"{name}.csv").write_text(",".join(roster_files.PASCAL.base) + "\n" + "\n".join(lines) + "\n")
    for name in "abc":
        expected += [f"{name}{i}" for i in range(40)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")  # several blocks a file
    try:
        stored = written(roster_files.read_raw_csv(spark, str(folder)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for most in (1000, 1):  # broadcast places, and joined ones
        rows = roster_files.with_dense_order(stored, max_places=most)
        assert rows.schema["Ordinal"].dataType.simpleString() == "bigint"
        assert [r["Name"] for r in rows.orderBy("Ordinal").collect()] == expected
    marked = dedup.mark_duplicates(rows, "EmployeeID", "Ordinal", max_rows=0)
    assert "SortAggregate" not in marked._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["Name"] for r in marked.where("not is_duplicate").collect()) == [f"a{i}" for i in range(7)]
