"""Indicators, summaries, quantiles and distributions against brute force."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from musterline.functions.dates import tenure_years
from musterline.functions.numbers import round_half_up, short_thousands
from musterline.model import SNAKE
from musterline.operators import distributions, growth, metrics, reports
from musterline.operators.quantiles import exact_quantiles


@pytest.fixture
def four_rows(roster):
    rows = roster(
        (1001, "HR", "Manager", 60000, "2023-01-01", 4),
        (1002, "Engineering", "Lead", 150000, "2024-06-15", 5),
        (1003, "Engineering", "Developer", 80000, "2025-03-01", 3),
        (1004, "Marketing", "Associate", 50000, "2024-11-20", 4),
    )
    return rows.withColumn(SNAKE.tenure, tenure_years(rows, SNAKE.joining_date))


def hot_values(seed=3, n=1500):
    """(group, value) rows: one group holds a third, one value a third of it; nulls and NaN."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        group = "hot" if rng.random() < 0.34 else rng.choice([None, "a", "b", "c"])
        kind = rng.random()
        if kind < 0.33:
            value = 50000.0
        elif kind < 0.4:
            value = rng.choice([None, float("nan")])
        else:
            value = round(rng.choice([-1, 1, 1, 1]) * rng.lognormvariate(8, 3), 2)
        rows.append((group, value))
    rows.append(("single", 4.0))
    return rows


def by_group(rows):
    groups = {}
    for group, value in rows:
        if value is not None and not math.isnan(value):
            groups.setdefault(group, []).append(value)
    return groups


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_exact_quantiles_against_numpy(spark, max_rows):
    rows = hot_values()
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    for partitions in (1, 4, 32):
        df = spark.createDataFrame(rows, "g string, v double").repartition(partitions)
        found = exact_quantiles(df, "v", probabilities, by=["g"], max_rows=max_rows).collect()
        expected = by_group(rows)
        assert {r["g"] for r in found} == set(expected)
        for row in found:
            values = expected[row["g"]]
            assert row["n"] == len(values)
            np.testing.assert_allclose(
                [row[f"q{i}"] for i in range(6)], np.quantile(values, probabilities), rtol=1e-12
            )
    whole = exact_quantiles(df, "v", [0.5]).first()
    everything = [v for values in expected.values() for v in values]
    assert whole["q0"] == np.median(everything)


def test_quantiles_of_extreme_magnitudes(spark):
    rng = random.Random(8)
    values = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(301)]
    values += [0.0, -0.0, 5e-324, 1.7e308, -1.7e308, 1.0, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    row = exact_quantiles(df, "v", [0.0, 1 / 307, 0.5, 100 / 307, 1.0]).first()
    ranked = sorted(values)
    assert row["n"] == 308 and row["q0"] == ranked[0] and row["q4"] == ranked[-1]
    assert row["q1"] == ranked[1] and row["q3"] == pytest.approx(ranked[100])
    assert row["q2"] == (ranked[153] + ranked[154]) / 2


def test_quantile_plan_aggregates_by_hash_and_keeps_no_group_in_one_buffer(spark):
    df = spark.createDataFrame(hot_values(), "g string, v double")
    plan = exact_quantiles(df, "v", [0.5], by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert exact_quantiles(df, "v", [0.5], by=["g"]).isEmpty()
    assert exact_quantiles(df, "v", [0.5]).isEmpty()


def test_kpis(four_rows):
    row = metrics.kpis(four_rows).first()
    assert (row["Headcount"], row["TotalSalaryExpense"], row["AverageSalary"]) == (4, 340000.0, 85000.0)
    assert (row["MedianSalary"], row["MaxSalary"], row["MinSalary"]) == (70000.0, 150000.0, 50000.0)
    assert (row["AveragePerformanceScore"], row["HighPerformersCount"]) == (4.0, 3)
    assert row["HighPerformersRatio"] == 75.0
    nested = metrics.kpis_with_top_earners(four_rows, 2).first()["Top5Earners"]
    assert [(e["EmployeeID"], e["Salary"], e["Department"]) for e in nested] == [
        (1002, 150000.0, "Engineering"), (1003, 80000.0, "Engineering"),
    ]


def test_kpis_of_nothing(four_rows):
    row = metrics.kpis(four_rows.limit(0)).first()
    assert (row["Headcount"], row["TotalSalaryExpense"], row["HighPerformersRatio"]) == (0, 0.0, 0.0)
    assert row["MedianSalary"] is None and row["AverageSalary"] is None
    tiles = metrics.dashboard_tiles(four_rows.limit(0)).first()
    assert tuple(tiles) == (0, 0.0, 0.0, 0.0)


def test_department_summary_and_total(roster):
    rows = roster(
        (1, "Engineering", "x", 100000, "2024-01-01", 1),
        (2, "Engineering", "x", 200000, "2024-01-01", 1),
        (3, "HR", "x", 60000, "2024-01-01", 1),
    )
    assert [tuple(r) for r in metrics.department_summary(rows).collect()] == [
        ("Engineering", 2, 300000.0, 150000.0, 200000.0),
        ("HR", 1, 60000.0, 60000.0, 60000.0),
    ]
    total = metrics.department_summary_with_total(rows).collect()[-1]
    # The average is that of the two department averages, not of the three salaries.
    assert tuple(total) == ("Grand Total", 3, 360000.0, 105000.0, 200000.0)


def test_null_department_is_a_group_of_the_summary_only(roster):
    rows = roster((1, None, "x", 1, "2024-01-01", 5), (2, "HR", "x", 2, "2024-01-01", 1))
    assert metrics.department_summary(rows).count() == 2
    for chart in (
        metrics.count_by(rows, "department"),
        metrics.sum_by(rows, "department", "salary"),
        metrics.mean_by(rows, "department", "salary"),
        metrics.high_performers_by(rows, "department"),
        distributions.box_stats(rows, "department", "salary"),
        distributions.density(rows, "department", "salary").where("point = 0"),
    ):
        assert [r[0] for r in chart.collect()] == ["HR"]


def test_top_earner_ties_keep_input_order(roster):
    rows = roster(*[(i, "HR", "x", 10 + (i % 2), "2024-01-01", 1) for i in range(9, 0, -1)])
    assert [r["EmployeeID"] for r in metrics.top_earners(rows.repartition(7), 6).collect()] == [
        9, 7, 5, 3, 1, 8,
    ]


def test_sums_do_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    data = [("d", round(rng.uniform(15000, 300000), 2)) for _ in range(3000)]
    df = spark.createDataFrame(data, "department string, salary double")
    results = {
        tuple(metrics.sum_by(df.repartition(p, F.rand(p)), "department", "salary").first())
        for p in (1, 4, 32)
    }
    assert results == {("d", round(sum(int(round(v * 100)) for _, v in data) / 100, 2))}


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (0.285,)], "v double")
    assert [r[0] for r in df.select(round_half_up(F.col("v"))).collect()] == [1.01, 2.68, 0.13, 0.29]


def test_score_distribution_and_pivot(roster):
    rows = roster(
        (1, "HR", "x", 1, "2024-01-01", 5),
        (2, "HR", "x", 1, "2024-01-01", 3),
        (3, "IT", "x", 1, "2024-01-01", 3),
        (4, "IT", "x", 1, "2024-01-01", None),
    )
    assert [tuple(r) for r in metrics.score_distribution(rows).collect()] == [(3, 2, 66.7), (5, 1, 33.3)]
    assert [tuple(r) for r in metrics.high_performers_by(rows, "department").collect()] == [
        ("HR", 1, 1), ("IT", 2, 0),
    ]
    assert rows.columns == [c for c in rows.columns if c != "is_high_performer"]


def test_correlation_pairs_nulls_and_constants(spark):
    rng = random.Random(2)
    rows = [
        (rng.choice([None, rng.random()]), rng.choice([None, float("nan"), rng.random()]), 1.0)
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = {(r["x"], r["y"]): r["r"] for r in metrics.correlation_matrix(df, ["a", "b", "c"]).collect()}
    pairs = [(a, b) for a, b, _ in rows if a is not None and b is not None and not math.isnan(b)]
    expected = np.corrcoef(np.array(pairs).T)[0, 1]
    assert found[("a", "b")] == found[("b", "a")] == pytest.approx(expected, abs=1e-6)
    assert found[("a", "a")] == 1.0
    assert all(found[pair] is None for pair in found if "c" in pair)


@pytest.mark.parametrize("bins", [1, 10, 15])
def test_histogram_against_numpy(spark, bins):
    rng = random.Random(bins)
    # Values on bin edges as well as between them.
    values = [float(rng.randrange(0, 151)) for _ in range(500)] + [rng.random() * 150 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    rows = distributions.histogram(df, "v", bins).collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [r["count"] for r in rows] == counts.tolist()
    np.testing.assert_allclose([r["lower_edge"] for r in rows] + [rows[-1]["upper_edge"]], edges)


def test_histogram_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    rows = distributions.histogram(df, "v", 4).collect()
    assert [r["count"] for r in rows] == np.histogram([5.0, 5.0], bins=4)[0].tolist()
    assert (rows[0]["lower_edge"], rows[-1]["upper_edge"]) == (4.5, 5.5)
    assert [r["count"] for r in distributions.histogram(df.limit(0), "v", 3).collect()] == [0, 0, 0]


def test_boxes_and_outliers_against_brute_force(spark):
    rows = hot_values(seed=11, n=800)
    df = spark.createDataFrame(rows, "g string, v double")
    groups = {g: np.array(v) for g, v in by_group(rows).items() if g is not None}
    found = {r["g"]: r for r in distributions.box_stats(df, "g", "v").collect()}
    assert set(found) == set(groups)
    outside = []
    for group, values in groups.items():
        q1, median, q3 = np.percentile(values, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        row = found[group]
        np.testing.assert_allclose([row["q1"], row["median"], row["q3"]], [q1, median, q3])
        assert row["whisker_low"] == min(values[values >= low].min(), q1)
        assert row["whisker_high"] == max(values[values <= high].max(), q3)
        far = values[(values < low) | (values > high)]
        assert row["outliers"] == len(far)
        outside += [(group, v) for v in far]
    listed = [tuple(r) for r in distributions.outliers(df, "g", "v").collect()]
    assert sorted(listed) == sorted(outside)


def test_density_against_brute_force(spark):
    rng = random.Random(4)
    rows = [("a", rng.gauss(100, 20)) for _ in range(200)] + [("b", 7.0)] * 3 + [("c", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {}
    for r in distributions.density(df, "g", "v").collect():
        found.setdefault(r["g"], {})[r["point"]] = (r["at"], r["density"])
    values = np.array([v for g, v in rows if g == "a"])
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 100)
    expected = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (
        len(values) * h * math.sqrt(2 * math.pi)
    )
    np.testing.assert_allclose([found["a"][i][0] for i in range(100)], grid)
    np.testing.assert_allclose([found["a"][i][1] for i in range(100)], expected, rtol=1e-9)
    assert all(found[g][i][1] == 1.0 for g in "bc" for i in range(100))
    stats = {r["g"]: r for r in distributions.violin_stats(df, "g", "v").collect()}
    assert stats["a"]["median"] == pytest.approx(np.median(values))
    assert (stats["b"]["n"], stats["b"]["lowest"], stats["b"]["highest"]) == (3, 7.0, 7.0)


def test_pair_counts_cover_all_points(spark):
    df = spark.createDataFrame([(float(i % 7), 5.0) for i in range(50)], "x double, y double")
    cells = distributions.pair_counts(df, "x", "y", 3, 4).collect()
    assert sum(r["points"] for r in cells) == 50
    assert {r["y_bin"] for r in cells} == {0} and {r["x_bin"] for r in cells} == {0, 1, 2}


@pytest.mark.parametrize("partitions", [1, 4, 32])
def test_cumulative_headcount(spark, partitions):
    rng = random.Random(9)
    hot = dt.date(2022, 2, 2)
    days = [hot if rng.random() < 0.4 else hot + dt.timedelta(rng.randrange(90)) for _ in range(700)]
    rows = list(enumerate(days))
    df = spark.createDataFrame(rows, "employee_id bigint, joining_date date").repartition(partitions)
    expected = {key: n for n, (key, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), 1)}
    found = growth.cumulative_headcount_rows(df).collect()
    assert {r["employee_id"]: r["cumulative_headcount"] for r in found} == expected
    daily = growth.cumulative_headcount(df).orderBy("joining_date").collect()
    assert daily[-1]["cumulative_headcount"] == 700
    assert all(r["cumulative_headcount"] == sum(d <= r["joining_date"] for d in days) for r in daily)


def test_row_numbers_come_from_many_tasks(spark):
    df = spark.range(10000).select(F.lit(1).alias("same"), "id")
    numbered = growth.number_rows(df, ["same", "id"], partitions=8)
    assert numbered.where("row_number <> id + 1").isEmpty()
    assert len(numbered.inputFiles()) == 8


def test_report_texts(spark, four_rows):
    values = [(340000.0, "340,000.0"), (10400234.7, "10,400,234.7"), (94547.59, "94,547.59"), (3.0, "3.0")]
    df = spark.createDataFrame(values, "v double, t string")
    assert df.where(short_thousands(F.col("v")) != F.col("t")).isEmpty()
    rows = reports.kpi_report(metrics.kpis(four_rows)).orderBy("position").collect()
    assert [r["value"] for r in rows[:4]] == ["4", "₹340,000.0", "₹85,000.0", "₹70,000.0"]
    assert rows[9]["value"] == "75.0%" and rows[7]["value"] == "4.0 / 5.0"


def test_pay(roster):
    row = reports.with_compensation(roster((1, "HR", "x", 100000, "2024-01-01", 1))).first()
    assert row["annual_salary"] == 1200000.0
    assert row["annual_bonus"] == pytest.approx(120000.0)
    assert row["annual_tax"] == pytest.approx(96000.0)
    assert row["net_salary"] == pytest.approx(1224000.0)
