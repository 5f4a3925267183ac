"""Quantiles of values that one logarithmic bucket holds, and density of repeated values."""

from __future__ import annotations

import numpy as np
import pytest

from pyspark.sql import functions as F

from musterline.operators import changes
from musterline.operators.quantiles import exact_quantiles
from musterline.operators.small_side import fits_in_bytes


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_close_values_are_told_apart(spark, max_rows):
    rng = np.random.default_rng(5)
    rows = [("a", float(v)) for v in rng.uniform(0, 0.0009, 3000)]
    rows += [("b", 1.7e9 + float(v)) for v in rng.integers(0, 500, 3000)]
    rows += [("c", 7.5)] * 3000 + [(None, float(v)) for v in rng.uniform(-1e-300, 1e-300, 500)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probabilities = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = exact_quantiles(
        df, "v", probabilities, by=["g"], max_rows=max_rows, rows_per_bucket=40
    ).collect()
    assert len(found) == 4
    for row in found:
        values = [v for g, v in rows if g == row["g"]]
        np.testing.assert_allclose(
            [row[f"q{i}"] for i in range(5)], np.quantile(values, probabilities), rtol=1e-12
        )


def test_byte_bound(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 10, "s string")
    assert fits_in_bytes(df, 10) and not fits_in_bytes(df, 9)
    assert not fits_in_bytes(df, 10, max_bytes=10_000)
    assert fits_in_bytes(df.limit(0), 0)


def test_offers_are_judged_one_by_one(spark):
    schema = (
        "offer int, employee_id int, name string, department string, designation string,"
        "salary double, joining_date date, performance_score int"
    )
    import datetime as dt

    def row(offer, key, salary=1.0, name="n"):
        return (offer, key, name, "d", "x", salary, dt.date(2024, 1, 1), 3)

    table = spark.createDataFrame([row(0, 1)], schema)
    batch = spark.createDataFrame(
        [
            row(1, 1), row(2, 1), row(3, 2, salary=-1.0), row(4, 2), row(5, 2), row(6, None),
            row(7, None), row(8, 3, name=None), row(9, 4, salary=float("nan")),
        ],
        schema,
    )
    checked = changes.checked_offers(table, batch, "offer").collect()
    assert {r["offer"]: r["reasons"] for r in checked} == {
        1: ["present"], 2: ["duplicate", "present"], 3: ["salary"], 4: [], 5: ["duplicate"],
        6: ["id"], 7: ["id"], 8: ["name"], 9: ["salary"],
    }
    assert changes.checked_offers(table, batch.limit(0), "offer").isEmpty()


def test_approximate_quantiles_state_their_rank(spark):
    from musterline.operators.quantiles import approximate_quantiles, rank_distances

    rows = spark.range(0, 40_000, 1, 7).select(
        F.when(F.col("id") % 2 == 0, "even").alias("g"),
        F.when(F.col("id") % 11 == 0, float("nan")).when(F.col("id") % 13 != 0, F.log(F.col("id") + 1)).alias("x"),
    )
    rows = rows.unionByName(spark.createDataFrame([("alone", 5.0), ("none", None)], "g string, x double"))
    ps, names = [0.0, 0.25, 0.5, 0.99, 1.0], ["low", "q1", "median", "p99", "high"]
    near = approximate_quantiles(rows, "x", ps, ["g"], names, rank_error=0.01)
    assert {(r["g"], r["median"]) for r in near.collect()} >= {("alone", 5.0), ("none", None)}
    found = rank_distances(rows, "x", near, ps, names, ["g"]).collect()
    assert {r["g"] for r in found} == {"even", None, "alone"}
    assert all(r["distance"] <= 0.01 * r["n"] + 1 for r in found)
    # An answer that is not there is told apart.
    wrong = near.withColumn("median", F.col("q1"))
    assert max(r["distance"] / r["n"] for r in rank_distances(rows, "x", wrong, ps, names, ["g"]).collect()) > 0.2


def test_density_of_continuous_values_is_exact_to_many_digits(spark):
    import numpy as np

    from musterline.operators.distributions import density

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 3000), rng.exponential(5, 500), [400.0]])
    rows = spark.createDataFrame([("g", float(v)) for v in x], "g string, x double")
    h = x.std(ddof=1) * len(x) ** -0.2
    found = density(rows, "g", "x", 50).orderBy("point").collect()
    at = np.array([r["at"] for r in found])
    expected = np.exp(-0.5 * ((at[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.abs(np.array([r["density"] for r in found]) - expected).max() < 1e-13 / h
