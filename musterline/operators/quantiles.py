"""Exact quantiles without collecting a group in one task.

``percentile`` and ``median`` keep every distinct value of a group in one aggregation buffer. Here
a first scan counts values per logarithmic bucket, which needs no bounds and combines on the map
side; the counts show which buckets hold the wanted ranks. While such a bucket holds too many rows
and more than one value, another scan counts its rows in equal steps between its own lowest and
highest value, so closely spaced values are told apart as well. The last scan reads only the values
of the buckets found, and combines equal values before ranking them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from musterline.functions.text import finite
from musterline.operators.small_side import (
    SMALL_ROWS,
    collect_if_small,
    join_statistics,
    null_safe_join,
)
from musterline.session import written

BUCKETS_PER_E = 1024
STEPS = 4096
# Rows that one task may rank: some 24 MB.
ROWS_PER_BUCKET = 1_000_000


def _bucket(value: Column) -> Column:
    """A bucket number that never decreases as the value grows."""
    return (
        F.signum(value) * F.floor(F.log1p(F.abs(value)) * F.lit(float(BUCKETS_PER_E)))
    ).cast("bigint")


def _wanted_ranks(n: Column, probabilities: Sequence[float]) -> Column:
    """The ranks on both sides of each probability, as (probability index, side, rank)."""
    ranks = []
    for index, p in enumerate(probabilities):
        position = (n - 1) * F.lit(float(p))
        for side, rank in ((0, F.floor(position)), (1, F.ceil(position))):
            ranks.append(
                F.struct(
                    F.lit(index).alias("index"),
                    F.lit(side).alias("side"),
                    rank.cast("bigint").alias("rank"),
                )
            )
    return F.array(*ranks)


def _step(value: Column, low: Column, high: Column) -> Column:
    """The part of low..high that ``value`` is in; the two ends never share one."""
    share = (value - low) / (high - low)
    part = F.least(F.floor(share * F.lit(float(STEPS))), F.lit(STEPS - 1))
    return F.when(high > low, part).otherwise(F.lit(0)).cast("bigint")


def _histogram(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    return values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__in_bucket"),
        F.min("__value").alias("__low"),
        F.max("__value").alias("__high"),
    )


def _holding_ranks(histogram: DataFrame, parents: Sequence[str], bucket: str) -> DataFrame:
    """The buckets that hold one of ``__ranks``, with the rows before them.

    ``__before`` counts the rows before the parent when it comes in, those before the bucket when
    it goes out.
    """
    until = Window.partitionBy(*parents).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("__before") + F.sum("__in_bucket").over(until) - F.col("__in_bucket")
    here = F.filter(
        F.col("__ranks"),
        lambda r: (r["rank"] >= F.col("__before"))
        & (r["rank"] < F.col("__before") + F.col("__in_bucket")),
    )
    found = histogram.withColumn("__before", before).withColumn("__ranks", here)
    return found.where(F.size("__ranks") > 0)


def _known(chosen: DataFrame, max_rows: int) -> tuple[DataFrame, int]:
    """``chosen`` to be used several times, and the rows of its largest bucket of several values."""
    small = collect_if_small(chosen, max_rows)
    held = small if small is not None else written(chosen)
    mixed = F.when(F.col("__low") < F.col("__high"), F.col("__in_bucket"))
    largest = held.agg(F.max(mixed)).first()[0] or 0
    return (F.broadcast(held) if small is not None else held), largest


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    max_rows: int = SMALL_ROWS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per group with linearly interpolated quantiles; nulls and NaN are ignored.

    The histogram jobs run when this is called, the rest is lazy. No task ranks more than
    ``rows_per_bucket`` different values of a group, however they are distributed. Columns: the
    groups, ``n`` and one double per probability (``names``, by default q0, q1, ...).
    """
    by = list(by)
    names = list(names or [f"q{i}" for i in range(len(probabilities))])
    values = df.select(
        *by, finite(F.col(value).cast("double")).alias("__value")
    ).where(F.col("__value").isNotNull())
    values = values.withColumn("__bucket0", _bucket(F.col("__value")))

    # At most (groups x buckets) rows; a bucket number is bounded by the range of a double.
    keys = [*by, "__bucket0"]
    histogram = (
        _histogram(values, keys)
        .withColumn("n", F.sum("__in_bucket").over(Window.partitionBy(*by)))
        .withColumn("__before", F.lit(0).cast("bigint"))
        .withColumn("__ranks", _wanted_ranks(F.col("n"), probabilities))
    )
    chosen, largest = _known(_holding_ranks(histogram, by, "__bucket0"), max_rows)
    while largest > rows_per_bucket:
        bounds = chosen.select(*keys, "__low", "__high")
        bucket = f"__bucket{len(keys) - len(by)}"
        step = _step(F.col("__value"), F.col("__low"), F.col("__high"))
        inside = null_safe_join(values, bounds, keys, "inner")
        values = inside.select(*keys, "__value", step.alias(bucket))
        parents, keys = keys, [*keys, bucket]
        histogram = null_safe_join(
            _histogram(values, keys), chosen.select(*parents, "n", "__before", "__ranks"), parents, "inner"
        )
        chosen, largest = _known(_holding_ranks(histogram, parents, bucket), max_rows)

    # Only the count is aggregated here; what a bucket's target says joins in afterwards, so this
    # stays a hash aggregation.
    counted = (
        null_safe_join(values, chosen.select(*keys), keys, "left_semi")
        .groupBy(*keys, "__value")
        .agg(F.count(F.lit(1)).alias("__count"))
    )
    targets = chosen.select(*keys, "n", "__before", "__ranks")
    counted = null_safe_join(counted, targets, keys, "inner")
    end = F.col("__before") + F.sum("__count").over(
        Window.partitionBy(*keys)
        .orderBy("__value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    hits = counted.withColumn("__end", end).select(
        *by,
        "n",
        "__value",
        F.explode(
            F.filter(
                F.col("__ranks"),
                lambda r: (r["rank"] < F.col("__end"))
                & (r["rank"] >= F.col("__end") - F.col("__count")),
            )
        ).alias("__hit"),
    )

    def at(index: int, side: int) -> Column:
        here = (F.col("__hit.index") == index) & (F.col("__hit.side") == side)
        return F.max(F.when(here, F.col("__value")))

    per_group = hits.groupBy(*by, "n").agg(
        *[
            at(index, side).alias(f"__v{index}_{side}")
            for index in range(len(probabilities))
            for side in (0, 1)
        ]
    )
    result = []
    for index, (p, name) in enumerate(zip(probabilities, names)):
        position = (F.col("n") - 1) * F.lit(float(p))
        share = position - F.floor(position)
        result.append(
            (F.col(f"__v{index}_0") * (1 - share) + F.col(f"__v{index}_1") * share).alias(name)
        )
    return per_group.select(*by, "n", *result)


def approximate_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    rank_error: float = 0.001,
) -> DataFrame:
    """One row per group with values that stand near the wanted ranks: one scan, no job when called.

    The opt-in for reports that need no exact figure. Each answer is a value of the group whose rank is at
    most ``rank_error`` times its rows away from the wanted one. Summaries of that precision are made on
    the map side and merged, so a group takes some 1 / ``rank_error`` numbers of a task, whatever its rows;
    nothing is interpolated. Nulls and NaN are ignored, a group without other values gives nulls. Columns as
    in :func:`exact_quantiles`.
    """
    names = list(names or [f"q{i}" for i in range(len(probabilities))])
    number = finite(F.col(value).cast("double"))
    # A merged summary may be off by twice what each part is.
    accuracy = F.lit(int(2 / rank_error) + 1)
    found = F.percentile_approx(number, [float(p) for p in probabilities], accuracy).alias("__q")
    rows = df.groupBy(*by).agg(F.count(number).alias("n"), found)
    return rows.select(*by, "n", *[F.get("__q", F.lit(i)).alias(name) for i, name in enumerate(names)])


def rank_distances(
    df: DataFrame,
    value: str,
    answers: DataFrame,
    probabilities: Sequence[float],
    names: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """How far each answer's exact rank is from the wanted one: (groups, name, n, wanted, distance).

    Ranks run from 0. An answer that stands for several equal values has all their ranks, and the nearest one
    counts; distance is 0 if the wanted rank lies between them. One scan with the answers, one row per group,
    joined to it; null answers give no row.
    """
    numbers = df.select(*by, finite(F.col(value).cast("double")).alias("__value")).where("__value is not null")
    if by:
        joined = join_statistics(numbers, answers.select(*by, *names), list(by))
    else:
        row = answers.select(F.struct(*names).alias("row")).scalar()
        joined = numbers.withColumns({name: row[name] for name in names})
    counts = [
        agg
        for i, name in enumerate(names)
        for agg in (
            F.count_if(F.col("__value") < F.col(name)).alias(f"__below{i}"),
            F.count_if(F.col("__value") <= F.col(name)).alias(f"__upto{i}"),
        )
    ]
    ranks = joined.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.first(n).alias(n) for n in names], *counts)
    each = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                (F.lit(float(p)) * (F.col("n") - 1)).alias("wanted"),
                F.when(F.col(name).isNotNull(), F.col(f"__below{i}").cast("double")).alias("first"),
                (F.col(f"__upto{i}") - 1).cast("double").alias("last"),
            )
            for i, (name, p) in enumerate(zip(names, probabilities))
        ]
    )
    rows = ranks.select(*by, "n", F.explode(each).alias("r")).where("r.first is not null")
    distance = F.greatest(F.col("r.first") - F.col("r.wanted"), F.col("r.wanted") - F.col("r.last"), F.lit(0.0))
    return rows.select(*by, F.col("r.name").alias("name"), "n", F.col("r.wanted").alias("wanted"), distance.alias("distance"))
