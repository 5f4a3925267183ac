"""Histograms, box statistics, outliers and densities: the data behind the distribution charts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from musterline.functions.text import finite
from musterline.operators.quantiles import exact_quantiles
from musterline.operators.small_side import collect_if_small, join_statistics, null_safe_join

WHISKER_REACH = 1.5
GRID_POINTS = 100
#: Cells of a density per bandwidth, and powers kept of each.
CELLS_PER_WIDTH, MOMENTS = 16, 8
POINTS_PER_RUN = 25


def _finite_values(df: DataFrame, value: str, *keep: str) -> DataFrame:
    return df.select(*keep, finite(F.col(value).cast("double")).alias("__x")).where(
        F.col("__x").isNotNull()
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """``bins`` equal bins from the lowest to the highest value; the last one is closed.

    A constant column gets the range value +- 0.5, an empty one the range 0 to 1. Empty bins are
    kept. The range is found by a job at call time; the counts then combine to at most ``bins``
    rows per task.
    """
    values = _finite_values(df, value)
    lo, hi = values.agg(F.min("__x"), F.max("__x")).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins
    edges = [lo + index * step for index in range(bins)] + [hi]

    # The division may land one bin off at an edge: compare with the edges themselves.
    x, guess = F.col("__x"), F.col("__guess")
    edge = F.array(*[F.lit(e) for e in edges])
    place = F.least(F.floor((x - lo) / (hi - lo) * float(bins)), F.lit(bins - 1)).cast("int")
    index = (
        F.when(x < F.get(edge, guess), guess - 1)
        .when((guess < bins - 1) & (x >= F.get(edge, guess + 1)), guess + 1)
        .otherwise(guess)
    )
    counts = (
        values.withColumn("__guess", place)
        .groupBy(index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    spine = df.sparkSession.createDataFrame(
        [(i, edges[i], edges[i + 1]) for i in range(bins)],
        "bin int, lower_edge double, upper_edge double",
    )
    # counts has at most one row per bin, so broadcasting it is bounded by the argument.
    return (
        spine.join(F.broadcast(counts), "bin", "left")
        .withColumn("count", F.coalesce("count", F.lit(0)))
        .orderBy("bin")
    )


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per non-null group: n, quartiles, and whiskers at the last value within 1.5 IQR.

    A whisker never ends inside the box.
    """
    values = _finite_values(df.where(F.col(group).isNotNull()), value, group)
    quartiles = exact_quantiles(
        values, "__x", [0.25, 0.5, 0.75], by=[group], names=["q1", "median", "q3"]
    )
    reach = WHISKER_REACH * (F.col("q3") - F.col("q1"))
    joined = join_statistics(values, quartiles, group)
    inside_low = F.col("__x") >= F.col("q1") - reach
    inside_high = F.col("__x") <= F.col("q3") + reach
    return (
        joined.groupBy(group, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside_low, F.col("__x"))).alias("__low"),
            F.max(F.when(inside_high, F.col("__x"))).alias("__high"),
            F.count_if(~(inside_low & inside_high)).alias("outliers"),
        )
        .select(
            group,
            "n",
            "q1",
            "median",
            "q3",
            F.least("__low", "q1").alias("whisker_low"),
            F.greatest("__high", "q3").alias("whisker_high"),
            "outliers",
        )
    )


def outliers(df: DataFrame, group: str, value: str) -> DataFrame:
    """The rows whose value lies more than 1.5 IQR outside their group's box."""
    quartiles = exact_quantiles(
        df.where(F.col(group).isNotNull()), value, [0.25, 0.75], by=[group], names=["__q1", "__q3"]
    ).drop("n")
    joined = join_statistics(df, quartiles, group)
    reach = WHISKER_REACH * (F.col("__q3") - F.col("__q1"))
    x = finite(F.col(value).cast("double"))
    return joined.where((x < F.col("__q1") - reach) | (x > F.col("__q3") + reach)).drop(
        "__q1", "__q3"
    )


def violin_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per non-null group: n, mean, median, lowest and highest value."""
    values = _finite_values(df.where(F.col(group).isNotNull()), value, group)
    medians = exact_quantiles(values, "__x", [0.5], by=[group], names=["median"]).drop("n")
    basic = values.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("__x").alias("mean"),
        F.min("__x").alias("lowest"),
        F.max("__x").alias("highest"),
    )
    return join_statistics(basic, medians, group).select(
        group, "n", "mean", "median", "lowest", "highest"
    )


def _series() -> list[Column]:
    """Coefficients by powers of z of what a cell's rows add to exp(-z^2 / 2).

    exp(-(z - d)^2 / 2) is exp(-z^2 / 2) times the sum of He_k(z) d^k / k!, He being the Hermite polynomials.
    """
    hermite = [[1.0], [0.0, 1.0]]
    for k in range(1, MOMENTS - 1):
        longer = [0.0, *hermite[k]]
        for j, c in enumerate(hermite[k - 1]):
            longer[j] -= k * c
        hermite.append(longer)
    return [
        sum((F.col(f"__m{k}") * (hermite[k][j] / math.factorial(k)) for k in range(j, MOMENTS) if hermite[k][j]), F.lit(0.0))
        for j in range(MOMENTS)
    ]


def density(df: DataFrame, group: str, value: str, points: int = GRID_POINTS) -> DataFrame:
    """Gaussian kernel density per non-null group on ``points`` evenly spaced values.

    Bandwidth: sample deviation times n^(-1/5). A group of equal values has density 1 at that
    value. Rows are summed up per cell of 1 / CELLS_PER_WIDTH bandwidths, as powers of the distance
    to its middle, and the kernel is evaluated per cell: a row costs a few products, however many
    points there are, and only cells are shuffled. With MOMENTS powers the kernel's series around
    the middle of a cell is off by less than 1e-13 of its height. A cell meets only its own group's
    grid, and the partial sums leave at most points x groups values per task.
    """
    values = _finite_values(df.where(F.col(group).isNotNull()), value, group)
    deviation = F.stddev_samp("__x")
    stats = values.groupBy(group).agg(
        F.count(F.lit(1)).cast("double").alias("__n"),
        F.min("__x").alias("__lo"),
        ((F.max("__x") - F.min("__x")) / (points - 1)).alias("__step"),
        (deviation * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("__h"),
    )
    small = collect_if_small(stats)
    stats = F.broadcast(small) if small is not None else stats
    # Null for a group of equal values, whose step is zero.
    width = F.when(F.col("__step") > 0, F.col("__h"))
    placed = null_safe_join(values, stats, [group], "inner").select(
        group, ((F.col("__x") - F.col("__lo")) / width).alias("__u")
    )
    placed = placed.withColumn("__cell", F.floor(F.col("__u") * CELLS_PER_WIDTH))
    placed = placed.withColumn("__d", F.col("__u") - (F.col("__cell") + 0.5) / CELLS_PER_WIDTH)
    powers, power = [], F.lit(1.0)
    for k in range(MOMENTS):
        powers.append(F.sum(power).alias(f"__m{k}"))
        power = power * F.col("__d")
    cells = placed.groupBy(group, "__cell").agg(*powers)
    # In bandwidths: the distance from a cell's middle to the first grid point, and between grid points.
    scaled = null_safe_join(cells, stats, [group], "inner").select(
        group,
        *[c.alias(f"__a{j}") for j, c in enumerate(_series())],
        (-(F.col("__cell") + 0.5) / CELLS_PER_WIDTH).alias("__start"),
        (F.col("__step") / width).alias("__stride"),
    )
    # A cell is repeated once per run of neighbouring points, not once per point: the sums of a
    # run are columns of one aggregation.
    runs = math.ceil(points / POINTS_PER_RUN)
    repeated = scaled.withColumn("__run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))

    def kernel(offset: int) -> Column:
        point = F.col("__run") * POINTS_PER_RUN + offset
        z = F.col("__start") + point * F.col("__stride")
        series = F.col(f"__a{MOMENTS - 1}")
        for j in reversed(range(MOMENTS - 1)):
            series = series * z + F.col(f"__a{j}")
        return series * F.exp(F.lit(-0.5) * z * z)

    offsets = range(POINTS_PER_RUN)
    sums = repeated.groupBy(group, "__run").agg(
        *[F.sum(kernel(offset)).alias(f"__sum{offset}") for offset in offsets]
    )
    by_point = sums.select(
        group,
        F.inline(
            F.array(
                *[
                    F.struct(
                        (F.col("__run") * POINTS_PER_RUN + offset).alias("point"),
                        F.col(f"__sum{offset}").alias("__sum"),
                    )
                    for offset in offsets
                ]
            )
        ),
    ).where(F.col("point") < points)
    share = F.col("__sum") / (F.col("__n") * F.col("__h") * math.sqrt(2 * math.pi))
    return null_safe_join(by_point, stats, [group], "inner").select(
        group,
        "point",
        (F.col("__lo") + F.col("point") * F.col("__step")).alias("at"),
        F.when(F.col("__step") > 0, share).otherwise(F.lit(1.0)).alias("density"),
    )


def value_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """The points of a scatter chart."""
    return df.select(x, y)


def pair_counts(df: DataFrame, x: str, y: str, x_bins: int, y_bins: int) -> DataFrame:
    """Points per cell of an x_bins by y_bins grid; empty cells are left out.

    The form of a scatter chart that stays readable, and bounded, for any number of points.
    """
    points = df.select(
        finite(F.col(x).cast("double")).alias("__x"), finite(F.col(y).cast("double")).alias("__y")
    ).where(F.col("__x").isNotNull() & F.col("__y").isNotNull())
    x0, x1, y0, y1 = points.agg(
        F.min("__x"), F.max("__x"), F.min("__y"), F.max("__y")
    ).first()

    def cell(name: str, low: float | None, high: float | None, bins: int) -> Column:
        if low is None or low == high:
            return F.lit(0)
        share = (F.col(name) - low) / (high - low)
        return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")

    return points.groupBy(
        cell("__x", x0, x1, x_bins).alias("x_bin"), cell("__y", y0, y1, y_bins).alias("y_bin")
    ).agg(F.count(F.lit(1)).alias("points"))
