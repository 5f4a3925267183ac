"""Landed JSON payloads of nested users, and auxiliary feeds."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from musterline.errors import PayloadError
from musterline.fixed_values import DEFAULT_USERS, FEED_DEFAULTS, FEED_NAMES
from musterline.model import USER_SCHEMA
from musterline.sources.roster_files import path_is_missing


def read_payloads(
    spark: SparkSession,
    path: str,
    on_corrupt: str = "fail",
    one_per_line: bool = False,
    place: str | None = None,
) -> DataFrame:
    """Users from payloads that are JSON arrays: one per file, or one per line.

    The second form can be split, so a large landing need not be many small files. A payload that
    does not parse, or is no array, is an error with ``on_corrupt='fail'`` (a check job runs now)
    and is left out with ``'quarantine'``; :func:`corrupt_payloads` lists those. ``place`` names a
    column that gets each user's (file, block, row, position), ascending in reading order.
    """
    payloads = _payloads(spark, path, one_per_line)
    if on_corrupt == "fail":
        bad = [row[0] for row in corrupt_payloads(spark, path, one_per_line).limit(5).collect()]
        if bad:
            raise PayloadError(f"not a JSON array of users: {', '.join(bad)}")
    if place is None:
        return payloads.select(F.explode("users").alias("user")).select("user.*")
    users = payloads.select("file", "block", "row", F.posexplode("users").alias("position", "user"))
    return users.select("user.*", F.struct("file", "block", "row", "position").alias(place))


def corrupt_payloads(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """File and text of the payloads that are no JSON array of users."""
    payloads = _payloads(spark, path, one_per_line)
    return payloads.where(F.col("users").isNull()).select("file", "payload")


def _payloads(spark: SparkSession, path: str, one_per_line: bool) -> DataFrame:
    users = F.from_json("value", T.ArrayType(USER_SCHEMA))
    # from_json would wrap a lone object into an array.
    is_array = F.json_array_length("value").isNotNull()
    return spark.read.text(path, wholetext=not one_per_line).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("payload"),
        F.when(is_array, users).alias("users"),
    )


def read_payload_lines(spark: SparkSession, path: str) -> DataFrame:
    """Users from JSON Lines files, the splittable form for large landings."""
    return spark.read.schema(USER_SCHEMA).json(path)


def default_users(spark: SparkSession, place: str | None = None) -> DataFrame:
    """The five users used when the payload source is out of reach."""
    texts = spark.createDataFrame([json.dumps(DEFAULT_USERS)], T.StringType())
    users = texts.select(
        F.posexplode(F.from_json("value", T.ArrayType(USER_SCHEMA))).alias("position", "user")
    )
    if place is None:
        return users.select("user.*")
    first = (F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("row"))
    return users.select("user.*", F.struct(*first, "position").alias(place))


def users_or_default(
    spark: SparkSession,
    path: str,
    on_corrupt: str = "fail",
    one_per_line: bool = False,
    place: str | None = None,
) -> DataFrame:
    """Landed users, or the default ones when nothing has landed at ``path``."""
    try:
        return read_payloads(spark, path, on_corrupt, one_per_line, place)
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        return default_users(spark, place)


def resolve_feeds(
    landed: DataFrame,
    names: Sequence[str] = FEED_NAMES,
    epoch: int | None = None,
    order: str | None = None,
) -> DataFrame:
    """One row per feed name: its landed data, or its default data with status ``fallback``.

    ``landed`` has (feed, data) and, if a feed can land more than once, the ``order`` column whose
    highest value wins. A feed whose landing is no JSON falls back too; one without default data
    falls back to an empty object. ``epoch`` completes the default of the time feed.
    """
    spark = landed.sparkSession
    defaults = []
    for name in names:
        default = dict(FEED_DEFAULTS.get(name, {}))
        if name == "Time" and epoch is not None:
            default["epoch"] = epoch
        defaults.append((name, json.dumps(default)))
    spine = spark.createDataFrame(defaults, "feed string, __default string")
    present = landed.where(F.col("feed").isin(*names) & F.col("data").isNotNull())
    if order:
        # The latest landing is found by its order alone: texts in an aggregation buffer would
        # have all rows sorted first. One row per requested name.
        last = present.groupBy("feed").agg(F.max(order).alias(order))
        present = present.join(F.broadcast(last), ["feed", order], "left_semi")
    present = present.groupBy("feed").agg(F.max("data").alias("__landed"))
    present = present.where(F.try_parse_json("__landed").isNotNull())
    # At most one row per requested name.
    return spine.join(F.broadcast(present), "feed", "left").select(
        "feed",
        F.when(F.col("__landed").isNull(), "fallback").otherwise("success").alias("status"),
        F.coalesce("__landed", "__default").alias("data"),
    )
