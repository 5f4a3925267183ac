"""Large JSON arrays, read by many tasks.

A payload that is one JSON array is one line, so a reader of lines gives it to a single task as a single row. Here
the file is cut at every closing brace, which readers of byte ranges can do anywhere. Whether a piece begins inside a
text, and how deep it is nested, follows from the pieces before it: each block of a file is summed up for both
possibilities, the blocks' sums (one row each) say which one holds, and then every piece knows its depth. Pieces
up to a brace that closes an element of the array are put together and parsed by themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from musterline.errors import PayloadError
from musterline.model import USER_SCHEMA
from musterline.operators.small_side import collect_if_small, null_safe_join
from musterline.session import written

_TEXT = r'"[^"]*("|\z)'
_BEFORE = Window.unboundedPreceding, -1


def _length(text: Column, without: str) -> Column:
    """How many of some characters a text has."""
    return F.length(text) - F.length(F.translate(text, without, ""))


def _nesting(outside: Column) -> Column:
    return _length(outside, "{[") - _length(outside, "]")


def _joined(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Sums of a block to its pieces: by broadcast if there are few blocks."""
    small = collect_if_small(blocks)
    return null_safe_join(rows, F.broadcast(small) if small is not None else blocks, ["file", "block"], "inner")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, value, last, quotes, d0, d1, c0, c1): per piece its quotes, and for a block that begins
    outside (0) or inside (1) of a text, the change of depth and whether the brace behind it closes something."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value",
    )
    raw = written(raw)  # rows are numbered once
    ends = raw.groupBy("file").agg(F.max(F.struct("block", "row")).alias("end"))
    raw = null_safe_join(raw, ends, ["file"], "inner").withColumn("last", F.col("end") == F.struct("block", "row")).drop("end")
    bare = F.regexp_replace("value", r"\\.", "")
    raw = raw.withColumn("bare", bare).withColumn("quotes", _length(F.col("bare"), '"'))
    outside = F.regexp_replace("bare", _TEXT, "")
    inside = F.regexp_replace(F.regexp_replace("bare", r'^[^"]*("|\z)', ""), _TEXT, "")
    raw = raw.withColumns({"n0": _nesting(outside), "n1": _nesting(inside)}).drop("bare")
    within = Window.partitionBy("file", "block").orderBy("row")
    odd = F.coalesce(F.sum("quotes").over(within.rowsBetween(*_BEFORE)), F.lit(0)) % 2
    raw = raw.withColumn("odd", odd)
    for start in (0, 1):
        begins_inside = (F.col("odd") + start) % 2
        closes = ~F.col("last") & ((begins_inside + F.col("quotes")) % 2 == 0)
        change = F.when(begins_inside == 0, F.col("n0")).otherwise(F.col("n1")) - closes.cast("int")
        raw = raw.withColumns({f"c{start}": closes, f"d{start}": change})
    return written(raw.drop("odd", "n0", "n1"))


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, value, last, depth, element): depth behind the piece, and which element it belongs to."""
    pieces = _pieces(spark, path)
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(*_BEFORE)
    within = Window.partitionBy("file", "block").orderBy("row")
    blocks = pieces.groupBy("file", "block").agg(*[F.sum(c).alias(c) for c in ("quotes", "d0", "d1")])
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(in_file), F.lit(0)) % 2)
    blocks = blocks.withColumn("d", F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1")))
    blocks = blocks.withColumn("deep", F.coalesce(F.sum("d").over(in_file), F.lit(0))).select("file", "block", "inside", "deep")
    rows = _joined(pieces, written(blocks))
    change = F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1"))
    closes = F.when(F.col("inside") == 0, F.col("c0")).otherwise(F.col("c1"))
    depth = F.col("deep") + F.sum(change).over(within.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("depth", depth).withColumn("ends", (closes & (F.col("depth") == 1)).cast("int"))
    before = F.coalesce(F.sum("ends").over(within.rowsBetween(*_BEFORE)), F.lit(0))
    rows = written(rows.withColumn("before", before).select("file", "block", "row", "value", "last", "depth", "ends", "before"))
    counts = rows.groupBy("file", "block").agg(F.sum("ends").alias("ended"))
    counts = counts.withColumn("earlier", F.coalesce(F.sum("ended").over(in_file), F.lit(0))).select("file", "block", "earlier")
    rows = _joined(rows, written(counts))
    return rows.withColumn("element", F.col("earlier") + F.col("before")).drop("earlier", "before")


def array_elements(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(elements, corrupt): file, element number from 0 and JSON text of each element, and the files that are no
    JSON array of objects, whose elements are not to be trusted.

    ``path`` is a file or folder of files that hold one array each, of any size. Blank files are corrupt.
    """
    rows = _numbered(spark, path)
    # What follows the last element is the end of the array in one piece, or something is wrong with the file.
    ended = rows.groupBy("file").agg(F.sum("ends").alias("elements"))
    rows = null_safe_join(rows, ended, ["file"], "inner")
    rest = rows.where(F.col("element") == F.col("elements"))
    closing = F.when(F.col("elements") == 0, F.lit(r"^\s*\[\s*\]\s*$")).otherwise(F.lit(r"^\s*\]\s*$"))
    good = F.col("last") & (F.col("depth") == 0) & F.rlike("value", closing)
    wrong = rest.where(~good).select("file")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "row", "value"))), lambda p: p["value"]), "}")
    found = rows.where(F.col("element") < F.col("elements")).groupBy("file", "element").agg(F.concat(whole, F.lit("}")).alias("text"))
    mark = F.when(F.col("element") == 0, F.lit(r"^\s*\[\s*\{")).otherwise(F.lit(r"^\s*,\s*\{"))
    begins = F.rlike("text", mark)
    found = found.withColumn("json", F.regexp_replace("text", r"^\s*[\[,]\s*", ""))
    found = written(found.select("file", "element", "json", (begins & F.try_parse_json("json").isNotNull()).alias("good")))
    wrong = wrong.unionByName(found.where(~F.col("good")).select("file"))
    # A file without any piece has no row at all.
    return found.select("file", "element", "json"), written(wrong.distinct())


def read_large_arrays(spark: SparkSession, path: str, on_corrupt: str = "fail", place: str | None = None) -> DataFrame:
    """Users from files of one JSON array each, cut by byte ranges; arguments and result as ``read_payloads``."""
    elements, corrupt = array_elements(spark, path)
    if on_corrupt == "fail":
        bad = [row[0] for row in corrupt.limit(5).collect()]
        if bad:
            raise PayloadError(f"not a JSON array of users: {', '.join(bad)}")
    else:
        small = collect_if_small(corrupt)
        elements = elements.join(F.broadcast(small) if small is not None else corrupt, "file", "left_anti")
    users = elements.select("file", "element", F.from_json("json", USER_SCHEMA).alias("user"))
    if place is None:
        return users.select("user.*")
    zero = F.lit(0).cast("bigint")
    where = F.struct("file", zero.alias("block"), F.col("element").cast("bigint").alias("row"), F.lit(0).alias("position"))
    return users.select("user.*", where.alias(place))
