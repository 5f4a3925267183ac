"""Name searches over a file table by a trigram index.

For each data file, once: every three neighbouring characters of a folded name with the row's key, in hash buckets
and sorted within them. A pattern's literal stretches of three or more characters name the trigrams that a match
must have; the keys that have all of them are few, and only their rows are read, from the files that hold them, and
compared with the pattern. Data files never change, so their entries never do; entries of replaced files are left
unread. Patterns without such a stretch scan the names.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from musterline.operators.search import fold_ascii, folded_pattern, name_contains
from musterline.operators.small_side import rows_with_keys
from musterline.session import written
from musterline.sources.file_table import DataFile, FileTable, file_place
from musterline.sources.folders import children, claim, read_mark

BUCKETS = 64
_ENTRIES = "trigram string, file string, key bigint, bucket int"


def _bucket(trigram: Column) -> Column:
    return F.pmod(F.xxhash64(trigram), F.lit(BUCKETS)).cast("int")


def _mark(table: FileTable, file: DataFile) -> str:
    return f"{table.base}/trigrams/files/{file.file.replace('/', '_')}"


def index_names(spark: SparkSession, table: FileTable) -> int:
    """Enter the files that are not indexed yet and return how many they were.

    A name gives at most as many entries as it has characters. Names that are null or shorter than three characters
    give none: no stretch of three matches them. Two indexers of one file leave two sets of equal entries, of which
    the one marked first counts.
    """
    noted = set(children(spark, f"{table.base}/trigrams/files"))
    new = [f for f in table.files if f.file.replace("/", "_") not in noted]
    if not new:
        return 0
    c, run = table.columns, uuid.uuid4().hex
    name = fold_ascii(F.col(c.name))
    # Every three characters from each place on, by a look-ahead that matches no characters: a compiled
    # expression, where a lambda per place was interpreted for every character of every name. No place starts
    # inside a character outside the BMP, which Java holds as two chars.
    grams = F.array_distinct(F.regexp_extract_all(name, F.lit("(?s)(?=([^\\uDC00-\\uDFFF].{2}))"), F.lit(1)))
    rows = table.read(spark, new).select(F.explode(grams).alias("trigram"), file_place().alias("file"), F.col(c.id).alias("key"))
    rows = rows.withColumn("bucket", _bucket(F.col("trigram")))
    # A trigram that many names share fills several files of its bucket.
    rows = rows.repartitionByRange("bucket", "trigram", "key").sortWithinPartitions("bucket", "trigram", "key")
    rows.write.partitionBy("bucket").parquet(f"{table.base}/trigrams/runs/{run}")
    for f in new:
        claim(spark, _mark(table, f), run)
    return len(new)


def pattern_trigrams(query: str) -> list[str]:
    """The trigrams that every match of a query must have; ``%`` and ``_`` are wildcards."""
    stretches = re.split("[%_]", folded_pattern(query))
    return sorted({s[i : i + 3] for s in stretches for i in range(len(s) - 2)})


def candidates(spark: SparkSession, table: FileTable, grams: list[str]) -> tuple[DataFrame, list[DataFile]]:
    """(file, key of the rows that have all trigrams; files that are not indexed).

    Only the buckets of these trigrams are opened, and row groups without them are passed over.
    """
    runs: dict[str, list[str]] = {}
    unknown = []
    for f in table.files:
        run = read_mark(spark, _mark(table, f))
        if run is None:
            unknown.append(f)
        else:
            runs.setdefault(run, []).append(f.file)
    found = spark.createDataFrame([], _ENTRIES).select("file", "key")
    buckets = [row[0] for row in spark.createDataFrame([(g,) for g in grams], "g string").select(_bucket(F.col("g"))).distinct().collect()]
    for run, files in runs.items():
        entries = spark.read.schema(_ENTRIES).parquet(f"{table.base}/trigrams/runs/{run}")
        entries = entries.where(F.col("bucket").isin(buckets) & F.col("trigram").isin(grams))
        held = spark.createDataFrame([(f,) for f in files], "file string")
        entries = entries.join(F.broadcast(held), "file", "left_semi")  # one name per data file
        all_of = entries.groupBy("file", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams))
        found = found.unionByName(all_of.select("file", "key"))
    return found, unknown


def search_names(spark: SparkSession, table: FileTable, query: str) -> DataFrame:
    """The rows whose name contains ``query``, as ``search(query=...)`` finds them; an empty query is no condition."""
    if not query:
        return table.read(spark)
    c = table.columns
    match = name_contains(F.col(c.name), query)
    grams = pattern_trigrams(query)
    if not grams:
        return table.read(spark).where(match)
    found, unknown = candidates(spark, table, grams)
    found = written(found)
    names = {row[0] for row in found.select("file").distinct().collect()}  # at most one per data file
    rows = table.read(spark, [f for f in table.files if f.file in names])
    rows = rows_with_keys(rows, found.select(F.col("key").alias(c.id)), c.id).select(*table.schema.names)
    if unknown:
        rows = rows.unionByName(table.read(spark, unknown))
    return rows.where(match)
