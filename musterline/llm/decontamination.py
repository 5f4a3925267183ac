"""Benchmark passages in documents, with DataFrame operations only.

A passage is looked for in windows of its own number of words. Windows are placed where a shingle of the passage
ends them, and counted only if the shingles of the passage that they hold, taken together, could weigh enough.
Each window has a SimHash of 63 bits over its weighted shingles. The bits are cut into RADIUS + 1 blocks, and
fingerprints within RADIUS agree in one block at least, so an equi-join on (words, block, value) finds every
passage within the radius. All candidates are verified exactly: the weighted share of the passage's shingles,
with their numbers of occurrences, that the window holds; a shingle of fewer items weighs more.

A similarity bounds the distance of fingerprints only on average. Windows that were placed for a passage and lie
outside the radius of it are therefore verified as well: nothing similar enough is left out.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from musterline.operators.small_side import fits_in_bytes
from musterline.session import written

SHINGLE = 5
SIMILAR = 0.8
_BITS = 63
#: Of vectors with a cosine of SIMILAR, a hash bit differs with this chance; 99 % of pairs are within the radius.
_DIFFERS = math.acos(SIMILAR) / math.pi
RADIUS = math.ceil(_BITS * _DIFFERS + 2.33 * math.sqrt(_BITS * _DIFFERS * (1 - _DIFFERS)))
#: Sides of a join are broadcast only if they have at most so many rows, and few bytes.
SMALL_ROWS = 200_000


def words(text: Column) -> Column:
    """Letters and digits in lower case, cut at everything else."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def gram_hashes(tokens: str, size: int) -> Column:
    """A hash of every ``size`` consecutive words of the array column ``tokens``."""
    grams = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - size),
        lambda i: F.xxhash64(*[F.get(F.col(tokens), i + j) for j in range(size)]),
    )
    return F.when(F.size(tokens) >= size, grams)


def _shingles(tokens: str, size: Column) -> Column:
    grams = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - size), lambda i: F.array_join(F.slice(F.col(tokens), i + 1, size), " ")
    )
    return F.when(F.size(tokens) >= size, grams).otherwise(F.array(F.array_join(tokens, " ")))


def sized(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a check finds it small in rows and bytes; it should be cheap to evaluate."""
    return F.broadcast(df) if fits_in_bytes(df, rows) else df


def simhashes(shingles: DataFrame, of: list[str]) -> DataFrame:
    """(columns ``of``, print): per group of (shingle, weight, times) the sign of each hash bit's weighted sum."""
    hashed = shingles.withColumns({"__h": F.xxhash64("shingle", F.lit(17)), "__w": F.col("weight") * F.col("times")})
    sums = [
        F.sum(F.when(F.shiftrightunsigned("__h", bit).bitwiseAND(F.lit(1)) == 1, F.col("__w")).otherwise(-F.col("__w"))).alias(f"__b{bit}")
        for bit in range(_BITS)
    ]
    bits = [F.when(F.col(f"__b{bit}") > 0, F.lit(1 << bit)).otherwise(F.lit(0).cast("long")) for bit in range(_BITS)]
    return hashed.groupBy(*of).agg(*sums).select(*of, reduce(lambda x, y: x.bitwiseOR(y), bits).alias("print"))


def block_keys(fingerprint: Column, radius: int = RADIUS) -> Column:
    """(block, value) of each of ``radius`` + 1 blocks of the fingerprint."""
    edges = [_BITS * i // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
            for i, (a, b) in enumerate(zip(edges, edges[1:]))
        ]
    )


def within_radius(left: DataFrame, right: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs of ``left`` (print, n, ...) and ``right`` (item_print, n, ...) whose fingerprints differ in at
    most ``radius`` bits: they agree in a block, which is what is joined."""
    many = left.withColumn("b", F.explode(block_keys(F.col("print"), radius))).select("*", "b.*").drop("b")
    few = right.withColumn("b", F.explode(block_keys(F.col("item_print"), radius))).select("*", "b.*").drop("b")
    near = many.join(sized(few), ["n", "block", "value"]).drop("block", "value")
    return near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius).drop("print", "item_print").distinct()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(key, item, start, similarity): the most similar window of each document and item that match.

    Null or empty texts, and rows without a key, match nothing. Of rows of one key the best window counts,
    and so it does for rows of one item, which are versions of it. Very long texts are scanned whole. An item of fewer words than a shingle is one shingle as a whole.
    Of equally similar windows the first counts in which a shingle has the place it has in the item; without
    such a one, the first.
    """
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    plain = plain.select("key", F.xxhash64("text").alias("row"), words(F.col("text")).alias("w"))
    items = benchmark.select(F.col(item).alias("item"), words(F.col(item_text)).alias("iw")).where("item is not null and size(iw) > 0")
    items = items.select(
        "item", "iw", F.size("iw").alias("n"), F.least(F.size("iw"), F.lit(SHINGLE)).alias("g"), F.xxhash64("iw").alias("version")
    ).dropDuplicates(["item", "version"])
    items = written(items)

    grams = {row["g"]: gram_hashes("iw", row["g"]) for row in items.select("g").distinct().collect()}  # 1 to SHINGLE
    if not grams:
        none = plain.select("key", F.lit(0).cast("long").alias("start"), F.lit(0.0).alias("similarity")).limit(0)
        none = none.crossJoin(F.broadcast(items.select("item").limit(0)))
        return none.select(F.col("key").alias(key), F.col("item").alias(item), "start", "similarity")
    places = [
        items.where(F.col("g") == g).withColumn("gram", gram).withColumn("shingle", _shingles("iw", F.col("g")))
        .select("item", "version", "n", "g", F.posexplode(F.arrays_zip("gram", "shingle")).alias("place", "x")).select("*", "x.*").drop("x")
        for g, gram in grams.items()
    ]
    places = written(reduce(DataFrame.unionByName, places))

    # Weights, and the rarest shingles that no similar window misses altogether.
    of_item = places.groupBy("item", "version", "g", "shingle", "gram").agg(F.count(F.lit(1)).alias("in_item"))
    spread = of_item.groupBy("shingle").agg(F.count_distinct("item").alias("items"))
    total = items.select(F.count_distinct("item")).scalar()
    of_item = of_item.join(spread, "shingle").withColumn("weight", 1 + F.log(total / F.col("items")))
    whole = of_item.groupBy("item", "version").agg(F.sum(F.col("weight") * F.col("in_item")).alias("whole"))
    of_item, whole = written(of_item), written(whole)
    rarest = Window.partitionBy("item", "version").orderBy("items", "shingle")
    up_to = F.sum(F.col("weight") * F.col("in_item")).over(rarest.rowsBetween(Window.unboundedPreceding, 0))
    first = of_item.withColumn("before", up_to - F.col("weight") * F.col("in_item")).join(sized(whole), ["item", "version"])
    first = first.where(F.col("before") <= (1 - SIMILAR + 1e-6) * F.col("whole"))
    first = written(first.select("item", "version", "g", "gram"))

    def of_docs(texts: DataFrame, g: int) -> DataFrame:
        return texts.select("key", "row", F.size("w").alias("size"), F.posexplode(gram_hashes("w", g)).alias("at", "gram"))

    pairs = [
        of_docs(plain, g).join(sized(first.where(F.col("g") == g).drop("g")), "gram").select("key", "row", "item", "version") for g in grams
    ]
    pairs = written(reduce(DataFrame.unionByName, pairs).distinct())

    # Windows of the candidates that end with a shingle of the item: the first of the best ones is among them.
    involved = plain.join(sized(pairs.select("key").distinct()), "key", "left_semi")
    wanted = pairs.join(sized(of_item.join(items.select("item", "version", "n"), ["item", "version"]).drop("shingle")), ["item", "version"])
    hits = [of_docs(involved, g).join(wanted.where(F.col("g") == g), ["key", "row", "gram"]) for g in grams]
    hits = reduce(DataFrame.unionByName, hits)
    # Of each hit, the weight of all hits in the window that it ends; the window holds n - g more places.
    # Its range is the same for all items in millionths of that; rounding may only let one more place in.
    reach = F.greatest(F.col("n") - F.col("g"), F.lit(0.5))
    scaled = F.floor(F.col("at") / reach * 1_000_000).cast("long")
    back = Window.partitionBy("key", "row", "item", "version").orderBy(scaled).rangeBetween(-1_000_001, 0)
    hits = hits.withColumn("most", F.sum("weight").over(back)).join(sized(whole), ["item", "version"])
    enough = hits.where(F.col("most") >= (SIMILAR - 1e-6) * F.col("whole"))

    def starts(at: Column) -> Column:
        return F.greatest(F.lit(0), F.least(at, F.col("size") - F.col("n")))

    pair = ["key", "row", "item", "version"]
    ends = written(enough.select(*pair, "n", "g", "whole", starts(F.col("at") - (F.col("n") - F.col("g"))).alias("start")).distinct())
    # Near these, also where a shingle has the place it has in the item: of equal windows these are preferred.
    parts = ends.select(*pair, F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda i: F.floor(F.col("start") / F.col("n")) + i)).alias("part"))
    set_places = places.select("item", "version", "gram", "place").distinct()
    aligned = hits.join(sized(set_places), ["item", "version", "gram"]).select(*pair, "n", "g", "whole", starts(F.col("at") - F.col("place")).alias("start"))
    aligned = aligned.withColumn("part", F.floor(F.col("start") / F.col("n"))).join(sized(parts.distinct()), [*pair, "part"], "left_semi").drop("part")
    placed = aligned.withColumn("aligned", F.lit(1)).unionByName(ends.withColumn("aligned", F.lit(0)))
    placed = written(placed.groupBy(*pair, "n", "g", "whole", "start").agg(F.max("aligned").alias("aligned")))

    windows = placed.select("key", "row", "start", "n", "g").distinct()
    seen = involved.distinct().join(windows, ["key", "row"]).withColumn("ww", F.slice("w", F.col("start") + 1, F.col("n")))
    at = ["key", "row", "start", "n"]
    seen = seen.select(*at, F.explode(_shingles("ww", F.col("g"))).alias("shingle")).groupBy(*at, "shingle").agg(F.count(F.lit(1)).alias("times"))
    seen = written(seen)

    # Fingerprints. A shingle of no item weighs as much as one of a single item.
    known = spread.select("shingle", (1 + F.log(total / F.col("items"))).alias("weight"))
    weighted = seen.join(sized(written(known)), "shingle", "left").withColumn("weight", F.coalesce("weight", 1 + F.log(total)))
    prints = simhashes(weighted, at)
    of_items = simhashes(of_item.withColumn("times", F.col("in_item")), ["item", "version"]).withColumnRenamed("print", "item_print")
    of_items = written(of_items.join(items.select("item", "version", "n"), ["item", "version"]))
    near = within_radius(prints, of_items).join(sized(whole), ["item", "version"])
    chosen = near.select(*at, "item", "version", "whole", F.lit(0).alias("aligned"))
    chosen = chosen.unionByName(placed.select(*chosen.columns)).groupBy(*at, "item", "version", "whole").agg(F.max("aligned").alias("aligned"))

    # Exact similarity.
    shared = seen.join(chosen, at).join(sized(of_item.drop("g", "gram", "items")), ["item", "version", "shingle"])
    held = F.sum(F.col("weight") * F.least("in_item", "times")) / F.col("whole")
    scored = shared.groupBy("key", "row", "start", "aligned", "item", "version", "whole").agg(held.alias("similarity"))
    scored = scored.withColumn("similarity", F.round("similarity", 9)).where(F.col("similarity") >= SIMILAR)
    best = F.max(F.struct("similarity", "aligned", (-F.col("start")).alias("back"))).alias("best")
    return scored.groupBy("key", "item").agg(best).select(
        F.col("key").alias(key), F.col("item").alias(item), (-F.col("best.back")).cast("long").alias("start"), F.col("best.similarity").alias("similarity")
    )


def op2_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """The best window of each document and benchmark item that match; odd rows as in :func:`contaminated`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage_decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark passage; rows without a key or text stay, columns are unchanged."""
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = written(found.select("doc_id").distinct())
    return docs.join(sized(gone), "doc_id", "left_anti").select(*docs.columns)
