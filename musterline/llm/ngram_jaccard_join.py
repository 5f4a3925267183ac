"""Size-aware exact Jaccard join of documents on word n-grams.

A document is the set of its distinct ``k``-word shingles; two link when their Jaccard similarity is
at least ``num / den``. Sets of sizes s and t then share at least c(s, t) = ceil(num (s+t) / (num+den))
shingles. Equal sets are one class. Small sets enumerate their subsets of every size c that a partner
can require: sets of a block (equal subset of size c) link to the block's smallest set, which is exact,
because sharing c shingles is enough for a smaller partner if it is for a larger one. Large sets
scan inverted lists: of each set those of its first n - ceil(n num/den) + 1 shingles, rare ones
first, since linked sets must share one of them. The size that divides small from large has the least
cost by the sizes and list lengths found.

Lists are worked off in two turns so that near copies don't give all pairs: first every set is
verified against one hub of each list; then only pairs of a list that are still in different
components are.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from musterline.llm.components import connected_components
from musterline.llm.decontamination import sized
from musterline.llm.text_hashing import SPACED, combine, list_array, shingle_sets, slices, text_bytes
from musterline.session import written

#: Sets up to this size may become small ones; beyond it subsets are too many for any threshold here.
MOST_SMALL = 40
#: A shingle of so many documents counts as frequent: it comes last when the lists to scan are chosen.
FREQUENT = 6
#: At most so many frequent shingles (16 bytes each) are sent to the tasks; the bound on FREQUENT is
#: raised until they fit. It only decides an order: the result does not depend on it.
MOST_FREQUENT = 1 << 21
#: Tasks that count shingles hold about so many of them.
COUNTED_PER_TASK = 1_000_000


def _counted(shingles: np.ndarray, tasks: int) -> np.ndarray:
    """Under which number a shingle is counted: its bucket and 32 bits.

    Two of a bucket that share these bits count together, which may change the order, not the result, and halves
    the shuffle.
    """
    bucket = (shingles >> np.uint64(32)) % np.uint64(tasks)
    return bucket << np.uint64(32) | (shingles & np.uint64(0xFFFFFFFF))


def least_overlap(s: int, t: int, num: int, den: int) -> int:
    return -(-num * (s + t) // (num + den))


def subset_sizes(n: int, num: int, den: int) -> range:
    """The overlaps that a set of ``n`` can need with a partner of any admissible size."""
    low = least_overlap(n, -(-num * n // den), num, den)
    return range(max(1, low), n + 1)


def n_subsets(n: int, num: int, den: int) -> int:
    return sum(comb(n, c) for c in subset_sizes(n, num, den))


def prefix_length(n: int, num: int, den: int) -> int:
    return n - (-(-num * n // den)) + 1 if n else 0


def _sets(batches, text: str, k: int):
    for part in slices(batches, text):
        words, bounds = SPACED.hashes(*text_bytes(part.column(text)))
        yield part, list(shingle_sets(words, bounds, k))


def frequent_shingles(docs: DataFrame, text: str, k: int, tasks: int) -> np.ndarray:
    """Shingles of at least FREQUENT documents, the less frequent first: all documents are counted.

    Each map task counts within parts of the input and packs the counts by hash into one binary
    row per bucket, so a shingle of all documents arrives once per part, and buckets are even.
    """

    def packed(batches):
        def flush(held):
            tokens, counts = np.unique(_counted(np.concatenate(held), tasks), return_counts=True)
            cuts = np.searchsorted(tokens, np.arange(tasks + 1, dtype=np.uint64) << np.uint64(32))
            low = tokens.astype(np.uint32)
            single = [low[a:b][counts[a:b] == 1] for a, b in zip(cuts, cuts[1:])]
            many = [low[a:b][counts[a:b] > 1] for a, b in zip(cuts, cuts[1:])]
            number = [counts[a:b][counts[a:b] > 1].astype(np.uint32) for a, b in zip(cuts, cuts[1:])]
            return pa.record_batch(
                [
                    pa.array(np.arange(tasks, dtype=np.int32)),
                    *[pa.array([x.tobytes() for x in xs], pa.binary()) for xs in (single, many, number)],
                ],
                names=["bucket", "single", "many", "number"],
            )

        held, size = [], 0
        for _, sets in _sets(batches, text, k):
            held += sets
            size += sum(map(len, sets))
            if size > 1_500_000:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    def counted(batches):
        for batch in batches:
            single, many, number = ([np.frombuffer(x, np.uint32) for x in batch.column(name).to_pylist()] for name in ("single", "many", "number"))
            ones = np.ones(sum(map(len, single)), np.uint32)
            yield np.concatenate([*single, *many]), np.concatenate([ones, *number])

    def per_bucket(key, table):
        got = list(counted(table.to_batches()))
        tokens = np.concatenate([t for t, _ in got])
        counts = np.concatenate([c for _, c in got])
        del got
        if not len(tokens):
            return pa.table({"token": pa.array([], pa.int64()), "df": pa.array([], pa.int64())})
        order = np.argsort(tokens)
        tokens, counts = tokens[order], counts[order]
        del order
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        total = np.add.reduceat(counts, first, dtype=np.int64)
        often = total >= FREQUENT
        found = tokens[first[often]].astype(np.uint64) | np.uint64(key[0].as_py() << 32)
        return pa.table({"token": pa.array(found.view(np.int64)), "df": pa.array(total[often])})

    packs = docs.select(text).mapInArrow(packed, "bucket int, single binary, many binary, number binary")
    often = written(packs.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(per_bucket, "token long, df long"))
    bound = FREQUENT
    while often.where(F.col("df") >= bound).count() > MOST_FREQUENT:
        bound *= 2
    return often.where(F.col("df") >= bound).orderBy("df", "token").select("token").toArrow().column("token").to_numpy().view(np.uint64)


def document_sets(docs: DataFrame, key: str, text: str, k: int, num: int, den: int, frequent: np.ndarray, tasks: int) -> DataFrame:
    """(key, n, d1, d2, rare, prefix, whole): set size, digest, number of shingles that are not
    frequent, the shingles whose lists are scanned, and all shingles of a set that may be small."""
    spark = docs.sparkSession
    order = np.argsort(frequent)
    sent = spark.sparkContext.broadcast((frequent[order], order))

    def of(batches):
        tokens, ranks = sent.value
        for part, sets in _sets(batches, text, k):
            n = np.array([len(s) for s in sets], np.int32)
            rare, prefixes = np.zeros(len(sets), np.int32), []
            digests = np.zeros((2, len(sets)), np.uint64)
            for i, s in enumerate(sets):
                digests[:, i] = _digest(s)
                short = _counted(s, tasks)
                at = np.minimum(np.searchsorted(tokens, short), max(len(tokens) - 1, 0))
                often = tokens[at] == short if len(tokens) else np.zeros(len(s), bool)
                rare[i] = len(s) - int(often.sum())
                size = prefix_length(len(s), num, den)
                chosen = s[~often][:size]
                if len(chosen) < size:
                    last = s[often][np.lexsort((s[often], ranks[at[often]]))]
                    chosen = np.concatenate([chosen, last[: size - len(chosen)]])
                prefixes.append(chosen)
            whole = [s if len(s) <= MOST_SMALL else s[:0] for s in sets]
            yield pa.record_batch(
                [part.column(key), pa.array(n), *[pa.array(d.view(np.int64)) for d in digests], pa.array(rare), list_array(prefixes), list_array(whole)],
                names=["key", "n", "d1", "d2", "rare", "prefix", "whole"],
            )

    schema = "key long, n int, d1 long, d2 long, rare int, prefix array<long>, whole array<long>"
    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(of, schema)


def _digest(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits of a sorted set of hashes."""
    with np.errstate(over="ignore"):
        place = np.arange(1, len(s) + 1, dtype=np.uint64)
        return combine(s, place).sum(dtype=np.uint64), combine(place, s).sum(dtype=np.uint64)


def _boundary(sets: DataFrame, num: int, den: int) -> int:
    """The largest size of a small set, by cost. At most MOST_SMALL + 1 rows reach the driver."""
    short = sets.where(f"n between 1 and {MOST_SMALL}")
    sizes = {r["n"]: r["rows"] for r in short.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).collect()}
    lists = short.select(F.explode("prefix").alias("token")).groupBy("token").count()
    mean = lists.agg(F.try_divide(F.sum(F.col("count") * F.col("count")), F.sum("count"))).first()[0] or 1.0

    def cost(bound: int) -> float:
        small = sum(rows * n_subsets(n, num, den) for n, rows in sizes.items() if n <= bound)
        large = sum(rows * prefix_length(n, num, den) * mean for n, rows in sizes.items() if n >= num * (bound + 1) / den)
        return small + large

    return min(range(MOST_SMALL + 1), key=lambda b: (cost(b), b))


def _subset_links(reps: DataFrame, bound: int, num: int, den: int) -> DataFrame:
    """Links among small sets, each set with the smallest set of each of its blocks."""

    def subsets(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                keys, sizes, one, two, n = [], [], [], [], []
                for key, whole in zip(part.column("key").to_pylist(), part.column("whole").to_pylist()):
                    values = np.array(whole, np.int64).view(np.uint64)
                    marks = [combine(values, np.full(len(values), seed, np.uint64)) for seed in (1, 2)]
                    for c in subset_sizes(len(values), num, den):
                        left_out = np.array(list(combinations(range(len(values)), len(values) - c)), np.int64)
                        for out, mark in ((one, marks[0]), (two, marks[1])):
                            # A sum of mixed hashes names a subset; leaving out is subtracting.
                            out.append(mark.sum(dtype=np.uint64) - (mark[left_out].sum(axis=1, dtype=np.uint64) if c < len(values) else np.zeros(1, np.uint64)))
                        keys.append(np.full(len(one[-1]), key))
                        sizes.append(np.full(len(one[-1]), c))
                        n.append(np.full(len(one[-1]), len(values)))
                if keys:
                    columns = [np.concatenate(x) for x in (keys, n, sizes, one, two)]
                    yield pa.record_batch(
                        [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in columns],
                        names=["key", "n", "c", "h1", "h2"],
                    )

    blocks = reps.where(f"n between 1 and {bound}").select("key", "whole").mapInArrow(subsets, "key long, n long, c long, h1 long, h2 long")
    block = ["c", "h1", "h2"]
    hubs = blocks.groupBy(*block).agg(F.min(F.struct("n", "key")).alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    joined = blocks.join(hubs, block).where(F.col("key") != F.col("hub.key"))
    enough = F.col("c") * (num + den) >= num * (F.col("n") + F.col("hub.n"))
    return joined.where(enough).select(F.col("hub.key").alias("a"), F.col("key").alias("b")).distinct()


def _plausible(pairs: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """The candidate pairs whose scanned shingles do not rule them out.

    Of two sets, the one whose scanned shingles end first in the order shares, beyond those both scan,
    at most the shingles it does not scan. The rest must make up the least overlap.
    """
    of = reps.select("key", "n", "prefix")
    left = of.withColumnsRenamed({"key": "a", "n": "n1", "prefix": "p1"})
    right = of.withColumnsRenamed({"key": "b", "n": "n2", "prefix": "p2"})
    both = pairs.join(left, "a").join(right, "b")
    scanned = F.size(F.array_intersect("p1", "p2"))
    beyond = F.greatest(F.col("n1") - F.size("p1"), F.col("n2") - F.size("p2"))
    return both.where((scanned + beyond) * (num + den) >= num * (F.col("n1") + F.col("n2"))).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, k: int, num: int, den: int) -> DataFrame:
    """The candidate pairs (a, b) that link, by their whole texts."""
    texts = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text")).where("__key is not null")
    # Few keys go to every task, so that only their texts are shuffled, not all of them.
    involved = written(pairs.select(F.explode(F.array("a", "b")).alias("__key")).distinct())
    texts = written(texts.join(sized(involved), "__key", "left_semi").groupBy("__key").agg(F.max("__text").alias("__text")))
    left = texts.select(F.col("__key").alias("a"), F.col("__text").alias("text_a"))
    right = texts.select(F.col("__key").alias("b"), F.col("__text").alias("text_b"))

    def similar(batches):
        for part in slices(batches, "text_b", rows=256):
            both = []
            for name in ("text_a", "text_b"):
                words, bounds = SPACED.hashes(*text_bytes(part.column(name)))
                both.append(list(shingle_sets(words, bounds, k)))
            keep = [
                den * (shared := len(np.intersect1d(x, y, assume_unique=True))) >= num * (len(x) + len(y) - shared) and shared > 0
                for x, y in zip(*both)
            ]
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(similar, "a long, b long")


def ngram_jaccard_components(
    docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest key reachable over links of similarity ``num / den`` or more. A
    null or empty text has no shingles and links with nothing. Rows of one key are one node; their
    texts should be equal (else one of their sets counts, and a link may be that of another). A null key gets a null
    component. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    size = docs.select(F.sum(F.length(text))).first()[0] or 0
    tasks = int(max(8, 1 + size // 6 // COUNTED_PER_TASK))
    frequent = frequent_shingles(docs, text, k, tasks)
    sets = written(document_sets(docs, key, text, k, num, den, frequent, tasks))

    distinct = sets.where("key is not null and n > 0")
    classes = distinct.groupBy("n", "d1", "d2").agg(F.min("key").alias("rep"))
    member = distinct.join(classes, ["n", "d1", "d2"]).groupBy("key").agg(F.min("rep").alias("rep"))
    member = written(member)
    heads = classes.select(F.col("rep").alias("key")).distinct()
    reps = written(distinct.join(heads, "key", "left_semi").dropDuplicates(["key"]).select("key", "n", "rare", "prefix", "whole"))

    bound = _boundary(reps, num, den)
    links = [_subset_links(reps, bound, num, den)]

    # A set can hold its partners only among those of a similar size: small ones near the boundary scan too.
    postings = reps.where(F.col("n") * den >= num * (bound + 1)).select("key", "n", "rare", F.posexplode("prefix").alias("pos", "token"))
    lists = postings.groupBy("token").agg(F.min(F.struct("rare", "n", "key", "pos")).alias("hub"), F.count(F.lit(1)).alias("members"))
    shared = written(postings.join(lists.where("members > 1").select("token", "hub"), "token"))
    # Two sets that must share c shingles share one of the first n - c + 1 of either: fewer of them the
    # more alike their sizes are.
    needed = F.floor((num * (F.col("n") + F.col("n2")) + (num + den - 1)) / (num + den))
    fits = (F.col("pos") + needed <= F.col("n")) & (F.col("pos2") + needed <= F.col("n2"))
    to_hub = shared.where(F.col("key") != F.col("hub.key")).withColumns({"n2": F.col("hub.n"), "pos2": F.col("hub.pos")}).where(fits)
    to_hub = to_hub.select(F.col("hub.key").alias("a"), F.col("key").alias("b")).distinct()
    first = written(links[0].unionByName(_verified(written(_plausible(to_hub, reps, num, den)), docs, key, text, k, num, den)))
    found = connected_components(first)

    # The rest: pairs of a list that are in different components so far.
    grouped = shared.select("token", "key", "n", "pos").join(found.withColumnRenamed("node", "key"), "key", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "key"))
    mixed = grouped.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    grouped = written(grouped.join(mixed.select("token"), "token", "left_semi"))
    other = grouped.select("token", F.col("key").alias("key2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("component").alias("component2"))
    pairs = grouped.join(other, "token").where((F.col("component") < F.col("component2")) & fits)
    pairs = pairs.select(F.least("key", "key2").alias("a"), F.greatest("key", "key2").alias("b")).distinct()
    tried = to_hub.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = _verified(written(_plausible(pairs.join(tried, ["a", "b"], "left_anti"), reps, num, den)), docs, key, text, k, num, den)
    found = connected_components(first.unionByName(second))

    of_rep = member.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    classes = of_rep.select("key", F.coalesce("component", "rep").alias("component"))
    # The smallest key of a component is the representative of its class, so the minimum is over all.
    result = sets.select("key", "n").join(classes, "key", "left")
    return result.select(
        F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "key").alias("component_id")
    )


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Set size and component of every document (3 words, 0.9); odd rows as in :func:`ngram_jaccard_components`."""
    return ngram_jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, num=9, den=10)


def keep_one_per_group(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` without the documents that are not the first of their component; columns unchanged.

    The key is ``doc_id``. Rows without one stay; of rows with equal keys all stay or all go; empty texts stay.
    """
    groups = ngram_jaccard_components(docs, k, num, den)
    gone = written(groups.where("doc_id <> component_id").select("doc_id").distinct())
    return docs.join(sized(gone), "doc_id", "left_anti").select(*docs.columns)


def stage_ngram_jaccard_join(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near duplicates on five-word shingles at 0.8: one document of each group stays."""
    return keep_one_per_group(docs)
