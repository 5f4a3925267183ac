"""Approximate nearest neighbours by cosine: a forest of sorted hash strings (LSH forest).

A vector's hash string in a tree is the row of signs of BITS random projections; a tree is the sorted
array of the strings. A query descends each tree to its longest matching prefixes: those are a range of the
array. All trees then ascend together, one bit at a time, until the ranges hold CANDIDATES rows; these
are ranked by exact cosine in double precision.

Rows are split into shards of at most SHARD rows, each with its own forest, so memory is bounded and
candidates per query grow in proportion to the rows. Queries visit every shard in blocks; a shard
answers with its nearest, and the best of all shards remain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

SHARD, BLOCK = 4096, 2048
TREES, BITS = 32, 32
#: Parts of the shards for each core.
PARTS_PER_CORE = 4
#: Candidates per query and shard, as a share of the shard. Isotropic vectors need a large one:
#: signs of projections say little about neighbours at a cosine of 0.4.
CANDIDATES = 0.5


def _usable(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors as doubles; None for null, zero, empty or holding null or non-finite components."""
    out = []
    for v in column:
        x = None
        if v.is_valid and len(v.values) and not v.values.null_count:
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            # A power of two scales without rounding: squares of very large or small components stay finite.
            x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])) if np.isfinite(x).all() and x.any() else None
        out.append(x)
    return out


def _packed(df: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """(dim, ids, data): rows of one dimension packed up to ``size`` at a time, where they are."""

    def pack(batches):
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def flush(dim):
            ids, xs = held.pop(dim)
            return pa.record_batch(
                [pa.array([dim]), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([np.stack(xs).tobytes()], pa.binary())],
                names=["dim", "ids", "data"],
            )

        for batch in batches:
            for i, x in zip(batch.column("key").to_pylist(), _usable(batch.column("vector"))):
                if x is not None and i is not None:
                    ids, xs = held.setdefault(len(x), ([], []))
                    ids.append(i)
                    xs.append(x)
                    if len(ids) == size:
                        yield flush(len(x))
        for dim in list(held):
            yield flush(dim)

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"))
    return rows.mapInArrow(pack, "dim long, ids binary, data binary")


class Forest:
    """Sorted arrays of hash strings over the rows of one shard."""

    def __init__(self, x: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.bits = bits
        rng = np.random.default_rng(11)
        self.planes = [rng.standard_normal((x.shape[1], bits)) for _ in range(trees)]
        self.sorted, self.rows = [], []
        for strings in self.strings(x):
            order = np.argsort(strings, kind="stable")
            self.sorted.append(strings[order])
            self.rows.append(order)

    def strings(self, x: np.ndarray) -> list[np.ndarray]:
        weight = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        return [((x @ p > 0) * weight).sum(axis=1) for p in self.planes]

    def candidates(self, queries: np.ndarray, wanted: int):
        """Per query the rows in the ranges of the longest prefix at which the trees hold ``wanted``."""
        strings = self.strings(queries)
        low = np.zeros((self.bits + 1, len(strings), len(queries)), np.int32)
        high = np.zeros_like(low)
        for tree, (s, q) in enumerate(zip(self.sorted, strings)):
            for depth in range(self.bits + 1):
                shift = self.bits - depth
                prefix = q >> shift << shift
                low[depth, tree] = np.searchsorted(s, prefix)
                high[depth, tree] = np.searchsorted(s, prefix + (1 << shift))
        total = (high - low).sum(axis=1)
        for i in range(len(queries)):
            # Descend as far as the trees together still offer several times what is wanted (ranges
            # overlap), then ascend together until enough different rows are found.
            depth = int(np.flatnonzero(total[:, i] >= min(wanted, total[0, i]))[-1])
            while True:
                mark = np.zeros(len(self.rows[0]), bool)
                for tree, rows in enumerate(self.rows):
                    mark[rows[low[depth, tree, i] : high[depth, tree, i]]] = True
                if depth == 0 or mark.sum() >= wanted:
                    break
                depth -= 1
            yield np.flatnonzero(mark)


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each query, ties to smaller keys.

    Shards are dealt out to PARTS_PER_CORE parts per core, and every part gets all query blocks: a shard's forest
    is built once, where the shard is. Repeated rows are candidates once.

    Rows and queries with a null key, and vectors that are null, zero, empty or not finite, take no part;
    vectors of another dimension are no candidates. The row of a query's own key is none either.
    """
    count = max(1, -(-rows.count() // SHARD))
    parts = min(count, PARTS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)
    blocks = _packed(queries, key, vector, BLOCK).withColumnsRenamed({"ids": "query_ids", "data": "query_data"})
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(parts, "dim", "part")
    shards = _packed(rows.repartition(count), key, vector, SHARD)
    dealt = F.pmod(F.spark_partition_id(), F.lit(parts)).alias("part")
    shards = shards.select("*", dealt).repartition(parts, "dim", "part")

    def search(batches):
        known, forest = None, None
        for batch in batches:
            for start in range(batch.num_rows):  # a row holds a whole shard and a whole block
                row = batch.slice(start, 1).to_pylist()[0]
                ids = np.frombuffer(row["ids"], np.int64)
                x = np.frombuffer(row["data"]).reshape(len(ids), row["dim"])
                if (row["dim"], row["ids"]) != known:
                    known, forest = (row["dim"], row["ids"]), Forest(x)
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                q = np.frombuffer(row["query_data"]).reshape(len(query_ids), row["dim"])
                length, q_length = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
                wanted = max(4 * k, int(CANDIDATES * len(ids)))
                out = [[], [], []]
                for i, found in enumerate(forest.candidates(q, wanted)):
                    found = found[ids[found] != query_ids[i]]
                    # Sums of products row by row: equal vectors get equal scores.
                    score = (x[found] * q[i]).sum(axis=1) / (length[found] * q_length[i])
                    if len(found) > 8 * k:
                        part = score >= np.partition(score, -k)[-k]
                        found, score = found[part], score[part]
                    best = np.lexsort((ids[found], -score))[:k]
                    out[0].append(np.full(len(best), query_ids[i]))
                    out[1].append(ids[found[best]])
                    out[2].append(score[best])
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in out], names=["query_id", "vec_id", "score"])

    paired = shards.join(blocks, ["dim", "part"])
    found = paired.mapInArrow(search, "query_id long, vec_id long, score double").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_ann_prefix_forest(spark, sf_dir: str) -> DataFrame:
    """Five nearest rows of each fiftieth vector; odd and repeated rows as in :func:`nearest`."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(rows, rows.where("vec_id % 50 = 0"))
