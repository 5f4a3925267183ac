"""Ranked lexical search: dense blocks of item weights times document impacts.

One pass turns every document into its number of terms and its counts of the items' terms. Then tiles of
documents become dense matrices of impacts (a row for each item term that the tile holds), and are multiplied
with the items' weights in float64. All numbers are whole; the rows of a product are cut so that no partial sum
reaches 2^53, where float64 stops being exact, and the parts are added as 64-bit integers. Of a tile, every score
that may belong to the best ones is kept, ties included, before the best are chosen by score and key.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from musterline.llm.text_hashing import ALNUM, list_array, slices, text_bytes
from musterline.session import written

BEST = 20
#: Items searched in one pass have about so many bytes of text; more items take more passes.
ITEM_BYTES = 16 << 20
#: Cells of a dense tile of impacts, and of a tile of scores.
CELLS = 1 << 22
ITEMS, DOCS = 256, 1024
#: Whole numbers below this are exact in float64.
EXACT = 1 << 53
# Fixed values of the measure.
SCALE, STEP, SPREAD, FREE, SHARE = 1_000_000_000, 1000, 12, 75, 25


def _term_counts(words: np.ndarray, bounds: np.ndarray, vocabulary: np.ndarray):
    """(text, term, count) of the terms of the sorted vocabulary, in the order of texts, then terms."""
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[at] == words)
    row = np.searchsorted(bounds, known, side="right") - 1
    keys, counts = np.unique(row * len(vocabulary) + at[known], return_counts=True)
    return keys // len(vocabulary), keys % len(vocabulary), counts


class Query:
    """Items of one pass: their terms as a sorted vocabulary of 64-bit hashes, and counts per item."""

    def __init__(self, keys: list, texts: list[str | None]):
        words, bounds = ALNUM.hashes(*text_bytes(pa.array(texts, pa.large_string())))
        self.vocabulary = np.unique(words)
        self.keys = sorted(set(keys))
        place = {k: i for i, k in enumerate(self.keys)}
        of = np.repeat([place[k] for k in keys], np.diff(bounds)) if len(words) else np.zeros(0, int)
        size = max(len(self.vocabulary), 1)
        cells, counts = np.unique(of * size + np.searchsorted(self.vocabulary, words), return_counts=True)
        self.item, self.term, self.count = cells // size, cells % size, counts


def term_counts(docs: DataFrame, vocabulary: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, terms, counts) of each row: its number of terms, and places in the vocabulary with counts.

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case, known by a 64-bit hash.
    A null text has none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches):
        for part in slices(batches, text, rows=4096, size=4 << 20):
            words, bounds = ALNUM.hashes(*text_bytes(part.column(text)))
            row, term, count = _term_counts(words, bounds, sent.value)
            cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
            lists = [list_array([x[a:b] for a, b in zip(cuts, cuts[1:])]) for x in (term, count)]
            yield pa.record_batch([part.column(0), pa.array(np.diff(bounds), pa.int64()), *lists], names=["key", "n", "terms", "counts"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias(text))
    return rows.mapInArrow(counted, "key long, n long, terms array<long>, counts array<long>")


class Best:
    """The best rows per item so far; a score below the last of BEST is no candidate, an equal one is."""

    def __init__(self, items: int, best: int):
        self.best, self.least = best, np.ones(items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def offer(self, first: int, scores: np.ndarray, keys: np.ndarray, null: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[first : first + len(scores), None])
        if len(item):
            self.parts.append((item + first, scores[item, doc], null[doc], keys[doc]))
            self.held += len(item)
        if self.held > CELLS // 4:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        item, score, null, key = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((key, null, -score, item))
        item, score, null, key = item[order], score[order], null[order], key[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.best - 1
        self.least[item[last]] = score[last]
        kept = tuple(x[rank < self.best] for x in (item, score, null, key))
        self.parts, self.held = [kept], len(kept[0])
        return kept


def _products(weights: np.ndarray, impacts: np.ndarray) -> np.ndarray:
    """weights @ impacts, exact: both hold whole numbers of at least 0; rows are cut before a sum could reach EXACT."""
    most = weights.max(axis=0, initial=0).astype(object) * impacts.max(axis=1, initial=0).astype(object)
    total = np.zeros((len(weights), impacts.shape[1]), np.int64)
    left, right = weights.astype(np.float64), impacts.astype(np.float64)
    start, held = 0, 0
    for i, bound in enumerate([*map(int, most), EXACT]):
        if held + bound >= EXACT:
            total += (left[:, start:i] @ right[start:i]).astype(np.int64)
            start, held = i, 0
        held += bound
    return total


def score_tiles(postings: DataFrame, query: Query, weight: np.ndarray, documents: int, terms: int, best: int = BEST) -> DataFrame:
    """(item, score, key): of every task, each item's best documents with a score above 0."""
    sent = postings.sparkSession.sparkContext.broadcast((query.keys, query.item, query.term, query.count, weight))

    def scored(batches):
        keys, item, term, count, weight = sent.value
        chosen = Best(len(keys), best)
        for batch in batches:
            n = batch.column("n").to_numpy()
            lists, counts = batch.column("terms"), batch.column("counts")
            bounds = lists.offsets.to_numpy()
            all_terms, all_counts = lists.values.to_numpy(), counts.values.to_numpy()
            null = np.asarray(batch.column("key").is_null())
            key = batch.column("key").fill_null(0).to_numpy()
            start = 0
            while start < batch.num_rows:
                # As many documents as a dense tile has room for, whatever terms they hold.
                room = int(np.searchsorted(bounds, bounds[start] + CELLS // 16, side="right")) - 1
                stop = min(batch.num_rows, start + DOCS, max(room, start + 1))
                a, b = bounds[start], bounds[stop]
                held, place = np.unique(all_terms[a:b], return_inverse=True)
                fits = max(1, CELLS // max(len(held), 1))
                if stop - start > fits:
                    stop = start + fits
                    b = bounds[stop]
                    held, place = np.unique(all_terms[a:b], return_inverse=True)
                if len(held):
                    of = np.repeat(np.arange(stop - start), np.diff(bounds[start : stop + 1]))
                    m = FREE + SHARE * n[start:stop] * documents // terms
                    tf = all_counts[a:b]
                    impacts = np.zeros((len(held), stop - start), np.int64)
                    impacts[place, of] = SCALE * tf // (STEP * tf + SPREAD * m[of])
                    column = np.full(len(weight), -1)
                    column[held] = np.arange(len(held))
                    here = column[term] >= 0
                    for first in range(0, len(keys), ITEMS):
                        mine = here & (item >= first) & (item < first + ITEMS)
                        weights = np.zeros((min(ITEMS, len(keys) - first), len(held)), np.int64)
                        weights[item[mine] - first, column[term[mine]]] = count[mine] * weight[term[mine]]
                        chosen.offer(first, _products(weights, impacts), key[start:stop], null[start:stop])
                start = stop
        item, score, null, key = chosen.cut()
        found = [pa.array([keys[i] for i in item.tolist()], pa.int64()), pa.array(score), pa.array(key, mask=null.astype(bool))]
        yield pa.record_batch(found, names=["item", "score", "key"])

    return postings.mapInArrow(scored, "item long, score long, key long")


def _ranked(found: DataFrame, by: list[str], best: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def search_pass(docs: DataFrame, query: Query, key: str, text: str, best: int) -> DataFrame:
    """(item, rank, key, score) of the items of one pass: all documents are counted, then scored."""
    postings = written(term_counts(docs, query.vocabulary, key, text))
    documents, terms = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ln = F.log((F.lit(2 * documents + 2).cast("double")) / (2 * F.col("df") + 1))
    # One row per term of the items of this pass.
    found = holding.select("term", F.floor(1000 * ln).cast("long").alias("weight")).toArrow()
    weight = np.zeros(max(len(query.vocabulary), 1), np.int64)
    weight[found.column("term").to_numpy()] = found.column("weight").to_numpy()
    scored = score_tiles(postings, query, weight, documents, max(terms, 1), best)
    # Many tasks name rows for an item: they are cut per part first, so that no task sorts all of them.
    parts = _ranked(scored.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(64))), ["item", "part"], best).drop("part", "rank")
    return _ranked(parts, ["item"], best).select("item", "rank", "key", "score")


def ranked_search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", best: int = BEST
) -> DataFrame:
    """(item, rank, key, score): each item's ``best`` highest-scoring documents with a score above 0.

    Equal scores rank by ascending key, null last. All rows of ``docs`` count and are searched, repeated rows and
    those without a key too; a null text has no term. Rows of one item are one query, their terms together; rows
    without an item, and items without a term that occurs, give nothing. Items are searched in passes of about
    ITEM_BYTES, so what is broadcast does not grow with their number.
    """
    spark = docs.sparkSession
    rows = items.select(F.col(item).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).where("item is not null")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) + 16 * F.count(F.lit(1))).first()[0]
    passes = int(size) // ITEM_BYTES + 1
    found = []
    for i in range(passes):
        mine = rows.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == i).toArrow()
        if mine.num_rows:
            query = Query(mine.column("item").to_pylist(), mine.column("text").to_pylist())
            if len(query.vocabulary):
                found.append(written(search_pass(docs, query, key, text, best)))
    if not found:
        return spark.createDataFrame([], f"`{item}` long, rank int, `{key}` long, score long")
    return reduce(DataFrame.unionByName, found).select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item; odd rows as in :func:`ranked_search`."""
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
queries AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM queries) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term, docs),
impacts AS (
  SELECT c.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + ((25 * n * docs) // all_terms)))) AS part
  FROM counts c JOIN lengths l USING (doc_id) JOIN weights USING (term), totals),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * part) AS BIGINT) AS score
  FROM queries JOIN impacts USING (term) GROUP BY item_id, doc_id HAVING sum(times * part) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
