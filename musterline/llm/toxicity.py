"""Toxicity scores: logistic regression on hashed word n-grams and skip-grams, fitted by FTRL-proximal.

Features of a text are its distinct words, their stems (first STEMS bytes, for inflected forms), word
pairs and pairs with one word between, hashed to DIMENSIONS places. Each weight has its own learning rate, and L1 keeps most at zero, so the model
that goes to the tasks is a short list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from musterline.llm.text_hashing import ALNUM, combine, list_array, slices, text_bytes, with_fields

DIMENSIONS = 1 << 20
#: Labelled rows that the model is fitted on: those with the smallest hash of their key.
SAMPLE_ROWS = 12_000
EPOCHS = 2
STEMS = (4, 6)
ALPHA, BETA, L1, L2 = 0.15, 1.0, 2.0, 1.0


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every word, stem, pair and skip pair, repeats included."""
    data, limits = text_bytes(column)
    words, bounds = ALNUM.hashes(data, limits)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    parts = [(text, words)]
    for n in STEMS:
        stems = ALNUM.hashes(data, limits, first=n)[0]
        parts.append((text, combine(stems, np.full(len(stems), n, np.uint64))))
    for gap in (1, 2):
        same = text[:-gap] == text[gap:]
        parts.append((text[:-gap][same], combine(words[:-gap], words[gap:], np.full(max(len(words) - gap, 0), gap, np.uint64))[same]))
    shift = np.uint64(64 - DIMENSIONS.bit_length() + 1)
    return np.concatenate([t for t, _ in parts]), (np.concatenate([h for _, h in parts]) >> shift).astype(np.int64)


def fit_ftrl(rows: list[np.ndarray], labels: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and weights from one pass after the other over ``rows`` of feature places."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    l1 = np.full(DIMENSIONS + 1, L1)
    l1[DIMENSIONS] = 0

    def weights(at):
        size = np.maximum(np.abs(z[at]) - l1[at], 0)
        return -np.sign(z[at]) * size / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for row, label in zip(rows, labels):
            at = np.append(row, DIMENSIONS)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    all_weights = weights(np.arange(DIMENSIONS + 1))
    return float(all_weights[-1]), all_weights[:-1]


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic"):
    """(intercept, places, weights) from at most SAMPLE_ROWS labelled rows.

    ``labels`` has a key and a label of 0 or 1; rows without either are ignored, of a repeated key the
    larger label counts. Without labelled texts, the model scores everything 0.5.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(F.max(label).cast("int").alias("__label"))
        .orderBy(F.xxhash64("__key"), "__key")
        .limit(SAMPLE_ROWS)
    )
    sample = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__key")

    def distinct(batches):
        for part in slices(batches, "__text"):
            of, place = _features(part.column("__text"))
            found = np.unique(of * DIMENSIONS + place)
            cuts = np.searchsorted(found, np.arange(part.num_rows + 1) * DIMENSIONS)
            rows = [(found[a:b] % DIMENSIONS) for a, b in zip(cuts, cuts[1:])]
            yield pa.record_batch([part.column("__key"), part.column("__label"), list_array(rows)], names=["__key", "__label", "places"])

    def fitted(table):
        table = table.sort_by("__key")
        rows = [np.asarray(x.values) for x in table.column("places")]
        order = np.random.default_rng(7).permutation(len(rows))
        y = table.column("__label").to_numpy()
        intercept, w = fit_ftrl([rows[i] for i in order], y[order])
        at = np.flatnonzero(w)
        return pa.table({"place": np.append(at, -1), "weight": np.append(w[at], intercept)})

    kind = sample.schema["__key"].dataType.simpleString()
    rows = sample.select("__key", "__label", "__text").mapInArrow(distinct, f"__key {kind}, __label int, places array<long>")
    model = rows.groupBy(F.lit(0).alias("one")).applyInArrow(fitted, "place long, weight double").toArrow()
    place, weight = model.column("place").to_numpy(), model.column("weight").to_numpy()
    inner = place >= 0
    return float(weight[~inner].sum()), place[inner], weight[inner]


def score_toxicity(docs: DataFrame, model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; an empty or null text gets that of no features.

    All columns stay; one that is already called ``score`` is replaced.
    """
    intercept, place, weight = model
    sent = docs.sparkSession.sparkContext.broadcast((place, weight))
    kept = docs.drop(score)

    def scored(batches):
        weights = np.zeros(DIMENSIONS)
        weights[sent.value[0]] = sent.value[1]
        counts = weights != 0
        for part in slices(batches, text):
            of, at = _features(part.column(text))
            hit = counts[at]
            found = np.unique(of[hit] * DIMENSIONS + at[hit])
            total = np.bincount(found // DIMENSIONS, weights[found % DIMENSIONS], part.num_rows) + intercept
            result = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.record_batch([*part.columns, pa.array(result)], names=[*part.schema.names, score])

    return kept.mapInArrow(scored, with_fields(kept.schema, f"`{score}` double"))


def held_out(key: str, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == fold, F.lit(False))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score of every document, learned from the rows not held out; null and empty texts get a score too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(~held_out("doc_id", 5, 0))
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
