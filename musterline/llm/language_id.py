"""Language by nearest centroid: TF-IDF vectors of character n-grams, several centroids per language.

Vectors count the letter n-grams (1 to 3 characters, what is no letter is a space) of a whole text in
hashed places, damp them by a logarithm, weigh them by inverse document frequency over all training
texts, and have length 1. Each language has a few centroids, found by spherical k-means; a text gets
the language of the centroid with the greatest cosine. A text farther from it than nearly all
training texts of that language is marked as rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from musterline.llm.decontamination import sized
from musterline.llm.text_hashing import slices, with_fields
from musterline.llm.toxicity import held_out
from musterline.session import written

DIMENSIONS = 4096
CENTROIDS = 4
#: Centroids are fitted on so many texts per language, those with the smallest hash of their key.
SAMPLE_PER_LANGUAGE = 1_000
LEADING_BITS = 16
#: Texts are compared with so many centroids at a time.
BLOCK = 1_024
#: Share of a language's sample that lies farther from its centroids than the limit of rejection.
REJECTED_SHARE = 0.005
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_letters: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _letters[0][codes]


def counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A row of n-gram counts per text, and whether it has a letter."""
    joined = [f" {t.lower()} " if t else " " for t in texts]
    bounds = np.cumsum([0, *map(len, joined)])
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter(codes)
    codes = np.where(letter, codes, np.uint32(32))
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    total = np.zeros(len(texts) * DIMENSIONS, np.int64)
    hashed, some = np.zeros(len(codes), np.uint32), np.zeros(len(codes), bool)
    for n in range(1, 4):
        hashed = hashed[: len(codes) - n + 1] * _MIX[2] + codes[n - 1 :] * _MIX[0] + _MIX[1]
        some = some[: len(codes) - n + 1] | letter[n - 1 :]
        keep = some & (row[: len(hashed)] == row[n - 1 :])
        place = ((hashed ^ (hashed >> np.uint32(15))) * _MIX[1]) >> np.uint32(20)
        total += np.bincount(row[: len(hashed)][keep] * DIMENSIONS + place[keep], minlength=len(total))
    found = np.bincount(row[letter], minlength=len(texts)) > 0
    return total.reshape(len(texts), DIMENSIONS), found


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(count).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids of length 1 by spherical k-means, started from texts far from one another."""
    chosen = [0]
    nearest = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    centre = x[chosen]
    for _ in range(12):
        of = (x @ centre.T).argmax(axis=1)
        sums = np.stack([x[of == i].sum(axis=0) if (of == i).any() else centre[i] for i in range(len(centre))])
        centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centre


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id"):
    """(idf, languages, centroids, limits) from the rows with a language and a text with a letter."""
    rows = docs.select(F.col(key).alias("__key"), F.col(lang).alias("__lang"), F.col(text).alias("__text"))
    rows = rows.where("__lang is not null and __text is not null")

    def document_counts(batches):
        df, n = np.zeros(DIMENSIONS, np.int64), 0
        for part in slices(batches, "__text", rows=256):
            count, found = counts(part.column("__text").to_pylist())
            df += (count > 0).sum(axis=0)
            n += int(found.sum())
        if n:
            yield pa.record_batch([pa.array(np.arange(DIMENSIONS + 1)), pa.array(np.append(df, n))], names=["place", "df"])

    totals = rows.select("__text").mapInArrow(document_counts, "place long, df long").groupBy("place").agg(F.sum("df").alias("df"))
    totals = totals.orderBy("place").toArrow().column("df").to_numpy()
    if not len(totals):
        return np.ones(DIMENSIONS, np.float32), [], np.zeros((0, DIMENSIONS), np.float32), np.zeros(0)
    idf = (np.log((1 + totals[-1]) / (1 + totals[:-1])) + 1).astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast(idf)

    # Rank by (hash, key) within a language: Spark keeps only the best rows of each task before the shuffle.
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("__lang").orderBy(F.xxhash64("__key"), "__key"))
    # Before that, the hashes beyond those that can be among the first of a language are left out, by a count of
    # their leading bits: a rank sees little more than the rows it keeps, however many there are.
    lead = F.shiftright(F.xxhash64("__key"), 64 - LEADING_BITS)
    leads = rows.groupBy("__lang", lead.alias("__lead")).agg(F.count(F.lit(1)).alias("n"))
    until = F.sum("n").over(Window.partitionBy("__lang").orderBy("__lead"))
    before = leads.withColumn("before", until - F.col("n")).where(F.col("before") < SAMPLE_PER_LANGUAGE)
    last = written(before.groupBy("__lang").agg(F.max("__lead").alias("__last")))
    keys = rows.select("__key", "__lang").join(sized(last), "__lang").where(lead <= F.col("__last")).drop("__last")
    keys = keys.withColumn("__rank", rank)
    keys = written(keys.where(F.col("__rank") <= SAMPLE_PER_LANGUAGE).select("__key", "__lang").distinct())
    sample = rows.join(sized(keys), ["__key", "__lang"])

    def centroids(key, table):
        x, found = [], []
        for part in slices(table.to_batches(), "__text", rows=128):
            count, some = counts(part.column("__text").to_pylist())
            x.append(vectors(count, sent.value)[some])
        x = np.concatenate(x)
        if not len(x):
            return pa.table({"__lang": pa.array([], pa.string()), "centre": pa.array([], pa.binary()), "limit": pa.array([], pa.float64())})
        centre = cluster(x, CENTROIDS)
        limit = float(np.quantile((x @ centre.T).max(axis=1), REJECTED_SHARE))
        return pa.table({"__lang": pa.array([key[0].as_py()] * len(centre)), "centre": pa.array([c.tobytes() for c in centre], pa.binary()), "limit": [limit] * len(centre)})

    model = sample.select("__lang", "__text").groupBy("__lang").applyInArrow(centroids, "__lang string, centre binary, limit double")
    model = model.toArrow().sort_by([("__lang", "ascending"), ("centre", "ascending")])
    centres = [np.frombuffer(c, np.float32) for c in model.column("centre").to_pylist()]
    stacked = np.stack(centres) if centres else np.zeros((0, DIMENSIONS), np.float32)
    return idf, model.column("__lang").to_pylist(), stacked, model.column("limit").to_numpy()


def identify_languages(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (the greatest cosine, 0 to 1) and rejected.

    lang_pred is ``und`` for a null text or one without a letter, whose score is 0. All columns stay;
    those of the results' names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "score", "rejected")

    def predicted(batches):
        idf, languages, centres, limits = sent.value
        names = np.array([*languages, "und"], object)
        for part in slices(batches, text, rows=256):
            count, found = counts(part.column(text).to_pylist())
            x = vectors(count, idf)
            best, near = np.full(len(found), len(languages)), np.full(len(found), -np.inf, np.float32)
            for start in range(0, len(centres), BLOCK):
                cosine = x @ centres[start : start + BLOCK].T
                at = cosine.argmax(axis=1)
                top = cosine[np.arange(len(at)), at]
                closer = found & (top > near)
                best[closer], near[closer] = start + at[closer], top[closer]
            score = np.where(best < len(languages), np.clip(near, 0, 1), 0).astype(float)
            rejected = score < np.append(limits, 1.0)[best]
            columns = [pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.record_batch([*part.columns, *columns], names=[*part.schema.names, "lang_pred", "score", "rejected"])

    return kept.mapInArrow(predicted, with_fields(kept.schema, "lang_pred string, score double, rejected boolean"))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document; null texts and those without a letter are ``und``, other columns are no inputs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_languages(docs.where(~held_out("doc_id", 3, 1)))
    found = identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "rejected")
