"""Quality from weak labels: heuristic labellers, their accuracies by expectation-maximisation, and a
linear scorer on hashed features that learns the posterior labels.

Every labeller calls a document low, fine or abstains. The distinct vote patterns of all documents are
counted (at most 3 ** labellers of them, whatever the corpus); EM on the counts estimates how often each
labeller calls low and fine documents low, and so the probability of low for each pattern. The
scorer is a logistic regression on hashed byte-class trigrams and repetition features, fitted on a
bounded sample of documents weighted to the posterior; it scores every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from musterline.llm.text_hashing import SPACED, slices, text_bytes, with_fields
from musterline.session import written

#: Documents that the scorer is fitted on: so many of each posterior label, by hash of the text.
SAMPLE_PER_CLASS = 2_500
DIMENSIONS = 1024

#: The labellers: name, feature, at most this is fine, at least this is low (between: abstain).
LABELLERS = (
    ("shouting", "upper", 0.30, 0.60),
    ("symbols", "symbol", 0.015, 0.05),
    ("exclaiming", "exclaim", 0.05, 0.30),
    ("cells", "cell", 0.02, 0.15),
    ("stuttering", "stutter", 0.06, 0.30),
    ("few words", "repeat", 0.80, 0.93),
    ("repeated lines", "lines", 0.30, 0.60),
    ("one word", "top", 0.20, 0.40),
)
FEATURES = ("upper", "symbol", "exclaim", "cell", "stutter", "repeat", "lines", "top")


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, 7)
    for i in range(256):
        c = chr(i)
        if i >= 0x80:
            kinds[i] = 1
        elif c.isalpha():
            kinds[i] = 1 if c.islower() else 2
        elif c.isdigit():
            kinds[i] = 3
        elif c == " ":
            kinds[i] = 0
        elif c == "\n":
            kinds[i] = 4
        elif c in ".,;:'\"()-?":
            kinds[i] = 5
        else:
            kinds[i] = 6 + i % 9
    return kinds


_KINDS = _byte_classes()
_UPPER, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91], _LETTER[65:91], _LETTER[97:123] = True, True, True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*@^~|<>{}[]\\=+_`"]] = True


def _share(flags: np.ndarray, of: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(of, 1)


def _group_sizes(keys: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of distinct keys and the count of its most frequent one."""
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (r[1:] != r[:-1])]) if len(k) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(k)))
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, r[first], size)
    return np.bincount(r[first], minlength=rows), most


def describe(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(FEATURES, hashed trigram shares) of each text; all zero for a null or empty one."""
    data, bounds = text_bytes(column)
    data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
    rows, size = len(bounds) - 1, np.diff(bounds)
    words, cuts = SPACED.hashes(data, bounds)
    n = np.diff(cuts)
    row = np.repeat(np.arange(rows), n)
    out = np.zeros((rows, len(FEATURES)))
    letters = _share(_LETTER[data], np.ones(rows), bounds)
    out[:, 0] = _share(_UPPER[data], letters, bounds)
    out[:, 1] = _share(_SYMBOL[data], size, bounds)
    out[:, 2] = np.minimum(1, _share(data == ord("!"), n, bounds) / 2)
    out[:, 3] = _share(data == ord("|"), n, bounds)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    out[:, 4] = _share(same, n, cuts)
    distinct, most = _group_sizes(words, row, rows)
    # A long text has fewer distinct words per word: compare with what a text of that length may have.
    out[:, 5] = np.where(n >= 30, 1 - distinct / np.maximum(np.minimum(n, 400), 1), 0).clip(0)
    out[:, 7] = np.where(n >= 10, most / np.maximum(n, 1), 0)
    # Lines as words between line breaks.
    ends = np.flatnonzero(data == 10)
    line_bounds = np.unique(np.concatenate([bounds, ends + 1]))
    line_row = np.searchsorted(bounds, line_bounds[:-1], side="right") - 1
    word_line = np.searchsorted(line_bounds, _word_starts(data, bounds), side="right") - 1
    names = np.zeros(max(len(line_bounds) - 1, 1), np.uint64)  # a line is named by the sum of its words
    np.add.at(names, word_line, words)
    filled = np.bincount(word_line, minlength=len(names)) > 0
    line_row, names = line_row[filled[: len(line_row)]], names[: len(line_row)][filled[: len(line_row)]]
    lines = np.bincount(line_row, minlength=rows)
    kinds, _ = _group_sizes(names, line_row, rows)
    out[:, 6] = np.where(lines >= 3, 1 - kinds / np.maximum(lines, 1), 0)

    k = _KINDS[data]
    tri = k[:-2] * 225 + k[1:-1] * 15 + k[2:] if len(k) > 2 else np.zeros(0, np.int64)
    place = (tri * 0x9E3779B1 & 0xFFFFFFFF) >> 22
    of = np.repeat(np.arange(rows), size)[: len(tri)]
    hist = np.bincount(of * DIMENSIONS + place, minlength=rows * DIMENSIONS).reshape(rows, DIMENSIONS)
    return out, (np.sqrt(hist / np.maximum(size, 1)[:, None])).astype(np.float32)


def _word_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    inside = ~SPACED.separator[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = bounds[:-1][bounds[:-1] < len(data)]
    first[begins] |= inside[begins]
    return np.flatnonzero(first)


def votes(features: np.ndarray) -> np.ndarray:
    """One number per row whose base-3 digits are the votes: 0 fine, 1 low, 2 abstains."""
    total = np.zeros(len(features), np.int64)
    for i, (_, name, fine, low) in enumerate(LABELLERS):
        x = features[:, FEATURES.index(name)]
        total += np.where(x >= low, 1, np.where(x <= fine, 0, 2)) * 3**i
    return total


def expectation_maximisation(patterns: np.ndarray, rows: np.ndarray, turns: int = 400) -> np.ndarray:
    """Probability of low per pattern; starts from: low where a labeller says so.

    Kinds of bad text mostly exclude one another, so there is one class of low documents per labeller,
    in which only that labeller votes otherwise than on fine documents, and one class in which all may.
    Every labeller's rate of low votes on fine documents is estimated. It abstains as often on low as on
    fine documents, so an abstention says nothing. In no class does it vote low more rarely than on fine
    documents. The priors weigh a few rows, whatever the corpus.
    """
    n = len(LABELLERS)
    digits = patterns[:, None] // 3 ** np.arange(n) % 3
    said_low, said = (digits == 1).astype(float), (digits != 2).astype(float)
    # Classes: fine, one per labeller, all labellers.
    own = np.eye(n + 2, n, -1, dtype=bool)
    plain = ~own
    plain[-1] = False
    none, any_low = ~said_low.any(axis=1), said_low.sum(axis=1)
    of = np.zeros((len(patterns), n + 2))
    of[:, 0] = np.where(none, 0.98, 0.1)
    of[:, 1:-1] = np.where(none[:, None], 0.01 / n, 0.8 * said_low / np.maximum(any_low, 1)[:, None])
    of[:, -1] = 1 - of.sum(axis=1)
    for _ in range(turns):
        weight = of * rows[:, None]
        low_votes, all_votes = weight.T @ said_low, weight.T @ said
        on_fine = ((low_votes * plain).sum(axis=0) + 0.02) / ((all_votes * plain).sum(axis=0) + 2.0)
        rate = np.where(own, (low_votes + 9.0) / (all_votes + 10.0), on_fine)
        rate[-1] = (low_votes[-1] + 1.0) / (all_votes[-1] + 2.0)
        rate = np.maximum(rate, on_fine)
        share = weight.sum(axis=0) + 1.0
        log = np.log(share) + said_low @ np.log(rate).T + (said - said_low) @ np.log1p(-rate).T
        before, of = of, np.exp(log - log.max(axis=1, keepdims=True))
        of /= of.sum(axis=1, keepdims=True)
        if np.abs(of - before).max() < 1e-6:
            break
    return 1 - of[:, 0]


def _design(features: np.ndarray, hist: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(hist), 1)), np.minimum(features, 1) * 4, hist], axis=1)


def fit_linear(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 2.0) -> np.ndarray:
    """Weighted logistic regression on soft targets, by Newton's steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(penalty)
        w -= np.linalg.solve(curve, gradient)
    return w


def fit_quality(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Weights of the scorer, from the documents alone."""

    def voted(batches):
        for part in slices(batches, text):
            yield pa.record_batch([pa.array(votes(describe(part.column(text))[0])), part.column("h")], names=["pattern", "h"])

    texts = docs.select(F.col(text).cast("string").alias(text)).where(F.length(text) > 0).withColumn("h", F.crc32(text))
    # Votes of all documents; only the counts per pattern are gathered.
    voted_on = written(texts.mapInArrow(voted, "pattern long, h long"))
    table = voted_on.groupBy("pattern").agg(F.count(F.lit(1)).alias("rows")).orderBy("pattern").toArrow()
    width = 1 + len(FEATURES) + DIMENSIONS
    if not table.num_rows:
        return np.zeros(width)
    patterns, rows = table.column("pattern").to_numpy(), table.column("rows").to_numpy()
    low = expectation_maximisation(patterns, rows)

    # The sample: distinct hashes first, so a text with many copies counts once.
    bad = F.col("pattern").isin([int(p) for p in patterns[low >= 0.5]])
    chosen = [
        voted_on.where(bad if is_low else ~bad).select("h").distinct().orderBy("h").limit(SAMPLE_PER_CLASS) for is_low in (False, True)
    ]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]).distinct())
    sample = texts.join(chosen, "h", "left_semi").groupBy("h").agg(F.min(text).alias(text))
    class_rows = np.array([rows[low < 0.5].sum(), rows[low >= 0.5].sum()], float)

    def fitted(table):
        x, p = [], []
        for part in slices(table.sort_by("h").to_batches(), text):
            seen, hist = describe(part.column(text))
            x.append(_design(seen, hist))
            at = np.minimum(np.searchsorted(patterns, votes(seen)), len(patterns) - 1)
            p.append(low[at])
        p = np.concatenate(p)
        is_low = (p >= 0.5).astype(int)
        sampled = np.maximum(np.bincount(is_low, minlength=2), 1)
        weight = np.minimum(class_rows / sampled, class_rows.sum() / sampled.sum())[is_low]
        return pa.table({"w": fit_linear(np.concatenate(x), 1 - p, weight / weight.mean())})

    return sample.groupBy(F.lit(0).alias("one")).applyInArrow(fitted, "w double").toArrow().column("w").to_numpy()


def score_quality(docs: DataFrame, weights: np.ndarray, text: str = "text", score: str = "quality_score") -> DataFrame:
    """``docs`` with the probability that a text is fine (0 for a null or empty one).

    All columns stay; one that is already called ``score`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    kept = docs.drop(score)

    def scored(batches):
        for part in slices(batches, text):
            x = _design(*describe(part.column(text)))
            p = 1 / (1 + np.exp(-np.clip(x @ sent.value, -30, 30)))
            empty = np.diff(text_bytes(part.column(text))[1]) == 0
            yield pa.record_batch([*part.columns, pa.array(np.where(empty, 0.0, p))], names=[*part.schema.names, score])

    return kept.mapInArrow(scored, with_fields(kept.schema, f"`{score}` double"))


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Score and verdict of every document, fitted on votes over all of them; a null text counts as empty."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs))
    return scored.select("doc_id", "quality_score", (F.col("quality_score") < 0.5).alias("rejected"))


def stage_quality_classifier(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject."""
    scored = score_quality(docs, fit_quality(docs), score="__quality")
    return scored.where("__quality >= 0.5").select(*docs.columns)
