"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of features of its text. Pairs of a document labelled good and one labelled
bad are preferences, and the weights minimise the logistic loss on the differences of their features. The threshold
is a quantile of the training strengths: the one that parts the labels best, the lowest of equals, where a good
document rejected weighs as much as ``keep_weight`` bad ones kept. A score is
the strength's distance from it through a logistic curve that passes 0.7 at the threshold.

Only the labels are read for training, and only of rows that aren't held out: crc32 of the doc_id's decimal text
modulo 4 is not 2. At most ``max_labelled`` labelled documents take part (those with the smallest hashes of their
doc_id): a bounded sample, whose features are all that reaches the driver. Language, source and ids are no inputs.

Defined results: null text scores as the empty text; null doc_id is not held out; repeated rows each keep a row
(labels joined to repeated rows count once per row within the sample's bound); without labels of both kinds every
score is 0.75; an empty table gives an empty result; other columns are ignored (``keep_good`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalake.llm.common import pick, positional, rows

GOOD = 0.7
FEATURES = ["words", "mean_word", "unique_words", "repeated_next", "symbols", "bangs", "bars", "upper", "digits",
            "other_marks", "repeated_lines", "longest_word"]
_UPPER, _DIGIT = slice(65, 91), slice(48, 58)


def features(text: str | None) -> np.ndarray:
    """Shape of a text: sizes as logarithms, shares as log(1 + 100 * share)."""
    raw = (text or "").encode()
    if not raw:
        return np.zeros(len(FEATURES))
    words = raw.split()
    n, size = max(1, len(words)), len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    at = lambda chars: seen[list(chars)].sum() / size
    lines = [line for line in raw.split(b"\n") if line.strip()]
    marks = b"\"'()+,-./:;=?@[\\]^_`{}~"
    shares = [1 - len(set(words)) / n, sum(map(eq, words, words[1:])) / n, at(b"#*$%&<>"), at(b"!"), at(b"|"),
              seen[_UPPER].sum() / size, seen[_DIGIT].sum() / size, at(marks),
              1 - len(set(lines)) / max(1, len(lines))]
    sizes = [np.log1p(len(words)), np.log1p(size / n)]
    return np.array([*sizes, *np.log1p(100 * np.array(shares)), np.log1p(max(map(len, words), default=0))])


class Ranker:
    """Weights, scaling and threshold; ``score`` maps a feature matrix to [0, 1]."""

    def __init__(self, mean, scale, weights, threshold, spread):
        self.mean, self.scale, self.weights = mean, scale, weights
        self.threshold, self.spread = threshold, spread

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.75)
        z = (self.strength(x) - self.threshold) / self.spread + np.log(GOOD / (1 - GOOD))
        # rounded: the threshold itself must not fall a rounding error below 0.7
        return np.round(1 / (1 + np.exp(-np.clip(z, -40, 40))), 12)


def train(x: np.ndarray, good: np.ndarray, pairs: int = 200_000, rounds: int = 400, keep_weight: int = 3,
          seed: int = 5) -> Ranker:
    """Fit on labelled features: logistic loss on the feature differences of drawn (good, bad) pairs."""
    if not good.any() or good.all():
        return Ranker(0, 1, None, 0, 1)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    diff = z[rng.choice(better, pairs)] - z[rng.choice(worse, pairs)]
    w, velocity = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(rounds):
        lost = 1 / (1 + np.exp(np.clip(diff @ w, -40, 40)))
        gradient = diff.T @ lost / pairs - 1e-4 * w
        velocity = 0.9 * velocity + gradient
        w = w + 0.3 * velocity
    s = z @ w
    order = np.argsort(s, kind="stable")
    # gain of a cut before position k over keeping all
    right = np.concatenate([[0], np.cumsum(np.where(good[order], -keep_weight, 1))])
    k = int(np.argmax(right))
    level = k / len(s)
    lo = s[order[k - 1]] if k else s[order[0]] - 1
    hi = s[order[k]] if k < len(s) else s[order[-1]] + 1
    threshold = float(np.quantile(s, level)) if lo == hi else float((lo + hi) / 2)
    return Ranker(mean, scale, w, threshold, float(s.std()) / 2 + 1e-9)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> Ranker:
    known = (pick(labels, "doc_id", "quality").where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .where(F.col("doc_id").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_labelled))
    found = pick(docs, "doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(q, features(t).tolist()) for q, t in rows(batch, "quality", "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([q for q, _ in got], pa.int64()),
                 pa.array([f for _, f in got], pa.list_(pa.float64()))], ["doc_id", "quality", "f"])

    sample = (found.mapInArrow(run, "doc_id long, quality long, f array<double>")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "f").limit(max_labelled).collect())
    x = np.array([r.f for r in sample]).reshape(len(sample), len(FEATURES))
    return train(x, np.array([r.quality == 1 for r in sample], bool))


def score(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    ranker = fit(docs, labels, max_labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([features(t) for (t,) in rows(batch, "text")])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ranker.score(x))], ["doc_id", "score"])

    out = pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= GOOD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    ranker = fit(docs, labels, max_labelled)
    renamed, at = positional(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([features(t) for (t,) in rows(batch, at["text"])])
                yield batch.filter(pa.array(ranker.score(x) >= GOOD))

    return renamed.mapInArrow(run, renamed.schema).toDF(*docs.columns)
