"""Masked pseudo-likelihood scores by a bidirectional window network, trained and run in numpy.

Every token is hidden in turn and predicted from the two tokens before and the two after it: their embeddings (one
table per position) are added and squashed, and a two-level softmax gives first the token's class, then the token in
its class. A document's score is the sum of the log-probabilities of its tokens.

Tokens are the words of the corpus: the most frequent ones have ids by rank (counted over all documents), the rest
share ``RARE`` ids by hash, and a rare word's score is that of its shared id. The documents are dealt into ``ROUNDS``
disjoint parts by a hash of their text. In every round each task trains a copy of the network on its partition's
documents of one part, and the copies are averaged, weighted by tokens, together with the step sizes they have come
to; all documents are trained on once. (Copies are averaged by partition, so how the input is cut into partitions has
a small influence on the scores.) The model has a fixed size: the words beyond the most frequent 960 are counted, but
not told apart.

Defined results: null text has no tokens and the score 0; repeated rows each keep a row and train as often; a null
doc_id passes through; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalake.llm.common import pick, rows, saved

CLASSES, IN_CLASS, WIDTH = 32, 32, 16
VOCABULARY = CLASSES * IN_CLASS
RARE = 63            # hashed ids of rare words; id 0 marks the edge of a document
BATCH = 16_384       # tokens of a forward pass
STEP = 2_048         # tokens of a training step
RATE = 0.05
ROUNDS = 8           # parts of the corpus that are trained on one after the other
HIGHEST = 60.0
OFFSETS = (-2, -1, 1, 2)
_SHAPES = {"embed": (len(OFFSETS), VOCABULARY, WIDTH), "bias": (WIDTH,), "cls": (WIDTH, CLASSES),
           "cls_bias": (CLASSES,), "tok": (CLASSES, WIDTH, IN_CLASS), "tok_bias": (CLASSES, IN_CLASS)}
SCHEMA = "doc_id long, n_tokens long, pseudo_log_likelihood double, mean_log_prob double"


def start_model(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {k: (rng.normal(0, 0.1, s) if len(s) > 1 and "bias" not in k else np.zeros(s)).astype(np.float32)
            for k, s in _SHAPES.items()}


def start_squares() -> dict[str, np.ndarray]:
    """Sums of squared gradients to start from, well below a gradient, so that rare ids take whole steps too."""
    return {k: np.full(s, 1e-6, np.float32) for k, s in _SHAPES.items()}


def flat(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in _SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in _SHAPES.items():
        size = int(np.prod(s))
        out[k] = values[at: at + size].reshape(s).astype(np.float32)
        at += size
    return out


class Words:
    """Token ids of a text: ranks of frequent words from RARE + 1 on, hashed ids of the others below."""

    def __init__(self, frequent: list[str]):
        self.ids = {w.encode(): i + RARE + 1 for i, w in enumerate(frequent[: VOCABULARY - RARE - 1])}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        get, h = self.ids.get, xxhash.xxh32_intdigest
        return np.array([get(w) or h(w) % RARE + 1 for w in words], np.uint16)


def _context(tokens: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    return [tokens[at + o] for o in OFFSETS]


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Row by row, in place. The hidden layer lies within 1, so logits are small; ``HIGHEST`` keeps exp finite anyhow."""
    np.minimum(logits, HIGHEST, out=logits)
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(logits.shape[1], logits.dtype))[:, None]
    return logits


def _forward(model, context, target):
    """Hidden layer, class probabilities, order of the targets by class, and log-probabilities."""
    h = model["embed"][0].take(context[0], axis=0)
    for p, x in enumerate(context[1:], 1):
        h += model["embed"][p].take(x, axis=0)
    h += model["bias"]
    np.tanh(h, out=h)
    logits = _softmax(h @ model["cls"] + model["cls_bias"])
    cls, inside = target // IN_CLASS, target % IN_CLASS
    order = np.argsort(cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(CLASSES + 1))
    logp = np.log(logits[np.arange(len(h)), cls] + 1e-30)
    parts = []
    for c in range(CLASSES):
        who = order[edges[c]: edges[c + 1]]
        if len(who):
            own = _softmax(h[who] @ model["tok"][c] + model["tok_bias"][c])
            logp[who] += np.log(own[np.arange(len(who)), inside[who]] + 1e-30)
            parts.append((c, who, own))
    return h, logits, cls, inside, parts, logp


def _gradients(model, context, target) -> dict[str, np.ndarray]:
    return _gradients_and_loss(model, context, target)[0]


def _gradients_and_loss(model, context, target) -> tuple[dict[str, np.ndarray], float]:
    h, p_cls, cls, inside, parts, logp = _forward(model, context, target)
    g = {k: np.zeros(s, np.float32) for k, s in _SHAPES.items()}
    p_cls[np.arange(len(h)), cls] -= 1
    g["cls"], g["cls_bias"] = h.T @ p_cls, p_cls.sum(axis=0)
    dh = p_cls @ model["cls"].T
    for c, who, own in parts:
        own[np.arange(len(who)), inside[who]] -= 1
        g["tok"][c], g["tok_bias"][c] = h[who].T @ own, own.sum(axis=0)
        dh[who] += own @ model["tok"][c].T
    dh *= 1 - h * h
    g["bias"] = dh.sum(axis=0)
    for p, x in enumerate(context):
        order = np.argsort(x, kind="stable")
        ids, first = np.unique(x[order], return_index=True)
        g["embed"][p][ids] = np.add.reduceat(dh[order], first, axis=0)
    return g, -float(logp.sum(dtype=np.float64))


class Trainer:
    """Adagrad steps over a stream of documents."""

    def __init__(self, model: dict[str, np.ndarray], squares: dict[str, np.ndarray] | None = None):
        self.model = {k: v.copy() for k, v in model.items()}
        self.squares = {k: v.copy() for k, v in (squares or start_squares()).items()}
        self.held, self.size, self.tokens, self.loss = [], 0, 0, 0.0

    def add(self, tokens: np.ndarray) -> None:
        for lo in range(0, len(tokens), STEP):
            # a long document goes in pieces that see each other's edge tokens
            self.held.append((tokens, lo, min(len(tokens), lo + STEP)))
            self.size += self.held[-1][2] - lo
            if self.size >= STEP:
                self.step()

    def step(self) -> None:
        line, at = joined([(t[max(0, a - 2): b + 2], a - max(0, a - 2), b - a) for t, a, b in self.held])
        self.tokens += len(at)
        self.held, self.size = [], 0
        if not len(at):
            return
        gradients, loss = _gradients_and_loss(self.model, _context(line, at), line[at])
        self.loss += loss
        for k, g in gradients.items():
            g /= len(at)
            self.squares[k] += g * g
            self.model[k] -= RATE * g / np.sqrt(self.squares[k])


def joined(pieces: list[tuple[np.ndarray, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """One line of tokens with edges between pieces, and the places of the tokens to predict."""
    line, places, size = [], [], 0
    edge = np.zeros(2, np.uint16)
    for tokens, skip, n in pieces:
        line += [edge, tokens]
        places.append(size + 2 + skip + np.arange(n))
        size += 2 + len(tokens)
    return np.concatenate([*line, edge]), (np.concatenate(places) if places else np.zeros(0, np.int64))


def log_probs(model: dict[str, np.ndarray], docs: list[np.ndarray]) -> list[float]:
    """The summed log-probabilities of each document's tokens."""
    line, at = joined([(t, 0, len(t)) for t in docs])
    logp = np.empty(len(at))
    for lo in range(0, len(at), BATCH):
        here = at[lo: lo + BATCH]
        logp[lo: lo + BATCH] = _forward(model, _context(line, here), line[here])[-1]
    ends = np.cumsum([len(t) for t in docs])
    total = np.concatenate([[0.0], np.cumsum(logp)])
    return (total[ends] - total[ends - [len(t) for t in docs]]).tolist() if docs else []


def frequent_words(docs: DataFrame) -> list[str]:
    """The most frequent words of all documents, by count and then by name: as many as the vocabulary has ids for."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in seen], pa.string()),
                                              pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for (text,) in rows(batch, "text"):
                seen.update((text or "").encode().lower().split())
                if len(seen) > 200_000:
                    yield told()
        yield told()

    counts = pick(docs, "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.col("n").desc(), "word").limit(VOCABULARY - RARE - 1)
    return [r.word for r in top.collect()]


_State = tuple[dict[str, np.ndarray], dict[str, np.ndarray]]


def coded(spark: SparkSession, docs: DataFrame, words: Words) -> DataFrame:
    """The documents' token ids, written once for all rounds and the scores, with the part that each is dealt into."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [words(t).tobytes() for (t,) in rows(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(ids, pa.binary())],
                                             ["doc_id", "part", "ids"])

    dealt = pick(docs, "doc_id", "text").withColumn("part", F.pmod(F.xxhash64("text"), F.lit(ROUNDS)))
    return saved(dealt.mapInArrow(code, "doc_id long, part long, ids binary"), spark, "lm-ids")


def train_round(spark: SparkSession, docs: DataFrame, state: _State) -> tuple[_State, float]:
    """One pass of every partition over its documents (their ids) from the same model and squares: the token-weighted
    means of the copies, and the loss a token over all documents, taken before each step."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(*state)
        for batch in batches:
            for (ids,) in rows(batch, "ids"):
                trainer.add(np.frombuffer(ids, np.uint16))
        trainer.step()
        if trainer.tokens:
            values = np.concatenate([flat(trainer.model), flat(trainer.squares)])
            part = TaskContext.get().partitionId()
            pieces = np.array_split(values, 16)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(pieces)), pa.int32()), pa.array([part] * len(pieces), pa.int32()),
                 pa.array([float(trainer.tokens)] * len(pieces)), pa.array([trainer.loss] * len(pieces)),
                 pa.array([p.astype("<f4").tobytes() for p in pieces], pa.binary())],
                ["piece", "part", "tokens", "loss", "weights"])

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        total = frame["tokens"].sum()
        out = sum(t * np.frombuffer(w, "<f4").astype(np.float64) for t, w in zip(frame["tokens"], frame["weights"]))
        return pd.DataFrame({"piece": frame["piece"].iloc[:1], "part": frame["part"].iloc[:1] // 1024,
                             "tokens": [total], "loss": [frame["loss"].sum()],
                             "weights": [(out / total).astype("<f4").tobytes()]})

    copies = docs.mapInArrow(fit, "piece int, part int, tokens double, loss double, weights binary")
    # two levels, so that no task takes the copies of all partitions
    some = copies.groupBy("piece", F.expr("part % 1024")).applyInPandas(mean, copies.schema)
    whole = some.groupBy("piece").applyInPandas(mean, copies.schema).orderBy("piece").collect()
    if not whole:
        return state, 0.0
    model, squares = np.split(np.concatenate([np.frombuffer(r.weights, "<f4") for r in whole]), 2)
    return (unflat(model), unflat(squares)), whole[0].loss / whole[0].tokens


def trained(spark: SparkSession, ids: DataFrame) -> dict[str, np.ndarray]:
    state = (start_model(), start_squares())
    for n in range(ROUNDS):
        state, _ = train_round(spark, ids.where(F.col("part") == n).select("ids"), state)
    return state[0]


def fit(spark: SparkSession, docs: DataFrame) -> tuple[Words, dict[str, np.ndarray]]:
    words = Words(frequent_words(docs))
    return words, trained(spark, coded(spark, docs, words))


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, number of tokens, sum and mean of the tokens' conditional log-probabilities."""
    ids = coded(spark, docs, Words(frequent_words(docs)))
    model = trained(spark, ids)
    names = ["doc_id", "n_tokens", "pseudo_log_likelihood", "mean_log_prob"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for i, (doc_id, own) in enumerate(rows(batch, "doc_id", "ids")):
                held.append((doc_id, np.frombuffer(own, np.uint16)))
                size += len(held[-1][1])
                if size >= 4 * BATCH or i == batch.num_rows - 1:
                    got = log_probs(model, [t for _, t in held])
                    n = [len(t) for _, t in held]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d for d, _ in held], pa.int64()), pa.array(n, pa.int64()), pa.array(got, pa.float64()),
                         pa.array([g / k if k else 0.0 for g, k in zip(got, n)], pa.float64())], names)
                    held, size = [], 0

    return ids.select("doc_id", "ids").mapInArrow(run, SCHEMA)
