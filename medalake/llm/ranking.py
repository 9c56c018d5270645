"""Ranked lexical search by Block-Max MaxScore over an inverted index in shards.

Index: a shard holds the documents of a task, in parts of at most ``SHARD_DOCS`` documents and about ``SHARD_TERMS``
terms, numbered by length. It has one row per term: the number of its documents and occurrences, and its postings in
compressed blocks of ``BLOCK`` (document numbers from the block's first one, and occurrences, in the least number of
bytes the block needs), with each block's first and last document and greatest number of occurrences. As documents are
numbered by length, the first one of a block is its shortest, so these give a close bound on all its scores. One more row per
shard, of the empty term, lists its documents. All texts are indexed whole, whatever the queries are.

Search: the queries' terms pick the rows of the index, which meet by shard. Within a shard, for each query, the
documents are taken in windows, against the score of the tenth best so far:

- terms are ordered by the greatest bound of their blocks; those whose bounds together stay below the score to beat
  are non-essential: a document of these alone can't enter, so only the essential lists give candidates;
- a window whose blocks' bounds sum to less is passed over without being read;
- a candidate's bound is its score in the essential lists plus the bounds of the very blocks of the non-essential
  lists that may hold it; if that is below the score to beat, it is rejected before those blocks are decompressed.

Only bounds strictly below are rejected, as an equal score may win by its doc_id. The ten best of every shard then
meet in Spark. Queries are taken in blocks of at most ``block_chars`` characters; one block at a time is held.

Scores: see ``weight``, ``length_factor`` and ``part``; integers, but for the logarithm in a weight.

Defined results: null and empty texts have no term and are never found; a query without known terms has no rows;
each row of the queries is a query, also if ids are equal or null; a null doc_id comes after the others; repeated
documents each have a rank; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medalake.llm.common import pick, rows, saved
from medalake.llm.decontamination import blocks, words

SHARD_DOCS, SHARD_TERMS, BLOCK, WINDOW = 1 << 14, 1 << 22, 64, 2048
_HEAD = np.dtype([("first", "<u2"), ("last", "<u2"), ("most", "<u4"), ("at", "<u4")])
_DOC = np.dtype([("doc_id", "<i8"), ("known", "<i8"), ("n", "<i8")])
_LISTS = "shard long, term string, df long, total long, heads binary, postings binary"
_LISTS_ARROW = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("total", pa.int64()),
                          ("heads", pa.binary()), ("postings", pa.binary())])
_BEST = "query long, doc_id long, score long"


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 10 + (90 * n * n_docs) // max(n_terms, 1)


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's share of a score, before its weight: grows with tf, falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# --- index --------------------------------------------------------------------------------------------------------

def _compressed(docs: np.ndarray, tf: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block heads and the bytes of all blocks; ``first``: where blocks begin among the postings."""
    size = np.diff(np.append(first, len(docs)))
    heads = np.zeros(len(first), _HEAD)
    heads["first"], heads["last"] = docs[first], docs[first + size - 1]
    heads["most"] = np.maximum.reduceat(tf, first)
    of_doc, of_tf = _widths(heads)
    heads_at = np.cumsum(size * (of_doc + of_tf)) - size * (of_doc + of_tf)
    block = np.repeat(np.arange(len(first)), size)
    place = np.arange(len(docs)) - first[block]
    out = np.zeros(int((size * (of_doc + of_tf)).sum()), np.uint8)
    for values, width, at in ((docs - heads["first"][block], of_doc, heads_at[block]),
                              (tf, of_tf, (heads_at + size * of_doc)[block])):
        for byte in range(4):
            own = np.flatnonzero(width[block] > byte)
            out[at[own] + place[own] * width[block][own] + byte] = values[own] >> 8 * byte & 255
    heads["at"] = heads_at
    return heads, out


def _widths(heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes a document number and a number of occurrences take in each block."""
    return (np.where(heads["last"].astype(np.int64) - heads["first"] < 256, 1, 2),
            np.where(heads["most"] < 256, 1, 4))


def decompress(heads: np.ndarray, df: int, raw: bytes, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, occurrences and block of the postings in some blocks of a list."""
    sizes = np.full(len(heads), BLOCK)
    sizes[-1] = df - BLOCK * (len(heads) - 1)
    data = np.frombuffer(raw, np.uint8)
    own, size = heads[some], sizes[some]
    of_doc, of_tf = _widths(own)
    block = np.repeat(np.arange(len(own)), size)
    place = np.arange(len(block)) - np.repeat(np.cumsum(size) - size, size)

    def values(width, at):
        out = np.zeros(len(block), np.int64)
        for byte in range(int(width.max(initial=0))):
            there = np.flatnonzero(width[block] > byte)
            out[there] |= data[at[block[there]] + place[there] * width[block[there]] + byte].astype(np.int64) << 8 * byte
        return out

    at = own["at"].astype(np.int64)
    return values(of_doc, at) + own["first"][block], values(of_tf, at + size * of_doc), np.asarray(some)[block]


class _Builder:
    def __init__(self):
        self.vocabulary: dict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = lambda: len(self.vocabulary)
        self.ids, self.texts, self.size = [], [], 0

    def add(self, doc_id, text: bytes):
        own = words(text)
        if own:
            self.texts.append(np.fromiter(map(self.vocabulary.__getitem__, own), np.int64, len(own)))
            self.ids.append(doc_id)
            self.size += len(own)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.size >= SHARD_TERMS

    def lists(self, shard: int) -> Iterator[pa.RecordBatch]:
        docs = np.zeros(len(self.ids), _DOC)
        docs["doc_id"], docs["known"] = [d or 0 for d in self.ids], [d is not None for d in self.ids]
        docs["n"] = [len(t) for t in self.texts]
        order = np.lexsort((docs["doc_id"], docs["n"]))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        pairs = np.concatenate(self.texts) * len(order) + np.repeat(number, docs["n"])
        pairs, tf = np.unique(pairs, return_counts=True)
        term, doc = pairs // len(order), pairs % len(order)
        starts = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        df, total = np.diff(starts), np.add.reduceat(tf, starts[:-1])
        n_blocks = -(-df // BLOCK)
        within = np.arange(int(n_blocks.sum())) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        heads, raw = _compressed(doc, tf, np.repeat(starts[:-1], n_blocks) + within * BLOCK)
        head_at = np.concatenate([[0], np.cumsum(n_blocks)])
        raw_at = np.append(heads["at"], len(raw)).astype(np.int64)[head_at]
        heads["at"] -= np.repeat(raw_at[:-1], n_blocks).astype("<u4")
        heads, raw = heads.tobytes(), raw.tobytes()
        names = list(self.vocabulary)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "term": [""], "df": [len(order)], "total": [self.size],
                                          "heads": [docs[order].tobytes()], "postings": [None]}, _LISTS_ARROW)
        for at in range(0, len(names), 8192):
            own = range(at, min(at + 8192, len(names)))
            yield pa.RecordBatch.from_pydict({
                "shard": [shard] * len(own), "term": [names[i].decode() for i in own], "df": df[at: own.stop],
                "total": total[at: own.stop],
                "heads": [heads[12 * head_at[i]: 12 * head_at[i + 1]] for i in own],
                "postings": [raw[raw_at[i]: raw_at[i + 1]] for i in own]}, _LISTS_ARROW)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    shard, now = TaskContext.get().partitionId() << 32, _Builder()
    for batch in batches:
        for doc_id, text in rows(batch, "doc_id", "text"):
            now.add(doc_id, text)
            if now.full():
                yield from now.lists(shard)
                shard, now = shard + 1, _Builder()
    if now.ids:
        yield from now.lists(shard)


def build_index(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The written inverted index of all documents."""
    own = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"))
    return saved(own.mapInArrow(_index, _LISTS), spark, "lexical-index")


# --- search -------------------------------------------------------------------------------------------------------

class _List:
    """A term's postings in a shard under its weight."""

    def __init__(self, df: int, heads: bytes, raw: bytes, w: int, m: np.ndarray):
        self.df, self.heads, self.raw, self.w, self.m = df, np.frombuffer(heads, _HEAD), raw, w, m
        self.first, self.last = (self.heads[c].astype(np.int64) for c in ("first", "last"))
        self.bounds = w * part(self.heads["most"].astype(np.int64), m[self.first])
        self.bound = int(self.bounds.max())
        self.read: dict[tuple, tuple] = {}

    def blocks(self, low: int, high: int) -> tuple[int, int]:
        """Blocks that may hold documents in [low, high)."""
        return int(np.searchsorted(self.last, low)), int(np.searchsorted(self.first, high))

    def window_bound(self, low: int, high: int) -> int:
        a, b = self.blocks(low, high)
        return int(self.bounds[a:b].max()) if a < b else 0

    def scores(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        docs, tf, _ = decompress(self.heads, self.df, self.raw, some)
        return docs, self.w * part(tf, self.m[docs])

    def window(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents in [low, high) with their scores; kept for the shard's next queries."""
        if low not in self.read:
            docs, score = self.scores(np.arange(*self.blocks(low, high)))
            own = (docs >= low) & (docs < high)
            self.read[low] = docs[own], score[own]
        return self.read[low]

    def block_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that may hold each document, and its bound; 0 where there is none."""
        block = np.minimum(np.searchsorted(self.last, docs), len(self.last) - 1)
        there = (self.first[block] <= docs) & (docs <= self.last[block])
        return block, np.where(there, self.bounds[block], 0)


def best_of_shard(lists: list[_List], doc_ids: np.ndarray, n_docs: int, top: int,
                  seen: dict | None = None) -> list[tuple[int, int]]:
    """The ``top`` best (score, place of document) of a shard by descending score, then doc_ids."""
    lists = sorted(lists, key=lambda x: x.bound)
    upto = np.cumsum([x.bound for x in lists])
    docs_best, score_best, beat = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    for low in range(0, n_docs, WINDOW):
        high = min(low + WINDOW, n_docs)
        weak = int(np.searchsorted(upto, beat))          # lists[:weak] alone can't reach the score to beat
        if weak == len(lists):
            break
        if sum(x.window_bound(low, high) for x in lists) < beat:
            continue
        total = np.zeros(high - low, np.int64)
        for x in lists[weak:]:
            docs, score = x.window(low, high)
            total[docs - low] += score                   # a list names a document once
        found = np.flatnonzero(total)
        score, docs = total[found], found + low
        if weak and len(docs):
            at = [x.block_of(docs) for x in lists[:weak]]
            score, docs = _finished(lists[:weak], at, score, docs, beat, seen)
        docs, score = np.concatenate([docs_best, docs]), np.concatenate([score_best, score])
        keep = np.flatnonzero(score >= beat)
        keep = keep[np.lexsort((doc_ids[docs[keep]], -score[keep]))][:top]
        docs_best, score_best = docs[keep], score[keep]
        if len(keep) == top:
            beat = max(beat, int(score_best[-1]))
    return list(zip(score_best.tolist(), docs_best.tolist()))


def _finished(lists: list[_List], at: list[tuple], score: np.ndarray, docs: np.ndarray, beat: int, seen: dict | None):
    """Adds the non-essential lists, from the greatest bound down, to candidates that may still reach ``beat``."""
    rest = np.zeros(len(docs), np.int64)
    for _, bound in at:
        rest += bound
    left = np.arange(len(docs))
    for x, (block, bound) in reversed(list(zip(lists, at))):
        left = left[score[left] + rest[left] >= beat]
        rest[left] -= bound[left]
        held = left[bound[left] > 0]
        if not len(held):
            continue
        some = np.unique(block[held])
        if seen is not None:
            seen["blocks"] = seen.get("blocks", 0) + len(some)
        there, own = x.scores(some)
        place = np.minimum(np.searchsorted(there, docs[held]), len(there) - 1)
        hit = there[place] == docs[held]
        score[held[hit]] += own[place[hit]]
    left = left[score[left] >= beat]
    return score[left], docs[left]


def _search(queries: dict[int, dict[str, int]], n_docs: int, n_terms: int, top: int):
    """``queries``: the weights of each one's terms."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        weights = {t: w for q in queries.values() for t, w in q.items()}
        docs = np.frombuffer(frame.loc[frame["term"] == "", "heads"].iloc[0], _DOC)
        m = length_factor(docs["n"], n_docs, n_terms)
        by_id = np.lexsort((docs["doc_id"], -docs["known"]))  # a null id comes last
        place = np.empty(len(docs), np.int64)
        place[by_id] = np.arange(len(docs))
        lists = {t: _List(int(df), h, p, weights[t], m) for t, df, h, p in
                 zip(frame["term"], frame["df"], frame["heads"], frame["postings"]) if t and weights[t] > 0}
        out = []
        for q, own in queries.items():
            held = [lists[t] for t in own if t in lists]
            if held:
                out += [(q, int(docs["doc_id"][d]) if docs["known"][d] else None, s)
                        for s, d in best_of_shard(held, place, len(docs), top)]
        return pd.DataFrame({"query": pd.Series([r[0] for r in out], dtype="int64"),
                             "doc_id": pd.Series([r[1] for r in out], dtype="Int64"),
                             "score": pd.Series([r[2] for r in out], dtype="int64")})

    return run


def search(spark: SparkSession, index: DataFrame, queries: DataFrame, top: int = 10,
           block_chars: int = 1 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each row (item_id, text) of ``queries``."""
    about = index.where("term = ''").agg(F.sum("df"), F.sum("total")).first()
    n_docs, n_terms = about[0] or 0, about[1] or 0
    asked = pick(queries, "item_id", "text").where("text IS NOT NULL").select(
        "item_id", F.col("text").cast("binary").alias("text"))
    item_type = asked.schema["item_id"].dataType
    passes = []
    for block in blocks(asked, block_chars):
        terms = [list(dict.fromkeys(w.decode() for w in words(text))) for _, text in block]
        every = spark.createDataFrame([(t,) for t in sorted({t for own in terms for t in own})], "term string")
        df = dict(index.join(F.broadcast(every), "term").groupBy("term").agg(F.sum("df")).collect())
        weights = {t: weight(n_docs, n) for t, n in df.items()}
        known = {q: {t: weights[t] for t in own if t in weights} for q, own in enumerate(terms)}
        picked = index.join(F.broadcast(every.union(spark.createDataFrame([("",)], "term string"))), "term")
        best = picked.groupBy("shard").applyInPandas(_search(known, n_docs, n_terms, top), _BEST)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ids = spark.createDataFrame(list(enumerate(i for i, _ in block)), f"query long, item_id {item_type.simpleString()}")
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        passes.append(ranked.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score"))
    if len(passes) > 1:
        passes = [saved(p, spark, "lexical-best") for p in passes]
    if not passes:
        passes = [spark.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, doc_id long, score long")]
    out = passes[0]
    for p in passes[1:]:
        out = out.union(p)
    return out
