"""Benchmark decontamination by an FM-index of each training shard.

A shard is about ``shard_words`` words of whole documents; a longer document is cut into pieces that overlap by a
window less one word. Each shard's words become symbols and an FM-index (``fm_index``). Every window of the benchmark
is searched backwards through the wavelet tree's ranks, its occurrences are located by the sampled suffix positions,
and overlapping or touching ones are merged into a document's removal spans.

Words: A-Z lower-cased, then runs of ASCII letters, digits and characters outside ASCII. A window: ``window``
consecutive words of an item, or all words of a shorter one.

Nothing is shuffled: a task indexes the shards of its documents. Test phrases come to the tasks in blocks of at most
``block_chars`` characters (or one longer item), which the driver passes on one at a time and never holds together. A
benchmark of several blocks takes a pass over the documents for each; the passes' spans then meet by document.

Defined results: null and empty texts have no words and no spans; an item without words has no window; rows of equal
item_id are one item, null ids count as the empty string; repeated documents each keep a row; empty tables give no
rows, or documents without spans; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalake.llm.common import pick, rows, saved
from medalake.llm.fm_index import FMIndex

_SPANS = ("rid long, doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>")
_ARROW = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ("items", pa.list_(pa.string()))])
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if chr(c).isupper() else 32
              for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased."""
    return (text or b"").translate(_FOLD).split()


class Phrases:
    """The distinct windows of a block of items, as arrays of word numbers by length."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        vocabulary: dict[bytes, int] = {}
        of: dict[tuple, set] = defaultdict(set)
        for item, text in items:
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                of[tuple(ids[i:i + size])].add(item)
        self.words = list(vocabulary)
        self.by_length: list[tuple[np.ndarray, list[list[str]]]] = []
        for _, same in itertools.groupby(sorted(of, key=len), key=len):
            own = list(same)
            self.by_length.append((np.array(own, np.int32), [sorted(of[w]) for w in own]))


def merged(spans) -> list[tuple[int, int]]:
    """Disjoint spans that cover the same places, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Shard:
    """Pieces of documents under one vocabulary."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = lambda: len(self.vocabulary) + 1
        self.texts, self.keys, self.size = [], [], 0

    def add(self, key: tuple, piece: list[bytes]):
        self.texts.append(np.fromiter(map(self.vocabulary.__getitem__, piece), np.int32, len(piece)))
        self.keys.append(key)
        self.size += len(piece) + 1

    def search(self, phrases: Phrases) -> Iterator[tuple]:
        """(key, spans, items) of each piece; spans count from the piece's start."""
        zero = np.zeros(1, np.int32)
        text = np.concatenate([zero, *itertools.chain.from_iterable((t, zero) for t in self.texts)])
        starts = np.cumsum([1] + [len(t) + 1 for t in self.texts])
        symbol = np.array([self.vocabulary.get(w, 0) for w in phrases.words], np.int64)
        index = FMIndex(text, len(self.vocabulary) + 1)
        change = np.zeros(len(text) + 1, np.int32)
        found: dict[int, set] = defaultdict(set)
        for patterns, items in phrases.by_length:
            own = symbol[patterns]
            there = np.flatnonzero((own > 0).all(axis=1))
            which, places = index.occurrences(own[there])
            np.add.at(change, places, 1)
            np.add.at(change, places + patterns.shape[1], -1)
            piece = np.searchsorted(starts, places, "right") - 1
            for both in np.unique(piece * len(items) + there[which]).tolist():
                found[both // len(items)].update(items[both % len(items)])
        edge = np.diff((np.cumsum(change) > 0).astype(np.int8), prepend=0)
        low, high = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        piece = np.searchsorted(starts, low, "right") - 1
        spans = defaultdict(list)
        for p, a, b in zip(piece.tolist(), low.tolist(), high.tolist()):
            spans[p].append((a - int(starts[p]), b - int(starts[p])))
        for p, key in enumerate(self.keys):
            yield key, spans.get(p, []), found.get(p, ())


def _searched(documents: Iterator[tuple], phrases: Phrases, window: int, shard_words: int) -> Iterator[tuple]:
    shard = Shard()
    for n, (rid, doc_id, text) in enumerate(documents):
        own = words(text)
        step = max(shard_words - window + 1, 1)
        for at in range(0, max(len(own) - window + 1, 1), step):
            shard.add((n, rid, doc_id, len(own), at), own[at: at + step + window - 1])
            if shard.size >= shard_words:
                yield from shard.search(phrases)
                shard = Shard()
    if shard.keys:
        yield from shard.search(phrases)


def _search(phrases: Phrases, window: int, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = (r for b in batches for r in rows(b, "rid", "doc_id", "text"))
        out = []
        for (_, rid, doc_id, n), pieces in itertools.groupby(
                _searched(documents, phrases, window, shard_words), key=lambda r: r[0][:4]):
            spans, items = [], set()
            for key, own, ids in pieces:
                spans += [(key[4] + a, key[4] + b) for a, b in own]
                items.update(ids)
            out.append({"rid": rid, "doc_id": doc_id, "n_words": n, "items": sorted(items),
                        "spans": [{"start": a, "end": b} for a, b in merged(spans)]})
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, _ARROW)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, _ARROW)

    return run


def _join_passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [{"rid": rid, "doc_id": doc_id, "n_words": n, "items": sorted(set(items)),
                "spans": [{"start": a, "end": b} for a, b in merged((s["start"], s["end"]) for s in spans)]}
               for rid, doc_id, n, spans, items in rows(batch, "rid", "doc_id", "n_words", "spans", "items")]
        yield pa.RecordBatch.from_pylist(out, _ARROW)


def blocks(table: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Rows (id, text) in lists of at most ``most`` characters, or one longer row; one list at a time is held, and
    one partition of the table."""
    held, size = [], 0
    for r in table.toLocalIterator():
        if held and size + len(r[1]) > most:
            yield held
            held, size = [], 0
        held.append((r[0], bytes(r[1])))
        size += len(r[1])
    if held:
        yield held


def removal_spans(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  shard_words: int = 1 << 20, block_chars: int = 1 << 21) -> DataFrame:
    """Per document: rid (a number of its row), doc_id, n_words, spans (word offsets, end exclusive, to be removed)
    and items (ids as strings, in order)."""
    phrases = pick(benchmark, "item_id", "text").where("text IS NOT NULL").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("binary"))
    own = pick(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                                              F.col("text").cast("binary").alias("text"))
    each = blocks(phrases, block_chars)
    first, second = next(each, []), next(each, None)
    if second is None:
        return own.mapInArrow(_search(Phrases(first, window), window, shard_words), _SPANS)
    own = saved(own, spark, "decontaminate-docs")  # rids that all passes share
    passes = [saved(own.mapInArrow(_search(Phrases(b, window), window, shard_words), _SPANS), spark, "decontaminate")
              for b in itertools.chain([first, second], each)]
    met = passes[0]
    for p in passes[1:]:
        met = met.union(p)
    return met.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")) \
        .mapInArrow(_join_passes, _SPANS)


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of ``removal_spans``: words, words to remove, items met and their ids' SHA-256, and the verdict."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removal_spans(spark, docs, benchmark).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
