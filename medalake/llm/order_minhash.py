"""Document fingerprints by Order MinHash.

K-mers are runs of ``K`` words, each numbered by its occurrence in the text, so a repeated k-mer counts as often as
it stands there. For each of ``SKETCHES`` hash functions the ``TUPLE`` k-mers with the smallest hashes are taken, put
back into text order and hashed together: moving text around changes the order and so the signature, as in an edit
distance. Likeness is the share of equal positions of two signatures.

The next document in descending order of doc_id comes from one range shuffle and a stream through each sorted
partition; only the first and last document of a partition meet in a small second step.

Defined results: null text is the empty text; a text without words has the fingerprint of no k-mers; with fewer
words than ``K`` the whole sequence is the k-mer; null doc_id sorts last; repeated doc_id rows are ordered by
length and hash of the text and each keep a row; a single row is its own next document; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medalake.llm.common import pick, rows, saved

K, TUPLE, SKETCHES, DIGITS = 3, 2, 24, 6
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_COLS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

_rng = np.random.default_rng(2024)
_FACTOR = _rng.integers(0, 1 << 62, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(0, 1 << 62, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2, _S = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(30)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def signature(text: str) -> np.ndarray:
    """``SKETCHES`` numbers of ``DIGITS`` hexadecimal digits."""
    words = text.encode().split()
    if not words:
        return np.zeros(SKETCHES, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(K, len(h))
    n = len(h) - k + 1
    kmer = np.zeros(n, np.uint64)
    for i in range(k):
        kmer += h[i: i + n] * _PLACE[i]
    kmer = _mix(kmer)
    order = np.argsort(kmer, kind="stable")
    run = np.flatnonzero(np.concatenate([[True], kmer[order][1:] != kmer[order][:-1]]))
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = np.arange(n) - np.repeat(run, np.diff(np.append(run, n)))
    numbered = _mix(kmer + occurrence * _M1)
    first, second = np.empty(SKETCHES, np.int64), np.empty(SKETCHES, np.int64)
    step = max(1, (1 << 18) // n)
    for at in range(0, SKETCHES, step):
        hashes = numbered[None, :] * _FACTOR[at: at + step, None]
        row = np.arange(len(hashes))
        first[at: at + step] = low = hashes.argmin(axis=1)
        hashes[row, low] = np.uint64(0xFFFFFFFFFFFFFFFF)
        second[at: at + step] = hashes.argmin(axis=1)
    lo, hi = np.minimum(first, second), np.maximum(first, second)
    made = kmer[lo] * _M2 + (kmer[hi] if n > 1 else np.uint64(0))
    return (_mix(made + _FACTOR) >> np.uint64(64 - 4 * DIGITS)) | np.uint64(0)


def _text_of(sig: np.ndarray) -> str:
    return "".join(f"{int(x):0{DIGITS}x}" for x in sig)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many leading code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(doc_id, text: str, sig: np.ndarray, following: str, next_sig: np.ndarray) -> tuple:
    new = edited(text, following)
    new_sig = signature(new)
    return (doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), _text_of(sig), _text_of(new_sig),
            float((sig == new_sig).mean()), float((sig == next_sig).mean()))


def _batch(listed: list[tuple], names, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in listed], k) for i, k in enumerate(kinds)], names)


def fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and their likeness and that to the next document's."""
    src = (pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
           .withColumn("n", F.length("text")).withColumn("tie", F.xxhash64("text")))
    keys = [F.col("doc_id").desc_nulls_last(), F.col("n").desc(), F.col("tie").desc()]
    ordered = src.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    names, kinds = [*_COLS, "part", "head", "tail"], [*_KINDS, pa.int32(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, head, last = TaskContext.get().partitionId(), None, None
        for batch in batches:
            out = []
            for doc_id, text in rows(batch, "doc_id", "text"):
                sig = signature(text)
                if last is None:
                    head = text
                else:
                    out.append((*_row(*last, text, sig), part, None, None))
                last = (doc_id, text, sig)
            yield _batch(out, names, kinds)
        if last is not None:  # the next document is the head of another partition
            yield _batch([(last[0], *[None] * 6, part, head, last[1])], names, kinds)

    done = saved(ordered.mapInArrow(run, f"{SCHEMA}, part int, head string, tail string"), spark, "omh")
    # one row per partition: its last document, and the head of the partition that follows it, the last one's
    # being the first
    edge = done.where("tail IS NOT NULL")
    number = edge.select("part", F.row_number().over(Window.orderBy("part")).alias("k"),
                         F.count("*").over(Window.partitionBy(F.lit(0))).alias("total"))
    at = number.select("part", "k", (F.col("k") % F.col("total") + 1).alias("next"))
    tails = edge.join(at, "part").select("doc_id", "tail", "next")
    heads = edge.join(at, "part").select(F.col("k").alias("next"), "head")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([_row(d, t, signature(t), h, signature(h)) for d, t, h in rows(batch, "doc_id", "tail", "head")],
                         _COLS, _KINDS)

    closed = tails.join(heads, "next").select("doc_id", "tail", "head").mapInArrow(close, SCHEMA)
    return done.where("tail IS NULL").select(*_COLS).union(closed)
