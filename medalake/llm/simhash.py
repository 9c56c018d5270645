"""SimHash near-duplicates by vantage-point trees.

Fingerprints: every bit of a document's 64 bits is the majority of that bit over the XXH64 hashes of its word
shingles. Equal fingerprints are one node; nodes link at a Hamming distance of at most ``radius``.

Search: a vantage-point tree, built from a bounded sample of the distinct fingerprints, deals all of them into
shards. At a node with vantage point v and threshold m, a fingerprint at distance d from v goes inside if d <= m,
outside if d > m, and to both if m < d <= m + radius. By the triangle inequality two fingerprints within the
radius always share a child, hence a shard, so no pair is lost however the tree was chosen; everything else is
pruned. Within a shard the same rule goes on in memory down to small leaves, which compare all their pairs with
XOR and popcount. A leaf reports its members with the smallest fingerprint they are connected to, one row per
member and never a row per pair, and the connected components of those links are found in Spark.

The sample steers only how evenly shards fill, never which pairs are found. It has 64 fingerprints for each
shard, at most ``MAX_SAMPLE``; shards hold about ``shard`` fingerprints besides boundary copies.

Defined results: null and empty texts have fingerprint zero and are linked like any other; fewer words than a
shingle: the whole sequence is the shingle; repeated rows each keep a row; a null doc_id is never the smallest
unless its component has no other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from medalake.llm.common import pick, positional, rows, saved
from medalake.llm.components import components

MAX_SAMPLE = 1 << 18
LEAF = 384


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's lower-cased word shingles, repeats included."""
    tokens = (text or "").encode().lower().split()  # bytes: A-Z only, and white space \x20 \x09-\x0d only
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    k = min(words, len(tokens))
    starts = [0, *(ends[: len(tokens) - k] + 1).tolist()]
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(line[a:b], seed) for a, b in zip(starts, ends[k - 1:].tolist())), np.uint64, len(starts))
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at: at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprint(frame: DataFrame, text: str, name: str, words: int = 3, seed: int = 42) -> DataFrame:
    """``frame`` with a long column of fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(t, words, seed)) for (t,) in rows(batch, text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.int64())],
                                             [*batch.schema.names, name])

    return frame.mapInArrow(run, StructType([*frame.schema.fields, StructField(name, LongType())]))


def _distances(points: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ v)


def _split(points: np.ndarray, radius: int, rng: np.random.Generator):
    """A vantage point and threshold that leave the fewest fingerprints in the larger child, or None."""
    best = None
    some = points if len(points) <= 2048 else rng.choice(points, 2048, replace=False)
    for v in rng.choice(points, min(8, len(points)), replace=False):
        hist = np.bincount(_distances(some, v), minlength=65 + radius)
        below = np.cumsum(hist)
        for m in range(64):
            inside, outside = below[m + radius], below[-1] - below[m]
            if inside and outside and (best is None or max(inside, outside) + 0.5 * (inside + outside) < best[0]):
                best = (max(inside, outside) + 0.5 * (inside + outside), v, m, max(inside, outside))
    return best[1:3] if best and best[3] <= 0.9 * len(some) else None


def build_tree(sample: np.ndarray, shards: int, radius: int, seed: int = 7):
    """Nested (vantage point, threshold, inside, outside); a leaf is its shard number."""
    rng, leaves = np.random.default_rng(seed), 0
    smallest = max(2, len(sample) // max(1, shards))

    def grow(points):
        nonlocal leaves
        cut = _split(points, radius, rng) if len(points) > smallest else None
        if cut is None:
            leaves += 1
            return leaves - 1
        d = _distances(points, cut[0])
        # children get their own points only: boundary copies would let a sample grow without end
        return (cut[0], cut[1], grow(points[d <= cut[1]]), grow(points[d > cut[1]]))

    return grow(sample)


def route(tree, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, fingerprint) of every copy."""
    out, todo = [], [(tree, points)]
    while todo:
        node, own = todo.pop()
        if not len(own):
            continue
        if not isinstance(node, tuple):
            out.append((np.full(len(own), node, np.int32), own))
            continue
        d = _distances(own, node[0])
        todo += [(node[2], own[d <= node[1] + radius]), (node[3], own[d > node[1]])]
    if not out:
        return np.zeros(0, np.int32), np.zeros(0, np.uint64)
    return np.concatenate([s for s, _ in out]), np.concatenate([p for _, p in out])


def _leaf_links(own: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a leaf's members to the smallest one they reach, in tiles of rows."""
    label = np.arange(len(own))
    while True:
        before = label
        label = label.copy()
        for at in range(0, len(own), LEAF):
            near = np.bitwise_count(own[at: at + LEAF, None] ^ own[None, :]) <= radius
            label[at: at + LEAF] = np.where(near, before[None, :], len(own)).min(axis=1)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(own)))
    if len(moved):
        yield own[moved], own[label[moved]]


def local_links(points: np.ndarray, radius: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all fingerprints of a shard which chains of pairs within the radius connect."""
    rng, todo, found = np.random.default_rng(seed), [np.unique(points)], []
    while todo:
        own = todo.pop()
        if len(own) < 2:
            continue
        cut = _split(own, radius, rng) if len(own) > LEAF else None
        if cut is None:
            found += _leaf_links(own, radius)
        else:
            d = _distances(own, cut[0])
            todo += [own[d <= cut[1] + radius], own[d > cut[1]]]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    pairs = np.unique(np.stack([np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])]), axis=1)
    return pairs[0], pairs[1]


def link_fingerprints(spark: SparkSession, distinct: DataFrame, radius: int = 3, shard: int = 8192) -> DataFrame:
    """(node, component) of the fingerprints (column fp, distinct) that have a neighbour."""
    n = distinct.count()
    shards = min(max(1, n // shard), MAX_SAMPLE // 4)
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(min(MAX_SAMPLE, 64 * shards)).toPandas()["fp"]
    tree = build_tree(sample.to_numpy(np.int64).view(np.uint64), shards, radius)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, p = route(tree, batch.column(0).to_numpy().view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(p.view(np.int64))], ["shard", "fp"])

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = local_links(frame["fp"].to_numpy(np.int64).view(np.uint64), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "shard int, fp long")
    links = dealt.groupBy("shard").applyInPandas(search, "a long, b long")
    return components(spark, links)


def representatives(spark: SparkSession, marked: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, rep): for each fingerprint of ``marked`` (fp, key) the smallest key of its component."""
    nodes = saved(marked.groupBy("fp").agg(F.min("key").alias("key")), spark, "simhash-nodes")
    linked = link_fingerprints(spark, nodes.select("fp"), radius)
    of = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "key", F.coalesce("component", "fp").alias("component"))
    least = of.groupBy("component").agg(F.min("key").alias("rep"))
    return of.join(least, "component").select("fp", "rep")


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """Per row: doc_id, its fingerprint in hex, and the smallest doc_id of its component."""
    marked = saved(with_fingerprint(pick(docs, "doc_id", "text"), "text", "fp", words).select("doc_id", "fp"),
                   spark, "simhash-prints")
    reps = representatives(spark, marked.select("fp", F.col("doc_id").alias("key")), radius)
    return marked.join(reps, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("rep").alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (of equal ones, the first written)."""
    renamed, at = positional(docs)
    marked = saved(with_fingerprint(renamed, at["text"], "fp", words)
                   .withColumn("rid", F.monotonically_increasing_id()), spark, "simhash-docs")
    key = F.struct(F.col(at["doc_id"]).isNull(), F.col(at["doc_id"]), F.col("rid"))
    reps = representatives(spark, marked.select("fp", key.alias("key")), radius)
    stay = reps.select(F.col("rep.rid").alias("rid")).distinct()
    kept = marked.join(stay, "rid", "left_semi")
    return kept.select(*[f"_{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)
