"""Operators 12 and 13 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import DOCS, SF, key, same

import __spark_entry__
from medalake.llm import decontamination as D
from medalake.llm import ranking as R
from medalake.llm.fm_index import Bits, FMIndex, WaveletTree, suffix_order

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def test_words():
    for t in [None, "", "A-b_C 1é2 ÀB\x85x\x00y z É", "it's\tTHE end.", "日本 x"]:
        assert [w.decode() for w in D.words(t and t.encode())] == words(t)


# --- FM-index -----------------------------------------------------------------------------------------------------

def texts_of(seed, n, symbols):
    rng = np.random.default_rng(seed)
    parts = [rng.integers(1, symbols, rng.integers(0, 30)) for _ in range(n)]
    parts += [parts[0]] * 3 + [np.full(200, 1)] + [np.tile(parts[1], 5)] * 2
    return np.concatenate([[0], *[x for p in parts for x in (p, [0])]]).astype(np.int32)


@pytest.mark.parametrize("symbols", [2, 3, 9, 300])
def test_index_equals_plain_search(symbols):
    text = texts_of(symbols, 30, symbols)
    assert sorted(suffix_order(text)) == list(range(len(text)))
    rng = np.random.default_rng(1)
    bits = Bits(text > 1)
    assert bits.ones(np.arange(len(text))).tolist() == np.cumsum(np.append(0, text > 1))[:-1].tolist()
    tree = WaveletTree(text, symbols)
    for c in rng.integers(0, symbols, 8).tolist():
        want = np.append(0, np.cumsum(text == c))
        assert (tree.rank(np.full(len(want), c), np.arange(len(want))) == want).all()
    index = FMIndex(text, symbols, rate=4)
    for length in (1, 2, 5, 12):
        at = rng.integers(0, len(text) - length, 40)
        patterns = np.array([text[i: i + length] for i in at] + [rng.integers(1, symbols, length) for _ in range(10)])
        patterns = patterns[(patterns > 0).all(axis=1)]
        which, places = index.occurrences(patterns)
        want = {(i, p) for i, x in enumerate(patterns) for p in range(len(text) - length + 1) if (text[p: p + length] == x).all()}
        assert set(zip(which.tolist(), places.tolist())) == want and len(which) == len(want)


# --- 12 decontamination -------------------------------------------------------------------------------------------

def brute_spans(text, items):
    w = words(text)
    hit, met = set(), set()
    for item, t in items:
        p = words(t)
        size = min(10, len(p))
        wins = {tuple(p[i:i + size]) for i in range(len(p) - size + 1)} if size else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in wins:
                hit |= set(range(i, i + size))
                met.add("" if item is None else str(item))
    return len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(3, "Line one here"), (10, " ".join(["again"] * 30)), (2, "the of and thing ening Über naïve été can't x1 ok 42 of"),
            (5, "again"), (None, "no ID, here!"), (5, "one"), (7, ""), (8, None), (9, "..."), (1, " ".join(["again"] * 10))]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("shard_words,block_chars", [(1 << 20, 1 << 21), (40, 25)])
def test_spans_against_brute_force(spark, odd, clashing, bench, shard_words, block_chars):
    items = [tuple(r) for r in bench.collect()]
    want = Counter((r.doc_id, *brute_spans(r.text, items)[:3]) for r in odd.collect())
    clash = bench.selectExpr("*", "1 AS TEXT", "2 AS Item_Id", "3 AS rid")
    for docs, b in ((odd, bench), (clashing, clash)):
        got = D.removal_spans(spark, docs, b, shard_words=shard_words, block_chars=block_chars).collect()
        assert Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), len(r["items"])) for r in got) == want
        for r in got:
            assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:])) and r["items"] == sorted(set(r["items"]))


def test_contamination_digest(spark, odd, bench, nothing):
    items = [tuple(r) for r in bench.collect()]
    want = [(r.doc_id, *brute_spans(r.text, items)) for r in odd.collect()]
    assert same(D.contamination(spark, odd, bench).collect(), want)
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(spark, nothing, bench).count() == 0
    clean = D.contamination(spark, odd, none).collect()
    assert len(clean) == len(want) and not any(r.contaminated for r in clean)


# --- 13 ranked search ---------------------------------------------------------------------------------------------

def brute_search(docs, queries, top=10):
    tfs = [(d, Counter(words(t))) for d, t in docs]
    tfs = [(d, tf, sum(tf.values())) for d, tf in tfs if tf]
    n_docs, n_terms = len(tfs), sum(n for _, _, n in tfs)
    df = Counter(t for _, tf, _ in tfs for t in tf)
    out = []
    for item, text in queries:
        scores = []
        for d, tf, n in tfs:
            m = 100 - 90 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t in set(words(text)) if t in tf)
            if s > 0:
                scores.append((-s, d is None, d, s))
        out += [(item, k + 1, d, s) for k, (_, _, d, s) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:top])]
    return out


def test_lists_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 63, 64, 65, 5000):
        docs = np.sort(rng.choice(1 << 14, n, replace=False))
        tf = np.where(rng.random(n) < .01, rng.integers(256, 1 << 20, n), rng.integers(1, 5, n))
        heads, raw = R._compressed(docs, tf, np.arange(0, n, R.BLOCK))
        got = R.decompress(heads, n, raw.tobytes(), np.arange(len(heads)))
        assert (got[0] == docs).all() and (got[1] == tf).all()
        some = np.unique(rng.integers(0, len(heads), 3))
        d, t, b = R.decompress(heads, n, raw.tobytes(), some)
        own = np.isin(np.arange(n) // R.BLOCK, some)
        assert (d == docs[own]).all() and (t == tf[own]).all() and (b == np.arange(n)[own] // R.BLOCK).all()


def test_search_against_brute_force(spark, odd, clashing, bench, monkeypatch):
    items = [tuple(r) for r in bench.collect()]
    want = sorted(map(key, brute_search([(r.doc_id, r.text) for r in odd.collect()], items)))
    for docs, size, window in ((odd, 1 << 14, 2048), (clashing, 7, 3)):
        monkeypatch.setattr(R, "SHARD_DOCS", size)
        monkeypatch.setattr(R, "WINDOW", window)
        index = R.build_index(spark, docs)
        for chars in (1 << 20, 30):
            got = R.search(spark, index, bench, block_chars=chars).collect()
            assert sorted(map(key, map(tuple, got))) == want


def test_pruning_is_exact_and_skips_blocks():
    rng = np.random.default_rng(5)
    n = 6000
    lengths = np.sort(rng.integers(5, 400, n))
    m = R.length_factor(lengths, n, int(lengths.sum()))
    ids = rng.permutation(n)
    lists, plain = [], np.zeros(n, np.int64)
    for df, w in ((5500, 40), (4000, 400), (900, 2000), (60, 5000), (7, 7000)):
        docs = np.sort(rng.choice(n, df, replace=False))
        tf = rng.integers(1, 6, df)
        heads, raw = R._compressed(docs, tf, np.arange(0, df, R.BLOCK))
        lists.append(R._List(df, heads.tobytes(), raw.tobytes(), w, m))
        plain[docs] += w * R.part(tf, m[docs])
    order = np.lexsort((ids, -plain))[:10]
    seen = {}
    assert R.best_of_shard(lists, ids, n, 10, seen) == list(zip(plain[order].tolist(), order.tolist()))
    assert seen["blocks"] < sum(len(x.heads) for x in lists[:3]) / 4


def test_hypothetical_ties_and_equal_rows(spark):
    rows = [(i, "same words here", "en", "s", 0) for i in (9, 3, 3, 40, 1, 2, 8, 7, 6, 5, 4, 11, 12)] + [(13, "other", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    q = spark.createDataFrame([(1, "here words"), (1, "here words"), (2, "nothing known")], "item_id long, text string")
    got = R.search(spark, R.build_index(spark, docs), q).collect()
    assert same(got, brute_search([r[:2] for r in rows], [(1, "here words"), (1, "here words")]))


def test_empty_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert R.search(spark, R.build_index(spark, odd), none).count() == 0
    assert R.search(spark, R.build_index(spark, nothing), spark.createDataFrame([(1, "a")], none.schema)).count() == 0


@pytest.mark.parametrize("name", ["op12_decontamination", "op13_ranked_search"])
def test_queries_equal_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(__spark_entry__.oracle_sql()[name])
    got = __spark_entry__.queries()[name](spark, SF)
    assert got.columns == want.columns
    assert same(got.collect(), want.fetchall())
    by = defaultdict(list)
    for r in got.collect():
        by[r[0]].append(r)
    assert by


def test_documents_against_brute_force(spark, docs):
    queries = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()][:6]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    frame = spark.createDataFrame(random.Random(1).sample(queries, 6), "item_id long, text string")
    assert same(R.search(spark, R.build_index(spark, docs), frame).collect(), brute_search(rows, queries))
