"""Tokenizing operators (2, 5, 10) against the tokenizers library."""

import hashlib
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import key, odd_texts
from tokenizers import Tokenizer

from medalake.llm import bpe, idcoder, packing, token_ids
from medalake.llm.token_ids import TextEncoder
from medalake.session import shared_dir

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_memoised_encoder_equals_library(path):
    enc, tok = TextEncoder(path, cap=50), Tokenizer.from_file(path)
    for text in odd_texts() * 2:
        want = tok.encode(text or "", add_special_tokens=False).ids
        assert list(np.frombuffer(enc.encode(text), "<u4")) == want


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_plain_texts_go_straight_to_the_model(path):
    enc, tok = TextEncoder(path), Tokenizer.from_file(path)
    assert enc.pattern
    letters = [c for c in map(chr, range(0x41, 0x250)) if c.isalpha()]
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(letters, rng.integers(1, 14))) for _ in range(3000)] + ["a×b", "x÷", "İi", "ǅ", "ŉn", "ªº", "µ"]
    texts = [t for w in words for t in (w, f"x {w}, {w.upper()}")]
    signs = list("abTé Ö019'st re .,!_#\n\t\r \x0b\x1c\x00\x7f<|>") + ["'ll", "'S", "  ", "<|endoftext|>", "\xa0", "日"]
    texts += ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(6000)]
    others = TextEncoder(path)
    others.pattern = None                    # a vocabulary for which the pattern doesn't hold
    for text in texts:
        want = tok.encode(text, add_special_tokens=False).ids
        assert list(np.frombuffer(enc.encode(text), "<u4")) == want, text
        assert list(np.frombuffer(others.encode(text), "<u4")) == want, text


def test_speculation_verifies_and_merges():
    m = bpe.SpeculativeBPE(BYTE, cap=50)
    tok = Tokenizer.from_file(BYTE)
    words = ["".join(w) for w in product("etha", repeat=5)] + ["a" * 100, "ab" * 60, "Ġ" * 40]
    got = m.encode_words(words)
    assert got == {w: m.merge(w) for w in words} and 0 < m.n_merged < m.n_proposed
    for text, (n, ids, raw) in zip(odd_texts(), m.encode_many([t or "" for t in odd_texts()])):
        want = tok.encode(text or "", add_special_tokens=False).ids
        assert (n, ids) == (len(want), ",".join(map(str, want)))
        assert raw.decode("utf-8", "replace") == tok.decode(want, skip_special_tokens=False)


def test_failing_words_are_merged_side_by_side(monkeypatch):
    m, exact = bpe.SpeculativeBPE(BYTE), bpe.SpeculativeBPE(BYTE)

    def merge(word):
        raise AssertionError(f"{word} merged alone")

    monkeypatch.setattr(m, "merge", merge)
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("Ġethaoinsr.é"), rng.integers(1, 33))) for _ in range(6000)})
    assert m.encode_words(words) == {w: exact.merge(w) for w in words} and m.n_merged > 2048


def test_words_over_line_feeds_are_the_librarys():
    m, tok = bpe.SpeculativeBPE(BYTE), Tokenizer.from_file(BYTE)
    rng = np.random.default_rng(6)
    signs = list("abTé.,'s\n\n \t1ßĳ") + ["it's", "end.\nThe", "ok!?\n", "<|endoftext|>", "<|\nendoftext|>", "日\n本"]
    texts = [""] + ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(3000)] + [""]
    for text, (n, ids, raw) in zip(texts, m.encode_many(texts), strict=True):
        want = tok.encode(text, add_special_tokens=False).ids
        assert (n, ids, raw.decode()) == (len(want), ",".join(map(str, want)), text)


def test_pairs_apart_agrees_with_merging_the_pair():
    m = bpe.SpeculativeBPE(BYTE)
    names = {i: s for s, i in m.vocab.items()}
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2000, 4000), rng.integers(0, 2000, 4000)
    for x, y, apart in zip(a.tolist(), b.tolist(), m.apart(a, b).tolist()):
        assert apart == (m.merge(names[x] + names[y]) == [x, y])


def test_encode_and_decode_rows(odd, clashing, nothing):
    tok = Tokenizer.from_file(BYTE)

    def want(r):
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))

    expected = sorted(map(key, (want(r) for r in odd.collect())))
    for df in (odd, clashing):
        assert sorted(key(tuple(r)) for r in bpe.encode_and_decode(df, BYTE, texts_at_once=500).collect()) == expected
    assert bpe.encode_and_decode(nothing, BYTE).count() == 0


def test_best_fill_against_all_choices():
    rng = np.random.default_rng(2)
    for _ in range(60):
        counts = {int(k): int(rng.integers(1, 4)) for k in rng.integers(1, 30, 4)}
        cap = int(rng.integers(1, 70))
        best = max(s for c in product(*[range(n + 1) for n in counts.values()])
                   if (s := sum(k * x for k, x in zip(counts, c))) <= cap)
        got = packing.best_fill(cap, counts)
        assert sum(k * n for k, n in got.items()) == best and all(n <= counts[k] for k, n in got.items())


@pytest.mark.parametrize("window,pool", [(2048, 4096), (64, 16)])
def test_packing_places_every_id_once(odd, clashing, nothing, window, pool):
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r.doc_id].append(ids_of(WORD, r.text) + [1])
    for df in (odd, clashing):
        pieces = packing.pack(df, WORD, window, pool=pool).collect()
        assert sum(p.length for p in pieces) == sum(len(x) for v in texts.values() for x in v)
        sequences, per_doc = defaultdict(list), defaultdict(list)
        for p in pieces:
            sequences[p.sequence_id].append(p)
            per_doc[p.doc_id].append(p)
            assert any(zlib.crc32(np.array(x[p.start: p.start + p.length], "<u4").tobytes()) == p.ids_crc32
                       and len(x) == p.doc_tokens for x in texts[p.doc_id])
        for s in sequences.values():
            s.sort(key=lambda p: p.offset)
            assert [p.offset for p in s] == [sum(q.length for q in s[:i]) for i in range(len(s))]
            total = sum(p.length for p in s)
            assert 0 < total <= window
            if pool > 16:  # no padding at all
                assert total & (total - 1) == 0
        assert sum(p.length for p in pieces) > 0.85 * sum(window if sum(p.length for p in s).bit_count() > 1 else sum(p.length for p in s)
                                                       for s in sequences.values())
        for d, own in per_doc.items():
            starts = sorted((p.start, p.length) for p in own)
            if len(texts[d]) == 1:
                assert [a for a, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]
    assert packing.pack(nothing, WORD).count() == 0


def test_blocks_round_trip_and_checksums():
    rng = np.random.default_rng(0)
    cases = [np.zeros(0, "<u4"), np.array([5], "<u4"), np.zeros(5000, "<u4"), np.full(3000, 65535, "<u4"),
             np.array([70000, 5, 2**32 - 1, 0, 65535] * 900, "<u4"), rng.integers(0, 50257, 9000).astype("<u4"),
             np.minimum(rng.zipf(1.3, 20_000), 50256).astype("<u4")]
    for ids in cases:
        assert (idcoder.decode_blocks(idcoder.encode_blocks(ids)) == ids).all()
    skewed = idcoder.encode_blocks(cases[-1])
    assert len(skewed) < len(cases[-1]) * 1.6          # well below two bytes an id
    # blocks are independent: a broken word spoils its own block, and is found
    broken = bytearray(skewed)
    broken[-40] ^= 1
    with pytest.raises(ValueError, match="block 9"):
        idcoder.decode_blocks(bytes(broken))
    with pytest.raises(ValueError):
        idcoder.decode_blocks(b"something else")


def test_classes_are_found_in_two_levels():
    rng = np.random.default_rng(7)
    rows = np.sort(rng.integers(1, 500, (300, 32)), axis=1).astype(np.int32)
    rows[:, 0] = 0
    v = rng.integers(0, 600, 300).astype(np.int32)
    assert idcoder._below(rows, v).tolist() == [int(np.searchsorted(r, x, side="right")) - 1 for r, x in zip(rows, v)]


def test_coded_bytes_stay_the_same():
    k = np.arange(30_000, dtype=np.int64)
    data = idcoder.encode_blocks((k * k // 7 % (1 + k % 50257)).astype("<u4"))
    assert hashlib.sha256(data).hexdigest() == "530020c0b21335d65c12de03f4a5fce70f74575adb11c5e4d5592b20b0e77511"


def test_symbols_to_encode_are_looked_up_many_steps_at_a_time(monkeypatch):
    steps = []
    slots = idcoder._Model.slots

    def seen(self, a, b):
        steps.append(a.shape[0] if a.ndim == 2 else 1)
        return slots(self, a, b)

    monkeypatch.setattr(idcoder._Model, "slots", seen)
    data = idcoder.encode_blocks(np.arange(3 * idcoder.BLOCK, dtype="<u4") % 700)
    assert sum(steps) == idcoder.BLOCK and len(steps) < idcoder.BLOCK / 20
    steps.clear()
    idcoder.decode_blocks(data)
    assert steps == [1] * idcoder.BLOCK


def test_packed_weights_learn_like_plain_ones():
    rng = np.random.default_rng(8)
    m, plain = idcoder._Model(3), np.tile([[0, 0, 1], [8, 0, 8], [0, 8, 8], [8, 4, 8], [24, 0, 8]], (27, 1))
    for _ in range(4000):
        state = np.arange(3) * 45 + rng.integers(0, 2, 3)
        outcome = rng.integers(0, 3, 3).astype(np.uint8)
        w = m.weight.take(state)
        m.learn(state, w, w * idcoder._SUMS, idcoder._LEARN.take(outcome))
        heavy = state[plain[state].sum(axis=1) > 2000]
        plain[state, outcome] += 24
        plain[heavy] = (plain[heavy] + 1) >> 1
    fields = [(m.weight >> np.uint64(k)) & np.uint64(0xFFFF) for k in (0, 16, 32, 48)]
    assert (np.stack(fields[:3], axis=1) == plain).all() and not fields[3].any()


def test_both_formats_round_trip_with_the_same_model():
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0, "<u4"), np.array([5], "<u4"), np.zeros(5000, "<u4"), np.full(3000, 65535, "<u4"),
                np.array([70000, 5, 2**32 - 1, 0, 65535] * 900, "<u4"), rng.integers(0, 65536, 50_000).astype("<u4"),
                np.minimum(rng.zipf(1.3, 300_000), 50256).astype("<u4")):
        old, new = idcoder.encode_blocks(ids), idcoder.encode_blocks(ids, idcoder.MAGIC2)
        assert (idcoder.decode_blocks(old) == ids).all() and (idcoder.decode_blocks(new) == ids).all()
        assert len(new) < 1.01 * len(old) + 16
    broken = bytearray(new)
    broken[-40] ^= 1
    with pytest.raises(ValueError, match=f"block {len(ids) // idcoder.BLOCK}"):
        idcoder.decode_blocks(bytes(broken))


def test_a_lane_moves_at_most_one_word_in_and_out_in_a_step():
    rng, lanes, steps = np.random.default_rng(4), 50, 3000
    totals = rng.integers(1, 45_000, (steps, lanes)).astype(np.uint64)
    skips = (rng.random((steps, lanes)) * totals).astype(np.uint64)
    skips[:, :10] = totals[:, :10] - np.uint64(1)          # carries run through many words
    shifts = rng.integers(0, 11, (steps, lanes)).astype(np.uint64)
    rc = idcoder._Carrying(lanes, None, 60)
    for total, skip, shift in zip(totals, skips, shifts):
        rc.make_room(1)
        before, r = rc.pos.copy(), rc.rng // total
        rc.narrow(lanes, r * skip, r >> shift)
        assert ((rc.pos - before) <= 1).all() and (rc.rng >= 2**32).all()
    rc.make_room(2)
    used = rc.flush()
    assert (rc.words < 2**32).all()
    rd = idcoder._Carrying(lanes, np.pad(rc.words[:, : used.max()], ((0, 0), (0, 4))).astype(np.uint32), 0)
    for total, skip, shift in zip(totals, skips, shifts):
        r = rd.rng // total
        assert (np.minimum(rd.code // r, total - np.uint64(1)) == skip).all()
        rd.narrow(lanes, r * skip, r >> shift)


MANY = ["", None, "a", " ", "  two  spaces\n\nand\ttabs \r\n", "it's we'll THEY'VE 'S o'clock", "x" * 15, "x" * 16, " " + "y" * 300,
        "naïveté straße ſ İstanbul 3×4 8÷2 ª º µ", "日本語 text と 中文", "🙂 ok 🙂", "a\x00b \x00\x00 \x00", "\x85\xa0 odd\u2003space",
        "<|endoftext|> in <|endoftext|>text", "12x3 4.5,6 (a)-[b]_c_ ...!?", "end ", " start", "A.B.C. d,e", "Éa", "a" + "é" * 7 + "b"]


@pytest.mark.parametrize("vocabulary", [BYTE, WORD])
def test_columns_of_texts_get_the_ids_of_the_library(vocabulary, monkeypatch):
    rng = np.random.default_rng(5)
    words = [w for t in MANY if t for w in t.split(" ")]
    texts = MANY + [" ".join(rng.choice(words, n)) for n in (1, 5, 50, 700)] + \
        ["".join(map(chr, rng.integers(32, 0x180, n))) for n in (3, 20, 400)]
    wanted = [ids_of(vocabulary, t) for t in texts]
    for piece, at_once in ((1 << 21, 1 << 17), (40, 64)):
        monkeypatch.setattr(token_ids, "_PIECE", piece)
        monkeypatch.setattr(token_ids, "_AT_ONCE", at_once)
        enc = TextEncoder(vocabulary, 16)           # a table of 64 parts, emptied again and again
        for _ in range(2):
            assert [x.tolist() for x in enc.encode_many(pa.array(texts))] == wanted
    assert enc.encode_many(pa.array([], pa.string())) == []


def test_known_parts_are_looked_up_without_a_call_each(monkeypatch):
    enc = TextEncoder(BYTE)
    texts = pa.array([f"known words, {i % 7} and again known words." for i in range(500)])
    enc.encode_many(texts)
    for name in ("_ids", "_plain", "_library"):
        monkeypatch.setattr(enc, name, None)
    assert len(enc.encode_many(texts)) == 500


def test_files_give_back_every_document_in_order(spark, odd, clashing, nothing, monkeypatch):
    for df, size in ((odd, 1 << 20), (clashing, 3000)):
        path = shared_dir(spark, "tests", "ids")
        idcoder.write_ids(df, path, BYTE, segment_ids=size)
        got = idcoder.read_ids(spark, path).orderBy("start").collect()
        rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, len(r.text or "")))
        start = 0
        for r, g in zip(rows, got, strict=True):
            ids = ids_of(BYTE, r.text) + [0]
            assert (g.doc_id, g.start, g.n_tokens) == (r.doc_id, start, len(ids))
            assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            start += len(ids)
    path = shared_dir(spark, "tests", "ids")
    idcoder.write_ids(nothing, path, BYTE)
    assert idcoder.read_ids(spark, path).count() == 0
