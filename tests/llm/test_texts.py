"""Operators on texts (1, 3, 4, 6, 7, 8, 9) against brute force."""

import base64
import bz2
import gzip
import hashlib
import html.parser
import lzma
import random
import re
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard
from llm_cases import SF, key, odd_texts, same

from medalake.llm import (bradley_terry, order_minhash, pseudo_lm, quality_rules, secrets_scan, simhash, warc)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- 1 quality rules ----------------------------------------------------------------------------------------------

def brute_counts(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    marked = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(marked))


def test_measures_equal_brute_force():
    for t in odd_texts():
        assert quality_rules.measure(t)[:5] == brute_counts(t)


def brute_bucket(v):
    return v - v % (1 << max(v.bit_length() - 5, 0))


def test_rules_against_brute_force(spark, docs, odd, clashing, nothing):
    for df in (docs, odd, clashing):
        got = quality_rules.judge(spark, df).collect()
        src = [(r["lang"], r["source"], quality_rules.measure(r["text"])) for r in df.collect()]
        names = list(quality_rules.RATES)

        def quartile(rows, rate, q):
            v = sorted(brute_bucket(m[6 + names.index(rate)]) for m in rows)
            return v[-(-q * len(v) // 4) - 1]

        def kept(lang, source, m):
            if m[5]:
                return False
            groups = [[x for a, b, x in src if not x[5] and (a, b) == (lang, source)],
                      [x for a, _, x in src if not x[5] and a == lang], [x for _, _, x in src if not x[5]]]
            group = next((g for g in groups if len(g) >= quality_rules.MIN_GROUP), groups[-1])
            for rate, (slack, low) in quality_rules.RATES.items():
                a, b, v = quartile(group, rate, 1), quartile(group, rate, 3), m[6 + names.index(rate)]
                if v > b + quality_rules.FENCE * (b - a) + slack or low and v < a - quality_rules.FENCE * (b - a) - slack:
                    return False
            return True

        cache = {}
        want = Counter((*m[:6], cache.setdefault((a, b, m), kept(a, b, m))) for a, b, m in src)
        assert Counter((*r[1:6], r.base_failed, r.kept) for r in got) == want
    assert quality_rules.judge(spark, nothing).count() == 0
    assert quality_rules.keep_good(spark, nothing).count() == 0


def test_keep_good_keeps_rows_and_columns(spark, docs, clashing):
    for df in (docs, clashing):
        out = quality_rules.keep_good(spark, df)
        assert out.schema.fieldNames() == df.schema.fieldNames()
        assert out.count() == quality_rules.judge(spark, df).where("kept").count()


# --- 3 classifier ---------------------------------------------------------------------------------------------------

def test_classifier_on_held_out_labels(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    out = bradley_terry.score(docs, labels)
    got = {r.doc_id: r for r in out.collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    import zlib
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(held) > 50 and np.mean([q == r.predicted for q, r in held]) > 0.95
    good, bad = [r.score for q, r in held if q], [r.score for q, r in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    kept = {r.doc_id for r in bradley_terry.keep_good(docs, labels).collect()}
    assert kept == {d for d, r in got.items() if r.predicted}


def test_classifier_edges(spark, odd, clashing, nothing):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(5, None, None), (None, 1, 0)],
                                   "doc_id long, quality long, toxic long")
    none = labels.limit(0)
    for df in (odd, clashing):
        assert bradley_terry.score(df, labels).count() == odd.count()
        assert {r.score for r in bradley_terry.score(df, none).collect()} == {0.75}
        assert bradley_terry.keep_good(df, none).schema.fieldNames() == df.schema.fieldNames()
    assert bradley_terry.score(nothing, labels).count() == 0


def test_held_out_labels_are_not_read(spark):
    from pyspark.sql import functions as F
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(bradley_terry.held_out(F.col("doc_id")), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    assert same(bradley_terry.score(docs, labels).collect(), bradley_terry.score(docs, flipped).collect())


# --- 4 fingerprints -------------------------------------------------------------------------------------------------

def test_fingerprints_against_a_plain_loop(spark, docs, odd, clashing, nothing):
    single = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    for df in (docs, single, single.selectExpr("*", "1 AS DOC_ID", "2 AS part", "3 AS head", "4 AS n")):
        rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), reverse=True)
        want = []
        for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
            new = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
            a, b, c = (order_minhash._text_of(order_minhash.signature(x)) for x in (t, new, nxt))
            like = lambda x, y: sum(x[i:i + 6] == y[i:i + 6] for i in range(0, len(x), 6)) / 24
            want.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), a, b, like(a, b), like(a, c)))
        assert same(order_minhash.fingerprints(spark, df).collect(), want)
    for df in (odd, clashing):
        assert order_minhash.fingerprints(spark, df).count() == odd.count()
    assert order_minhash.fingerprints(spark, nothing).count() == 0
    one = spark.createDataFrame([(3, "some words stand here")], "doc_id long, text string")
    assert order_minhash.fingerprints(spark, one).first().near_next == 1.0


def test_order_counts_in_signatures():
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    text, shuffled = " ".join(words), words.copy()
    blocks = [shuffled[i:i + 20] for i in range(0, 400, 20)]
    rnd.shuffle(blocks)
    moved = " ".join(w for b in blocks for w in b)
    near = lambda a, b: (order_minhash.signature(a) == order_minhash.signature(b)).mean()
    edit = " ".join(words[:200] + ["new"] + words[200:])
    assert near(text, text) == 1 and near(text, edit) > 0.8
    assert near(text, moved) < near(text, edit)         # the same k-mers, in another order


def test_one_repeated_kmer_leaves_the_others():
    """A near copy that repeats a k-mer is ranked by the same hashes as its original."""
    rnd = random.Random(6)
    for _ in range(20):
        words = [f"w{rnd.randrange(10 ** 9)}" for _ in range(80)]
        a, b = (order_minhash.signature(" ".join(w)) for w in (words, words + words[:3]))
        assert (a == b).mean() > 0.7


# --- 6 secrets --------------------------------------------------------------------------------------------------------

def brute_base(t):
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
                         r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        out += [(m.start(), "assign", m.end())] * (len(m[2]) >= 8)
    out += [(m.start(), "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return out + [(m.start(), "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]


def test_base_spans(docs):
    rnd = random.Random(5)
    texts = [r.text or "" for r in docs.collect()] + [t or "" for t in odd_texts()]
    texts += ["".join(rnd.choice(["token", "Secret", "=", ": ", "'", "a1b2c3d4e5f6", "AKIA", "ABCDEFGH", " ", "ſecret", "é"])
                      for _ in range(30)) for _ in range(300)]
    for t in texts:
        base, spans, _, _ = secrets_scan.scan_layers(t)
        assert sorted(base) == sorted(brute_base(t)) and set(base) <= set(spans)


SECRET = "Password = hunter2hunter2"
LAYERS = {
    "url": urllib.parse.quote, "url_all": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s), "hexes": lambda s: "".join(f"\\x{ord(c):02x}" for c in s),
    "entities": lambda s: "".join(f"&#{ord(c)};" for c in s), "base64": lambda s: base64.b64encode(s.encode()).decode(),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    "bzip2": lambda s: base64.b64encode(bz2.compress(s.encode())).decode(),
}


@pytest.mark.parametrize("outer", LAYERS)
@pytest.mark.parametrize("inner", LAYERS)
def test_nested_layers_map_to_the_original(outer, inner):
    coded = LAYERS[outer](LAYERS[inner](f"é {SECRET} é"))
    text = f"ßome words {coded} more"
    base, spans, layers, _ = secrets_scan.scan_layers(text)
    assert layers >= 3 and spans
    assert all(11 <= a < b <= 11 + len(coded) for a, _, b in spans)
    assert not secrets_scan.scan_layers(secrets_scan.redacted(text, spans))[1]


def test_spans_of_character_layers_are_exact():
    text = "x " + LAYERS["url_all"]("é " + SECRET + " é")
    (a, kind, b), = secrets_scan.scan_layers(text)[1]
    assert kind == "assign" and urllib.parse.unquote(text[a:b]) == SECRET


@pytest.mark.parametrize("text, spot", [
    (r'say "password": "\u0068unter2hunter2" now', r'password": "\u0068unter2hunter2'),
    ("say password = %68%75%6Eter2hunter2 now", "password = %68%75%6Eter2hunter2"),
    ("say pass%77ord = hunter2hunter2 now", "pass%77ord = hunter2hunter2"),
    ("say token &#58; %68unter2hunter2 now", "token &#58; %68unter2hunter2"),
    ("say token %3D %68unter2hunter2 now", "token %3D %68unter2hunter2"),
    ("say " + base64.b64encode(b"long password = ").decode() + " 'hunter2hunter2' now", "'hunter2hunter2"),
    ("say " + base64.b64encode(gzip.compress(b"the token:")).decode() + " hunter2hunter2 now", " hunter2hunter2"),
])
def test_plain_and_encoded_parts_meet(text, spot):
    spans = secrets_scan.scan_layers(text)[1]
    assert any(kind == "assign" and spot in text[a:b] for a, kind, b in spans)
    clean = secrets_scan.redacted(text, spans)
    assert "unter2" not in clean and clean.startswith("say ") and clean.endswith(" now")


@pytest.mark.parametrize("prefix", ["", "io/cb/", "token_", "a-b-c-d-e/", "x/y_zzz/"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, bz2.compress, zlib.compress, lambda b: zlib.compress(b, wbits=9)])
def test_base64_behind_other_characters(prefix, pack):
    text = f"see {prefix}{base64.b64encode(pack(b'password = hunter2hunter2')).decode()} now"
    spans = secrets_scan.scan_layers(text)[1]
    assert any(kind == "assign" for _, kind, _ in spans)
    assert secrets_scan.redacted(text, spans).endswith(" now")
    assert not secrets_scan.scan_layers(secrets_scan.redacted(text, spans))[1]


@pytest.mark.parametrize("odd", [b"\x00", b"\xe9", b"\xff\x01"])
def test_odd_bytes_lose_no_secret(odd):
    data = odd + b" password = hunter2hunter2 caf\xe9"
    url = "".join(f"%{x:02x}" for x in data)
    for coded, size in ((base64.b64encode(data).decode(), 4 / 3), (url, 3)):
        (a, kind, b), = secrets_scan.scan_layers("see " + coded)[1]
        start = 4 + (len(odd) + 1) * size
        assert kind == "assign" and start - 2 < a <= start and b - a <= 25 * size + 3


@pytest.mark.parametrize("wrap", [8, 20, 60, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
def test_wrapped_base64(wrap, end):
    coded = base64.b64encode(b"some longer words come first; password = hunter2hunter2 and more words follow on").decode()
    text = f"see{end}{end.join(coded[i:i + wrap] for i in range(0, len(coded), wrap))} now"
    spans = secrets_scan.scan_layers(text)[1]
    assert any(kind == "assign" for _, kind, _ in spans)
    assert not secrets_scan.scan_layers(secrets_scan.redacted(text, spans))[1]


def test_cycles_and_bombs_end():
    bomb = base64.b64encode(gzip.compress(b"a" * 2_000_000 + b" token=abcdefgh1")).decode()
    assert secrets_scan.scan_layers(bomb)[1] and secrets_scan.scan_layers(bomb, max_layer=1000)[3] == 1
    assert secrets_scan.scan_layers("%2525252525 " * 50)[1] == []


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_compressed_data_is_read_whole(pack):
    coded = lambda b: "see " + base64.b64encode(b).decode() + " now"
    scan = lambda t, **k: secrets_scan.scan_layers(t, **k)
    # repetitive data may leave 32 equal base64 digits, a hex run of the text itself
    kinds = lambda t, **k: {kind for _, kind, _ in scan(t, **k)[1]} - {"hex"}
    members = b"".join(pack(x) for x in (b"one, two; " * 9, b"three, four; " * 9, b"token=abcdefgh1, five"))
    assert kinds(coded(members)) == {"assign"}
    late = coded(pack(b"plain, words; " * 20_000 + b"token=abcdefgh1, end"))
    assert kinds(late, max_layer=10_000) == {"assign"} and scan(late, max_layer=10_000)[3] == 1
    for cut in range(9_993, 10_008):  # across the end of a chunk
        assert kinds(coded(pack(b"x," * (cut // 2) + b"token=abcdefgh1," + b"y," * 9_000)), max_layer=10_000) == {"assign"}
    noise = random.Random(7).randbytes(3_000)
    text = coded(pack(b"some words, " * 50 + noise + b"token=abcdefgh1")[:-40])
    assert "unread" in kinds(text) and secrets_scan.redacted(text, scan(text)[1]) == "see [SECRET] now"
    assert kinds(coded(pack(b"some words, " * 50))) == set()


def test_secret_rows_and_redaction(spark, odd, clashing, nothing):
    for df in (odd, clashing):
        got = secrets_scan.find_secrets(df)
        assert got.count() == odd.count()
        assert secrets_scan.redact(df).schema.fieldNames() == df.schema.fieldNames()
    assert secrets_scan.find_secrets(nothing).count() == 0 and secrets_scan.redact(nothing).count() == 0
    row = spark.createDataFrame([(1, "a token: abcdefgh1 b", 20), (2, None, 7)], "doc_id long, text string, n_chars long")
    assert same(secrets_scan.redact(row).collect(), [(1, "a [SECRET] b", 12), (2, None, 7)])


# --- 7 SimHash --------------------------------------------------------------------------------------------------------

def brute_print(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))


def brute_components(rows):
    """rows: (doc_id, fingerprint) -> component of each."""
    group = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [min((d for (d, _), h in zip(rows, group) if h == g and d is not None), default=None) for g in group]


def test_near_duplicates_against_all_pairs(spark, docs, odd, clashing, nothing):
    for df in (docs, odd, clashing):
        rows = [(r["doc_id"], brute_print(r["text"])) for r in df.collect()]
        want = [(d, f"{f:016x}", c) for (d, f), c in zip(rows, brute_components(rows))]
        assert same(simhash.near_duplicates(spark, df).collect(), want)
        kept = simhash.keep_one(spark, df)
        assert kept.schema.fieldNames() == df.schema.fieldNames()
        assert kept.count() == len({c for _, _, c in want})
    assert simhash.near_duplicates(spark, nothing).count() == 0 and simhash.keep_one(spark, nothing).count() == 0


def test_trees_lose_no_link():
    """Fingerprints in chains and dense balls, over many shards: the same components as all pairs give."""
    rng = np.random.default_rng(9)
    seeds = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    chain = [seeds[0]]
    for i in range(40):
        chain.append(chain[-1] ^ np.uint64(0b111 << (i % 60)))
    ball = [seeds[1] ^ np.uint64((1 << a) | (1 << b)) for a in range(30) for b in range(30)]
    points = np.unique(np.concatenate([seeds, np.array(chain), np.array(ball)]))

    def groups(pairs):
        up = {int(p): int(p) for p in points}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            a, b = root(int(a)), root(int(b))
            up[max(a, b)] = min(a, b)
        return {x: root(x) for x in up}

    near = np.argwhere(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3, 1))
    want = groups((points[i], points[j]) for i, j in near)
    tree = simhash.build_tree(points[::3], 16, 3)
    shard, copy = simhash.route(tree, points, 3)
    assert len(np.unique(shard)) > 8
    found = [pair for s in np.unique(shard) for pair in zip(*simhash.local_links(copy[shard == s], 3))]
    assert groups(found) == want and len(found) < 4 * len(copy)


# --- 8 WARC -------------------------------------------------------------------------------------------------------------

class Text(html.parser.HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_derivatives(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    responses = warc.response_records(pages)
    raw = {r.page_id: bytes(r.record) for r in responses.collect()}
    made = warc.derivatives(responses).collect()
    assert len(made) == 2 * len(raw) and {r.record_type for r in made} == {"metadata", "conversion"}
    pages = {r.page_id: r for r in pages.collect()}
    for r in made:
        fields, status, headers, payload = warc.parse_response(raw[r.page_id])
        assert payload.decode() == pages[r.page_id].html and r.target_uri == pages[r.page_id].url
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        own = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        block = rest[: int(own["Content-Length"])]
        assert rest == block + b"\r\n\r\n" and own["WARC-Block-Digest"] == warc.digest(block) == r.block_digest
        assert own["WARC-Refers-To"] == fields["warc-record-id"] == r.refers_to
        assert own["WARC-Source-Payload-Digest"] == fields["warc-payload-digest"] == warc.digest(payload)
        if r.record_type == "conversion":
            parser = Text()
            parser.feed(payload.decode())
            assert "".join(block.decode().split()) == "".join("".join(parser.out).split())
        else:
            assert "http-header-content-type: text/html; charset=utf-8" in block.decode()
    assert len({r.record_id for r in made}) == len(made)


def test_warc_edges(spark):
    rows = [(1, None, None, 0), (None, "http://a", "<p>x", 0), (2, "u", "a<br>b &amp; c<script>no</script", 0),
            (2, "u", "a<br>b &amp; c<script>no</script", 0), (3, "v", "<!-- <p>no</p> --><a href='q\"r'>t</a> 1 < 2", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, RECORD int")
    got = warc.derivatives(warc.response_records(pages)).where("record_type = 'conversion'").collect()
    assert sorted(bytes(r.record).split(b"\r\n\r\n")[1].decode() for r in got) == ["", "a\nb & c", "a\nb & c", "t 1 < 2", "x"]
    assert warc.derivatives(warc.response_records(pages.limit(0))).count() == 0
    with pytest.raises(ValueError):
        warc.parse_response(b"WARC/1.1\r\nWARC-Type: request\r\n\r\n")


# --- 9 language model ---------------------------------------------------------------------------------------------------

def test_conditionals_are_probabilities():
    """Over all tokens at one place the probabilities add up to one, and scores add up over places."""
    model = pseudo_lm.unflat(np.random.default_rng(0).normal(0, 0.5, len(pseudo_lm.flat(pseudo_lm.start_model()))))
    every = np.arange(pseudo_lm.VOCABULARY, dtype=np.uint16)
    around = [np.full(len(every), x, np.uint16) for x in (3, 700, 0, 9)]
    assert abs(np.exp(pseudo_lm._forward(model, around, every)[-1]).sum() - 1) < 1e-3
    text = np.array([5, 6, 900, 6, 5], np.uint16)
    padded = np.concatenate([[0, 0], text, [0, 0]]).astype(np.uint16)
    one = sum(float(pseudo_lm._forward(model, [padded[i + o: i + o + 1] for o in pseudo_lm.OFFSETS],
                                       padded[i: i + 1])[-1][0]) for i in range(2, 7))
    assert np.allclose(pseudo_lm.log_probs(model, [text[:0], text, text[:0]]), [0, one, 0], atol=1e-3)


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    model = pseudo_lm.unflat(rng.normal(0, 0.3, len(pseudo_lm.flat(pseudo_lm.start_model()))))
    context = [rng.integers(0, 50, 40).astype(np.uint16) for _ in range(4)]
    target = rng.integers(0, 50, 40).astype(np.uint16)
    g = pseudo_lm._gradients(model, context, target)
    model = {k: v.astype(np.float64) for k, v in model.items()}
    loss = lambda: -pseudo_lm._forward(model, context, target)[-1].sum()
    for name, at in (("cls", (3, 0)), ("tok", (0, 2, 7)), ("bias", (1,)), ("embed", (2, int(context[2][0]), 4))):
        keep = model[name][at]
        model[name][at] = keep + 1e-4
        up = loss()
        model[name][at] = keep - 1e-4
        assert abs((up - loss()) / 2e-4 - g[name][at]) < 1e-2
        model[name][at] = keep


def test_training_beats_the_start(spark, docs):
    words, model = pseudo_lm.fit(spark, docs)
    texts = [r.text or "" for r in docs.collect()]
    ids = [words(t) for t in texts]
    mean = lambda m, x: sum(pseudo_lm.log_probs(m, x)) / sum(map(len, x))
    assert mean(model, ids) > mean(pseudo_lm.start_model(), ids) + 0.3
    got = {r.doc_id: r for r in pseudo_lm.score(spark, docs).collect()}
    one = docs.first()
    assert got[one.doc_id].n_tokens == len((one.text or "").encode().split())
    assert np.isclose(got[one.doc_id].pseudo_log_likelihood, pseudo_lm.log_probs(model, [words(one.text)])[0], rtol=1e-3)


def test_documents_score_above_their_shuffled_words(spark, docs):
    words, model = pseudo_lm.fit(spark, docs)
    ids = [words(r.text) for r in docs.collect()]
    mean = lambda x: sum(pseudo_lm.log_probs(model, x)) / sum(map(len, x))
    rng = np.random.default_rng(0)
    assert mean(ids) > mean([rng.permutation(x) for x in ids]) + 0.05


def test_order_of_words_counts():
    text = np.tile(np.arange(100, 140, dtype=np.uint16), 1000)
    trainer = pseudo_lm.Trainer(pseudo_lm.start_model())
    for _ in range(40):
        trainer.add(text)
    mixed = np.random.default_rng(0).permutation(text)
    ordered, other = (pseudo_lm.log_probs(trainer.model, [t])[0] / len(t) for t in (text, mixed))
    assert ordered > other + 1


def test_lm_edges(spark, odd, clashing, nothing):
    for df in (odd, clashing):
        got = pseudo_lm.score(spark, df).collect()
        assert len(got) == odd.count() and all((r.n_tokens == 0) == (r.pseudo_log_likelihood == 0) for r in got)
    assert pseudo_lm.score(spark, nothing).count() == 0
