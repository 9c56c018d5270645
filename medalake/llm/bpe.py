"""Byte-pair encoding by speculation and verification, and decoding.

Greedy longest match proposes tokens for every new word of a batch, in a walk of all words through one prefix tree.
A proposal equals the result of the merge
rules exactly when each adjacent pair of its tokens would stay apart if the pair were encoded alone; numpy
tests all adjacent pairs of the batch at once by undoing, from the top, the merges that formed the two tokens and
looking for a rule that would have crossed the boundary earlier. Only words with a failing pair are merged rule
by rule, one rule of every such word at a time. Pre-tokenization is the library's; ids are kept per distinct word in a
bounded memo.

Defined results: null text encodes as the empty text (no ids); null or repeated doc_id rows each keep a row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from medalake.llm.common import pick, rows
from medalake.llm.token_ids import _WORD_AND_TAIL, Memo, cut, part_text

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_NEVER = 1 << 62
# a word and the punctuation behind it; the same again behind a line feed, which is a pre-token before a letter
_WORDS = re.compile(_WORD_AND_TAIL.pattern + "(?:(\n)" + _WORD_AND_TAIL.pattern.replace("( ?", "(") + ")?")


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest for 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _joined(values: pa.Array, at: np.ndarray, lengths: np.ndarray, by) -> pa.Array:
    """Strings of ``values`` picked by ``at``, as many as each of ``lengths`` says joined to one."""
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(ends, values.take(pa.array(at))), pa.scalar(by, values.type))


class _Lookup:
    """Number of a key among distinct ``keys`` (0 and up) by a quarter-full hash table; the last number: none of them."""

    def __init__(self, keys: np.ndarray):
        bits = int(4 * len(keys)).bit_length()
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.numbers = np.full(1 << bits, len(keys), np.int64)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            first = np.unique(slot, return_index=True)[1]
            first = first[self.keys[slot[first]] < 0]
            self.keys[slot[first]], self.numbers[slot[first]] = keys[left[first]], left[first]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out, held = self.numbers[slot], self.keys[slot]      # an empty slot's number: none
        far = np.flatnonzero((held != keys) & (held >= 0))
        while len(far):
            slot[far] = (slot[far] + 1) & self.mask
            out[far], held = self.numbers[slot[far]], self.keys[slot[far]]
            far = far[(held != keys[far]) & (held >= 0)]
        return out


class SpeculativeBPE:
    def __init__(self, path: str, cap: int = 300_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pre = Tokenizer.from_file(path).pre_tokenizer
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_rx = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        # rule -> rank; the first rule that makes a token is how the token is formed
        self.rule: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            made, pair = vocab[a + b], (vocab[a], vocab[b])
            if pair not in self.rule:
                self.rule[pair] = (rank, made)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, *pair
        self.rule_at = _Lookup(np.array([a << 32 | b for a, b in self.rule], np.int64))
        self.rule_ranks = np.array([*(r for r, _ in self.rule.values()), _NEVER], np.int64)
        # tokens that their own text encodes to; others are never proposed
        formed = np.flatnonzero(self.rank >= 0)
        sound = np.ones(size, bool)
        sound[formed] = self.apart(self.left[formed], self.right[formed], self.rank[formed])
        for t in formed[np.argsort(self.rank[formed])]:
            sound[t] &= sound[self.left[t]] & sound[self.right[t]]
        self.vocab = vocab
        self._plant({s: i for s, i in vocab.items() if sound[i]})
        self.made = np.full(len(spec["model"]["merges"]), -1, np.int64)      # by rank
        for rank, made in self.rule.values():
            self.made[rank] = made
        letters = _byte_letters()
        raw = {i: bytes(letters[c] for c in s) if all(c in letters for c in s) else s.encode()
               for s, i in [*vocab.items(), *self.special.items()]}
        self.decimal = pa.array([str(i) for i in range(size)], pa.large_string())
        self.raw = pa.array([raw.get(i, b"") for i in range(size)], pa.large_binary())
        kind = spec["pre_tokenizer"]
        self.spelling = None
        if kind["type"] == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"]:
            of = {b: c for c, b in letters.items()}
            self.spelling = {c: "".join(of[b] for b in chr(c).encode()) for c in range(0x250)}
        self.words, self.parts = Memo(None, cap), Memo(None, cap)
        self.n_proposed = self.n_merged = 0

    def apart(self, a: np.ndarray, b: np.ndarray, below: np.ndarray | None = None) -> np.ndarray:
        """Whether no rule joins across the boundary of the token pairs (a, b); with ``below``, none of lower rank."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(x), _NEVER) if below is None else below.astype(np.int64)
        result = np.ones(len(x), bool)
        live = np.arange(len(x))
        while len(live):
            rank = self.rule_ranks[self.rule_at(x << 32 | y)]
            crossed = rank < limit
            result[live[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crossed & ((rx >= 0) | (ry >= 0))
            live, x, y, rx, ry = live[go], x[go], y[go], rx[go], ry[go]
            # undo the later of the two merges; of equal rules the left place comes first
            undo_left = rx > ry
            limit = np.where(undo_left, rx, ry + 1)
            x, y = np.where(undo_left, self.right[x], x), np.where(undo_left, y, self.left[y])
        return result

    def _plant(self, proposable: dict[str, int]) -> None:
        """The tree of all prefixes of the tokens that are proposed: (node, letter) -> node, and the token a node spells."""
        letters = sorted({c for s in proposable for c in s})
        number = {c: i for i, c in enumerate(letters)}
        self.letter = np.full(max(map(ord, letters)) + 2, -1, np.int64)      # by code point; the last one: none
        self.letter[[ord(c) for c in letters]] = range(len(letters))
        self.fan = len(letters) + 1                                          # the last letter ends a word, and has no edge
        nodes, edges = {"": 0}, []
        for s in proposable:
            node = 0
            for k in range(1, len(s) + 1):
                after = nodes.get(s[:k])
                if after is None:
                    after = nodes[s[:k]] = len(nodes)
                    edges.append(node * self.fan + number[s[k - 1]])
                node = after
        self.edge_at = _Lookup(np.array(edges, np.int64))       # edge i leads to node i + 1
        self.none = len(edges)
        self.spells = np.fromiter((proposable.get(s, -1) for s in nodes), np.int64, len(nodes))

    def propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words by greedy longest match, one word behind the other, and how many each word has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        letters = self.letter[np.minimum(points, len(self.letter) - 1)]
        if (letters < 0).any():
            raise ValueError(f"no token for {chr(points[np.argmin(letters)])!r}")
        ends = np.cumsum(lengths) + np.arange(len(words))                    # where a word's end letter stands
        chars = np.full(len(points) + len(words), self.fan - 1, np.int64)
        inside = np.ones(len(chars), bool)
        inside[ends] = False
        chars[inside] = letters
        token_at = np.full(len(chars), -1, np.int64)
        end, at = ends, ends - lengths                                       # of the words under way; the token's start
        place, node, best, upto = at, np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64), at
        while len(place):
            edge = self.edge_at(node * self.fan + chars[place])
            on = edge < self.none
            node = np.where(on, edge + 1, 0)
            spelt = self.spells[node]
            longer = on & (spelt >= 0)
            best, upto = np.where(longer, spelt, best), np.where(longer, place + 1, upto)
            off = ~on
            if (best[off] < 0).any():
                raise ValueError("no token for a letter")
            token_at[at[off]] = best[off]
            at, best, place = np.where(on, at, upto), np.where(on, best, -1), np.where(on, place + 1, upto)
            if (go := at < end).sum() < len(go):
                end, at, place, node, best, upto = (v[go] for v in (end, at, place, node, best, upto))
        counts = np.diff(np.cumsum(token_at >= 0)[ends], prepend=0)
        return token_at[token_at >= 0], counts

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the rules that join tokens a and b."""
        return self.rule_ranks[self.rule_at(a << 32 | b)]

    def merge_many(self, words: list[str]) -> np.ndarray:
        """``merge`` of short words, side by side: in each step every word takes its rule of lowest rank, leftmost first.
        A row of ids for each word, -1 behind its last one."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = int(lengths.max())
        cols = np.arange(width)
        # unused places hold -1, which no rule has
        ids = np.full((len(words), width), -1, np.int64)
        ids[cols < lengths[:, None]] = [self.vocab[c] for w in words for c in w]
        ranks = np.full((len(words), width), _NEVER)
        ranks[:, :-1] = self._ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), width - 1)
        out = np.empty_like(ids)
        who = np.arange(len(words))
        while True:
            j = ranks.argmin(1)
            rank = ranks[np.arange(len(who)), j]
            ended = rank == _NEVER
            if ended.any():
                out[who[ended]] = ids[ended]
                go = ~ended
                who, ids, ranks, j, rank = who[go], ids[go], ranks[go], j[go], rank[go]
                if not len(who):
                    return out
            row, behind = np.arange(len(who)), cols[:-1] > j[:, None]
            ids[:, :-1] = np.where(behind, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            ids[:, -1], ranks[:, -1] = -1, _NEVER
            ids[row, j] = made = self.made[rank]
            ranks[row, j] = self._ranks(made, ids[row, np.minimum(j + 1, width - 1)])
            left = np.flatnonzero(j)
            ranks[left, j[left] - 1] = self._ranks(ids[left, j[left] - 1], made[left])

    def merge(self, word: str) -> list[int]:
        """The merge rules applied exactly: always the rule of lowest rank, leftmost place first."""
        ids = [self.vocab[c] for c in word]
        if len(ids) <= 32:  # short: a list of the rules at each place is enough
            rule, none = self.rule.get, (_NEVER, 0)
            found = [rule(p, none) for p in zip(ids, ids[1:])]
            while found:
                best = min(found)
                if best is none:
                    break
                i = found.index(best)
                ids[i: i + 2] = [best[1]]
                del found[i]
                if i:
                    found[i - 1] = rule((ids[i - 1], ids[i]), none)
                if i < len(found):
                    found[i] = rule((ids[i], ids[i + 1]), none)
            return ids
        after, before = [*range(1, len(ids)), -1], list(range(-1, len(ids) - 1))
        heap = [(self.rule[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rule]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] is None or j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = self.rule[pair][1], None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (p := (ids[k], ids[after[k]])) in self.rule:
                    heapq.heappush(heap, (self.rule[p][0], k, p))
        return [t for t in ids if t is not None]

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each word (pre-tokens in the vocabulary's letters)."""
        words = [w for w in words if w]
        ids, lengths = self.encode_flat(words)
        return {w: x.tolist() for w, x in zip(words, np.split(ids, np.cumsum(lengths)[:-1]))}

    def encode_flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one word behind the other, and how many each word has."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        flat, lengths = self.propose(words)
        self.n_proposed += len(words)
        ends = np.cumsum(lengths)
        inner = np.ones(max(len(flat) - 1, 0), bool)
        inner[ends[:-1] - 1] = False  # a pair over the end of a word is none
        place = np.flatnonzero(inner)
        failing = place[~self.apart(flat[place], flat[place + 1])]
        again = np.unique(np.searchsorted(ends, failing, side="right"))
        self.n_merged += len(again)
        kept = np.ones(len(words), bool)
        kept[again] = False
        rows: list[tuple[np.ndarray, np.ndarray]] = []        # words, and their ids with -1 behind them
        size = np.fromiter((len(words[w]) for w in again), np.int64, len(again))
        short = again[size <= 32][np.argsort(size[size <= 32], kind="stable")]
        for at in range(0, len(short), 2048):     # words of like length, so few places stay unused
            some = short[at: at + 2048]
            rows.append((some, self.merge_many([words[w] for w in some])))
        for w in again[size > 32]:
            rows.append((np.array([w]), np.array([self.merge(words[w])], np.int64)))
        lengths = lengths.copy()
        for some, ids in rows:
            lengths[some] = (ids >= 0).sum(1)
        starts = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), np.int64)
        old = np.repeat(kept, np.diff(ends, prepend=0))
        out[np.repeat(kept, lengths)] = flat[old]
        for some, ids in rows:
            used = ids >= 0
            out[(starts[some][:, None] + np.arange(ids.shape[1]))[used]] = ids[used]
        return out, lengths

    def learn(self, keys: list[str]) -> dict[str, bytes]:
        """Ids of new parts, as unsigned 32-bit integers."""
        split: dict[str, str | tuple] = {}      # part -> its pre-token or pre-tokens
        new: set[str] = set()
        space = self.spelling and self.spelling[32]
        for key in keys:
            if space and key.isascii() and key.isalpha():
                split[key] = word = space + key
                new.add(word)
                continue
            text = part_text(key)
            plain = self.spelling and _WORDS.fullmatch(text)
            if plain:  # pre-tokens are the word with its space, the punctuation, the line feed
                split[key] = words = tuple([w.translate(self.spelling) for w in plain.groups() if w])
                new.update(words)
                continue
            pieces: list = []
            for k, s in enumerate(self.special_rx.split(text) if self.special_rx else [text]):
                if k % 2:
                    pieces.append(np.array([self.special[s]], "<u4").tobytes())
                elif s:
                    pieces += [w for w, _ in self.pre.pre_tokenize_str(s)]
            split[key] = tuple(pieces)
            new.update(w for w in pieces if isinstance(w, str))
        known = {w: got for w in new if (got := self.words.get(w) or self.words.old.get(w)) is not None}
        unknown = [w for w in new if w and w not in known]
        ids, lengths = self.encode_flat(unknown)
        raw, upto = ids.astype("<u4").tobytes(), (4 * np.cumsum(lengths)).tolist()
        for w, a, b in zip(unknown, [0, *upto], upto):
            known[w] = got = raw[a:b]
            if len(w) <= 64:
                self.words.put(w, got)
        out = {}
        for key, pieces in split.items():
            if isinstance(pieces, str):
                out[key] = known[pieces]
            else:
                out[key] = b"".join([known[p] if isinstance(p, str) else p for p in pieces])
        return out

    def encode_many(self, texts: list[str]) -> Iterator[tuple[int, str, bytes]]:
        """For each text: number of ids, ids in decimal joined by commas, and the decoded bytes."""
        cuts = [cut(t) for t in texts]
        parts = list(chain.from_iterable(cuts))
        keys = list(set(parts))
        got = list(map(self.parts.get, keys))
        old, unknown = self.parts.old, []
        for i in [i for i, g in enumerate(got) if g is None]:
            got[i] = value = old.get(keys[i])
            if value is None:
                unknown.append(i)
            else:
                self.parts.put(keys[i], value)
        fresh = self.learn([keys[i] for i in unknown])
        for i in unknown:
            key = keys[i]
            got[i] = value = fresh[key]
            if len(key) <= 64:
                self.parts.put(key, value)
        held = np.frombuffer(b"".join(got), "<u4")
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        start = np.cumsum(size) - size
        number = dict(zip(keys, range(len(keys))))
        at = np.fromiter(map(number.__getitem__, parts), np.int64, len(parts))
        n, ends = size[at], np.cumsum([len(c) for c in cuts], dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = held[np.repeat(start[at] - upto[:-1], n) + np.arange(upto[-1])]
        lengths = np.diff(upto[ends], prepend=0)
        yield from zip(lengths.tolist(), _joined(self.decimal, ids, lengths, ",").to_pylist(),
                       _joined(self.raw, ids, lengths, b"").to_pylist())


_MODELS: dict[str, SpeculativeBPE] = {}


def model(path: str) -> SpeculativeBPE:
    if path not in _MODELS:
        _MODELS[path] = SpeculativeBPE(path)
    return _MODELS[path]


def encode_and_decode(docs: DataFrame, vocabulary: str, texts_at_once: int = 1_000_000) -> DataFrame:
    """Per row: token count, digest of the ids, digest of the text that the ids decode to.

    ``texts_at_once``: characters that are tokenized together (at least one text); it bounds memory only.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(vocabulary)

        def done(held):
            out = [[] for _ in names]
            for (doc_id, _), (n, ids, raw) in zip(held, bpe.encode_many([t for _, t in held])):
                text = raw.decode("utf-8", "replace")
                for col, v in zip(out, (doc_id, n, hashlib.sha256(ids.encode()).hexdigest(),
                                        hashlib.sha256(text.encode()).hexdigest())):
                    col.append(v)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string()))], names)

        held, size = [], 0
        for batch in batches:
            for doc_id, text in rows(batch, "doc_id", "text"):
                held.append((doc_id, text or ""))
                size += len(text or "")
                if size >= texts_at_once:
                    yield done(held)
                    held, size = [], 0
        yield done(held)

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)
