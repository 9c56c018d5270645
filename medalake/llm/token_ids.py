"""Token ids of whole texts by the tokenizers library, one library call per distinct word.

Texts of ASCII and Latin letters need no normalization but folding, and their pre-tokens are told by a plain pattern.
So their ids come straight from the library's model, once per distinct pre-token: its bytes, written in the
vocabulary's byte letters, are merged, without the pipeline around that. Whether this holds for a vocabulary is tried
at the start, letter by letter and on probe texts; where it doesn't, all texts go the way of the others:

A text is cut before white space that follows other characters. The pre-tokenizers of the two vocabularies
never join across such a place and look at nothing to its left, so the ids of the parts, one after the other,
are the ids of the text. Parts repeat, hence a bounded memo of the ids of recent parts; a miss goes to the
library. Texts with white space outside ASCII go to the library whole.

``encode_many`` takes a column of texts. Plain texts are cut in their bytes by numpy, before white space that follows
other characters and between a letter and ASCII punctuation; the parts are looked up all at once in a table of
the ids of parts, and only parts that it lacks go through ``encode``'s way, once each.
"""

from __future__ import annotations

import os
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_CHUNK = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_ODD_SPACE = re.compile("[\x85\xa0  -     　]")
_SPACE_AFTER_SPACE = tuple(w + " " for w in " \t\n\r\x0b\x0c")
# a word of Latin letters (not the signs × and ÷ among them) and the ASCII punctuation behind it: both pre-tokenizers
# cut between the two
_WORD_AND_TAIL = re.compile("( ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-/:-@\\[-`{-~]*)")


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the rest for 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_LETTER_OF = {b: c for c, b in byte_letters().items()}
_LATIN, _SPACE = "A-Za-zÀ-ÖØ-öø-įı-ſ", " \\t-\\r"
_PLAIN = re.compile(f"[\\x00-\\x7f{_LATIN}]*")
# fixed values: the pre-token patterns of the two vocabularies, as far as plain texts need them
_FOLDED = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^{_SPACE}{_LATIN}0-9]+")
_SPACED_WORD = re.compile(f" ?[{_LATIN}]+")
_SPACED = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^{_SPACE}{_LATIN}0-9]+"
                     f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


# of each byte: what it is (1 white space, 2 ASCII punctuation), 4 times what a part ends before when it follows the
# byte, and 16 if no plain text has it; the bytes of Latin letters are 0xC3 to 0xC5 and 0x80 to 0xBF
def _byte_kind(b: int) -> int:
    if b in b" \t\n\x0b\x0c\r":
        return 1
    c = chr(b)
    if b >= 128:
        return 12 if b < 0xC0 or 0xC3 <= b <= 0xC5 else 16
    return 12 if c.isalpha() else 4 + 2 * (c.isprintable() and not c.isdigit())


_KINDS = bytes(map(_byte_kind, range(256)))
_NO_LETTERS = [c.encode() for c in "×÷İ"]
_AT_ONCE = 1 << 17      # parts looked up at a time
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_PIECE = 1 << 21        # bytes of texts taken at a time, or one longer text


def cut(text: str) -> list[str]:
    """Keys of the parts of a text: ``x`` stands for a space and x, ``x `` (a space at the end) for x alone."""
    if not text:
        return []
    odd = not text.isascii() and _ODD_SPACE.search(text)
    if odd:
        return [text + " "]
    if any(w in text for w in _SPACE_AFTER_SPACE):
        return [c[1:] if c[0] == " " and c[1:2] > " " else c + " " for c in _CHUNK.findall(text)]
    parts = text.split(" ")
    if parts[0]:
        parts[0] += " "
        return parts
    return parts[1:]


def part_text(key: str) -> str:
    return key[:-1] if key.endswith(" ") else " " + key


class Memo(dict):
    """At most twice ``cap`` results of ``fn``: when the young half is full it becomes the old one."""

    def __init__(self, fn, cap: int):
        super().__init__()
        self.fn, self.cap, self.old = fn, cap, {}

    def put(self, key, value):
        if len(self) >= self.cap:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.fn(key)
        if len(key) <= 64:
            self.put(key, value)
        return value


class PartTable:
    """Ids of at most ``cap`` parts of up to 15 bytes, found for many parts at once; emptied when it is full.

    A part's key is two numbers: its bytes and, in the last place, its length. Keys lie at their hash or, if that place is
    taken, at the next free one."""

    def __init__(self, cap: int):
        self.cap = max(cap, _AT_ONCE)
        bits = (2 * self.cap - 1).bit_length()
        self.keys, self.word = np.zeros((2, 1 << bits), np.uint64), np.zeros(1 << bits, np.int32)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.first, self.ids = np.zeros(self.cap + 2, np.int64), np.zeros(4 * self.cap, "<u4")
        self.n = 0

    def find(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys and their numbers; 0 for a key that is not there, with a free place for it."""
        h = lo * np.uint64(0x9E3779B97F4A7C15)
        h ^= hi * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        at = (h >> self.shift).view(np.int64)
        word = self.word.take(at)
        todo = np.flatnonzero((word > 0) & ((self.keys[0].take(at) != lo) | (self.keys[1].take(at) != hi)))
        while len(todo):
            place = (at.take(todo) + 1) & self.mask
            found = self.word.take(place)
            at[todo], word[todo] = place, found
            todo = todo[(found > 0) & ((self.keys[0].take(place) != lo.take(todo)) | (self.keys[1].take(place) != hi.take(todo)))]
        return at, word

    def add(self, lo: np.ndarray, hi: np.ndarray, ids: list[list[int]]):
        """Distinct keys that are not there, as many as there is room for, and their ids."""
        at, _ = self.find(lo, hi)
        number = np.arange(self.n + 1, self.n + 1 + len(lo), dtype=np.int32)
        todo = np.arange(len(lo))
        while len(todo):
            free = todo[self.word.take(at.take(todo)) == 0]
            self.word[at.take(free)] = number.take(free)         # of several keys for one place, one gets it
            got = free[self.word.take(at.take(free)) == number.take(free)]
            self.keys[0, at.take(got)], self.keys[1, at.take(got)] = lo.take(got), hi.take(got)
            todo = todo[self.word.take(at.take(todo)) != number.take(todo)]
            at[todo] = (at.take(todo) + 1) & self.mask
        ends = self.first[self.n + 1] + np.cumsum(list(map(len, ids)))
        if ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(int(ends[-1]), "<u4")])
        self.ids[self.first[self.n + 1]: ends[-1]] = list(chain.from_iterable(ids))
        self.n += len(lo)
        self.first[self.n + 1 - len(lo) + 1: self.n + 2] = ends

    def clear(self):
        self.word[:] = 0
        self.n = 0


class TextEncoder:
    """``encode(text)``: the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cap: int = 250_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        # a vocabulary that folds letter case and drops white space shares the ids of a word's spellings
        plain = self.tok.encode("ab", add_special_tokens=False).ids
        self.fold = self.tok.encode("\n AB ", add_special_tokens=False).ids == plain
        self.parts = Memo(self._part, cap)
        self.words = Memo(self._library, cap)
        self.model = self.tok.model
        self.tokens = Memo(self._merged, cap)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.pattern = _FOLDED if self.fold else _SPACED
        if any(self._plain(t) != self._library(t) for t in self._probes()):
            self.pattern = None
        self.cap, self.table = cap, None
        self.long = Memo(self._plain, cap)

    def _probes(self) -> list[str]:
        letters = [c for c in map(chr, range(0x41, 0x250)) if _PLAIN.fullmatch(c)]
        some = ["".join(letters[i::7]) for i in range(7)] + ["The naïveté's, straße 12x3 it'll  'S\n\n ok?! _a_ \t#", " a  b \r\n c"]
        return [*map(chr, range(128)), *letters, *(" " + c for c in letters), *some]

    def _ids(self, pretoken: str) -> list[int]:
        if pretoken.isascii() and pretoken.isprintable():        # all but the space stand for themselves
            letters = pretoken.replace(" ", _LETTER_OF[32])
        else:
            letters = pretoken.encode().decode("latin-1").translate(_LETTER_OF)
        return [t.id for t in self.model.tokenize(letters)]

    def _merged(self, pretoken: str) -> bytes:
        ids = self._ids(pretoken)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part_ids(self, part: str) -> list[int]:
        if _SPACED_WORD.fullmatch(part) and not self.fold:          # one pre-token, kept by the table of parts
            return self._ids(part)
        return memoryview(self._plain(part)).cast("I").tolist()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.tokens.__getitem__, self.pattern.findall(text.lower() if self.fold else text)))

    def _library(self, chunk: str) -> bytes:
        ids = self.tok.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: str) -> bytes:
        if self.fold:
            chunk = chunk.strip(" \t\n\r\x0b\x0c")
        m = _WORD_AND_TAIL.fullmatch(chunk)
        if not m:
            return self.words[chunk]
        word, tail = m.groups()
        if self.fold:
            word = word.lower()
        return self.words[word] + (self.words[tail] if tail else b"")

    def _part(self, key: str) -> bytes:
        text = part_text(key)
        if _ODD_SPACE.search(text):
            return self._library(text)
        return b"".join(map(self._chunk, _CHUNK.findall(text)))

    def encode(self, text: str | None) -> bytes:
        if text and self.pattern and (text.isascii() or _PLAIN.fullmatch(text)) and not any(a in text for a in self.added):
            return self._plain(text)
        return b"".join(map(self.parts.__getitem__, cut(text or "")))

    def encode_many(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string column; of none, for a null."""
        if not self.pattern:
            return [np.frombuffer(self.encode(t), "<u4") for t in texts.to_pylist()]
        if self.table is None:
            self.table = PartTable(4 * self.cap)
        out, texts = [], texts.cast(pa.large_binary())
        sizes = np.cumsum(np.array(pc.binary_length(texts).fill_null(0), np.int64))
        at = 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _PIECE, side="right")))
            out += self._piece(texts.slice(at, upto - at))
            at = upto
        return out

    def _piece(self, texts: pa.Array) -> list[np.ndarray]:
        lengths = np.array(pc.binary_length(texts).fill_null(0), np.int64)
        ends = np.cumsum(lengths)
        begins = ends - lengths
        data = b"".join(t for t in texts.to_pylist() if t)
        kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
        # texts that go the other way
        others = set(np.searchsorted(ends, np.flatnonzero(kinds & 16), side="right").tolist())
        for sign in _NO_LETTERS + [a.encode() for a in self.added]:
            at = data.find(sign)
            while at >= 0:
                text = int(np.searchsorted(ends, at, side="right"))
                others.add(text)
                at = data.find(sign, int(ends[text]))
        new = np.zeros(len(data) + 1, bool)
        new[1:len(data)] = (kinds[1:] & (kinds[:-1] >> 2) & 3) > 0
        new[begins] = True
        new[-1] = False
        starts = np.flatnonzero(new)
        n_ids, ids = self._parts_ids(data, starts)
        # ids before each text
        upto = np.concatenate([[0], np.cumsum(n_ids)])
        upto = upto.take(np.searchsorted(starts, np.append(begins, len(data))))
        return [np.frombuffer(self.encode(data[begins[i]: ends[i]].decode()), "<u4") if i in others else ids[upto[i]: upto[i + 1]]
                for i in range(len(lengths))]

    def _parts_ids(self, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each part has, and the ids of all; the parts begin at ``starts`` and fill ``data``."""
        words = np.frombuffer(data + bytes(24 + -len(data) % 8), "<u8")
        ends = np.append(starts[1:], len(data))
        counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
        for i in range(0, len(starts), _AT_ONCE):
            n, found = self._look_up(data, words, starts[i: i + _AT_ONCE], ends[i: i + _AT_ONCE])
            counts.append(n)
            ids.append(found)
        return np.concatenate(counts), np.concatenate(ids)

    def _look_up(self, data: bytes, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size, table = end - start, self.table
        # the 16 bytes from each start on, then no more than the part has
        place, shift = start >> 3, ((start & 7) << 3).view(np.uint64)
        back = np.uint64(63) - shift
        a, b, c = words.take(place), words.take(place + 1), words.take(place + 2)
        lo = (a >> shift) | (b << np.uint64(1) << back)
        hi = (b >> shift) | (c << np.uint64(1) << back)
        lo &= _MASKS.take(size, mode="clip")
        hi &= _MASKS.take(size - 8, mode="clip")
        hi |= size.view(np.uint64) << np.uint64(56)
        is_long = size > 15
        lo[is_long], hi[is_long] = 0, 0                     # the key of no part at all
        at, word = table.find(lo, hi)
        lacking = np.flatnonzero((word == 0) & ~is_long)
        if len(lacking):
            new = {key: i for key, i in zip(zip(lo.take(lacking).tolist(), hi.take(lacking).tolist()), lacking.tolist())}
            if table.n + len(new) > table.cap:
                table.clear()
                return self._look_up(data, words, start, end)
            one = np.fromiter(new.values(), np.int64, len(new))
            parts = zip(start.take(one).tolist(), end.take(one).tolist())
            table.add(lo.take(one), hi.take(one), [self._part_ids(data[s:e].decode()) for s, e in parts])
            word[lacking] = table.find(lo.take(lacking), hi.take(lacking))[1]
        first = table.first.take(word)
        n = table.first.take(word + 1) - first
        longs = np.flatnonzero(is_long).tolist()
        long_ids = [np.frombuffer(self.long[data[start[i]: end[i]].decode()], "<u4") for i in longs]
        n[longs] = [len(x) for x in long_ids]
        upto = np.cumsum(n)
        before = upto - n
        ids = table.ids.take(np.repeat(first - before, n) + np.arange(upto[-1]), mode="clip")
        for i, x in zip(longs, long_ids):
            ids[before[i]: upto[i]] = x
        return n, ids


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The Python worker's encoder of a vocabulary file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
