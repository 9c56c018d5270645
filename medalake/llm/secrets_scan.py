"""Secret scan with a recursive decoding worklist.

The text is the first layer. Every layer is scanned for secrets and for encoded runs: URL escapes, Unicode escapes
and character references, base64, and compressed data (gzip, zlib, bzip2, xz, zstd) behind base64. Each run that
decodes is put back into the text around it, as far as a secret could reach (two more runs of non-space on each
side), so a plain key with an encoded value, or the other way round, is found. That makes a new layer, and so on
until no new layer appears; a layer whose content was seen before is not taken up again, so a text that decodes to
itself ends. Every character of a layer knows the span of the
original text that it comes from (for compressed data the whole run), so a secret found at any depth is reported
as a span of the original text, in code points, end exclusive.

Spans found in the text itself are the base spans; they always stay, and deeper ones are added.

Compressed data is read as a stream, all members that follow each other, and held ``max_layer`` bytes at a time: what
is longer is scanned in chunks that share half with the next and counted in ``n_oversize``. A compressed run that can't
be read to its end (cut off, damaged), or where one encoded run may be longer than what two chunks share, is a span of
its own kind, ``unread``, and redacted whole.

Defined results: null text scans as the empty text; null or repeated doc_id rows each keep a row; an empty table
gives an empty result; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalake.llm.common import pick, positional, rows

KINDS = ("assign", "access", "hex")
SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "n_layers long, n_oversize long")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more; shorter runs never count

_TOKEN, _TOKENS = re.compile(r"\S*"), re.compile(r"\S*(?:\x20+\S+){0,2}")
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})"
                      r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)*+"
                     r"|[A-Za-z0-9+/_-]{4,}+(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]{4,}+)++"
                     r"(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)?+)={0,2}", re.ASCII)  # also wrapped over lines
_IN_BASE64 = np.isin(np.arange(256), np.frombuffer(b"+-/_" + bytes(range(48, 58)) + bytes(range(65, 91))
                                                   + bytes(range(97, 123)), np.uint8))
_STANDARD = bytes.maketrans(b"-_", b"+/")
_SEPARATOR = re.compile(rb"[+/]")
_MEMBERS = {"gzip": re.compile(rb"\x1f\x8b\x08[\x00-\x1f]", re.DOTALL),
            "bzip2": re.compile(rb"BZh[1-9](?:1AY&SY|\x17rE8P\x90)"), "xz": re.compile(rb"\xfd7zXZ\x00"),
            "zstd": re.compile(rb"\x28\xb5\x2f\xfd")}
_SKIPPABLE = re.compile(rb"[\x50-\x5f]\x2a\x4d\x18....", re.DOTALL)
# bytes that no encoded run and no secret goes across, or more words than a secret has
_BREAK = re.compile(rb"""[^A-Za-z0-9+/_=.%\\{}&#;:"'\s-]|(?:[\x20\t]+[A-Za-z0-9,.]+){8}""")
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd", re.DOTALL)
_UNPRINTABLE = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\x9f\ud800-\udfff\ufffd]")


def scan(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the secrets that stand in ``text`` itself."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return found


class _Packed:
    """The compressed members (or streams, or frames) that follow each other in ``data`` from ``at`` on.

    ``end`` is how far they reach, ``sure`` whether ``data`` is compressed beyond doubt, ``whole`` whether all was read.
    """

    def __init__(self, data: bytes, at: int):
        self.data, self.end, self.sure, self.whole = data, at, False, False

    def _next(self) -> str | None:
        """The format of the member at ``end``; zero bytes and skippable frames between members are passed over."""
        at, data = self.end, self.data
        while self.whole and data[at: at + 1] == b"\0":
            at += 1
        while _SKIPPABLE.match(data, at):
            at += 8 + int.from_bytes(data[at + 4: at + 8], "little")
        for kind, magic in _MEMBERS.items():
            if magic.match(data, at):
                self.end, self.sure = at, True
                return kind
        if at + 1 < len(data) and data[at] & 0x8F == 8 and not data[at + 1] & 0x20 and (data[at] << 8 | data[at + 1]) % 31 == 0:
            self.end = at
            return "zlib"
        return None

    def pieces(self, size: int) -> Iterator[bytes]:
        """What the members hold, at most about ``size`` bytes at a time."""
        while kind := self._next():
            self.whole = False
            try:
                yield from self._member(kind, size)
            except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, ImportError):
                return
            except Exception as e:  # zstandard's own error type
                if type(e).__name__ == "ZstdError":
                    return
                raise
            if not self.whole:
                return

    def _member(self, kind: str, size: int) -> Iterator[bytes]:
        block = 1 << 16
        if kind in ("gzip", "zlib"):
            d = zlib.decompressobj(47)
        elif kind == "bzip2":
            d = bz2.BZ2Decompressor()
        elif kind == "xz":
            d = lzma.LZMADecompressor()
        else:
            import zstandard

            d, block = zstandard.ZstdDecompressor().decompressobj(), 256  # it takes no bound on what a block becomes
        at, rest, full = self.end, b"", False
        while not d.eof:
            if not rest and not full:
                rest = self.data[at: at + block]
                at += len(rest)
                if not rest:
                    return  # cut off
            if kind == "zstd":
                out, rest = d.decompress(rest), b""
            else:
                out = d.decompress(rest, size)
                rest = d.unconsumed_tail if kind in ("gzip", "zlib") else b""
                full = len(out) == size if kind in ("gzip", "zlib") else not d.needs_input
            if out:
                yield out
        self.end, self.whole = at - len(d.unused_data), True


def _chunks(packed: _Packed, limit: int) -> Iterator[tuple[bytes, bool, bool]]:
    """The content in chunks of ``limit`` bytes, each sharing half with the one before; whether it is the last, and
    whether something longer than what is shared may lie across its end."""
    held = bytearray()
    for piece in packed.pieces(min(limit, 1 << 20)):
        held += piece
        while len(held) > limit:
            chunk = bytes(held[:limit])
            yield chunk, False, not _BREAK.search(chunk, limit - limit // 2)
            del held[: limit - limit // 2]
    yield bytes(held), True, False


class _Layer:
    """A text and, for each of its characters, the span of the original text it comes from.

    All characters of ``packed`` [i, j) come from the one span [lo, hi); ``starts`` and ``ends`` are those of the others.
    Base64 runs are taken up in a layer only where they touch ``core`` (None: everywhere).
    """

    def __init__(self, text: str, starts: np.ndarray | None, ends: np.ndarray | None,
                 packed: tuple[int, int, int, int] | None = None, core: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.packed, self.core = text, starts, ends, packed, core

    def _origin(self, places: np.ndarray, values: np.ndarray, side: int) -> np.ndarray:
        if self.packed is None:
            return values[places]
        i, j = self.packed[:2]
        out = np.full(len(places), self.packed[2 + side], np.int64)
        plain = (places < i) | (places >= j)
        at = places[plain]
        out[plain] = values[np.where(at < i, at, at - (j - i))]
        return out

    def origins(self, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Spans [starts, ends) of this layer as spans of the original text."""
        starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
        if self.starts is None:
            return starts, ends
        return self._origin(starts, self.starts, 0), self._origin(ends - 1, self.ends, 1)

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        if self.packed is None:
            return int(self.starts[start:end].min()), int(self.ends[start:end].max())
        i, j, lo, hi = self.packed
        n = j - i
        parts = [(self.starts[x:y], self.ends[x:y]) for x, y in ((min(start, i), min(end, i)),
                                                                 (max(start, j) - n, max(end, j) - n)) if x < y]
        los, his = [int(x.min()) for x, _ in parts], [int(y.max()) for _, y in parts]
        if start < j and end > i:
            los, his = [*los, lo], [*his, hi]
        return min(los), max(his)


def _char_bytes(text: str) -> np.ndarray:
    """For each character, the index of its first UTF-8 byte, and at the end the number of bytes."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    size[(points >= 0xDC80) & (points <= 0xDCFF)] = 1  # a byte that is no UTF-8
    return np.concatenate([[0], np.cumsum(size)])


_Piece = tuple[int, int, str, np.ndarray, np.ndarray]


def _replaced(layer: _Layer, lo: int, hi: int, pieces: list[_Piece], core: tuple[int, int] | None = None) -> _Layer:
    """Characters lo..hi with pieces (start, end, replacement, starts and ends of its characters) put in."""
    text, starts, ends, at = [], [], [], lo
    nothing = np.zeros(0, np.int64)
    for a, b, new, new_starts, new_ends in [*pieces, (hi, hi, "", nothing, nothing)]:
        text += [layer.text[at:a], new]
        starts += [np.arange(at, a), new_starts]
        ends += [np.arange(at + 1, a + 1), new_ends]
        at = b
    return _Layer("".join(text), *layer.origins(np.concatenate(starts), np.concatenate(ends)), core=core)


def _left(text: str, lo: int) -> int:
    """``lo`` less the non-space characters before it and the two runs of non-space that only spaces part from them:
    the assign pattern has three such runs at most (key, sign, value)."""
    for last in (False, False, True):
        while lo and not text[lo - 1].isspace():
            lo -= 1
        at = lo
        while at and text[at - 1] == " ":
            at -= 1
        if last or at == lo or not at or text[at - 1].isspace():
            return lo
        lo = at
    return lo


def _right(text: str, hi: int) -> tuple[int, int]:
    """The end of the non-space characters after ``hi``, and of the two runs of non-space that follow."""
    return _TOKEN.match(text, hi).end(), _TOKENS.match(text, hi).end()


def _windows(layer: _Layer, pieces: list[_Piece]) -> Iterator[_Layer]:
    """All pieces put back into the text around them, as one layer where their surroundings meet."""
    text, group, lo, token, hi = layer.text, [], 0, -1, -1
    for piece in pieces:
        a, b = piece[:2]
        if group and a >= hi:
            left = _left(text, a)
            if left >= hi:
                yield _replaced(layer, lo, hi, group)
                group, lo = [], left
        elif not group:
            lo = _left(text, a)
        if b > token:
            token, hi = _right(text, b)
        group.append(piece)
    if group:
        yield _replaced(layer, lo, hi, group)


def _touches(layer: _Layer, m: re.Match) -> bool:
    return layer.core is None or m.start() < layer.core[1] and m.end() > layer.core[0]


def _text(data: bytes) -> str:
    """Bytes as UTF-8; each byte that is none stands as one lone surrogate, so that the places stay known."""
    return data.decode("utf-8", "surrogateescape")


def _url_layers(layer: _Layer) -> Iterator[_Layer]:
    pieces = []
    for m in _URL.finditer(layer.text):
        new = _text(bytes.fromhex(m[0].replace("%", "")))
        edge = 3 * _char_bytes(new) + m.start()  # three characters stand for a byte
        pieces.append((m.start(), m.end(), new, edge[:-1], edge[1:]))
    yield from _windows(layer, pieces)


def _unicode_layers(layer: _Layer) -> Iterator[_Layer]:
    pieces = []
    for m in _UNICODE.finditer(layer.text):
        code = int(next(g for g in m.groups()[:4] if g), 16) if m.lastindex != 5 else int(m[5])
        if code > 0x10FFFF or 0xD800 <= code < 0xE000:
            continue
        pieces.append((m.start(), m.end(), chr(code), np.array([m.start()]), np.array([m.end()])))
    yield from _windows(layer, pieces)


def _unpacked(layer: _Layer, lo: int, hi: int, text: str, first: bool, last: bool) -> _Layer:
    """``text``, which all comes from characters lo..hi, with the text around these where it stands first or last."""
    a, b = _left(layer.text, lo) if first else lo, _right(layer.text, hi)[1] if last else hi
    starts, ends = layer.origins(np.r_[a:lo, hi:b], np.r_[a:lo, hi:b] + 1)
    core = (lo - a, lo - a + len(text)) if _UNPRINTABLE.search(text) else None
    return _Layer(layer.text[a:lo] + text + layer.text[hi:b], starts, ends,
                  (lo - a, lo - a + len(text), *layer.span(lo, hi)), core)


def _packed_layers(layer: _Layer, lo: int, hi: int, packed: _Packed, limit: int, oversize: list,
                   unread: set) -> Iterator[_Layer]:
    first, torn, clean = True, False, 0
    for chunk, last, across in _chunks(packed, limit):
        if first and not last:
            oversize.append(lo)
        torn |= across
        text = _text(chunk)
        if text:
            if first:
                clean = 0 if _UNPRINTABLE.search(text) else len(text)
            yield _unpacked(layer, lo, hi, text, first, last)
        first = False
    # a zlib header is only two bytes, which other data may hold too
    packed.sure |= packed.whole or clean >= 32
    if packed.sure and (torn or not packed.whole):
        unread.add(layer.span(lo, hi))


def _base64_layers(layer: _Layer, limit: int, oversize: list, unread: set) -> Iterator[_Layer]:
    """Each run at all four alignments, as it may start with other characters of the alphabet."""
    for run in _BASE64.finditer(layer.text):
        if not _touches(layer, run):
            continue
        raw = np.frombuffer(run[0].encode(), np.uint8)
        place = np.flatnonzero(_IN_BASE64[raw])  # without line breaks and padding
        chars = raw[place].tobytes().translate(_STANDARD)
        place += run.start()
        if len(chars) < 16:
            continue
        behind = {0, 1, 2, 3, *(m.end() for m in _SEPARATOR.finditer(chars)), *(np.flatnonzero(np.diff(place) > 1) + 1).tolist()}
        a, b = _left(layer.text, run.start()), _right(layer.text, run.end())[1]
        for skip in range(4):
            size = len(chars) - skip
            size -= size % 4 == 1
            data = base64.b64decode(chars[skip: skip + size] + b"=" * (-size % 4))
            done = 0
            for at in _packed_at(data, [(x - skip) // 4 * 3 for x in behind if x >= skip and (x - skip) % 4 == 0]):
                if at >= done:
                    packed = _Packed(data, at)
                    lo = int(place[skip + at * 4 // 3])
                    yield from _packed_layers(layer, lo, run.end(), packed, limit, oversize, unread)
                    if packed.sure:
                        done = max(packed.end, at + 1)
            text = _text(data)
            edge = _char_bytes(text)  # byte i stands in characters 4i/3 to 4(i+1)/3
            starts, ends = place[skip + edge[:-1] * 4 // 3], place[skip + (-(-edge[1:] * 4 // 3)) - 1] + 1
            lo, hi = int(place[skip]), run.end()
            core = (lo - a, lo - a + len(text)) if _UNPRINTABLE.search(text) else None
            yield _replaced(layer, a, b, [(lo, hi, text, starts, ends)], core)


def _packed_at(data: bytes, behind: list[int]) -> list[int]:
    """Where compressed data may start: at a magic number, or at any zlib header that stands behind a separator."""
    found = {m.start() for m in _MAGIC.finditer(data)}
    found.update(i for i in behind if i + 1 < len(data) and data[i] & 0x8F == 8
                 and not data[i + 1] & 0x20 and (data[i] << 8 | data[i + 1]) % 31 == 0)
    return sorted(found)


def scan_layers(text: str, max_layer: int = 1 << 26) -> tuple[list, list, int, int]:
    """Base spans, all spans (sorted (start, kind, end)), number of layers, and of compressed runs scanned in chunks."""
    base = scan(text)
    spans, oversize, unread, n_layers = set(base), [], set(), 1

    def nested(layer: _Layer) -> Iterator[_Layer]:
        if "%" in layer.text:
            yield from _url_layers(layer)
        if "\\" in layer.text or "&#" in layer.text:
            yield from _unicode_layers(layer)
        yield from _base64_layers(layer, max_layer, oversize, unread)

    top = _Layer(text, None, None)
    todo, seen = [(top, nested(top))], set()
    while todo:  # one layer at each depth is held at a time
        layer, inner = todo[-1]
        new = next(inner, None)
        if new is None:
            todo.pop()
            continue
        # the same content at another place is another layer unless it lies on the way here
        if not new.text or new.text == layer.text:
            continue
        content = hashlib.blake2b(new.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        key = (content, *new.span(0, len(new.text)))
        if key not in seen:
            seen.add(key)
            n_layers += 1
            for start, kind, end in scan(new.text):
                lo, hi = new.span(start, end)
                spans.add((lo, kind, hi))
            todo.append((new, nested(new)))
    spans.update((lo, "unread", hi) for lo, hi in unread)
    order = {k: i for i, k in enumerate((*KINDS, "unread"))}
    by = lambda s: (s[0], order[s[1]], s[2])
    return sorted(base, key=by), sorted(spans, key=by), n_layers, len(oversize)


def _listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def find_secrets(docs: DataFrame, max_layer: int = 1 << 26) -> DataFrame:
    """Per row: counts of base spans by kind, their digest, and the list of all spans."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_oversize"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [[] for _ in names]
            for doc_id, text in rows(batch, "doc_id", "text"):
                base, spans, layers, over = scan_layers(text or "", max_layer)
                count = [sum(kind == k for _, kind, _ in base) for k in KINDS]
                for col, v in zip(cols, (doc_id, *count, hashlib.sha256(_listed(base).encode()).hexdigest(),
                                         _listed(spans), layers, over)):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def redacted(text: str, spans: list[tuple[int, str, int]], mark: str = "[SECRET]") -> str:
    """``text`` with every span, overlapping ones as one, replaced by ``mark``."""
    out, at, until = [], 0, -1
    for start, _, end in spans:
        if start >= until:
            if until >= 0:
                out.append(mark)
                at = until
            out.append(text[at:start])
        until = max(until, end)
    if until >= 0:
        out.append(mark)
        at = until
    return "".join(out) + text[at:]


def redact(docs: DataFrame, max_layer: int = 1 << 26) -> DataFrame:
    """``docs`` with all secrets, encoded ones included, replaced in ``text``; ``n_chars`` follows where it exists."""
    renamed, at = positional(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(at["text"])
            texts = [None if t is None else redacted(t, scan_layers(t, max_layer)[1])
                     for (t,) in rows(batch, at["text"])]
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))

    out = renamed.mapInArrow(run, renamed.schema)
    if "n_chars" in at:
        kind = docs.schema[docs.columns.index("n_chars")].dataType
        out = out.withColumn(at["n_chars"], F.coalesce(F.length(at["text"]).cast(kind), F.col(at["n_chars"])))
    return out.toDF(*docs.columns)
