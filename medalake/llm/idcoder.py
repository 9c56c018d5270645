"""Token-id files: an adaptive context-mixing range coder over independently reset, checksummed blocks.

A file part holds segments; a segment holds whole documents, an index of them, and blocks of at most ``BLOCK``
ids. Every block starts from the same empty model and carries a CRC-32 of its ids, so any block can be decoded
and checked alone. The blocks of a segment are coded side by side: numpy runs the same step for all of them.

The model predicts an id from three contexts and mixes them:

* order 2: the id that last followed the same two ids in this block;
* order 1: the id that last followed the same id;
* order 0: adaptive counts of id classes in this block (the first 512 ids are classes of their own, later
  classes span 8 or 1,024 ids with even odds inside).

An id is coded as "order 2 was right", "order 1 was right" or "neither" with weights that each block learns for
every state (which predictions exist and agree, and what held for the two ids before), then by order 0 if
neither was right. Decoder and encoder share the model code, which uses whole numbers only. The encoder knows all ids,
so it looks up and classifies a number of steps at once; only what learns, and the range coder, go step by step.

Files are written in format 2, the coder ``_Carrying``; those of format 1, the coder ``_Range``, are read as well. Model, blocks
and checksums are the same.

Files are written by Spark as Parquet rows of (part, segment, n_docs, n_ids, index, blocks): committed at once,
readable from any store that Spark reads, and split between tasks by segment.

Defined results: null text is a document of the end id alone; null doc_id sorts first; repeated doc_id rows are
ordered by a hash and the length of their text and each keep a row; an empty table gives an empty file set;
other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medalake.llm.common import pick, rows
from medalake.llm.token_ids import encoder

BLOCK = 2048           # symbols in a block
LANES = 2048           # blocks coded side by side, and at most so many in a segment
AT_ONCE = 32           # steps that the encoder prepares at a time
SLOTS = 12             # bits of the context tables of a block
MAGIC, MAGIC2 = b"TIDC\x01", b"TIDC\x02"
FILE_SCHEMA = "part int, segment int, n_docs long, n_ids long, index binary, blocks binary"
DOC_SCHEMA = "part int, segment int, doc_id long, local_start long, n_tokens long, ids_crc32 long"

_TOP, _LOW48 = np.uint64(1 << 32), np.uint64((1 << 48) - 1)
_U16, _U32, _U48 = np.uint64(16), np.uint64(32), np.uint64(48)
_LOW32, _U64_16, _ONE, _FIELD = np.uint64((1 << 32) - 1), np.uint64(1 << 16), np.uint64(1), np.uint64(0xFFFF)
_REBUILD = frozenset([16, 32, 64, 128, 256, 384, 512, 768, 1024, 1280, 1536, 1792])
#: Symbols are 16 bits. Classes of order 0: (first symbol, symbols in a class, first class).
_BANDS = ((0, 1, 0), (512, 8, 512), (4096, 1024, 960), (65536, 1, 1020))
_N_CLASSES = 1020


def _class_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each symbol, and first symbol and width of each class."""
    of = np.empty(65536, np.int64)
    first, width = np.empty(_N_CLASSES, np.int64), np.empty(_N_CLASSES, np.int64)
    for (lo, step, at), (hi, _, upto) in zip(_BANDS, _BANDS[1:]):
        of[lo:hi] = at + (np.arange(lo, hi) - lo) // step
        first[at:upto] = lo + step * np.arange(upto - at)
        width[at:upto] = step
    return of, first, width


_CLASS, _FIRST, _WIDTH = _class_tables()


class _Range:
    """Range coder state of all lanes: 48-bit low, carry-less, 16-bit words out or in. Decoding keeps the code less the low."""

    WORD, JOINT = np.uint16, False      # JOINT: a class and the place in it are one step

    def __init__(self, lanes: int, words: np.ndarray | None, room: int):
        self.low = np.zeros(lanes, np.uint64)
        self.rng = np.full(lanes, _LOW48, np.uint64)
        self.decoding = words is not None
        self.words = words if self.decoding else np.zeros((lanes, room), np.uint16)
        self.flat, self.room = self.words.ravel(), self.words.shape[1]
        self.pos = np.arange(lanes, dtype=np.int64) * self.room
        self.code = np.zeros(lanes, np.uint64)
        if self.decoding:
            for _ in range(3):
                self.code = (self.code << _U16) | self.flat[self.pos]
                self.pos += 1

    def make_room(self, more: int):
        pass

    def narrow(self, active: int, skip: np.ndarray, keep: np.ndarray):
        """The first ``active`` lanes: leave out ``skip``, keep ``keep``. All lanes take the step that puts a word out or
        in, by no bits if they have none; the few that may have another one are looked at again. Both arrays are used up."""
        low, code = self.low[:active], self.code[:active]
        low += skip
        if self.decoding:
            code -= skip
        near = np.add(low, keep, out=skip)
        near ^= low
        out = near < _TOP
        small = keep < _U64_16
        if small.any():
            cut = (small > out).nonzero()[0]
            keep[cut] = (~low.take(cut) + _ONE) & _FIELD
            out |= small
        shift = np.multiply(out, _U16, out=near)
        if self.decoding:
            pos = self.pos[:active]
            # a lane of a broken block may run past the words
            word = self.flat.take(pos, mode="clip")
            word *= out
            code <<= shift
            code |= word
            pos += out
        else:
            self._put(out.nonzero()[0])
        low <<= shift
        low &= _LOW48
        keep <<= shift
        self.rng[:active] = keep
        lane = (keep < _TOP).nonzero()[0]
        while len(lane):
            a, b = low.take(lane), keep.take(lane)
            near = ((a + b) ^ a) < _TOP
            todo = (near | (b < _U64_16)).nonzero()[0]
            if not len(todo):
                return
            lane, a, b = lane.take(todo), a.take(todo), b.take(todo)
            b = np.where(near.take(todo), b, (~a + _ONE) & _FIELD)
            if self.decoding:
                pos = self.pos.take(lane)
                self.code[lane] = (self.code.take(lane) << _U16) | self.flat.take(pos, mode="clip")
                self.pos[lane] = pos + 1
            else:
                self._put(lane)
            low[lane], keep[lane] = (a << _U16) & _LOW48, b << _U16
            self.rng[lane] = keep.take(lane)

    def _put(self, lane: np.ndarray):
        pos = self.pos.take(lane)
        self.flat[pos] = self.low.take(lane) >> _U32
        pos += 1
        self.pos[lane] = pos

    def flush(self):
        for shift in (32, 16, 0):
            self.flat[self.pos] = (self.low >> np.uint64(shift)).astype(np.uint16)
            self.pos += 1
        return self.pos - np.arange(len(self.low)) * self.room


class _Carrying(_Range):
    """Format 2: 64 bits and 32-bit words. The low end carries into words already out, which ``flush`` settles. So a lane puts
    a word out or in when its range is below 32 bits, at most one in a step even if that leaves 2 ** 6 parts of 2 ** 32,
    nothing is cut off the range, and decoding doesn't follow the low end."""

    WORD, JOINT = np.uint32, True

    def __init__(self, lanes: int, words: np.ndarray | None, room: int):
        self.low, self.rng = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
        self.decoding = words is not None
        # 32 bits and a carry; rarely is there more than a word for two steps
        self.words = words if self.decoding else np.zeros((lanes, room // 6 + 8), np.uint64)
        self.flat, self.room = self.words.ravel(), self.words.shape[1]
        self.pos = np.arange(lanes, dtype=np.int64) * self.room
        if self.decoding:
            self.code = (self.words[:, 0].astype(np.uint64) << _U32) | self.words[:, 1]
            self.pos += 2

    def make_room(self, more: int):
        """For as many more words in every lane."""
        lanes = np.arange(len(self.pos))
        if int((self.pos - lanes * self.room).max()) + more > self.room:
            words = np.zeros((len(lanes), 2 * self.room + more), np.uint64)
            words[:, : self.room] = self.words
            self.pos += lanes * (words.shape[1] - self.room)
            self.words, self.flat, self.room = words, words.ravel(), words.shape[1]

    def narrow(self, active: int, skip: np.ndarray, keep: np.ndarray):
        state = (self.code if self.decoding else self.low)[:active]
        if self.decoding:
            state -= skip
        else:
            state += skip
            over = (state < skip).nonzero()[0]
            if len(over):
                self.flat[self.pos.take(over) - 1] += _ONE
        lane = (keep < _TOP).nonzero()[0]
        if len(lane):
            pos, a, b = self.pos.take(lane), state.take(lane), keep.take(lane)
            if self.decoding:
                a <<= _U32
                # a lane of a broken block may run past the words
                a |= self.flat.take(pos, mode="clip")
            else:
                self.flat[pos] = a >> _U32
                a <<= _U32
            b <<= _U32
            pos += 1
            state[lane], keep[lane], self.pos[lane] = a, b, pos
        self.rng[:active] = keep

    def flush(self):
        for word in (self.low >> _U32, self.low & _LOW32):
            self.flat[self.pos] = word
            self.pos += 1
        used = self.pos - np.arange(len(self.low)) * self.room
        self.words = self.words[:, : int(used.max())].copy()
        flat = self.words.ravel()
        at = (flat > _LOW32).nonzero()[0]
        while len(at):
            flat[at] &= _LOW32
            at -= 1
            flat[at] += _ONE
            at = at[flat.take(at) > _LOW32]
        return used


def _below(rows: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The last of the 32 ascending values in each row that is at most v."""
    return np.bitwise_count(np.packbits(rows <= v[:, None], axis=None).view(np.uint32)).astype(np.int64) - 1


# The weights of the three outcomes are 16 bits each of one number; times _SUMS, its upper three places are the sums of
# the first, the first two and all of them. They are kept for 9 states of what held before x 5 cases of which predictions
# exist.
def _packed(w0: int, w1: int, w2: int) -> int:
    return w0 | w1 << 16 | w2 << 32


_WEIGHTS = np.tile(np.array([_packed(*w) for w in ((0, 0, 1), (8, 0, 8), (0, 8, 8), (8, 4, 8), (24, 0, 8))], np.uint64), 9)
_LEARN = np.array([_packed(24, 0, 0), _packed(0, 24, 0), _packed(0, 0, 24)], np.uint64)
_SUMS, _HEAVY = np.uint64(1 << 16 | 1 << 32 | 1 << 48), np.uint64(2001 << 48)
_FOURS = np.uint64(1 | 1 << 16 | 1 << 32 | 1 << 48)
_ROUND, _HALVED = np.uint64(_packed(1, 1, 1)), np.uint64(_packed(0x7FFF, 0x7FFF, 0x7FFF))
_SHIFT, _LAST = np.log2(_WIDTH).astype(np.uint64), (_WIDTH - 1).astype(np.uint64)
_FIRST16, _CLASS16 = _FIRST.astype(np.uint16), _CLASS.astype(np.uint16)
_SLOT = np.uint16((1 << SLOTS) - 1)
_TWO, _FIVE, _FIFTEEN = np.uint8(2), np.uint8(5), np.uint8(15)
_MIX1, _MIX2 = np.uint16(40503), np.uint16(57587)


class _Model:
    """What all lanes have seen: the id last seen in a context, plus 1; weights; counts of classes."""

    def __init__(self, lanes: int):
        self.seen1, self.seen2 = (np.zeros(lanes << SLOTS, np.uint16) for _ in range(2))
        self.weight = np.tile(_WEIGHTS, lanes)
        self.count = np.ones((lanes, _N_CLASSES), np.uint16)
        # where each class begins, and behind the last one the total, in 32 x 32 places; and every 32nd of them
        self.begins = np.full((lanes, 1024), 0xFFFF, np.uint16)
        self.flat, self.rows = self.begins.ravel(), self.begins.view("V64").ravel()
        self.total, self.counted = 0, 0
        every = np.arange(lanes, dtype=np.int64)
        self.firsts, self.states, self.fines, self.classes = every << SLOTS, every * 45, every * 32, every * 1024
        self.rebuild()

    def rebuild(self, seen: np.ndarray | None = None):
        """Count the symbols ``seen`` (steps x lanes) since the last time."""
        if seen is not None:
            # lane by lane, so that a lane's counts stay at hand
            k = _CLASS.take(np.ascontiguousarray(seen.T))
            k += (np.arange(k.shape[0]) * _N_CLASSES)[:, None]
            np.add.at(self.count.ravel(), k.ravel(), np.uint16(24))
            self.counted += len(seen)
        # four counts are one number; times _FOURS and a place up, it holds the sums of none, the first, the first two and three
        four = self.count.view(np.uint64) * _FOURS
        before = np.cumsum(four >> _U48, axis=1)
        four <<= _U16
        before *= _FOURS
        four[:, 1:] += before[:, :-1]
        self.begins[:, :_N_CLASSES].view(np.uint64)[:] = four
        self.begins[:, _N_CLASSES] = _N_CLASSES + 24 * self.counted
        self.coarse = np.ascontiguousarray(self.begins[:, ::32].T)
        self.total = np.uint64(_N_CLASSES + 24 * self.counted)

    def slots(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the tables of contexts, for the last id ``a`` and the one before it."""
        mixed, firsts = a * _MIX1, self.firsts[: a.shape[-1]]
        return firsts + (mixed >> np.uint16(4)), firsts + (((mixed + b * _MIX2) >> np.uint16(3)) & _SLOT)

    def state(self, c1: np.ndarray, c2: np.ndarray, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Places of the weights, for the predictions and the last two outcomes."""
        two = c2 > 0
        case = (c1 > 0).view(np.uint8) * _TWO
        case += two.view(np.uint8)
        two &= c1 == c2
        case += two.view(np.uint8)
        case += before * _FIFTEEN
        case += last * _FIVE
        return self.states[: c1.shape[-1]] + case

    def learn(self, state: np.ndarray, w: np.ndarray, sums: np.ndarray, step: np.ndarray):
        new = w + step
        heavy = (sums >= _HEAVY).nonzero()[0]
        if len(heavy):
            new[heavy] = ((new.take(heavy) + _ROUND) >> _ONE) & _HALVED
        self.weight[state] = new


def _spans(n: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(first step, step behind the last one, lanes active) of at most ``most`` steps, between which counts are rebuilt."""
    steps = int(n[0]) if len(n) else 0
    cuts = sorted({*range(0, steps, most), *(r for r in _REBUILD if r < steps), *np.unique(n).tolist()} | {0})
    return [(lo, hi, int((n > lo).sum())) for lo, hi in zip(cuts, cuts[1:])]


def _encode(n: np.ndarray, ids: np.ndarray, coder: type[_Range] = _Range) -> tuple[np.ndarray, np.ndarray]:
    """Code lanes of ``n`` symbols (longest first; lanes x symbols): their words, and how many. All symbols are known,
    so a number of steps at a time is looked up and classified at once; only what learns goes step by step."""
    lanes, steps = ids.shape
    rc, m = coder(lanes, None, 3 * steps + 8), _Model(lanes)
    # symbols of a step lie side by side; before the first one come two zeros
    symbols = np.zeros((steps + 2, lanes), np.uint16)
    symbols[2:] = ids.T
    outcomes = np.zeros((2 + AT_ONCE, lanes), np.uint8)          # and of the two steps before
    for t, end, active in _spans(n, AT_ONCE):
        if t in _REBUILD:
            m.rebuild(symbols[2 + m.counted: 2 + t, :active])
        size = end - t
        rc.make_room(2 * size + 2)
        x = symbols[2 + t: 2 + end, :active]
        after = x + np.uint16(1)
        s1, s2 = m.slots(symbols[1 + t: 1 + end, :active], symbols[t:end, :active])
        c1, c2 = np.empty_like(x), np.empty_like(x)
        for i in range(size):
            m.seen1.take(s1[i], out=c1[i], mode="clip")
            m.seen1[s1[i]] = after[i]
            m.seen2.take(s2[i], out=c2[i], mode="clip")
            m.seen2[s2[i]] = after[i]
        first, second = (c2 == after) & (after > 0), (c1 == after) & (after > 0)
        outcome = outcomes[2: 2 + size, :active]
        outcome[:] = np.where(first, 0, np.where(second, 1, 2))
        state = m.state(c1, c2, outcomes[:size, :active], outcomes[1: 1 + size, :active])
        step, w = _LEARN.take(outcome), np.empty(x.shape, np.uint64)
        for i in range(size):
            now = m.weight.take(state[i], mode="clip")
            m.learn(state[i], now, np.multiply(now, _SUMS, out=w[i]), step[i])
        w0, w1, total = (w >> _U16) & _FIELD, (w >> _U32) & _FIELD, w >> _U48
        miss = outcome == 2
        start = w1 * miss
        start += w0 * (outcome == 1)
        width = np.where(first, w0, np.where(miss, total, w1))
        width -= start
        k = _CLASS.take(x)
        at = m.classes[:active] + k
        lo = m.flat.take(at)
        wide = m.flat.take(at + 1) - lo
        # who has been coded keeps its range
        lo *= miss
        total0, wide = np.where(miss, m.total, _ONE), np.where(miss, wide, _ONE)
        inside = (x - _FIRST16.take(k)) * miss
        shift = _SHIFT.take(k) * miss
        lo, inside, rng = lo.astype(np.uint64), inside.astype(np.uint64), rc.rng[:active]
        for i in range(size):
            r = rng // total[i]
            rc.narrow(active, r * start[i], r * width[i])
            r = rng // total0[i]
            skip = r * lo[i]
            r *= wide[i]
            if not rc.JOINT:
                rc.narrow(active, skip, r)
                r, skip = rng, np.uint64(0)
            r = r >> shift[i]
            rc.narrow(active, skip + r * inside[i], r)
        outcomes[:2] = outcomes[size: size + 2]
    used = rc.flush()
    return rc.words, used


def _decode(n: np.ndarray, words: np.ndarray, coder: type[_Range] = _Range) -> np.ndarray:
    """The symbols of lanes of ``n`` symbols (longest first; lanes x symbols)."""
    lanes, steps = len(n), int(n[0])
    rc, m = coder(lanes, words, 0), _Model(lanes)
    symbols = np.zeros((steps + 2, lanes), np.uint16)
    outcomes = np.zeros((3, lanes), np.uint8)
    for begin, end, active in _spans(n, steps):
        if begin in _REBUILD:
            m.rebuild(symbols[2 + m.counted: 2 + begin, :active])
        coarse, most = m.coarse[:, :active], m.total - np.uint64(1)
        low, rng, code = rc.low[:active], rc.rng[:active], rc.code[:active]
        before, last, outcome = outcomes[:, :active]
        for t in range(begin, end):
            s1, s2 = m.slots(symbols[1 + t, :active], symbols[t, :active])
            c1, c2 = m.seen1.take(s1, mode="clip"), m.seen2.take(s2, mode="clip")
            state = m.state(c1, c2, before, last)
            w = m.weight.take(state, mode="clip")
            sums = w * _SUMS
            total, w1 = sums >> _U48, (sums >> _U32) & _FIELD
            r = rng // total
            upto0, upto1 = r * (w & _FIELD), r * w1
            first, hit = code < upto0, code < upto1
            total -= w1
            total *= r
            done = hit.nonzero()[0]
            if len(done):
                one = first.take(done)
                a, b = upto0.take(done), upto1.take(done)
                a, b = np.where(one, 0, a), np.where(one, a, b)
                total[done], upto1[done] = b - a, a
                guess = np.where(one, c2.take(done), c1.take(done)) - np.uint16(1)
            rc.narrow(active, upto1, total)
            # by order 0; who has been decoded keeps its range
            r = rng // m.total
            v = np.minimum(code // r, most).astype(np.uint16)
            k = np.add.reduce((coarse <= v).view(np.uint8), axis=0, dtype=np.uint8).astype(np.int64)
            k -= 1
            k = 32 * k + _below(m.rows.take(m.fines[:active] + k, mode="clip").view(np.uint16).reshape(-1, 32), v)
            at = m.classes[:active] + k
            lo = m.flat.take(at, mode="clip")
            at += 1
            width = m.flat.take(at, mode="clip") - lo
            if len(done):
                r[done], lo[done], width[done], k[done] = rng.take(done), 0, 1, 0
            skip = r * lo
            r *= width
            if not rc.JOINT:
                rc.narrow(active, skip, r)
                r, skip = rng, np.uint64(0)
            r = r >> _SHIFT.take(k)
            inside = np.minimum((code - skip) // r, _LAST.take(k))
            x = _FIRST16.take(k)
            x += inside.astype(np.uint16)
            inside *= r
            inside += skip
            rc.narrow(active, inside, r)
            if len(done):
                x[done] = guess
            symbols[2 + t, :active] = x
            np.subtract(np.uint8(2), hit.view(np.uint8), out=outcome)
            outcome -= first.view(np.uint8)
            m.learn(state, w, sums, _LEARN.take(outcome))
            x += np.uint16(1)
            m.seen1[s1] = x
            m.seen2[s2] = x
            before[:], last[:] = last, outcome
    return symbols[2:].T


_CODERS = {MAGIC: _Range, MAGIC2: _Carrying}


def encode_blocks(ids: np.ndarray, magic: bytes = MAGIC) -> bytes:
    """All ids of a segment (unsigned 32-bit) as blocks: a header, lengths and CRCs of the blocks, their words. ``magic``
    tells the format; the two differ in the range coder alone."""
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    symbols = ids.astype("<u4").view("<u2") if wide else ids.astype(np.uint16)
    n_blocks = -(-len(symbols) // BLOCK)
    n = np.full(n_blocks, BLOCK, np.int64)
    head = magic + struct.pack("<BQI", wide, len(symbols), n_blocks)
    if not n_blocks:
        return head
    n[-1] = len(symbols) - BLOCK * (n_blocks - 1)
    padded = np.zeros(n_blocks * BLOCK, np.uint16)
    padded[: len(symbols)] = symbols
    grid = padded.reshape(n_blocks, BLOCK)[:, : int(n[0])]
    crc = np.array([zlib.crc32(grid[i, : n[i]].tobytes()) for i in range(n_blocks)], "<u4")
    body, sizes, word = [], [], np.dtype(_CODERS[magic].WORD).newbyteorder("<")
    for at in range(0, n_blocks, LANES):
        words, used = _encode(n[at: at + LANES], grid[at: at + LANES], _CODERS[magic])
        body += [words[i, : used[i]].astype(word).tobytes() for i in range(len(used))]
        sizes.append(used)
    return head + np.concatenate(sizes).astype("<u4").tobytes() + crc.tobytes() + b"".join(body)


def decode_blocks(data: bytes) -> np.ndarray:
    """The ids of a segment; raises ValueError if a block's CRC doesn't match."""
    coder = _CODERS.get(data[: len(MAGIC)])
    if not coder:
        raise ValueError("not a token-id segment")
    word = np.dtype(coder.WORD).newbyteorder("<")
    wide, n_symbols, n_blocks = struct.unpack_from("<BQI", data, len(MAGIC))
    at = len(MAGIC) + struct.calcsize("<BQI")
    used = np.frombuffer(data, "<u4", n_blocks, at).astype(np.int64)
    crc = np.frombuffer(data, "<u4", n_blocks, at + 4 * n_blocks)
    at += 8 * n_blocks
    symbols = np.empty(n_symbols, np.uint16)
    n = np.full(n_blocks, BLOCK, np.int64)
    if n_blocks:
        n[-1] = n_symbols - BLOCK * (n_blocks - 1)
    for first in range(0, n_blocks, LANES):
        size = used[first: first + LANES]
        words = np.zeros((len(size), int(size.max()) + 4), coder.WORD)
        for i, k in enumerate(size):
            words[i, :k] = np.frombuffer(data, word, k, at)
            at += word.itemsize * k
        got = _decode(n[first: first + LANES], words, coder)
        for i in range(len(size)):
            block = got[i, : n[first + i]]
            if zlib.crc32(block.tobytes()) != crc[first + i]:
                raise ValueError(f"block {first + i}: checksum doesn't match")
            symbols[(first + i) * BLOCK: (first + i) * BLOCK + len(block)] = block
    return symbols.view("<u4").copy() if wide else symbols.astype("<u4")


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0,
              segment_ids: int = BLOCK * LANES) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into a token-id file set at ``path``.

    One range shuffle orders the documents; each task writes the segments of its range, of about
    ``segment_ids`` ids or one longer document.
    """
    src = pick(docs, "doc_id", "text").withColumn("tie", F.xxhash64("text")).withColumn("n", F.length("text"))
    ordered = src.repartitionByRange("doc_id", "n", "tie").sortWithinPartitions("doc_id", "n", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary), np.array([end_id], "<u4")
        part, segment = TaskContext.get().partitionId(), 0
        index: list[tuple] = []
        held: list[np.ndarray] = []
        size = 0

        def segment_row() -> pa.RecordBatch:
            listed = b"".join(struct.pack("<?qQ", d is not None, d or 0, n) for d, n in index)
            ids = np.concatenate(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(index)], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([listed], pa.binary()),
                 pa.array([encode_blocks(ids, MAGIC2)], pa.binary())],
                ["part", "segment", "n_docs", "n_ids", "index", "blocks"])

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode_many(batch.column("text"))):
                index.append((doc_id, len(ids) + 1))
                held += [ids, end]
                size += len(ids) + 1
                if size >= segment_ids:
                    yield segment_row()
                    segment, size = segment + 1, 0
                    index.clear()
                    held.clear()
        if index:
            yield segment_row()

    ordered.select("doc_id", "text").mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Decode a file set: one row per document with its place, its token count and the CRC-32 of its ids."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "segment", "doc_id", "local_start", "n_tokens", "ids_crc32"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            for part, segment, n_docs, n_ids, index, blocks in rows(
                    batch, "part", "segment", "n_docs", "n_ids", "index", "blocks"):
                ids = decode_blocks(blocks).tobytes()
                cols, at = [[] for _ in names], 0
                for known, doc_id, n in struct.iter_unpack("<?qQ", index):
                    row = (part, segment, doc_id if known else None, at, n, zlib.crc32(ids[4 * at: 4 * (at + n)]))
                    for col, v in zip(cols, row):
                        col.append(v)
                    at += n
                if at != n_ids or len(cols[0]) != n_docs:
                    raise ValueError(f"part {part}, segment {segment}: index and ids differ")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    docs = files.mapInArrow(run, DOC_SCHEMA)
    # ids before a segment: those before it in its part, and all of earlier parts (one row per part)
    sizes = files.select("part", "segment", "n_ids")
    in_part = sizes.select("part", "segment", (F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("segment")) - F.col("n_ids")).alias("before"))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("earlier"))
    offsets = in_part.join(earlier, "part").select("part", "segment", (F.col("before") + F.col("earlier")).alias("o"))
    return docs.join(offsets, ["part", "segment"]).select(
        "doc_id", (F.col("o") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
