"""Packing by minimum bin slack.

Documents become token ids plus an end id. Full windows are cut off the front of long documents; the remainders
(shorter than a window) wait in a pool of bounded size. A window takes the longest remainder and then the
multiset of other remainders that fills it closest to its capacity: a subset-sum over lengths with bounded
counts, kept as bits of one integer, with the counts found by walking the stages back. What is left at the end
of a task is cut: full windows first, then sequences whose lengths are powers of two, which need no padding.

Each task packs its own documents, nothing is shuffled, and a task holds at most ``pool`` remainders.

Defined results: null text packs as the end id alone; null or repeated doc_id values pass through, each row is a
document of its own; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from medalake.llm.common import pick, rows
from medalake.llm.token_ids import encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_COLS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def best_fill(capacity: int, counts: dict[int, int]) -> dict[int, int]:
    """Length -> count of the multiset with the largest sum that is at most ``capacity``."""
    stages: list[tuple[int, int, int]] = []  # (sums reachable before, length, copies taken together)
    reach, mask, goal = 1, (1 << (capacity + 1)) - 1, 1 << capacity
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, copies = min(counts[length], capacity // length), 1
        while left and not reach & goal:
            take = min(copies, left)
            stages.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left, copies = left - take, copies * 2
        if reach & goal:
            break
    at, chosen = reach.bit_length() - 1, defaultdict(int)
    for before, length, take in reversed(stages):
        if not before >> at & 1:
            chosen[length] += take
            at -= length * take
    return dict(chosen)


class Packer:
    """Packs (doc, start, ids) remainders; ``emit`` gets the pieces of each finished sequence."""

    def __init__(self, window: int, pool: int, emit):
        self.window, self.pool, self.emit = window, pool, emit
        self.by_length: dict[int, list] = defaultdict(list)
        self.waiting = 0

    def add(self, piece) -> None:
        self.by_length[len(piece[2]) // 4].append(piece)
        self.waiting += 1
        if self.waiting >= self.pool:
            while self.waiting > self.pool // 2:
                self.fill()

    def fill(self, exact: bool = False) -> bool:
        """One window; with ``exact`` only if it can be filled to the last token."""
        longest = max(self.by_length)
        counts = {k: len(v) - (k == longest) for k, v in self.by_length.items()}
        chosen = best_fill(self.window - longest, {k: n for k, n in counts.items() if n})
        if exact and longest + sum(k * n for k, n in chosen.items()) < self.window:
            return False
        chosen[longest] = chosen.get(longest, 0) + 1
        # the same multiset fills further windows for as long as its lengths last
        for _ in range(max(1, min(len(self.by_length[k]) // n for k, n in chosen.items()))):
            self.emit([self.by_length[k].pop() for k, n in sorted(chosen.items(), reverse=True) for _ in range(n)])
            self.waiting -= sum(chosen.values())
        for k in chosen:
            if not self.by_length[k]:
                del self.by_length[k]
        return True

    def finish(self) -> None:
        while self.waiting and self.fill(exact=True):
            pass
        rest = [p for k in sorted(self.by_length, reverse=True) for p in self.by_length[k]]
        total = sum(len(p[2]) // 4 for p in rest)
        sizes = [self.window] * (total // self.window)
        sizes += [1 << b for b in range(self.window.bit_length(), -1, -1) if total % self.window >> b & 1]
        rest.reverse()
        for size in sizes:
            pieces = []
            while size:
                doc, start, ids = rest.pop()
                n = len(ids) // 4
                if n > size:
                    rest.append((doc, start + size, ids[4 * size:]))
                    ids, n = ids[: 4 * size], size
                pieces.append((doc, start, ids))
                size -= n
            self.emit(pieces)


def pack(docs: DataFrame, vocabulary: str, window: int = 2048, end_id: int = 1, pool: int = 4096) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    ``window`` must be a power of two; ``pool`` bounds the remainders a task holds. Sequence ids are unique
    over all tasks and offsets are gapless from 0 within a sequence.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary), end_id.to_bytes(4, "little")
        out: list[list] = [[] for _ in _COLS]
        sequence = TaskContext.get().partitionId() << 32

        def emit(pieces) -> None:
            nonlocal sequence
            offset = 0
            for (doc_id, tokens), start, ids in pieces:
                n = len(ids) // 4
                for col, v in zip(out, (doc_id, start, n, zlib.crc32(ids), tokens, sequence, offset)):
                    col.append(v)
                offset += n
            sequence += 1

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], _COLS)
            for c in out:
                c.clear()
            return batch

        packer = Packer(window, pool, emit)
        for batch in batches:
            for doc_id, text in rows(batch, "doc_id", "text"):
                ids = enc.encode(text) + end
                doc, n = (doc_id, len(ids) // 4), len(ids) // 4
                whole = n - n % window
                for at in range(0, whole, window):
                    emit([(doc, at, ids[4 * at: 4 * (at + window)])])
                if whole < n:
                    packer.add((doc, whole, ids[4 * whole:]))
                if len(out[0]) >= 20_000:
                    yield flush()
        packer.finish()
        yield flush()

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)
