"""Conversation structure repair by the auction shortest-path algorithm.

A conversation's rows, in order, and the role initial written last (none, s, u, a) span a lattice; an edit is an arc:
Keep (0), Rerole to user or assistant (3), Delete (4, the only one for blank and duplicate rows), Insert an empty
user or assistant row (3). A truncated row that stays adds 3. The written initials must match ``(s?(ua)+)?``.

Auction (``_auction``): every node has a price, at first 0, never above arc cost plus the next node's price. The path
grows along an arc for which both are equal; where none is, its last node's price rises to the least such sum and
the path shrinks by that node. When it reaches the sink, its first node's price is the cost. All cheapest paths then
consist of tight arcs (price = cost + next price), so the lexicographically least edits are traced over those tight
arcs from which tight arcs lead on to the sink. Costs are integers and only inserting moves within a layer, at a
positive cost, so prices rise by 1 at least and the auction ends.

Long conversations: the lattice is cut into blocks of ``BLOCK`` rows. The costs from a block's end, one for each of
the four initials, are the arcs into its sink; blocks are solved from the last to the first, then traced from the
first to the last. No block ends in an insertion, so its traces are no prefixes of each other, and the least trace of
the blocks one after another is the least of all. Equal blocks before equal costs are solved once (a memo).

Spark: equal rows are counted map-side; a row's first place in its conversation is a partial aggregate, met again by
a join on a key that no two rows share; rows are dealt by ranges of (conversation, turn, role, text digest), so that a
conversation holding a third of all rows is spread over many tasks. Conversations that lie within one task's range
are repaired there. Pieces of the others are written with their costs from any initial to any other; one stream over
those costs, backwards, gives the costs at every piece's end; a second, forwards, traces. Both hold one piece at a
time (the digest of a whole repaired conversation can't be computed but in order).

Defined results: null roles and texts are one space, a null conv_id is a conversation, null turns come first; rows of
equal turn go by role, then SHA-256 of the text; an empty role's initial counts as no legal one; texts are equal if
their SHA-256 are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from medalake.llm.common import pick, rows, saved

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
NONE, SYSTEM, USER, ASSISTANT = range(4)  # the initial written last, or the initial of a row (3 + 1: any other)
OTHER = 4
WHOLE, MUST_GO, TRUNCATED = range(3)
INF = 1 << 60
BLOCK, PIECE, PIECE_CHARS, PIECES_HELD = 16, 4096, 1 << 20, 16
END = (0, INF, INF, 0)  # a conversation may end empty or after an assistant row
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_NAME = {USER: "user", ASSISTANT: "assistant"}


def fault(text: str, first: bool) -> int:
    """0 none, 1 blank, 2 duplicate, 3 truncated: the first that holds."""
    last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
    if not last:
        return 1
    return 2 if not first else 0 if last in ".!?" else 3


def _next(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _lattice(symbols: bytes, ends: tuple) -> list[list[tuple]]:
    """Arcs (cost, next node, edit) of each node 4 * layer + state; the sink is the last node. ``symbols``: 3 * initial
    + (whole, must go, truncated) of each row. The last layer inserts only where there are no rows at all."""
    n = len(symbols)
    sink = 4 * (n + 1)
    arcs: list[list[tuple]] = [[] for _ in range(sink + 1)]
    for i in range(n + 1):
        for state in range(4):
            out, to = arcs[4 * i + state], _next(state)
            if i < n or not n:
                out.append((INSERT, 4 * i + to, "I"))
            if i < n:
                initial, kind = divmod(symbols[i], 3)
                down = 4 * (i + 1)
                out.append((DELETE, down + state, "D"))
                if kind != MUST_GO:
                    extra = CUT_OFF if kind == TRUNCATED else 0
                    out.append((REROLE + extra, down + to, "R"))
                    if initial == to or (initial == SYSTEM and state == NONE):
                        out.append((KEEP + extra, down + initial, "K"))
            elif ends[state] < INF:
                out.append((ends[state], sink, ""))
    # only nodes that lead to the sink: any other price would rise for ever
    leads = _behind(arcs, sink, lambda i, cost, k: True)
    return [[a for a in out if a[1] in leads] if i in leads else [] for i, out in enumerate(arcs)]


def _behind(arcs: list[list[tuple]], sink: int, usable) -> set[int]:
    """The nodes from which usable arcs lead to the sink."""
    back: dict[int, list[int]] = {}
    for i, out in enumerate(arcs):
        for cost, k, _ in out:
            if usable(i, cost, k):
                back.setdefault(k, []).append(i)
    found, todo = {sink}, [sink]
    while todo:
        for i in back.get(todo.pop(), ()):
            if i not in found:
                found.add(i)
                todo.append(i)
    return found


def _auction(arcs: list[list[tuple]], source: int, sink: int, price: list[int]) -> int:
    """The cheapest way from source to sink; prices hold the dual solution, also for the next source."""
    path = [source]
    while path[-1] != sink:
        i = path[-1]
        least, to = INF, -1
        for cost, k, _ in arcs[i]:
            if cost + price[k] < least:
                least, to = cost + price[k], k
        if price[i] < least:      # contract
            price[i] = least
            if len(path) > 1:
                path.pop()
        else:                     # extend along a tight arc
            path.append(to)
    return price[source]


@lru_cache(maxsize=50_000)
def _solved(symbols: bytes, ends: tuple) -> tuple:
    """(cost, edits, last state) for each state before the rows; cost INF where no way leads to a finite end."""
    arcs = _lattice(symbols, ends)
    sink, price, out = len(arcs) - 1, [0] * len(arcs), []
    for source in range(4):
        if not arcs[source]:
            out.append((INF, "", source))
            continue
        cost = _auction(arcs, source, sink, price)
        tight = _behind(arcs, sink, lambda i, c, k: price[i] == c + price[k])
        at, edits, last = source, [], source
        while at != sink:
            last = at % 4
            label, at = min((label, k) for c, k, label in arcs[at] if k in tight and price[at] == c + price[k])
            edits.append(label)
        out.append((cost, "".join(edits), last))
    return tuple(out)


def solve(symbols: bytes, ends: tuple) -> tuple:
    low = min(ends)
    if low >= INF:
        return tuple((INF, "", s) for s in range(4))
    return tuple((c if c >= INF else c + low, e, s)
                 for c, e, s in _solved(symbols, tuple(x if x >= INF else x - low for x in ends)))


def before(symbols: bytes, ends: tuple) -> list[tuple]:
    """Costs from each block's start on, first block first; the last entry is ``ends``."""
    out = [ends]
    for at in reversed(range(0, len(symbols), BLOCK)):
        out.append(tuple(c for c, _, _ in solve(symbols[at: at + BLOCK], out[-1])))
    return out[::-1]


def after_all() -> tuple:
    """Costs behind the last row: what must still be inserted."""
    return tuple(c for c, _, _ in solve(b"", END))


def edits(symbols: bytes, ends: tuple, state: int) -> tuple[str, int]:
    """The least cheapest edits of rows behind which going on costs ``ends``, and the state after them."""
    costs, out = before(symbols, ends), []
    for n, at in enumerate(range(0, len(symbols), BLOCK)):
        _, text, state = solve(symbols[at: at + BLOCK], costs[n + 1])[state]
        out.append(text)
    return "".join(out), state


def transfer(symbols: bytes) -> list[int]:
    """Costs from each of the four states before the rows to each one after them."""
    columns = [before(symbols, tuple(0 if s == x else INF for s in range(4)))[0] for x in range(4)]
    return [columns[x][s] for s in range(4) for x in range(4)]


class _Piece:
    """Consecutive rows of a conversation: symbols, what may stay of them, and counts."""

    def __init__(self):
        self.symbols, self.roles, self.texts, self.chars = bytearray(), [], [], 0
        self.counts = [0, 0, 0, 0]  # by fault
        self.turns = [None, None, 0]  # first, last, distinct

    def add(self, turn, role: str, text: str, kind: int):
        self.counts[kind] += 1
        self.symbols.append(3 * _INITIAL.get(role[:1], OTHER) + (WHOLE, MUST_GO, MUST_GO, TRUNCATED)[kind])
        if kind in (0, 3):
            self.roles.append(role)
            self.texts.append(text)
            self.chars += len(text)
        if turn is not None and turn != self.turns[1]:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]

    def full(self) -> bool:
        return len(self.symbols) >= PIECE or self.chars >= PIECE_CHARS


class _Report:
    """The running result of a conversation, piece after piece."""

    def __init__(self, conv_id, as_rows: bool):
        self.conv_id, self.as_rows, self.state, self.cost = conv_id, as_rows, NONE, None
        self.counts, self.turns, self.illegal, self.initial = [0, 0, 0, 0], [None, None, 0], 0, None
        self.audit, self.digest, self.place = [], hashlib.sha256(), 0

    def take(self, symbols: bytes, roles, texts, counts, turns, ends: tuple) -> list[tuple]:
        """Adds a piece behind which going on costs ``ends``; returns its repaired rows if those are wanted."""
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        if turns[2]:
            same = self.turns[1] == turns[0]
            self.turns = [turns[0] if self.turns[0] is None else self.turns[0], turns[1], self.turns[2] + turns[2] - same]
        for s in symbols:
            if self.initial is not None and (self.initial, s // 3) not in _LEGAL:
                self.illegal += 1
            self.initial = s // 3
        if self.cost is None:
            self.cost = before(symbols, ends)[0][NONE]
        audit, last = edits(symbols, ends, self.state)
        out = self._write(audit, symbols, zip(roles, texts))
        self.state = last
        return out

    def _write(self, audit: str, symbols: bytes, stay: Iterator[tuple]) -> list[tuple]:
        out, state, kinds = [], self.state, iter(symbols)
        for edit in audit:
            role, text = ("", "") if edit == "I" or next(kinds) % 3 == MUST_GO else next(stay)
            if edit == "D":
                continue
            state = _INITIAL[role[:1]] if edit == "K" else _next(state)
            line = f"{role if edit == 'K' else _NAME[state]}:{text}"
            self.digest.update(("\n" * (self.place > 0) + line).encode("utf-8", "surrogatepass"))
            self.place += 1
            if self.as_rows:
                out.append((self.conv_id, self.place, edit, *line.split(":", 1)) if edit != "K"
                           else (self.conv_id, self.place, edit, role, text))
        self.audit.append(audit)
        return out

    def close(self) -> list[tuple]:
        cost, audit, _ = solve(b"", END)[self.state]
        out = self._write(audit, b"", iter(()))
        if self.as_rows:
            return out
        first, last, distinct = self.turns
        return out + [(self.conv_id, 0 if first is None else last - first + 1 - distinct, self.counts[1], self.counts[2],
                       self.counts[3], self.illegal, cost if self.cost is None else self.cost, "".join(self.audit),
                       self.digest.hexdigest())]


_SUMMARY = StructType([StructField("conv_id", LongType()),
                       *[StructField(n, LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                       StructField("audit", StringType()), StructField("repaired_sha256", StringType())])
_ROWS = "conv_id long, place long, edit string, role string, text string"
_PIECES = ("part int, piece int, symbols binary, roles array<string>, texts array<string>, counts array<long>, "
           "turns array<long>, transfer array<long>")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of a test corpus with planted faults by the crc32 of ``conv_id:turn``, and how often each occurs (copies).
    A dropped row leaves a row of no copies, so that its conversation stays known."""
    rows = pick(conversations, "conv_id", "turn", "role", "text")

    def text_of(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    gone = F.col("code") == 0
    return rows.withColumn("code", code).select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("code") == 4, "user").otherwise(text_of("role")).alias("role"),
        F.when(gone | (F.col("code") == 1), "").when(F.col("code") == 2, F.translate(text_of("text"), ".!?", ""))
        .otherwise(text_of("text")).alias("text"),
        F.when(gone, 0).when(F.col("code") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _ordered(conversations: DataFrame) -> DataFrame:
    """Distinct rows with their number and whether the first of them is the first of its role and text, in order."""
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1).cast("long")
    names = ["conv_id", "turn", "role", "text"] + ["copies"] * ("copies" in conversations.columns)
    own = pick(conversations, *names).select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], copies.alias("copies"))
    own = own.withColumn("sha", F.unhex(F.sha2("text", 256)))
    # a struct is one key that is never null, its fields may be
    row = F.struct("conv_id", "turn", "role", "sha").alias("row")
    counted = own.groupBy(row).agg(F.sum("copies").alias("n"), F.max("text").alias("text"))
    first = own.where("copies > 0").groupBy("conv_id", "role", "sha").agg(
        F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unknown")).select(
        F.struct("conv_id", F.when(~F.col("unknown"), F.col("least")).alias("turn"), "role", "sha").alias("row"),
        F.lit(True).alias("first"))
    order = ["conv_id", "turn", "role", "sha"]
    return counted.join(first, "row", "left").select("row.*", "text", "n", F.col("first").isNotNull().alias("first")) \
        .repartitionByRange(*order).sortWithinPartitions(*order)


def _pieces(run: Iterator[tuple]) -> Iterator[_Piece]:
    now = _Piece()
    for _, turn, role, text, n, first in run:
        for copy in range(n):
            now.add(turn, role, text, fault(text, first and copy == 0))
            if now.full():
                yield now
                now = _Piece()
    if now.symbols:
        yield now


def _repaired_in_place(as_rows: bool, schema: pa.Schema):
    """Repairs the conversations within a partition's range; pieces of those that may go on in another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, names, piece_no = TaskContext.get().partitionId(), schema.names, itertools.count()
        blank = dict.fromkeys(names)
        width = len(names) - 8

        def cut(conv_id, p: _Piece) -> dict:
            return blank | {"conv_id": conv_id, "part": part, "piece": next(piece_no), "symbols": bytes(p.symbols),
                            "roles": p.roles, "texts": p.texts, "counts": p.counts, "turns": p.turns,
                            "transfer": transfer(bytes(p.symbols))}

        def whole(conv_id, held: list[_Piece]) -> Iterator[dict]:
            ends = [after_all()]
            for p in reversed(held):
                ends.append(before(bytes(p.symbols), ends[-1])[0])
            report, done = _Report(conv_id, as_rows), []
            for p, e in zip(held, reversed(ends[:-1])):
                done += report.take(bytes(p.symbols), p.roles, p.texts, p.counts, p.turns, e)
            for r in done + report.close():
                yield blank | dict(zip(names[:width], r))

        def results() -> Iterator[dict]:
            all_rows = (r for b in batches for r in rows(b, "conv_id", "turn", "role", "text", "n", "first"))
            last, edge = None, True  # the first conversation may have begun, and the last one may go on, elsewhere
            for conv_id, own in itertools.groupby(all_rows, key=lambda r: r[0]):
                if last:
                    yield from map(cut, itertools.repeat(last[0]), last[1]) if edge else whole(*last)
                    edge = False
                held, sent = [], False
                for p in _pieces(own):
                    held.append(p)
                    if len(held) > PIECES_HELD:
                        yield from map(cut, itertools.repeat(conv_id), held)
                        held, sent = [], True
                if sent:
                    yield from map(cut, itertools.repeat(conv_id), held)
                    last, edge = None, False
                else:
                    last = (conv_id, held or [_Piece()])
            if last:
                yield from map(cut, itertools.repeat(last[0]), last[1])

        some, chars = [], 0
        for r in results():
            some.append(r)
            chars += sum(map(len, r["texts"] or ())) + len(r.get("text") or "")
            if len(some) >= 2000 or chars > PIECE_CHARS:
                yield pa.RecordBatch.from_pylist(some, schema)
                some, chars = [], 0
        if some:
            yield pa.RecordBatch.from_pylist(some, schema)

    return run


def _stream(df: DataFrame, backwards: bool) -> DataFrame:
    """Pieces of a conversation in one partition, in order or backwards."""
    order = [F.col(c).desc() if backwards else F.col(c) for c in ("part", "piece")]
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_id, now = (), None
    for batch in batches:
        out = []
        for c, part, piece, t in rows(batch, "conv_id", "part", "piece", "transfer"):
            if conv_id != (c,):
                conv_id, now = (c,), after_all()
            out.append((part, piece, list(now)))
            now = tuple(min(min(t[4 * s + x] + now[x] for x in range(4)), INF) for s in range(4))
        cols = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                                          pa.array(cols[2], pa.list_(pa.int64()))], ["part", "piece", "ends"])


def _traced(as_rows: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report = None

        def made(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in found], schema)

        for batch in batches:
            for c, symbols, roles, texts, counts, turns, ends in rows(
                    batch, "conv_id", "symbols", "roles", "texts", "counts", "turns", "ends"):
                if report is None or report.conv_id != c:
                    if report:
                        yield made(report.close())
                    report = _Report(c, as_rows)
                yield made(report.take(symbols, roles, texts, counts, turns, tuple(ends)))
        if report:
            yield made(report.close())

    return run


def _repair(spark: SparkSession, conversations: DataFrame, as_rows: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    result = StructType.fromDDL(_ROWS) if as_rows else _SUMMARY
    schema = StructType([*result.fields, *StructType.fromDDL(_PIECES).fields])
    made = saved(_ordered(conversations).mapInArrow(_repaired_in_place(as_rows, to_arrow_schema(schema)), schema),
                 spark, "repaired")
    names = result.fieldNames()
    cut = made.where("part IS NOT NULL")
    ends = _stream(cut.select("conv_id", "part", "piece", "transfer"), True).mapInArrow(
        _ends, "part int, piece int, ends array<long>")
    pieces = cut.drop("transfer", *[n for n in names if n != "conv_id"]).join(ends, ["part", "piece"])
    traced = _stream(pieces, False).mapInArrow(_traced(as_rows, to_arrow_schema(result)), result)
    return made.where("part IS NULL").select(*names).union(traced)


def repair(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Per conversation its faults, the cheapest repair's cost and edits, and the repaired text's digest. Input:
    conv_id, turn, role, text and, if given, copies (how often the row occurs, 0: only names its conversation)."""
    return _repair(spark, conversations, False)


def repaired_rows(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The repaired conversations: place from 1, the edit that left the row (K, R, I), role and text."""
    return _repair(spark, conversations, True)
