"""Payload files that hold one JSON array, read by as many tasks as they have splits.

Spark's multi-line JSON reader gives a whole file to one task. Here the text
reader cuts the file behind every ``}`` instead, which splits by byte range. A
piece isn't a record yet: the brace may stand inside a string or end a nested
object. Whether it does depends on all text before it, but only through two
values: whether a string is open, and how deep brackets are nested. So:

1. every split reports what it does to these two values, once for a string open
   at its start and once for none (quotes outside escapes flip the one, brackets
   outside strings count for the other);
2. running sums of those reports over a file's splits, one small row each, give
   the values at every split's start;
3. every split joins its pieces to records, from its own start values. What it
   has at its start of a record begun before, and at its end of one not yet
   ended, meet by file in a last small step: at most two texts per split.

Which files hold an array at all is told by their first pieces; the others are
read as JSON lines, so a payload may mix both. Anything that is no array of
objects fails the read.
"""

from __future__ import annotations

import itertools
import re
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ESCAPE = re.compile(r"\\.", re.DOTALL)
_BETWEEN = re.compile(r"\s*([\[,])\s*(?=\{)")
_END = re.compile(r"\s*(\[\s*)?\]\s*\}?")       # the brace is the cutter's, put behind the last piece too
RECORD, HEAD, TAIL = 0, 1, 2
_PARTS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("text", pa.string())])


def _pieces(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def after(piece: str, in_string: bool, depth: int) -> tuple[bool, int]:
    """The two values behind a piece and its closing brace."""
    parts = _ESCAPE.sub("", piece).split('"')
    for n, text in enumerate(parts):
        if (n % 2 == 0) != in_string:
            depth += text.count("{") + text.count("[") - text.count("]")
    in_string ^= len(parts) % 2 == 0
    return in_string, depth if in_string else depth - 1


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    rows = ((b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py())
            for b in batches for i in range(b.num_rows))
    for key, own in itertools.groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2] for r in own)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, start), pieces in _by_split(batches):
        quoted, plain = (True, 0), (False, 0)
        for p in pieces:
            quoted, plain = after(p, *quoted), after(p, *plain)
        yield pa.RecordBatch.from_pydict({"file": [file], "start": [start], "flips": [int(plain[0])], "plain": [plain[1]],
                                          "quoted": [quoted[1]]})


def _joined(states: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), pieces in _by_split(batches):
            in_string, depth = states[file, start]
            # a record is open unless the split begins between two of them
            kind, held = RECORD if not in_string and depth == (start > 0) else HEAD, []
            out: dict[str, list] = {n: [] for n in _PARTS.names}

            def put(kind, text):
                for n, v in zip(_PARTS.names, (file, start, kind, text)):
                    out[n].append(v)

            for p in pieces:
                in_string, depth = after(p, in_string, depth)
                held.append(p + "}")
                if not in_string and depth == 1:
                    put(kind, "".join(held))
                    kind, held = RECORD, []
                if len(out["kind"]) >= 2000:
                    yield pa.RecordBatch.from_pydict(out, _PARTS)
                    for v in out.values():
                        v.clear()
            if held:
                put(TAIL, "".join(held))
            if out["kind"]:
                yield pa.RecordBatch.from_pydict(out, _PARTS)

    return run


def _record(text: str) -> str:
    m = _BETWEEN.match(text.lstrip("﻿"))
    if not m:
        raise ValueError(f"no array of objects: {text[:60]!r}")
    return text.lstrip("﻿")[m.end():]


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_pydict({"value": [_record(t) for t in b.column(3).to_pylist()]})


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heads and tails of a file in order: a head ends the record that the tails before it began."""
    rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))))
    for file, own in itertools.groupby(rows, key=lambda r: r[0]):
        held = ""
        for _, kind, text in own:
            held += text
            if kind == HEAD:
                yield pa.RecordBatch.from_pydict({"value": [_record(held)]})
                held = ""
        if not _END.fullmatch(held.lstrip("﻿")):
            raise ValueError(f"{file}: no array of objects, it ends in {held[-60:]!r}")


def array_files(spark: SparkSession, path) -> dict[str, bool]:
    """File -> whether it opens with a bracket."""
    opens = F.substring(F.ltrim(F.translate("value", "\ufeff\t\r\n", "    ")), 1, 1)
    # a split's pieces come in order
    pieces = _pieces(spark, path).where("start = 0").select("file", opens.alias("opens"), F.monotonically_increasing_id().alias("at"))
    first = pieces.groupBy("file").agg(F.min_by("opens", "at").alias("opens"))
    return {r.file: r.opens == "[" for r in first.collect()}        # one row per file: control plane


def split_starts(spark: SparkSession, path) -> DataFrame:
    """(file, start, in_string, depth) of every split: one row each."""
    found = _pieces(spark, path).mapInArrow(_effects, "file string, start long, flips long, plain long, quoted long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    open_ = found.withColumn("in_string", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1)
    return open_.select("file", "start", "in_string", F.coalesce(
        F.sum(F.when(F.col("in_string"), F.col("quoted")).otherwise(F.col("plain"))).over(before), F.lit(0)).alias("depth"))


def read_payload_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records of all files at ``path``, each a JSON array or JSON lines; a malformed record fails the read."""
    plain = urllib.parse.unquote                            # file paths come as URIs
    is_array = array_files(spark, path)
    arrays, lines = ([plain(f) for f, own in sorted(is_array.items()) if own == kind] for kind in (True, False))
    parts = [spark.read.schema(schema).option("mode", "FAILFAST").json(lines)] if lines else []
    if arrays:
        # one row per split: control plane
        states = {(r.file, r.start): (r.in_string, r.depth) for r in split_starts(spark, arrays).collect()}
        text = _pieces(spark, arrays).mapInArrow(_joined(states), "file string, start long, kind int, text string")
        edges = text.filter(F.col("kind") != RECORD).repartition("file").sortWithinPartitions("file", "start", "kind")
        whole = text.filter(F.col("kind") == RECORD).mapInArrow(_records, "value string").unionByName(
            edges.mapInArrow(_stitched, "value string"))
        parsed = whole.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"))
        parts.append(parsed.select(*[F.col("r")[n].alias(n) for n in schema.fieldNames()]))
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
