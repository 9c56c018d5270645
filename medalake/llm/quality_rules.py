"""Quality rules with adaptive thresholds.

Each whole text gets counts and three whole-number rates: mean word length (hundredths), symbols per 1,000 word
characters, and repeated lines per 1,000 lines with words. (Words in repeated windows are bounded by the base rule.)
A rate's distribution within a language and source is held in a mergeable sketch: a histogram whose buckets keep the five
leading bits of a value (relative error under 1/16), so it has a bounded size, two sketches merge by adding counts,
and a source with a third of all rows is summed up inside every task first.

Thresholds are fences around the sketch's quartiles: above q75 + FENCE * (q75 - q25) + slack, for the word length
also below q25 likewise. The slack keeps a rate that hardly varies in a group from failing everything else. A
language and source with fewer than ``MIN_GROUP`` documents takes the merged sketch of its language, and that of
all rows if the language is small too. The verdicts come from a join of rows and thresholds.

Documents that fail the base rule don't enter the sketches: a source full of junk would widen its own fences.

Defined results: null text has no words and fails the base rule; null lang and source are values of their own;
repeated rows each count and each keep a row; a null doc_id passes through; an empty table gives an empty result;
other columns are ignored (``keep_good`` passes them on).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType
from pyspark.sql.window import Window

from medalake.llm.common import pick, positional, rows, saved

FENCE = 4
MIN_GROUP = 50
#: Rate -> (slack, whether low values fail too).
RATES = {"mean_len": (150, True), "symbol_rate": (50, False), "dup_rate": (400, False)}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = [*COUNTS, "base_failed", *RATES]

_SPACE = " \t\n\r\x0b\x0c"
_SYMBOLS = "#*$%&|<>"
_WINDOW = 8


def _repeat_words(words: list[bytes]) -> int:
    """Words in 8-word windows that occur twice or more, first occurrences included."""
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for i in range(_WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[i: i + n]
    if len(np.unique(rolled)) == n:  # equal windows have equal sums, so none is repeated
        return 0
    windows = list(zip(*[words[i: i + n] for i in range(_WINDOW)]))
    often = Counter(windows)
    marked = np.zeros(len(words) + 1, np.int64)
    at = np.fromiter((i for i, w in enumerate(windows) if often[w] > 1), np.int64)
    if not len(at):
        return 0
    np.add.at(marked, at, 1)
    np.add.at(marked, at + _WINDOW, -1)
    return int((np.cumsum(marked) > 0).sum())


def measure(text: str | None) -> tuple:
    """The values of ``MEASURES`` for a whole text."""
    text = text or ""
    words = text.encode().split()  # bytes split at \x20 and \x09-\x0d only
    n, chars = len(words), len(text) - sum(map(text.count, _SPACE))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    dup = len(lines) - len(set(lines))
    repeat = _repeat_words(words)
    rates = (100 * chars // n, 1000 * symbols // chars, 1000 * dup // len(lines)) if n else (0, 0, 0)
    return (n, chars, symbols, dup, repeat, n < 20 or 100 * repeat > 30 * n, *rates)


def with_measures(frame: DataFrame, text: str) -> DataFrame:
    """``frame`` with the columns of ``MEASURES``."""
    schema = StructType([*frame.schema.fields, *[
        StructField(m, BooleanType() if m == "base_failed" else LongType()) for m in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [measure(t) for (t,) in rows(batch, text)]
            new = [pa.array([g[i] for g in got], pa.bool_() if m == "base_failed" else pa.int64())
                   for i, m in enumerate(MEASURES)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *MEASURES])

    return frame.mapInArrow(run, schema)


def bucket(value):
    """The sketch's bucket of a whole number: its five leading bits."""
    step = F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - 5, F.lit(0))).cast("long")
    return value - value % step


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, rate, bucket, n) over the rows that pass the base rule."""
    rates = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), bucket(F.col(r)).alias("bucket")) for r in RATES]))
    return (measured.where(~F.col("base_failed")).select("lang", "source", rates.alias("r"))
            .groupBy("lang", "source", F.col("r.rate").alias("rate"), F.col("r.bucket").alias("bucket"))
            .agg(F.count("*").alias("n")))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rate, total, q25, q75) of merged sketches: the bucket where the running count passes the quarter."""
    merged = sketch.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "rate")
    run = merged.withColumn("upto", F.sum("n").over(by.orderBy("bucket"))).withColumn("total", F.sum("n").over(by))
    return run.groupBy(*keys, "rate").agg(
        F.first("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q25"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q75"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): the fences of every rate, from the narrowest level with enough documents."""
    own = _quartiles(sketch, ["lang", "source"])
    lang = _quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("l"), F.col("rate").alias("lr"), F.col("total").alias("lt"),
        F.col("q25").alias("l25"), F.col("q75").alias("l75"))
    every = _quartiles(sketch, []).select(F.col("rate").alias("er"), F.col("q25").alias("e25"),
                                          F.col("q75").alias("e75"))
    level = (own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rate") == F.col("lr")))
             .join(every, F.col("rate") == F.col("er")))
    pick_q = lambda q: (F.when(F.col("total") >= MIN_GROUP, F.col(f"q{q}"))
                        .when(F.col("lt") >= MIN_GROUP, F.col(f"l{q}")).otherwise(F.col(f"e{q}")))
    fenced = level.select("lang", "source", "rate", pick_q(25).alias("a"), pick_q(75).alias("b"))
    at = lambda rate, value: F.max(F.when(F.col("rate") == rate, value))
    spread = FENCE * (F.col("b") - F.col("a"))
    return fenced.groupBy("lang", "source").agg(
        *[at(r, F.col("b") + spread + slack).alias(f"{r}_max") for r, (slack, _) in RATES.items()],
        *[at(r, F.col("a") - spread - slack).alias(f"{r}_min") for r, (slack, low) in RATES.items() if low])


def verdicts(measured: DataFrame, lang: str, source: str, limits: DataFrame) -> DataFrame:
    """``measured`` with ``kept``. The limits are a small written table; Catalyst broadcasts it if its files are."""
    t = limits.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    good = ~F.col("base_failed")
    for r, (_, low) in RATES.items():
        good &= F.col(r) <= F.col(f"{r}_max")
        if low:
            good &= F.col(r) >= F.col(f"{r}_min")
    joined = measured.join(t, F.col(lang).eqNullSafe(F.col("t_lang")) & F.col(source).eqNullSafe(F.col("t_source")),
                           "left")
    return joined.withColumn("kept", F.coalesce(good, F.lit(False)))


def judge(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: the counts, base_failed, kept and the rates."""
    src = pick(docs, "doc_id", "text", "lang", "source")
    measured = saved(with_measures(src, "text").drop("text"), spark, "rules-measured")
    limits = saved(thresholds(sketches(measured)), spark, "rules-limits")
    return verdicts(measured, "lang", "source", limits).select(
        "doc_id", *COUNTS, "base_failed", "kept", *RATES)


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that the rules reject."""
    src = pick(docs, "text", "lang", "source")
    measured = with_measures(src, "text").drop("text")
    limits = saved(thresholds(sketches(measured)), spark, "rules-limits")
    renamed, at = positional(docs)
    told = verdicts(with_measures(renamed, at["text"]), at["lang"], at["source"], limits)
    return told.where("kept").select(*renamed.columns).toDF(*docs.columns)
