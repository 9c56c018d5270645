"""Slowly changing dimension, type 2.

Standard algorithm (default):

1. the batch: NULL-key rows go to the quarantine output; one row per key
   (newest watermark, deterministic tie-break) via a map-side-combined
   aggregate;
2. the active rows that share a key with the batch are found by a semi join,
   whose batch side Catalyst broadcasts while it is small, and meet the batch
   in a right outer join (both sides no larger than the batch);
3. each joined row is classified with a NULL-safe compare and emits, through
   one ``inline(filter(array(old, new)))``: changed -> the old row closed at
   ``as_of`` plus a new open row; new -> an open row; unchanged -> nothing.

These changes are all a silver run writes. The whole merged table, for callers
that want it as one DataFrame, comes from one full outer join instead, in
which unchanged and absent rows are emitted as they are; history (inactive
rows) passes through untouched.

All join inputs have one row per key (active rows by the SCD2 invariant, the
batch by step 1), so a hot key cannot skew a join.

``as_coded`` mode reproduces the result of the reference job, defects
included (it keeps only active rows, never re-opens changed keys, compares
with plain ``!=``; three tables only insert on the first load), in one pass.
It exists for parity checks; the reference's steps are public operators in
their own right.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalake.functions.expressions import any_differs, any_null, ts_literal
from medalake.operators.dedup import latest_per_key
from medalake.operators.quarantine import flag_quarantine
from medalake.plans.specs import TableSpec

def null_ts():
    return F.lit(None).cast("timestamp_ntz")


class MergeResult(NamedTuple):
    table: DataFrame         # the whole merged table (history + changes)
    quarantined: DataFrame   # incoming rows whose key is NULL
    changes: DataFrame       # only the rows opened and closed by this merge


def stamp(df: DataFrame, as_of, open_end: bool = True) -> DataFrame:
    """Open a version at ``as_of``. ``open_end=False`` reproduces the

    reference, which also sets the end date to the load time."""
    ts = ts_literal(as_of)
    keep = [c for c in df.columns if c not in ("effective_start_date", "effective_end_date", "is_active")]
    return df.select(*keep, ts.alias("effective_start_date"),
                     (null_ts() if open_end else ts).alias("effective_end_date"),
                     F.lit(True).alias("is_active"))


def prepare(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Source-shaped rows, with the quarantine flag when the table has one."""
    df = df.select(*spec.source_schema.fieldNames())
    return flag_quarantine(df, spec.required) if spec.quarantined else df


def empty_silver(spark, spec: TableSpec) -> DataFrame:
    """The relation a first load merges into. Catalyst knows that it is empty, and drops what joins it."""
    return spark.range(1).where(F.lit(False)).select(
        *[F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in spec.silver_schema.fields])


# --- standard ----------------------------------------------------------------

def split_batch(incoming: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(one prepared row per key, rows whose key is NULL)."""
    keys = list(spec.keys)
    inc = incoming.select(*spec.source_schema.fieldNames())
    null_key = any_null(keys)
    batch = latest_per_key(inc.filter(~null_key), keys, [spec.watermark] if spec.watermark else [])
    return prepare(batch, spec), inc.filter(null_key)


def merge_batch(current: DataFrame | None, batch: DataFrame, spec: TableSpec, as_of) -> tuple[DataFrame, DataFrame]:
    """(whole merged table, rows opened and closed) for a batch of one prepared row per key."""
    keys, cols = list(spec.keys), spec.silver_schema.fieldNames()
    ts = ts_literal(as_of)
    if current is None:
        first = stamp(batch, as_of).select(*cols)
        return first, first
    payload = [c for c in batch.columns if c not in keys]

    cur = current.select(*cols)
    history = cur.filter(~F.coalesce(F.col("is_active"), F.lit(False)))
    t = cur.filter(F.col("is_active")).select(
        *keys, *[F.col(c).alias(f"t_{c}") for c in payload], F.col("effective_start_date").alias("t_start"),
        F.col("effective_end_date").alias("t_end"), F.lit(True).alias("t_present"))
    s = batch.select(*keys, *[F.col(c).alias(f"s_{c}") for c in payload], F.lit(True).alias("s_present"))

    in_t = F.col("t_present").isNotNull()
    in_s = F.col("s_present").isNotNull()
    changed = in_t & in_s & any_differs([(f"t_{c}", f"s_{c}") for c in spec.compare], null_safe=True)
    if spec.watermark:
        late = F.coalesce(F.col(f"s_{spec.watermark}") < F.col(f"t_{spec.watermark}"), F.lit(False))
        changed = changed & ~late

    old_row = F.struct(
        *[F.col(k) for k in keys], *[F.col(f"t_{c}").alias(c) for c in payload],
        F.col("t_start").alias("effective_start_date"),
        F.when(changed, ts).otherwise(F.col("t_end")).alias("effective_end_date"),
        (~changed).alias("is_active"))
    new = F.when(in_s & (~in_t | changed), F.struct(
        *[F.col(k) for k in keys], *[F.col(f"s_{c}").alias(c) for c in payload],
        ts.alias("effective_start_date"), null_ts().alias("effective_end_date"),
        F.lit(True).alias("is_active")))

    def emit(joined: DataFrame, old_if) -> DataFrame:
        rows = F.array(F.when(old_if, old_row), new)
        return joined.select(F.inline(F.filter(rows, lambda x: x.isNotNull()))).select(*cols)

    whole = history.unionByName(emit(t.join(s, keys, "full_outer"), in_t))
    hit = t.join(s.select(*keys), keys, "left_semi")
    return whole, emit(hit.join(s, keys, "right_outer"), changed)


def scd2_merge(current: DataFrame | None, incoming: DataFrame, spec: TableSpec, as_of) -> MergeResult:
    """``current=None`` marks a first load (no committed version): every
    incoming key opens a version, so no join is planned at all.

    A row that is older than the active one by the table's watermark never
    replaces it, so late and replayed batches change nothing. With equal
    watermarks, or where one is NULL, the incoming row wins."""
    batch, quarantined = split_batch(incoming, spec)
    table, changes = merge_batch(current, batch, spec, as_of)
    return MergeResult(table, quarantined, changes)


# --- the reference's steps (as_coded) ----------------------------------------

def changed_keys(active: DataFrame, incoming: DataFrame, keys, compare,
                 null_safe: bool = True) -> DataFrame:
    """Keys of active rows whose incoming row differs in ``compare``."""
    t, s = active.alias("t"), incoming.alias("s")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    if "is_active" in active.columns:
        cond.append(F.col("t.is_active"))
    diff = any_differs([(f"t.{c}", f"s.{c}") for c in compare], null_safe)
    return t.join(s, cond, "inner").filter(diff).select(*[F.col(f"t.{k}").alias(k) for k in keys])


def expire(active: DataFrame, changed: DataFrame, keys, as_of) -> DataFrame:
    """Active rows of changed keys, closed at ``as_of``."""
    return (active.join(changed, list(keys), "left_semi")
            .withColumn("is_active", F.lit(False))
            .withColumn("effective_end_date", ts_literal(as_of)))


def subtract_positional(active: DataFrame, expired: DataFrame, order) -> DataFrame:
    """Distinct positional difference after a canonical reorder."""
    return active.select(*order).subtract(expired.select(*order))


def new_by_key(incoming: DataFrame, active: DataFrame, keys) -> DataFrame:
    """Incoming rows whose key has no active row."""
    return incoming.join(active.filter(F.col("is_active")), list(keys), "left_anti")


def new_bootstrap_only(incoming: DataFrame, active: DataFrame) -> DataFrame:
    """The reference anti-joins on the flag alone, i.e. all incoming rows

    when the target has no active row and none otherwise. Written as an
    emptiness test: the probe side is at most one row (``limit(1)``), so
    broadcasting it is bounded."""
    probe = active.filter(F.col("is_active")).select(F.lit(True).alias("_any")).limit(1)
    return (incoming.withColumn("_any", F.lit(True))
            .join(F.broadcast(probe), "_any", "left_anti").drop("_any"))


def _repeated(df: DataFrame, n: str) -> DataFrame:
    """Every row as often as ``n`` says (1 or more), in chunks, so that no array grows with a large ``n``."""
    chunk, zero, one = 65536, F.lit(0).cast("long"), F.lit(1).cast("long")
    return (df.withColumn("_chunk", F.explode(F.sequence(zero, F.expr(f"({n} - 1) DIV {chunk}"))))
            .withColumn("_at", F.explode(F.sequence(one, F.least(F.lit(chunk).cast("long"),
                                                                 F.col(n) - chunk * F.col("_chunk")))))
            .drop("_chunk", "_at", n))


def scd2_merge_as_coded(current: DataFrame, incoming: DataFrame, spec: TableSpec, as_of) -> DataFrame:
    """The reference's result as a multiset, its rows classified once.

    Its steps come down to, for the active rows A and the stamped batch B:
    each distinct row of A once (the positional difference removes nothing but
    repeats: an expired copy is inactive, an active row isn't); an expired copy
    of every row of A, repeats too, whose key has a pair of rows in A and B
    that differ by plain ``!=`` in a compared column; and the rows of B that
    are new, by key or only while A is empty.

    Whether a row of A has such a partner follows from the least and greatest
    value of each column over its key's rows in B: none differs only if both
    equal its own. So B is reduced to one row per key (map-side combined, also
    a key of very many rows), the keys of A's differing rows are found by one
    join with that, and the rows of A meet these keys in a second one, whose
    partitioning serves to count repeats. Rows without a key meet nothing: they
    are spread by a hash of their own. On a first load (A empty) no join is left."""
    keys, order = list(spec.keys), spec.silver_schema.fieldNames()
    no_key = any_null(keys)
    spread = F.when(no_key, F.xxhash64(*order)).otherwise(0).alias("_spread")
    b = stamp(prepare(incoming, spec), as_of, open_end=False).select(*order)
    a = current.filter(F.col("is_active")).select(*order)      # history dropped, as coded

    def by_key(df: DataFrame, *measures) -> DataFrame:
        # _spread is 0 here, but not as a constant: that would be taken out of the join's keys
        return df.filter(~no_key).groupBy(*keys).agg(F.min(F.lit(0).cast("long")).alias("_spread"), *measures)

    ends = by_key(b, *[f(c).alias(f"{name}_{c}") for c in spec.compare for name, f in (("_min", F.min), ("_max", F.max))])
    differs = any_differs([(c, f"{name}_{c}") for c in spec.compare for name in ("_min", "_max")], null_safe=False)
    changed = by_key(a.select(*keys, *spec.compare).join(ends.drop("_spread"), keys).filter(differs))
    on = [*keys, "_spread"]
    met = a.select("*", spread).join(changed.withColumn("_changed", F.lit(True)), on, "left")
    counted = met.groupBy(*order, "_spread", "_changed").agg(F.count(F.lit(1)).alias("_n"))

    closing = {"is_active": F.lit(False), "effective_end_date": ts_literal(as_of)}
    expired = F.struct(*[closing.get(c, F.col(c)).alias(c) for c in order], F.col("_n"))
    once = F.struct(*[F.col(c) for c in order], F.lit(1).cast("long").alias("_n"))
    both = F.array(once, F.when(F.col("_changed"), expired))
    old = _repeated(counted.select(F.inline(F.filter(both, lambda x: x.isNotNull()))), "_n")
    if spec.new_rows_as_coded == "by_key":
        return old.unionByName(b.select("*", spread).join(by_key(a), on, "left_anti").select(*order))
    return old.unionByName(new_bootstrap_only(b, a))


def merge(current: DataFrame, incoming: DataFrame, spec: TableSpec, as_of,
          mode: str = "standard") -> DataFrame:
    if mode == "as_coded":
        return scd2_merge_as_coded(current, incoming, spec, as_of)
    if mode != "standard":
        raise ValueError(f"unknown SCD2 mode {mode!r}")
    return scd2_merge(current, incoming, spec, as_of).table
