"""C6/C7 jobs: landing -> silver for the seven tables, driven by ``TableSpec``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from medalake.functions.expressions import any_null, ts_literal
from medalake.operators.refresh import from_landing, full_refresh
from medalake.operators.scd2 import empty_silver, merge, merge_batch, split_batch
from medalake.plans.specs import SILVER_ORDER, SPECS, TableSpec
from medalake.session import concurrently, delete_path
from medalake.sinks.landing import landed_batches, mark_merged, merged_batches
from medalake.sinks.tables import (COMPACTION_PREFIX, DELTA_PREFIX, Delivery, bands_in, committed_epoch,
                                   deltas_since_snapshot, read_silver, vacuum_silver, write_silver_version)
from medalake.sources.bronze import BATCH_COLUMN, read_bronze


def current_or_empty(spark: SparkSession, table_dir: str, spec: TableSpec) -> DataFrame:
    """The committed silver table, or an empty one on the first load.

    Absence is tested explicitly; any other read error propagates."""
    df = read_silver(spark, table_dir, spec.silver_schema)
    return df if df is not None else empty_silver(spark, spec)


def quarantine_rejected(spark: SparkSession, spec: TableSpec, incoming: DataFrame, silver_root: str, as_of,
                        batch: str) -> None:
    """The NULL-key rows of ``incoming``, one partition per batch, replaced as a whole: a batch that comes again
    rewrites its own rows, and nothing that was quarantined before is read. Rows tell their batch by a column, or
    are all of ``batch``."""
    _, bad = split_batch(incoming, spec)
    origin = F.col(BATCH_COLUMN) if BATCH_COLUMN in incoming.columns else F.lit(batch)
    bad = incoming.filter(any_null(spec.keys)).select(*bad.columns, ts_literal(as_of).alias("loaded_at"),
                                                      origin.alias("batch"))
    (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
     .parquet(f"{silver_root.rstrip('/')}/_quarantine/{spec.name}"))


def silver_job(spark: SparkSession, spec: TableSpec, incoming: DataFrame, silver_root: str,
               as_of, mode: str = "standard", batch: str | None = None, delivery: Delivery | None = None) -> str | None:
    """Run one silver table job on source-shaped ``incoming``; returns the new version path.

    An SCD2 run writes a delta, the rows it opens and closes; compaction and retention are separate calls
    (``maintain_silver``), so a job never deletes what a reader may be scanning. ``batch`` names the batch for the
    quarantine (default: the load time). With ``delivery``, an epoch that a version holds already writes none
    (None is returned); its quarantined rows are written again, in case the run died between the two."""
    table_dir, schema = f"{silver_root.rstrip('/')}/{spec.name}", spec.silver_schema
    batch = batch or (f"{delivery.stream}@{delivery.epoch}" if delivery else f"{as_of:%Y%m%d%H%M%S%f}")
    replayed = delivery is not None and committed_epoch(spark, table_dir, delivery.stream) >= delivery.epoch
    if spec.kind == "refresh" or mode != "standard":
        if replayed:
            return None
        if spec.kind == "refresh":
            result = full_refresh(incoming, spec, as_of, open_end=(mode == "standard"))
        else:
            result = merge(current_or_empty(spark, table_dir, spec), incoming, spec, as_of, mode)
        return write_silver_version(result, spark, table_dir, schema, delivery=delivery, buckets=spec.buckets,
                                    banded=mode == "standard")
    if replayed:
        if not incoming.filter(any_null(spec.keys)).isEmpty():
            quarantine_rejected(spark, spec, incoming, silver_root, as_of, batch)
        return None
    # NULL-key rows are counted while the merge is written; the
    # quarantine output costs a second pass only when there are any
    obs = Observation(f"null_keys_{spec.name}")
    observed = incoming.observe(obs, F.sum(F.when(any_null(spec.keys), 1).otherwise(0)).alias("bad"))
    rows, _ = split_batch(observed, spec)
    current = read_silver(spark, table_dir, schema)
    if current is None:
        path = write_silver_version(merge_batch(None, rows, spec, as_of)[1], spark, table_dir, schema, delivery=delivery,
                                    buckets=spec.buckets)
    else:
        # the batch, one row per key, is staged: it is read and reduced once, and Catalyst
        # knows its size when it plans the joins
        staged = f"{table_dir}/_staging/{uuid.uuid4().hex[:12]}"
        rows.write.parquet(staged)
        rows = spark.read.schema(rows.schema).parquet(staged)
        if spec.band and spec.band[0] in spec.keys:
            # equal keys lie in equal bands: no other folder is scanned
            current = read_silver(spark, table_dir, schema, bands=bands_in(rows, schema))
        elif spec.buckets:
            current = read_silver(spark, table_dir, schema, touching=rows.select(*spec.keys))
        path = write_silver_version(merge_batch(current, rows, spec, as_of)[1], spark, table_dir, schema, DELTA_PREFIX,
                                    delivery)
        delete_path(spark, staged)
    if (obs.get.get("bad") or 0) > 0:
        quarantine_rejected(spark, spec, incoming, silver_root, as_of, batch)
    return path


def maintain_silver(spark: SparkSession, spec: TableSpec, silver_root: str) -> int:
    """Compact a table into a snapshot and drop the versions that no reader of the last two snapshots needs.

    To be run when no reader holds an older version; returns the number of folders removed."""
    table_dir = f"{silver_root.rstrip('/')}/{spec.name}"
    current = read_silver(spark, table_dir, spec.silver_schema)
    if current is None:
        return 0
    if deltas_since_snapshot(spark, table_dir):
        write_silver_version(current, spark, table_dir, spec.silver_schema, COMPACTION_PREFIX, buckets=spec.buckets)
    return vacuum_silver(spark, table_dir)


def silver_from_landing(spark: SparkSession, landing_root: str, silver_root: str, as_of,
                        tables=SILVER_ORDER, mode: str = "standard", parallel: int = 4) -> dict[str, str]:
    """All silver jobs, ``parallel`` tables at a time, reading the landed batches.

    Standard: the batches that no earlier run has committed, all of them for an
    SCD2 table and the newest full load for a refreshed one; a table without
    new batches keeps its version. The ledger is written after the version, so
    a run that dies between the two merges the same batches again, which
    changes nothing. As coded: every batch that lies in the landing area."""
    def one(name: str) -> str | None:
        spec = SPECS[name]
        paths, fresh = None, []
        if mode == "standard":
            merged = merged_batches(spark, landing_root, name)
            fresh = [b for b in landed_batches(spark, landing_root, name) if b not in merged]
            if not fresh:
                return None
            paths = [f"{landing_root.rstrip('/')}/{name}/{b}"
                     for b in (fresh[-1:] if spec.kind == "refresh" else fresh)]
        incoming = from_landing(read_bronze(spark, landing_root, name, paths, with_batch=True), spec)
        version = silver_job(spark, spec, incoming, silver_root, as_of, mode)
        mark_merged(spark, landing_root, name, fresh)
        return version

    # the tables' jobs don't depend on each other
    done = concurrently(spark, one, tables, parallel)
    return {name: version for name, version in zip(tables, done) if version}


def active(df: DataFrame) -> DataFrame:
    """P5: current versions only."""
    return df.filter(F.col("is_active"))
