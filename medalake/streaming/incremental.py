"""Incremental silver loads driven by Structured Streaming.

The landing area is a file-stream source: the stream's checkpoint records
which landed files were already merged, so each run picks up only batches
that arrived since the last one (the reference tracks this with its archive
step). ``trigger(availableNow=True)`` makes a run a bounded job that
processes everything available and stops, so it can be scheduled like the
batch jobs. Each micro-batch goes through the same silver job (SCD2 merge or
full refresh) and commits a new silver version.

Delivery is exactly once: a version carries the id of the streaming query (kept
in its checkpoint) and the epoch, committed in one step. If a run dies after
the silver version is written but before the checkpoint commits, the
micro-batch is replayed, its epoch is found among the versions, and no version
is written. A query started anew on an empty checkpoint has another id.
Checkpoints live under the cluster's shared ``spark.checkpoint.dir`` unless a
location is given.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from medalake import schemas
from medalake.operators.refresh import from_landing
from medalake.plans.silver import silver_job
from medalake.plans.specs import TableSpec
from medalake.session import checkpoint_root
from medalake.sinks.landing import landed_batches, landed_glob, mark_merged, merged_batches
from medalake.sinks.tables import Delivery
from medalake.sources.bronze import read_bronze


def landing_stream(spark: SparkSession, landing_root: str, table: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The landed JSON of ``table`` as an unbounded source, declared schema."""
    r = spark.readStream.schema(schemas.BRONZE[table])
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(landed_glob(landing_root, table))


def stream_checkpoint(spark: SparkSession, silver_root: str, table: str) -> str:
    """A folder named by a hash of the whole silver path, so no two roots share one."""
    name = hashlib.sha256(silver_root.rstrip("/").encode()).hexdigest()
    return f"{checkpoint_root(spark).rstrip('/')}/medalake/streams/{name}/{table}"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint, across its runs."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def run_incremental_silver(spark: SparkSession, spec: TableSpec, landing_root: str,
                           silver_root: str, as_of, checkpoint: str | None = None,
                           mode: str = "standard", max_files_per_trigger: int | None = None) -> int:
    """Merge every landed batch not yet processed into the silver table.

    ``max_files_per_trigger`` bounds a micro-batch, so a large backlog of an
    SCD2 table is merged in several bounded steps (``availableNow`` honours
    it; an older row never replaces a newer one, whatever the file order). A
    refreshed table is rebuilt once, from the whole of the newest full load:
    the bound doesn't apply to it.
    Returns the number of micro-batches that committed a version."""
    merged = []
    landed = landed_batches(spark, landing_root, spec.name)
    refresh = spec.kind == "refresh"
    checkpoint = checkpoint or stream_checkpoint(spark, silver_root, spec.name)

    def merge_batch(batch: DataFrame, epoch_id: int) -> None:
        incoming = from_landing(batch, spec)
        if incoming.isEmpty():
            return
        if refresh:
            newest = f"{landing_root.rstrip('/')}/{spec.name}/{landed_batches(spark, landing_root, spec.name)[-1]}"
            incoming = from_landing(read_bronze(spark, landing_root, spec.name, newest), spec)
        delivery = Delivery(stream_id(spark, checkpoint), epoch_id)
        if silver_job(batch.sparkSession, spec, incoming, silver_root, as_of, mode, delivery=delivery):
            merged.append(epoch_id)

    q = (landing_stream(spark, landing_root, spec.name, None if refresh else max_files_per_trigger).writeStream
         .foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    # everything that lay there at the start is merged now
    known = merged_batches(spark, landing_root, spec.name)
    mark_merged(spark, landing_root, spec.name, [b for b in landed if b not in known])
    return len(merged)
