"""Incremental silver through Structured Streaming (availableNow runs)."""

import datetime as dt

from medalake import schemas
from medalake.operators.refresh import from_landing
from medalake.plans.silver import silver_job
from medalake.plans.specs import SPECS
from medalake.sinks.landing import land_json
from medalake.sinks.tables import committed_versions, read_silver
from medalake.sources.bronze import read_bronze
from medalake.streaming import run_incremental_silver

U = dt.datetime(2024, 1, 1)
T0, T1, T2 = dt.datetime(2024, 6, 1), dt.datetime(2024, 7, 1), dt.datetime(2024, 8, 1)
SPEC = SPECS["customers"]


def rows(spark, data):
    return spark.createDataFrame(data, schemas.SOURCE["customers"])


def test_each_run_merges_only_new_batches(spark, root):
    landing, silver, ckpt = f"{root}/landing", f"{root}/silver", f"{root}/ckpt"
    land_json(rows(spark, [(1, "a", "a@x", U), (2, "b", "b@x", U)]), landing, "customers", T0)
    assert run_incremental_silver(spark, SPEC, landing, silver, T0, ckpt) == 1
    land_json(rows(spark, [(1, "a2", "a@x", U), (3, "c", "c@x", U)]), landing, "customers", T1)
    assert run_incremental_silver(spark, SPEC, landing, silver, T1, ckpt) == 1
    # nothing new landed: the run merges nothing and commits no version
    assert run_incremental_silver(spark, SPEC, landing, silver, T2, ckpt) == 0
    assert committed_versions(spark, f"{silver}/customers") == [1, 2]
    cur = read_silver(spark, f"{silver}/customers", SPEC.silver_schema)
    got = sorted((r.customer_id, r.name, r.is_active) for r in cur.collect())
    assert got == [(1, "a", False), (1, "a2", True), (2, "b", True), (3, "c", True)]


def test_replayed_batch_is_a_noop(spark, root):
    landing, silver = f"{root}/landing", f"{root}/silver"
    path = land_json(rows(spark, [(1, "a", "a@x", U)]), landing, "customers", T0)
    batch = from_landing(read_bronze(spark, landing, "customers", path), SPEC)
    silver_job(spark, SPEC, batch, silver, T0)
    first = sorted(map(tuple, read_silver(spark, f"{silver}/customers", SPEC.silver_schema).collect()))
    silver_job(spark, SPEC, batch, silver, T1)      # the same micro-batch delivered again
    again = sorted(map(tuple, read_silver(spark, f"{silver}/customers", SPEC.silver_schema).collect()))
    assert first == again


def test_refresh_table_is_rebuilt_whole_whatever_the_trigger(spark, root):
    spec = SPECS["products"]
    data = [(i, f"p{i}", 1, 1.0, U) for i in range(40)]
    df = spark.createDataFrame(data, schemas.SOURCE["products"]).repartition(4)
    land_json(df, f"{root}/landing", "products", T0)
    run_incremental_silver(spark, spec, f"{root}/landing", f"{root}/silver", T0, f"{root}/ckpt", max_files_per_trigger=1)
    assert read_silver(spark, f"{root}/silver/products", spec.silver_schema).count() == 40


def test_streams_of_roots_with_equal_ends_have_their_own_checkpoints(spark):
    from medalake.streaming.incremental import stream_checkpoint
    tail = "x" * 100
    assert stream_checkpoint(spark, f"/a/{tail}", "t") != stream_checkpoint(spark, f"/b/{tail}", "t")
    assert stream_checkpoint(spark, "/a/b_c", "t") != stream_checkpoint(spark, "/a_b/c", "t")


def test_backlog_is_merged_in_bounded_micro_batches(spark, root):
    landing, silver, ckpt = f"{root}/landing", f"{root}/silver", f"{root}/ckpt"
    land_json(rows(spark, [(1, "a", "a@x", U)]).repartition(1), landing, "customers", T0)
    land_json(rows(spark, [(2, "b", "b@x", U)]).repartition(1), landing, "customers", T1)
    n = run_incremental_silver(spark, SPEC, landing, silver, T2, ckpt, max_files_per_trigger=1)
    assert n == 2
    assert read_silver(spark, f"{silver}/customers", SPEC.silver_schema).count() == 2


def test_replayed_epoch_writes_no_version(spark, root, monkeypatch):
    """A run that dies between the version and the checkpoint's commit delivers its epoch again."""
    import pytest

    from medalake.plans.silver import maintain_silver
    from medalake.sinks.tables import committed_epoch, versions
    from medalake.streaming import incremental as I
    landing, silver, ckpt = f"{root}/landing", f"{root}/silver", f"{root}/ckpt"
    land_json(rows(spark, [(1, "a", "a@x", U), (None, "n", "n@x", U)]), landing, "customers", T0)
    real = I.silver_job

    def dies_afterwards(*a, **k):
        real(*a, **k)
        raise OSError("lost before the checkpoint commits")

    with monkeypatch.context() as m:
        m.setattr(I, "silver_job", dies_afterwards)
        with pytest.raises(Exception):
            run_incremental_silver(spark, SPEC, landing, silver, T0, ckpt)
    table = f"{silver}/customers"
    assert committed_versions(spark, table) == [1]
    stream = I.stream_id(spark, ckpt)
    assert committed_epoch(spark, table, stream) == 0 and committed_epoch(spark, table, "00ff") == -1
    assert run_incremental_silver(spark, SPEC, landing, silver, T1, ckpt) == 0      # delivered again, skipped
    assert committed_versions(spark, table) == [1]
    assert [r.effective_start_date for r in read_silver(spark, table, SPEC.silver_schema).collect()] == [T0]
    assert spark.read.parquet(f"{silver}/_quarantine/customers").count() == 1
    # the next epoch counts; retention keeps the stream's newest version
    land_json(rows(spark, [(1, "b", "a@x", U)]), landing, "customers", T1)
    assert run_incremental_silver(spark, SPEC, landing, silver, T1, ckpt) == 1
    maintain_silver(spark, SPEC, silver)
    silver_job(spark, SPEC, rows(spark, [(2, "c", "c@x", U)]), silver, T2)
    maintain_silver(spark, SPEC, silver)
    assert committed_epoch(spark, table, stream) == 1
    assert [v.number for v in versions(spark, table)][0] == 2
    # a query begun anew on another checkpoint is another stream: its epoch 0 is new
    assert run_incremental_silver(spark, SPEC, landing, silver, T2, f"{root}/other") == 1


def test_replayed_refresh_writes_no_version(spark, root):
    from medalake.sinks.tables import Delivery
    spec = SPECS["products"]
    df = spark.createDataFrame([(1, "p", 1, 1.0, U)], schemas.SOURCE["products"])
    assert silver_job(spark, spec, df, root, T0, delivery=Delivery("0a-1", 3))
    assert silver_job(spark, spec, df, root, T1, delivery=Delivery("0a-1", 3)) is None
    assert silver_job(spark, spec, df, root, T1, delivery=Delivery("0a-1", 4))
    assert committed_versions(spark, f"{root}/products") == [1, 2]
