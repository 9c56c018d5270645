"""Landing: JSON round trip, explicit NULLs, empty batches, watermarks,
archive, failure isolation, reviews."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from medalake import schemas
from medalake.functions.expressions import file_date
from medalake.plans import landing as L
from medalake.plans.config import config_frame
from medalake.plans.medallion import lake_paths
from medalake.plans.silver import silver_from_landing
from medalake.plans.specs import SPECS
from medalake.session import list_dir
from medalake.sinks import landing as K
from medalake.sources.bronze import read_bronze
from seeds import frames

T0 = dt.datetime(2024, 6, 1)
T1 = dt.datetime(2024, 7, 1)


def test_json_landing_writes_nulls_and_epoch_ms(spark, root):
    df = spark.createDataFrame([(1, "a", None, dt.datetime(2024, 1, 1, 0, 0, 0, 123000))],
                               schemas.SOURCE["customers"])
    path = K.land_json(df, root, "customers", T0)
    assert path.endswith("customers/customers_01062024.json")
    line = spark.read.text(path).first()[0]
    rec = json.loads(line)
    assert rec == {"customer_id": 1, "name": "a", "email": None, "updated_at": 1704067200123}


def test_empty_batch_reads_as_empty_declared_schema(spark, root):
    empty = spark.createDataFrame([], schemas.SOURCE["orders"])
    path = K.land_json(empty, root, "orders", T0)
    df = read_bronze(spark, root, "orders", path)
    assert df.count() == 0 and df.schema == schemas.BRONZE["orders"]


def test_watermark_lookup_default_and_standard_vs_as_coded(spark):
    audit = spark.createDataFrame([
        ("orders", "Incremental", 5, T1, "SUCCESS", "db", T0),
        ("orders", "Incremental", 0, dt.datetime(2024, 8, 1), "FAILED", "db", None),
    ], schemas.AUDIT)
    names = spark.createDataFrame([("orders",), ("never",)], "tablename string")
    std = {r.tablename: r.latest_watermark for r in L.latest_watermarks(audit, names).collect()}
    assert std == {"orders": T0, "never": dt.datetime(1900, 1, 1)}
    ac = {r.tablename: r.latest_watermark for r in L.latest_watermarks(audit, names, as_coded=True).collect()}
    assert ac["orders"] == dt.datetime(2024, 8, 1)


def test_load_mode_dispatch(spark):
    assert [L.load_mode(x) for x in ("Full Load", "INCREMENTAL", " incremental ", "delta", None)] == [
        "full", "incremental", "incremental", "invalid", "invalid"]
    cfg = L.with_load_mode(config_frame(spark)).select("tablename", "load_mode").collect()
    assert dict(cfg)["orders"] == "incremental" and dict(cfg)["products"] == "full"


def test_file_date_expression(spark):
    df = spark.createDataFrame([("s3://b/landing/orders/orders_27032025.json/part-0001.json",),
                                ("orders_01062024.json",)], "p string")
    got = [r[0] for r in df.select(file_date("p")).collect()]
    assert got == [dt.date(2025, 3, 27), dt.date(2024, 6, 1)]


def test_ingest_all_isolates_failures_and_archives(spark, root):
    paths = lake_paths(root)
    seeds = frames(spark)
    rows = [("r", "retailer_db", "customers", "Incremental", "updated_at", "1", "x"),
            ("r", "retailer_db", "broken", "Full Load", None, "1", "x"),
            ("r", "retailer_db", "orders", "Full Load", None, "0", "x"),
            ("r", "retailer_db", "order_items", "Full Load", None, "1", "x")]
    log = L.ingest_all(spark, config_frame(spark, rows), lambda t: seeds[t], paths, T0)
    events = [(e[1], e[3]) for e in log.entries]
    assert ("ERROR", "broken") in events
    assert not any(t == "orders" for _, t in events)
    audit = spark.read.schema(schemas.AUDIT).parquet(paths.audit)
    assert {r.tablename: r.record_count for r in audit.collect()} == {"customers": 10, "order_items": 10}
    # second day, silver has committed day 1: the incremental extract sees nothing new, day 1 is archived
    for t in ("customers", "order_items"):
        K.mark_merged(spark, paths.landing, t, [f"{t}_01062024.json"])
    L.ingest_all(spark, config_frame(spark, rows), lambda t: seeds[t], paths, T1)
    assert list_dir(spark, f"{paths.landing}/customers") == ["customers_01072024.json"]
    assert read_bronze(spark, paths.landing, "customers").count() == 0
    arch = L.read_archive(spark, paths.archive, "customers")
    assert arch.count() == 10
    assert {(r.year, r.month, r.day) for r in arch.collect()} == {("2024", "06", "01")}


def test_run_log_saved_twice(spark, root):
    log = L.RunLog(T0)
    log.event("INFO", "hello")
    log.save(spark, f"{root}/logs", f"{root}/json")
    assert spark.read.schema(schemas.RUN_LOG).parquet(f"{root}/logs").count() == 1
    assert list_dir(spark, f"{root}/json") == ["pipeline_log_20240601000000.json"]
    L.RunLog(T0).save(spark, f"{root}/empty")     # empty log: nothing written
    assert list_dir(spark, f"{root}/empty") == []


def test_reviews_batch(spark, root):
    payload = spark.createDataFrame([("a", 1, 2, 5, "good", "2024-06-01"), ("b", 2, None, 1, "bad", "2024-06-01")],
                                    schemas.REVIEWS)
    ppath = f"{root}/payload"
    payload.write.json(ppath)
    n = L.land_reviews_batch(spark, ppath, f"{root}/landing", T0)
    assert n == 2
    assert "load_date=20240601" in list_dir(spark, f"{root}/landing/customer_reviews")
    got = spark.read.schema(schemas.REVIEWS).parquet(f"{root}/landing/customer_reviews/load_date=20240601")
    assert got.count() == 2


def test_reviews_missing_payload_raises(spark, root):
    import pytest
    with pytest.raises(Exception):
        L.land_reviews_batch(spark, f"{root}/nothing-here", f"{root}/landing", T0)


def test_config_csv_roundtrip(spark, root):
    from medalake.plans.config import write_config_csv
    path = write_config_csv(config_frame(spark), f"{root}/config")
    cfg = L.read_config(spark, path)
    assert cfg.count() == 7 and L.active_tables(cfg).count() == 7
    assert cfg.filter(F.col("watermark").isNull()).count() == 2
    assert os.path.basename(path) == "config"


def test_batch_day_matches_column_rule(spark):
    assert L.batch_day("orders_27032025.json") == dt.date(2025, 3, 27)
    df = spark.createDataFrame([("x/orders_27032025.json",)], "p string")
    assert df.select(file_date("p")).first()[0] == L.batch_day("orders_27032025.json")


def test_archive_same_day_rerun_replaces(spark, root):
    seeds = frames(spark)
    paths = lake_paths(root)
    for _ in range(2):   # the same day archived twice
        K.land_json(seeds["customers"], paths.landing, "customers", T0)
        L.archive_landed(spark, paths.landing, paths.archive, "customers")
    assert L.read_archive(spark, paths.archive, "customers").count() == 10
    assert list_dir(spark, f"{paths.landing}/customers") == []


def test_reviews_payload_as_json_array_pages(spark, root):
    import os
    from medalake.session import checkpoint_root
    pages = f"{root}/pages"
    local = pages.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    for i, recs in enumerate([[{"id": "a", "customer_id": 1, "product_id": 2, "rating": 5,
                                "review_text": "good", "review_date": "2024-06-01"}],
                              [{"id": "b", "customer_id": 2, "product_id": None, "rating": 1,
                                "review_text": "bad", "review_date": "2024-06-01"},
                               {"id": "c", "customer_id": 3, "product_id": 4, "rating": 3,
                                "review_text": "ok", "review_date": "2024-06-02"}]]):
        with open(f"{local}/page-{i}.json", "w") as f:
            json.dump(recs, f)
    df = K.read_payload(spark, pages, multi_line=True)
    assert sorted(r.id for r in df.collect()) == ["a", "b", "c"]
    assert df.schema == schemas.REVIEWS
    assert checkpoint_root(spark)


def test_partitioned_jdbc_read_needs_bounds(spark):
    import pytest
    from medalake.sources.jdbc import read_table
    with pytest.raises(ValueError):
        read_table(spark, {"url": "jdbc:derby:memory:x;create=true"}, "t", partition_column="id")


def test_a_batch_is_archived_by_one_rename(spark, root, monkeypatch):
    """However many files it has; a run that dies before the rename leaves the batch where it was."""
    paths = lake_paths(root)
    K.land_json(frames(spark)["customers"].repartition(7), paths.landing, "customers", T0)
    real, calls = L.hadoop_fs, []

    class Counting:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            calls.append(name)
            if calls == ["mkdirs", "delete", "rename"]:
                raise OSError("lost")
            return getattr(self.fs, name)

    monkeypatch.setattr(L, "hadoop_fs", lambda *a: (Counting(real(*a)[0]), real(*a)[1]))
    with pytest.raises(OSError):
        L.archive_landed(spark, paths.landing, paths.archive, "customers")
    assert K.landed_batches(spark, paths.landing, "customers") == ["customers_01062024.json"]
    L.archive_landed(spark, paths.landing, paths.archive, "customers")
    assert calls == ["mkdirs", "delete", "rename"] * 2
    got = L.read_archive(spark, paths.archive, "customers")
    assert got.count() == 10 and got.columns[-3:] == ["year", "month", "day"]
    assert K.landed_batches(spark, paths.landing, "customers") == []


def test_as_coded_on_three_equal_days(spark, root):
    """Each day archives first, so 20 products each day and one more day's gold rows appended; nothing is extracted
    incrementally after the first day."""
    from medalake.plans.config import RETAILER_CONFIG
    from medalake.plans.gold import read_current
    from medalake.plans.medallion import run_medallion
    from seeds import LOAD
    seeds, config = frames(spark), config_frame(spark, RETAILER_CONFIG)
    for day in range(3):
        gold = run_medallion(spark, lambda t: seeds[t], root, LOAD + dt.timedelta(days=day), config=config, mode="as_coded")
        assert gold.count() == 9 * (day + 1)
        assert read_current(spark, f"{root}/silver", "products").count() == 20
        assert read_current(spark, f"{root}/silver", "categories").count() == 10
        assert len(K.landed_batches(spark, f"{root}/landing", "products")) == 1
    audit = spark.read.schema(schemas.AUDIT).parquet(f"{root}/audit_log")
    counts = sorted((r.tablename, r.record_count) for r in audit.filter("load_type = 'Incremental'").collect())
    assert counts == sorted((t, n) for t in ("customers", "orders", "order_items") for n in (10, 0, 0))
    assert L.read_archive(spark, f"{root}/archive", "products").count() == 40


def _silver_keys(spark, root):
    from medalake.sinks.tables import read_silver
    return sorted(r.customer_id for r in read_silver(spark, f"{root}/silver/customers",
                                                     SPECS["customers"].silver_schema).filter("is_active").collect())


def _customers(spark, data):
    return spark.createDataFrame(data, schemas.SOURCE["customers"])


@pytest.mark.parametrize("second", [dt.timedelta(hours=1), dt.timedelta(days=1)])
def test_two_ingests_before_silver_lose_nothing(spark, root, second):
    """The watermark has moved past the first batch, so it must stay in the landing area until silver has it."""
    paths = lake_paths(root)
    cfg = {"tablename": "customers", "loadtype": "Incremental", "watermark": "updated_at", "datasource": "d"}
    first = [(1, "a", "a@x", dt.datetime(2024, 1, 1))]
    L.ingest_table(spark, _customers(spark, first), cfg, paths, T0, L.RunLog(T0))
    both = [*first, (2, "b", "b@x", dt.datetime(2024, 1, 2))]
    L.ingest_table(spark, _customers(spark, both), cfg, paths, T0 + second, L.RunLog(T0))
    silver_from_landing(spark, paths.landing, f"{root}/silver", T1, tables=["customers"])
    assert _silver_keys(spark, root) == [1, 2]
    # merged batches are archived by the next ingest, and silver without new batches keeps its version
    L.ingest_table(spark, _customers(spark, both), cfg, paths, T1, L.RunLog(T1))
    assert len(K.landed_batches(spark, paths.landing, "customers")) == 1
    assert L.read_archive(spark, paths.archive, "customers").count() == 2
    silver_from_landing(spark, paths.landing, f"{root}/silver", T1, tables=["customers"])
    assert silver_from_landing(spark, paths.landing, f"{root}/silver", T1, tables=["customers"]) == {}
    assert _silver_keys(spark, root) == [1, 2]


def test_refresh_takes_the_newest_full_load(spark, root):
    from medalake.sinks.tables import read_silver
    seeds = frames(spark)
    for hours in (0, 5):
        K.land_json(seeds["products"], f"{root}/landing", "products", T0 + dt.timedelta(hours=hours))
    silver_from_landing(spark, f"{root}/landing", f"{root}/silver", T1, tables=["products"])
    assert read_silver(spark, f"{root}/silver/products", SPECS["products"].silver_schema).count() == 20


def test_reviews_payload_shapes(spark, root):
    rec = {"id": "a", "customer_id": 1, "product_id": 2, "rating": 5, "review_text": "good", "review_date": "2024-06-01"}
    for name, text, n in (("indented", json.dumps([rec], indent=2), 1), ("array", json.dumps([rec, rec]), 2),
                          ("lines", json.dumps(rec) + "\n" + json.dumps(rec) + "\n", 2)):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{root}/{name}")
        assert L.land_reviews_batch(spark, f"{root}/{name}", f"{root}/landing-{name}", T0) == n
        got = spark.read.schema(schemas.REVIEWS).parquet(f"{root}/landing-{name}/customer_reviews")
        assert [r.id for r in got.collect()] == ["a"] * n
    spark.createDataFrame([("no json",)], "value string").write.text(f"{root}/bad")
    with pytest.raises(Exception):
        L.land_reviews_batch(spark, f"{root}/bad", f"{root}/landing-bad", T0)


def test_as_coded_watermark_is_any_rows_load_time(spark, root):
    audit = [("t", "Incremental", 1, T0, "SUCCESS", "d", dt.datetime(2024, 1, 1)),
             ("t", "Incremental", 0, T1, "FAILED", "other", None)]
    L.append_audit(spark.createDataFrame(audit, schemas.AUDIT), f"{root}/audit")
    assert L.lookup_watermark(spark, f"{root}/audit", "t", "d") == dt.datetime(2024, 1, 1)
    assert L.lookup_watermark(spark, f"{root}/audit", "t", None, as_coded=True) == T1


def test_watermark_comes_from_partitions_and_footers(spark, root):
    """No audit row is read: the scan is pruned to the table's partitions and its maximum is pushed down."""
    rows = [(t, "Incremental", 1, T0, s, d, w) for d in ("d1", "d2") for t in ("a", "b")
            for s, w in (("SUCCESS", dt.datetime(2024, 1, 2, 3, 4, 5, 678901)), ("FAILED", T1), ("SUCCESS", None))]
    for _ in range(2):
        L.append_audit(spark.createDataFrame(rows, schemas.AUDIT), f"{root}/audit")
    assert L.lookup_watermark(spark, f"{root}/audit", "a", "d1") == dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert L.lookup_watermark(spark, f"{root}/audit", "none", "d1") == dt.datetime(1900, 1, 1)
    # runs that found nothing: alone, and after one that did
    nothing = [(t, "Incremental", 0, T1, "SUCCESS", "d1", None) for t in ("a", "empty")]
    L.append_audit(spark.createDataFrame(nothing, schemas.AUDIT).coalesce(1), f"{root}/audit")
    assert L.lookup_watermark(spark, f"{root}/audit", "empty", "d1") == dt.datetime(1900, 1, 1)
    assert L.lookup_watermark(spark, f"{root}/audit", "a", "d1") == dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert L.lookup_watermark(spark, f"{root}/audit", "empty", as_coded=True) == T1
    plan = L.watermark_state(spark, f"{root}/audit", "a", "d1")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(high_us)]" in plan, plan
    partitions = plan.split("PartitionFilters: ")[1]
    assert all(c in partitions for c in ("datasource", "tablename", "status"))
    back = spark.read.schema(schemas.AUDIT).parquet(f"{root}/audit")
    assert back.count() == 26 and {r.datasource for r in back.collect()} == {"d1", "d2"}
    # the session itself is as it was
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_item_ids_of_large_part_keys_do_not_meet(spark, root):
    from medalake.sources import adapters as A
    from pyspark.sql import functions as F
    cols = "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, " \
           "l_extendedprice double, l_shipdate timestamp_ntz"
    rows = [(1, 1, p, s, 1.0, 1.0, T0) for p in (5, 100005, 2_000_000_000) for s in (3, 10003)]
    spark.createDataFrame(rows + rows[:1], cols).write.parquet(f"{root}/lineitem.parquet")
    got = A.order_items(spark, root, dedup=True)
    assert got.count() == 6 and got.select("order_item_id").distinct().count() == 6
    assert got.filter(F.col("order_item_id") <= 0).count() == 0


def test_item_ids_of_large_line_numbers_do_not_meet(spark, root):
    """Line 10 of order 1 and line 0 of order 2 are two items; a line number without a place fails."""
    from medalake.sources import adapters as A
    cols = "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, " \
           "l_extendedprice double, l_shipdate timestamp_ntz"
    rows = [(1, 10, 5, 3, 1.0, 1.0, T0), (2, 0, 5, 3, 1.0, 1.0, T0), (1, 999, 5, 3, 1.0, 1.0, T0)]
    spark.createDataFrame(rows, cols).write.parquet(f"{root}/lineitem.parquet")
    got = A.order_items(spark, root, dedup=True).collect()
    assert len({r.order_item_id for r in got}) == len(got) == 3 and sorted(r.order_id for r in got) == [1, 1, 2]
    spark.createDataFrame([(1, 1000, 5, 3, 1.0, 1.0, T0)], cols).write.parquet(f"{root}/far/lineitem.parquet")
    with pytest.raises(Exception, match="more lines in an order than ids"):
        A.order_items(spark, f"{root}/far", dedup=True).collect()


def test_tables_run_concurrently_in_stated_order_and_failures_surface(spark):
    import threading

    import pytest

    from medalake.session import concurrently
    meet = threading.Barrier(3, timeout=60)

    def job(n):
        meet.wait()                     # passes only if three jobs run at once
        return spark.range(n).count()

    assert concurrently(spark, job, [3, 1, 2], 3) == [3, 1, 2]
    ended = []

    def failing(n):
        if n == 0:
            raise ValueError("first")
        ended.append(n)

    with pytest.raises(ValueError, match="first"):
        concurrently(spark, failing, [0, 1, 2], 2)
    assert sorted(ended) == [1, 2]


def test_landed_files_are_packed_and_bounded(spark, root, monkeypatch):
    import glob
    import gzip
    monkeypatch.setattr(K, "ROWS_IN_FILE", 400)
    rows = spark.range(1000, numPartitions=1).selectExpr(
        "id AS order_id", "id AS customer_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS order_date", "1.5D AS total_amount",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS updated_at")
    path = K.land_json(rows, root, "orders", T0)
    files = glob.glob(f"{path.removeprefix('file:')}/part-*")
    texts = [gzip.open(f, "rt").read() for f in files]
    assert sorted(t.count("\n") for t in texts) == [200, 400, 400]
    assert 5 * sum(map(os.path.getsize, files)) < sum(map(len, texts))
    got = read_bronze(spark, root, "orders", path)
    assert got.count() == 1000 and got.select("order_id").distinct().count() == 1000
