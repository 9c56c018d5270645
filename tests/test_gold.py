"""Gold job: idempotent reruns (standard) vs appends (as coded); options."""

from medalake.operators.sales import sales_summary
from medalake.plans.gold import gold_job
from medalake.plans.silver import silver_job
from medalake.plans.specs import SPECS
from medalake.sinks.gold import read_gold
from seeds import LOAD, frames


def _silver(spark, root):
    for name, df in frames(spark).items():
        silver_job(spark, SPECS[name], df, f"{root}/silver", LOAD)
    return f"{root}/silver"


def test_standard_rerun_is_idempotent_and_as_coded_appends(spark, root):
    silver = _silver(spark, root)
    gold_job(spark, silver, f"{root}/gold")
    gold_job(spark, silver, f"{root}/gold")
    assert read_gold(spark, f"{root}/gold").count() == 9
    gold_job(spark, silver, f"{root}/gold_ac", mode="as_coded")
    gold_job(spark, silver, f"{root}/gold_ac", mode="as_coded")
    assert read_gold(spark, f"{root}/gold_ac").count() == 18


def test_exclude_quarantined_and_inactive_orders(spark):
    f = frames(spark)
    orders = f["orders"].selectExpr("*", "order_id <> 1001 AS is_active", "order_id = 1002 AS is_quarantined")
    out = sales_summary(orders, f["order_items"], f["products"], f["categories"], exclude_quarantined=True)
    names = {r.product_name for r in out.collect()}
    assert "Laptop" not in names                # order 1001 inactive
    assert "T-Shirt" not in names               # 1001 inactive, 1002 quarantined
    assert out.count() == 7


def test_incremental_gold_equals_full_rebuild(spark, root):
    import datetime as dt

    from medalake import schemas
    silver = _silver(spark, root)
    inc_dir, T1 = f"{root}/gold_inc", LOAD + dt.timedelta(days=40)
    gold_job(spark, silver, inc_dir, as_of=LOAD, incremental=True)          # first build: full
    assert read_gold(spark, inc_dir).count() == 9
    # second run: order 1001 moves to another month, one item changes quantity
    moved = [(1001, 1, T1, 1020.0, T1)]
    silver_job(spark, SPECS["orders"], spark.createDataFrame(moved, schemas.SOURCE["orders"]), silver, T1)
    item = [(3, 1002, 102, 5, 20.0, T1)]
    silver_job(spark, SPECS["order_items"], spark.createDataFrame(item, schemas.SOURCE["order_items"]),
               silver, T1)
    inc = gold_job(spark, silver, inc_dir, as_of=T1, incremental=True)
    full = gold_job(spark, silver, f"{root}/gold_full")
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, full.collect()))
    assert {r.order_date for r in inc.collect()} == {LOAD.date(), T1.date()}
    # nothing touched at a later time: nothing recomputed, table unchanged
    again = gold_job(spark, silver, inc_dir, as_of=T1 + dt.timedelta(days=1), incremental=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, full.collect()))


def test_incremental_gold_rebuilds_when_dimensions_change(spark, root):
    import datetime as dt

    from medalake import schemas
    from seeds import PRODUCTS
    silver = _silver(spark, root)
    inc_dir, T1 = f"{root}/gold_inc", LOAD + dt.timedelta(days=1)
    gold_job(spark, silver, inc_dir, as_of=LOAD, incremental=True)
    renamed = [(i, "Notebook" if i == 101 else n, c, p, T1) for i, n, c, p in PRODUCTS]
    silver_job(spark, SPECS["products"], spark.createDataFrame(renamed, schemas.SOURCE["products"]),
               silver, T1)
    inc = gold_job(spark, silver, inc_dir, as_of=T1, incremental=True)
    full = gold_job(spark, silver, f"{root}/gold_full")
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, full.collect()))
    assert "Notebook" in {r.product_name for r in inc.collect()}


def test_a_run_that_dies_leaves_the_last_build(spark, root, monkeypatch):
    import datetime as dt

    import pytest

    from medalake import schemas
    from medalake.plans import gold as G
    from medalake.sinks.gold import newest_build
    silver, inc, T1 = _silver(spark, root), f"{root}/gold_inc", LOAD + dt.timedelta(days=40)
    before = sorted(map(tuple, gold_job(spark, silver, inc, incremental=True).collect()))
    build = newest_build(spark, inc)
    silver_job(spark, SPECS["orders"], spark.createDataFrame([(1001, 1, T1, 10.0, T1)], schemas.SOURCE["orders"]),
               silver, T1)

    def die(*a):
        raise OSError("lost before publishing")

    with monkeypatch.context() as m:
        m.setattr(G, "publish", die)
        with pytest.raises(OSError):
            gold_job(spark, silver, inc, incremental=True)
    assert newest_build(spark, inc) == build                    # every month as it was, state included
    assert sorted(map(tuple, read_gold(spark, inc).collect())) == before
    assert _same(gold_job(spark, silver, inc, incremental=True), gold_job(spark, silver, f"{root}/full"))


def test_a_reader_keeps_its_build_while_the_next_one_is_published(spark, root):
    import datetime as dt

    from medalake import schemas
    from medalake.sinks.gold import builds, vacuum_gold
    silver, inc, T1 = _silver(spark, root), f"{root}/gold_inc", LOAD + dt.timedelta(days=40)
    old = gold_job(spark, silver, inc, incremental=True)        # planned, not yet read
    silver_job(spark, SPECS["orders"], spark.createDataFrame([(1001, 1, T1, 10.0, T1)], schemas.SOURCE["orders"]),
               silver, T1)
    new = gold_job(spark, silver, inc, incremental=True)
    assert old.count() == 9 and {r.order_date for r in old.collect()} == {LOAD.date()}
    assert {r.order_date for r in new.collect()} == {LOAD.date(), T1.date()}
    for day in range(2):                                        # two more builds, so the first one's folders go
        silver_job(spark, SPECS["orders"], spark.createDataFrame(
            [(1001, 2 + day, T1, 10.0, T1 + dt.timedelta(days=1 + day))], schemas.SOURCE["orders"]), silver, T1)
        gold_job(spark, silver, inc, incremental=True)
    assert builds(spark, inc) == [1, 2, 3, 4]
    assert vacuum_gold(spark, inc) > 0 and builds(spark, inc) == [3, 4]
    assert _same(read_gold(spark, inc), gold_job(spark, silver, f"{root}/full"))


def test_skipped_gold_run_is_caught_up(spark, root):
    import datetime as dt

    from medalake import schemas
    silver = _silver(spark, root)
    T1, T2 = LOAD + dt.timedelta(days=40), LOAD + dt.timedelta(days=80)
    gold_job(spark, silver, f"{root}/gold_inc", as_of=LOAD, incremental=True)
    for order, when in ((1001, T1), (1002, T2)):      # gold is not run after the first of these
        silver_job(spark, SPECS["orders"], spark.createDataFrame([(order, 1, when, 10.0, when)],
                                                                 schemas.SOURCE["orders"]), silver, when)
    inc = gold_job(spark, silver, f"{root}/gold_inc", as_of=T2, incremental=True)
    full = gold_job(spark, silver, f"{root}/gold_full")
    assert sorted(map(tuple, inc.collect())) == sorted(map(tuple, full.collect()))
    assert {T1.date(), T2.date()} <= {r.order_date for r in inc.collect()}


def test_orders_without_a_date_in_incremental_gold(spark, root):
    import datetime as dt

    from medalake import schemas
    silver, T1 = _silver(spark, root), LOAD + dt.timedelta(days=1)
    gold_job(spark, silver, f"{root}/gold_inc", as_of=LOAD, incremental=True)
    silver_job(spark, SPECS["orders"], spark.createDataFrame([(1001, 1, None, 10.0, T1)], schemas.SOURCE["orders"]),
               silver, T1)
    key = lambda r: tuple((x is not None, x) for x in r)
    inc = gold_job(spark, silver, f"{root}/gold_inc", as_of=T1, incremental=True)
    full = gold_job(spark, silver, f"{root}/gold_full")
    assert sorted(map(key, inc.collect())) == sorted(map(key, full.collect()))
    assert None in {r.order_date for r in inc.collect()}


def test_gold_without_quarantined_dimension_rows(spark, root):
    from medalake import schemas
    from seeds import PRODUCTS
    silver = _silver(spark, root)
    bad = [(i, None if i == 101 else n, c, p, LOAD) for i, n, c, p in PRODUCTS]
    silver_job(spark, SPECS["products"], spark.createDataFrame(bad, schemas.SOURCE["products"]), silver, LOAD)
    every = {r.product_id for r in gold_job(spark, silver, f"{root}/g1").collect()}
    some = {r.product_id for r in gold_job(spark, silver, f"{root}/g2", exclude_quarantined=True).collect()}
    assert every - some == {101}


def _same(a, b):
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_incremental_gold_across_maintenance_and_whole_loads(spark, root, monkeypatch):
    import datetime as dt

    from medalake import schemas
    from medalake.plans import gold as G
    from medalake.plans.silver import maintain_silver
    silver, inc = _silver(spark, root), f"{root}/gold_inc"
    gold_job(spark, silver, inc, as_of=LOAD, incremental=True)
    whole = []
    orig = G.counts
    monkeypatch.setattr(G, "counts", lambda *a: whole.append(1) or orig(*a))

    def order(order_id, when):
        silver_job(spark, SPECS["orders"], spark.createDataFrame([(order_id, 1, when, 10.0, when)],
                                                                 schemas.SOURCE["orders"]), silver, when)

    # one compaction in between: the deltas before it are still there, so only the change is counted
    T1, T2, T3 = (LOAD + dt.timedelta(days=d) for d in (40, 80, 120))
    order(1001, T1)
    maintain_silver(spark, SPECS["orders"], silver)
    again = gold_job(spark, silver, inc, as_of=T1, incremental=True)
    assert _same(again, gold_job(spark, silver, f"{root}/full1")) and not whole
    # deltas that gold hasn't seen are dropped by a second compaction: everything is counted again
    order(1002, T2)
    maintain_silver(spark, SPECS["orders"], silver)
    order(1003, T3)
    maintain_silver(spark, SPECS["orders"], silver)
    again = gold_job(spark, silver, inc, as_of=T3, incremental=True)
    assert len(whole) == 1 and _same(again, gold_job(spark, silver, f"{root}/full2"))
    # a whole load of a fact table too
    silver_job(spark, SPECS["orders"], frames(spark)["orders"], silver, T3, mode="as_coded")
    again = gold_job(spark, silver, inc, as_of=T3, incremental=True)
    assert len(whole) == 2 and _same(again, gold_job(spark, silver, f"{root}/full3"))


def _in_small_bands(monkeypatch, size=3):
    import dataclasses
    for t in ("orders", "order_items"):
        monkeypatch.setitem(SPECS, t, dataclasses.replace(SPECS[t], band=("order_id", size)))


def test_counting_equals_a_full_rebuild_after_random_batches(spark, root, monkeypatch):
    import datetime as dt
    import random

    from medalake import schemas
    from medalake.plans.gold import maintain_gold
    _in_small_bands(monkeypatch)
    rnd, silver, inc = random.Random(5), _silver(spark, root), f"{root}/gold_inc"
    gold_job(spark, silver, inc, incremental=True)
    for day in range(1, 6):
        when = LOAD + dt.timedelta(days=9 * day)
        ids = rnd.sample(range(995, 1016), 7)                   # changed, new and, by two batches, changed back
        orders = [(i, rnd.choice((1, 2, 3, None)), rnd.choice((LOAD, when, None)), 1.0, when) for i in ids]
        items = [(rnd.randrange(1, 16), rnd.choice((*range(995, 1016), None)), rnd.choice((101, 102, 111, 999, None)),
                  rnd.choice((1, 2, None)), rnd.choice((10.25, 3.0, None)), when) for _ in range(8)]
        for t, rows in (("orders", orders), ("order_items", items)):
            if rnd.random() < .8:
                silver_job(spark, SPECS[t], spark.createDataFrame(rows, schemas.SOURCE[t]), silver, when)
        if day != 3:                                            # one run is left out and caught up by the next
            out = gold_job(spark, silver, inc, incremental=True)
            assert _same(out, gold_job(spark, silver, f"{root}/full{day}"))
    maintain_gold(spark, inc)
    assert _same(read_gold(spark, inc), gold_job(spark, silver, f"{root}/full"))


def test_a_run_scans_only_the_bands_of_what_changed(spark, root, monkeypatch):
    import datetime as dt

    from medalake import schemas
    from medalake.plans import gold as G
    _in_small_bands(monkeypatch)
    silver, T1 = _silver(spark, root), LOAD + dt.timedelta(days=1)
    silver_job(spark, SPECS["orders"], spark.createDataFrame([(1001, 1, T1, 10.0, T1)], schemas.SOURCE["orders"]), silver, T1)
    silver_job(spark, SPECS["order_items"], spark.createDataFrame([(9, 1010, 120, 7, 1.0, T1)], schemas.SOURCE["order_items"]),
               silver, T1)
    plan = G.changed_counts(spark, silver, {"orders": 1, "order_items": 1}, {"orders": 2, "order_items": 2})
    scans = [line for line in plan._jdf.queryExecution().toString().split("\n") if "FileScan parquet" in line]
    # items are read for the band of order 1001 (333) only, orders for that of order 1010 (336)
    whole = [s for s in scans if "snap_" in s or "Location" in s]
    filters = [s.split("PartitionFilters: ")[1].split("PushedFilters")[0] for s in whole]
    assert any("333" in f for f in filters) and any("336" in f for f in filters), filters
    assert sum("333" in f or "336" in f for f in filters) >= 2
    assert plan.count() > 0


def test_equal_keys_are_merged_within_their_bands(spark, root, monkeypatch):
    import datetime as dt

    from medalake import schemas
    from medalake.sinks.tables import bands_in, read_silver
    _in_small_bands(monkeypatch)
    silver, T1 = _silver(spark, root), LOAD + dt.timedelta(days=1)
    schema = SPECS["orders"].silver_schema
    rows = [(-1, 1, T1, 1.0, T1), (-3, 1, T1, 1.0, T1), (1002, 5, T1, 2.0, T1), (2, 1, T1, 1.0, T1)]
    batch = spark.createDataFrame(rows, schemas.SOURCE["orders"])
    assert bands_in(batch, schema) == [-1, 0, 334]
    silver_job(spark, SPECS["orders"], batch, silver, T1)
    got = read_silver(spark, f"{silver}/orders", schema)
    assert got.filter("is_active").count() == 10 + 3 and got.count() == 14
    assert {r.order_id for r in read_silver(spark, f"{silver}/orders", schema, bands=[-1]).collect()} == {-1, -3}


def test_as_coded_versions_are_not_shuffled_into_bands(spark, root, monkeypatch):
    import datetime as dt

    from medalake import schemas
    from medalake.session import list_dir
    _in_small_bands(monkeypatch)
    silver, inc = _silver(spark, root), f"{root}/gold_inc"
    for t in ("orders", "order_items"):
        version = silver_job(spark, SPECS[t], frames(spark)[t], silver, LOAD + dt.timedelta(days=1), mode="as_coded")
        assert not [n for n in list_dir(spark, f"{version}/is_active=true") if n.startswith("_band")]
    gold_job(spark, silver, inc, incremental=True)
    # runs with bands go on from such a version
    for day in (2, 3):
        when = LOAD + dt.timedelta(days=day)
        silver_job(spark, SPECS["orders"], spark.createDataFrame([(1001, day, when, 10.0, when), (2000, 1, when, 1.0, when)],
                                                                 schemas.SOURCE["orders"]), silver, when)
        silver_job(spark, SPECS["order_items"], spark.createDataFrame([(9, 1010, 101, 6 + day, 1.0, when)],
                                                                      schemas.SOURCE["order_items"]), silver, when)
        got = gold_job(spark, silver, inc, incremental=True)
        assert _same(got, gold_job(spark, silver, f"{root}/full{day}"))


def test_runs_with_maintenance(spark, root):
    """Four days, each with a changed order; two of the runs compact."""
    import datetime as dt

    from medalake import schemas
    from medalake.plans.config import RETAILER_CONFIG, config_frame
    from medalake.plans.medallion import run_medallion
    from medalake.sinks.gold import builds
    from medalake.sinks.tables import versions
    seeds, config = frames(spark), config_frame(spark, RETAILER_CONFIG)
    for day in range(4):
        at = LOAD + dt.timedelta(days=30 * day)
        if day:
            row = spark.createDataFrame([(1001 + day, 1, at, 10.0, at)], schemas.SOURCE["orders"])
            seeds["orders"] = seeds["orders"].filter(f"order_id <> {1001 + day}").union(row)
        gold = run_medallion(spark, lambda t: seeds[t], root, at, config=config, maintain=day >= 2)
    assert [v.prefix for v in versions(spark, f"{root}/silver/orders")] == ["comp_", "ver_", "comp_"]
    assert len(builds(spark, f"{root}/gold")) == 2
    assert _same(gold, read_gold(spark, f"{root}/gold"))
    assert _same(gold, gold_job(spark, f"{root}/silver", f"{root}/full"))


def _shuffles(df) -> int:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning")


def test_lines_are_shuffled_once_behind_their_join(spark):
    from medalake.plans import gold as G
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = {n: df.selectExpr("*", "true AS is_active") for n, df in frames(spark).items()}
        # two sides of the join, the lines, and the facts and both dimensions on their way to the names
        assert _shuffles(G.counts(f["orders"], f["order_items"])) == 3
        assert _shuffles(sales_summary(*(f[t] for t in ("orders", "order_items", "products", "categories")))) == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_changes_meet_all_rows_in_one_join(spark, root):
    import datetime as dt

    from medalake import schemas
    from medalake.plans import gold as G
    silver, T1 = _silver(spark, root), LOAD + dt.timedelta(days=1)
    silver_job(spark, SPECS["orders"], spark.createDataFrame([(1001, 7, LOAD, 10.0, T1)], schemas.SOURCE["orders"]), silver, T1)
    silver_job(spark, SPECS["order_items"], spark.createDataFrame([(1, 1001, 101, 4, 1000.0, T1)],
                                                                 schemas.SOURCE["order_items"]), silver, T1)
    change = G.changed_counts(spark, silver, {"orders": 1, "order_items": 1}, {"orders": 2, "order_items": 2})
    assert change._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    got = {(r.product_id, r.customer_id): (r.n, r.units, float(r.sales)) for r in change.collect()}
    assert got[101, 1] == (-1, -1, -1000.0) and got[101, 7] == (1, 4, 4000.0)


def test_a_change_is_shuffled_once_to_be_counted(spark, root):
    import datetime as dt

    from medalake import schemas
    from medalake.plans import gold as G
    from medalake.sinks.tables import rows_signed
    silver, T1, T2 = _silver(spark, root), LOAD + dt.timedelta(days=1), LOAD + dt.timedelta(days=2)
    for t, qty in ((T1, 4), (T2, 5)):
        silver_job(spark, SPECS["order_items"], spark.createDataFrame([(1, 1001, 101, qty, 1000.0, t)],
                                                                     schemas.SOURCE["order_items"]), silver, t)
    spec = SPECS["order_items"]
    first = spark.read.parquet(f"{silver}/order_items/snap_0000000001").count()
    for since, changes in ((1, 4), (2, 2)):
        rows = rows_signed(spark, f"{silver}/order_items", spec.silver_schema, since, 3).collect()
        assert len(rows) == first + 4 and sum(r.change != 0 for r in rows) == changes      # each delta's two rows, once
        now = {}
        for r in rows:
            now[r.order_item_id, r.quantity] = now.get((r.order_item_id, r.quantity), 0) + r.now
        assert now[1, 5] == 1 and now[1, 4] == 0 and sum(now.values()) == first
    plan = G.changed_counts(spark, silver, {"orders": 1, "order_items": 1}, {"orders": 1, "order_items": 3})
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert sum("FileScan parquet" in line and "/order_items/ver_0000000003/is_active=true" in line for line in text.split("\n")) <= 1


def test_a_price_beyond_money_in_no_active_order_is_no_error(spark):
    f = frames(spark)
    orders = f["orders"].selectExpr("*", "order_id <> 1001 AS is_active")
    items = f["order_items"].selectExpr("order_item_id", "order_id", "product_id", "quantity",
                                        "if(order_id = 1001, 1e30D, price) AS price", "updated_at")
    assert sales_summary(orders, items, f["products"], f["categories"]).count() > 0
