"""SCD2 merge: edge cases and invariants (standard), and the reference's
behaviour (as_coded)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalake import schemas
from medalake.operators import scd2 as S
from medalake.operators.dedup import latest_per_key
from medalake.plans.silver import current_or_empty, silver_job
from medalake.plans.specs import SPECS
from medalake.sinks.tables import committed_versions, read_silver

T0 = dt.datetime(2024, 6, 1)
T1 = dt.datetime(2024, 7, 1)
T2 = dt.datetime(2024, 8, 1)
U = dt.datetime(2024, 1, 1)
CUST = SPECS["customers"]
PS = SPECS["product_suppliers"]


def cust(spark, rows):
    return spark.createDataFrame(rows, schemas.SOURCE["customers"])


def merge(spark, current, rows, as_of, spec=CUST):
    inc = spark.createDataFrame(rows, spec.source_schema)
    return S.scd2_merge(current, inc, spec, as_of)


def first(spark, rows, spec=CUST):
    return merge(spark, S.empty_silver(spark, spec), rows, T0, spec).table


def as_dict(df, key="customer_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r.asDict())
    return out


def check_invariants(df, keys=("customer_id",)):
    rows = df.collect()
    active = {}
    for r in rows:
        k = tuple(r[c] for c in keys)
        if r.is_active:
            assert k not in active, f"two active versions of {k}"
            active[k] = r
            assert r.effective_end_date is None
        else:
            assert r.effective_end_date is not None and r.effective_end_date >= r.effective_start_date
    by_key = {}
    for r in rows:
        by_key.setdefault(tuple(r[c] for c in keys), []).append(r)
    for vs in by_key.values():
        vs.sort(key=lambda r: r.effective_start_date)
        for a, b in zip(vs, vs[1:]):
            assert a.effective_end_date is not None and a.effective_end_date <= b.effective_start_date


BASE = [(1, "a", "a@x", U), (2, "b", "b@x", U), (3, "c", None, U)]


def test_first_load_into_empty_target(spark):
    df = first(spark, BASE)
    assert df.count() == 3 and df.filter("is_active").count() == 3
    d = as_dict(df)
    assert d[3][0]["is_quarantined"] is True and d[1][0]["is_quarantined"] is False
    assert d[1][0]["effective_start_date"] == T0 and d[1][0]["effective_end_date"] is None
    check_invariants(df)


def test_empty_batch_is_noop(spark):
    cur = first(spark, BASE)
    out = merge(spark, cur, [], T1).table
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, cur.collect()))


def test_identical_batch_twice_is_noop(spark):
    cur = first(spark, BASE)
    once = merge(spark, cur, BASE, T1).table
    twice = merge(spark, once, BASE, T2).table
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, cur.collect()))


def test_changed_absent_new_and_null_changes(spark):
    cur = first(spark, BASE)
    batch = [(1, "a2", "a@x", U),      # value changed
             (3, "c", "c@x", U),       # NULL -> value
             (4, "d", "d@x", U)]       # new; key 2 absent
    out = merge(spark, cur, batch, T1).table
    d = as_dict(out)
    assert len(d[1]) == 2 and len(d[3]) == 2 and len(d[2]) == 1 and len(d[4]) == 1
    closed = [v for v in d[1] if not v["is_active"]][0]
    opened = [v for v in d[1] if v["is_active"]][0]
    assert closed["name"] == "a" and closed["effective_end_date"] == T1
    assert opened["name"] == "a2" and opened["effective_start_date"] == T1
    assert d[2][0]["is_active"] and d[2][0]["effective_start_date"] == T0   # absence is not a delete
    check_invariants(out)
    # value -> NULL is a change too
    out2 = merge(spark, out, [(1, "a2", None, U)], T2).table
    assert out2.filter("customer_id = 1").count() == 3
    check_invariants(out2)


def test_history_passes_through(spark):
    cur = merge(spark, first(spark, BASE), [(1, "a2", "a@x", U)], T1).table
    out = merge(spark, cur, [(1, "a3", "a@x", U)], T2).table
    names = sorted((r.name, r.is_active) for r in out.filter("customer_id = 1").collect())
    assert names == [("a", False), ("a2", False), ("a3", True)]
    check_invariants(out)


def test_null_key_goes_to_quarantine_and_duplicates_keep_latest(spark):
    cur = first(spark, BASE)
    batch = [(None, "z", "z@x", U), (5, "old", "e@x", U), (5, "new", "e@x", U + dt.timedelta(days=1))]
    res = merge(spark, cur, batch, T1)
    assert res.quarantined.count() == 1
    five = res.table.filter("customer_id = 5").collect()
    assert len(five) == 1 and five[0].name == "new"
    assert res.table.filter(F.col("customer_id").isNull()).count() == 0


def test_all_rows_changed(spark):
    cur = first(spark, BASE)
    out = merge(spark, cur, [(k, n + "!", e, u) for k, n, e, u in BASE], T1).table
    assert out.count() == 6 and out.filter("is_active").count() == 3
    check_invariants(out)


def test_unseen_column_order(spark):
    cur = first(spark, BASE)
    inc = cust(spark, [(1, "a2", "a@x", U)]).select("updated_at", "email", "name", "customer_id")
    out = S.scd2_merge(cur, inc, CUST, T1).table
    assert out.filter("customer_id = 1 AND is_active").first().name == "a2"


def test_composite_key(spark):
    rows = [(1, 10, 5.0, U), (1, 11, 6.0, U), (2, 10, 7.0, U)]
    cur = first(spark, rows, PS)
    out = merge(spark, cur, [(1, 10, 5.5, U), (2, 10, 7.0, U), (3, 10, 1.0, U)], T1, PS).table
    assert out.count() == 5 and out.filter("is_active").count() == 4
    check_invariants(out, ("supplier_id", "product_id"))


def test_latest_per_key_ties(spark):
    df = spark.createDataFrame([(1, U, 3), (1, U, 5), (2, None, 1), (2, U, 0)], "k long, w timestamp_ntz, q long")
    got = {r.k: (r.w, r.q) for r in latest_per_key(df, ["k"], ["w", "q"]).collect()}
    assert got == {1: (U, 5), 2: (U, 0)}


# --- as coded: the reference's behaviour ------------------------------------------

def test_as_coded_defects(spark):
    cur = S.scd2_merge_as_coded(S.empty_silver(spark, CUST), cust(spark, BASE), CUST, T0)
    assert cur.count() == 3 and cur.filter("effective_end_date IS NOT NULL").count() == 3
    batch = cust(spark, [(1, "a2", "a@x", U),    # changed: expired, but new version not inserted (D5)
                         (2, "b", None, U),      # value -> NULL: missed by != (D7)
                         (4, "d", "d@x", U)])    # new key: inserted (customers insert by key)
    out = S.scd2_merge_as_coded(cur, batch, CUST, T1)
    d = as_dict(out)
    assert sorted(v["is_active"] for v in d[1]) == [False, True]     # old copy kept active too (D4)
    assert [v["name"] for v in d[1]] == ["a", "a"]
    assert len(d[2]) == 1 and d[2][0]["email"] == "b@x"
    assert 4 in d


def test_as_coded_bootstrap_only_never_inserts_later(spark):
    spec = SPECS["orders"]
    rows = [(1, 1, U, 1.0, U)]
    cur = S.scd2_merge_as_coded(S.empty_silver(spark, spec),
                                spark.createDataFrame(rows, spec.source_schema), spec, T0)
    out = S.scd2_merge_as_coded(cur, spark.createDataFrame([(2, 1, U, 2.0, U)], spec.source_schema), spec, T1)
    assert [r.order_id for r in out.collect()] == [1]    # D6


# --- storage: versioned silver ------------------------------------------------------

def test_versioned_silver_job(spark, root):
    path = f"{root}/customers"
    assert read_silver(spark, path, CUST.silver_schema) is None
    assert current_or_empty(spark, path, CUST).count() == 0
    silver_job(spark, CUST, cust(spark, BASE), root, T0)
    silver_job(spark, CUST, cust(spark, [(1, "a2", "a@x", U)]), root, T1)
    assert committed_versions(spark, path) == [1, 2]
    cur = read_silver(spark, path, CUST.silver_schema)
    assert cur.count() == 4
    check_invariants(cur)
    # a version whose job did not commit is ignored by readers
    spark.range(1).write.mode("overwrite").parquet(f"{path}/ver_0000000003")
    spark.sparkContext._jvm  # noqa: B018
    from medalake.session import delete_path
    delete_path(spark, f"{path}/ver_0000000003/_SUCCESS")
    assert committed_versions(spark, path) == [1, 2]


def test_empty_silver_schema(spark):
    e = S.empty_silver(spark, CUST)
    assert e.schema == CUST.silver_schema
    assert isinstance(e.schema["effective_start_date"].dataType, T.TimestampNTZType)


@pytest.mark.parametrize("mode", ["nope"])
def test_unknown_mode(spark, mode):
    with pytest.raises(ValueError):
        S.merge(S.empty_silver(spark, CUST), cust(spark, BASE), CUST, T0, mode)


def test_silver_job_writes_null_key_quarantine_only_when_present(spark, root):
    from medalake.session import list_dir
    silver_job(spark, CUST, cust(spark, BASE), root, T0)
    assert "_quarantine" not in list_dir(spark, root)
    silver_job(spark, CUST, cust(spark, [(None, "z", "z@x", U), (1, "a", "a@x", U)]), root, T1)
    q = spark.read.parquet(f"{root}/_quarantine/customers")
    assert q.count() == 1 and q.first().name == "z"
    assert read_silver(spark, f"{root}/customers", CUST.silver_schema).count() == 3


def test_older_row_never_replaces_a_newer_one(spark, root):
    day = dt.timedelta(days=1)
    silver_job(spark, CUST, cust(spark, [(1, "new", "a@x", U + day), (2, "b", "b@x", U)]), root, T0)
    silver_job(spark, CUST, cust(spark, [(1, "old", "a@x", U), (2, "b2", "b@x", U), (3, "c", "c@x", None)]), root, T1)
    cur = read_silver(spark, f"{root}/customers", CUST.silver_schema)
    got = sorted((r.customer_id, r.name, r.is_active) for r in cur.collect())
    # key 1: late, ignored; key 2: equal times, the incoming row wins
    assert got == [(1, "new", True), (2, "b", False), (2, "b2", True), (3, "c", True)]


def test_replayed_null_keys_are_quarantined_once(spark, root):
    batch = [(None, "z", "z@x", U), (1, "a", "a@x", U)]
    silver_job(spark, CUST, cust(spark, batch), root, T0, batch="b1")
    silver_job(spark, CUST, cust(spark, batch), root, T1, batch="b1")
    silver_job(spark, CUST, cust(spark, [(None, "y", "y@x", U)]), root, T2, batch="b2")
    got = spark.read.parquet(f"{root}/_quarantine/customers").collect()
    assert sorted((r.name, r.batch) for r in got) == [("y", "b2"), ("z", "b1")]
    assert {r.loaded_at for r in got} == {T1, T2}


def test_quarantine_names_the_landed_batch(spark, root):
    """Two batches merged by one run, one of them brought again by a run that lost the ledger."""
    from medalake.plans.silver import silver_from_landing
    from medalake.session import delete_path
    from medalake.sinks.landing import land_json
    for name, at in (("y", T0), ("z", T1)):
        land_json(cust(spark, [(None, name, "q@x", U), (1, name, "a@x", U)]), f"{root}/landing", "customers", at)
    for at in (T1, T2):
        silver_from_landing(spark, f"{root}/landing", f"{root}/silver", at, tables=["customers"])
        delete_path(spark, f"{root}/landing/_merged")
    got = spark.read.parquet(f"{root}/silver/_quarantine/customers").collect()
    assert sorted((r.name, r.batch) for r in got) == [("y", "customers_01062024.json"), ("z", "customers_01072024.json")]


def test_deltas_compaction_and_vacuum(spark, root):
    from medalake.plans.silver import maintain_silver
    from medalake.sinks.tables import versions
    path = f"{root}/customers"
    for i, rows in enumerate([BASE] + [[(1, f"a{i}", "a@x", U)] for i in range(3)]):
        silver_job(spark, CUST, cust(spark, rows), root, T0 + dt.timedelta(days=i))
    # jobs only add versions; nothing is dropped under a reader
    assert [(v.number, v.snapshot) for v in versions(spark, path)] == [(1, True), (2, False), (3, False), (4, False)]

    def rows():
        return sorted(map(tuple, read_silver(spark, path, CUST.silver_schema).select(
            "customer_id", "name", "is_active").collect()))

    before = rows()
    assert len(before) == 6 and sum(r[2] for r in before) == 3
    maintain_silver(spark, CUST, root)
    assert versions(spark, path)[-1].snapshot and rows() == before
    silver_job(spark, CUST, cust(spark, [(2, "b2", "b@x", U)]), root, T2)
    before = rows()
    maintain_silver(spark, CUST, root)
    assert versions(spark, path)[0].number == 5 and rows() == before
    check_invariants(read_silver(spark, path, CUST.silver_schema))


def test_a_delta_holds_only_opened_and_closed_rows(spark, root):
    path = f"{root}/customers"
    many = [(k, f"n{k}", f"{k}@x", U) for k in range(500)]
    silver_job(spark, CUST, cust(spark, many), root, T0)
    silver_job(spark, CUST, cust(spark, [(7, "seven", "7@x", U), (8, "n8", "8@x", U), (900, "z", "z@x", U)]), root, T1)
    written = spark.read.parquet(f"{path}/ver_0000000002").select("customer_id", "is_active").collect()
    assert sorted(map(tuple, written)) == [(7, "false"), (7, "true"), (900, "true")]      # 8 is unchanged
    assert read_silver(spark, path, CUST.silver_schema).count() == 502


def test_row_reopened_at_the_same_time_stays_open(spark, root):
    path = f"{root}/customers"
    for name in ("a", "b", "c"):        # all three runs carry one load time
        silver_job(spark, CUST, cust(spark, [(1, name, "a@x", U)]), root, T0)
    rows = read_silver(spark, path, CUST.silver_schema).collect()
    assert sorted((r.name, r.is_active) for r in rows) == [("a", False), ("b", False), ("c", True)]


def test_stored_changes_equal_the_whole_merge(spark, root):
    second = [(1, "a2", "a@x", U), (3, "c", None, U), (4, "d", "d@x", U), (2, "old", "b@x", U - dt.timedelta(days=1))]
    silver_job(spark, CUST, cust(spark, BASE), root, T0)
    silver_job(spark, CUST, cust(spark, second), root, T1)
    stored = read_silver(spark, f"{root}/customers", CUST.silver_schema)
    whole = merge(spark, first(spark, BASE), second, T1).table
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(key, stored.collect())) == sorted(map(key, whole.collect()))


def test_small_batch_is_broadcast_and_the_active_set_not_shuffled(spark, root):
    silver_job(spark, CUST, cust(spark, BASE), root, T0)
    cust(spark, [(1, "a2", "a@x", U)]).write.parquet(f"{root}/batch")
    batch = S.prepare(spark.read.schema(CUST.source_schema).parquet(f"{root}/batch"), CUST)
    current = read_silver(spark, f"{root}/customers", CUST.silver_schema)
    plan = S.merge_batch(current, batch, CUST, T1)[1]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def _as_coded_by_steps(current, incoming, spec, as_of):
    """The reference's steps one after the other, from the public step operators."""
    from medalake.operators import scd2 as S
    keys, order = list(spec.keys), spec.silver_schema.fieldNames()
    b = S.stamp(S.prepare(incoming, spec), as_of, open_end=False)
    a = current.filter("is_active")
    expired = S.expire(a, S.changed_keys(a, b, keys, spec.compare, null_safe=False), keys, as_of)
    new = S.new_by_key(b, a, keys) if spec.new_rows_as_coded == "by_key" else S.new_bootstrap_only(b, a)
    return S.subtract_positional(a, expired, order).unionByName(expired.select(*order)).unionByName(new.select(*order))


@pytest.mark.parametrize("name", ["customers", "orders", "product_suppliers"])
def test_as_coded_in_one_pass_equals_the_steps(spark, name):
    """Random rows with repeats, several rows of a key on either side, NULL keys and NULL values."""
    import random
    from medalake import schemas
    from medalake.operators.scd2 import scd2_merge_as_coded, stamp, prepare
    from medalake.plans.specs import SPECS
    spec, rnd = SPECS[name], random.Random(name)

    def value(f):
        kind = f.dataType.simpleString()
        some = {"bigint": (1, 2, 3, 4, 5, None), "string": ("x", "y", None), "double": (1.0, 2.0, None),
                "timestamp_ntz": (T0, T1, None)}[kind]
        return rnd.choice(some)

    def rows(n):
        out = [tuple(value(f) for f in schemas.SOURCE[name].fields) for _ in range(n)]
        return spark.createDataFrame(out + out[: n // 3], schemas.SOURCE[name])

    for n_old, n_new in ((30, 30), (0, 12), (12, 0)):
        old = stamp(prepare(rows(n_old), spec), T0, open_end=False).select(*spec.silver_schema.fieldNames())
        old = old.withColumn("is_active", F.coalesce(F.col("customer_id" if name != "product_suppliers" else "product_id") != 5,
                                                     F.lit(True)))
        old = spark.createDataFrame(old.collect(), old.schema)
        new = spark.createDataFrame(rows(n_new).collect(), schemas.SOURCE[name])
        key = lambda r: tuple((x is not None, x) for x in r)
        got = sorted(map(key, scd2_merge_as_coded(old, new, spec, T1).collect()))
        assert got == sorted(map(key, _as_coded_by_steps(old, new, spec, T1).collect()))


def test_as_coded_first_load_joins_nothing(spark):
    from medalake.operators.scd2 import empty_silver, scd2_merge_as_coded
    for name in ("customers", "orders"):
        spec = SPECS[name]
        new = spark.createDataFrame([], schemas.SOURCE[name]).union(spark.range(5).selectExpr(
            *[f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas.SOURCE[name].fields]))
        plan = scd2_merge_as_coded(empty_silver(spark, spec), new, spec, T1)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan, plan


def test_merge_into_buckets_shuffles_only_the_batch(spark, root):
    """Composite and single keys; deltas on top, compaction, another number of buckets, retention."""
    import dataclasses

    from medalake.plans.silver import maintain_silver
    from medalake.sinks.tables import versions
    spec = dataclasses.replace(PS, buckets=8)
    schema, path = spec.silver_schema, f"{root}/product_suppliers"

    def batch(rows):
        return spark.createDataFrame(rows, spec.source_schema)

    plain = f"{root}/plain"
    for i, rows in enumerate([[(s, p, 1.0, U) for s in range(20) for p in range(5)],
                              [(s, 1, 2.0 + s, U) for s in range(0, 30, 2)], [(4, 1, 9.0, U), (77, 1, 1.0, U)]]):
        silver_job(spark, spec, batch(rows), root, T0 + dt.timedelta(days=i))
        silver_job(spark, PS, batch(rows), plain, T0 + dt.timedelta(days=i))

    def rows_of(spec, base):
        return sorted(map(tuple, read_silver(spark, f"{base}/product_suppliers", spec.silver_schema).collect()))

    assert [v.buckets for v in versions(spark, path)] == [8, 0, 0] and rows_of(spec, root) == rows_of(PS, plain)
    keys = batch([(s, p, 3.0, U) for s in range(20) for p in range(5)]).select(*spec.keys).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = read_silver(spark, path, schema, touching=keys)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = [i for i, line in enumerate(plan) if "Bucketed: true" in line]
    assert at and all("SelectedBucketsCount: 8 out of 8" in plan[i] for i in at)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for i in at:            # the operators above the bucketed scan, up to its join, hold no exchange
        above, level = [], depth(plan[i])
        for line in reversed(plan[:i]):
            if depth(line) < level:
                level = depth(line)
                above.append(line)
            if "Join" in above[-1] if above else False:
                break
        assert "Join" in above[-1] and not any("Exchange" in line for line in above), above
    assert maintain_silver(spark, dataclasses.replace(spec, buckets=4), root) == 0
    assert versions(spark, path)[-1].buckets == 4 and rows_of(spec, root) == rows_of(PS, plain)
    silver_job(spark, spec, batch([(0, 0, 8.0, U)]), root, T2)
    silver_job(spark, PS, batch([(0, 0, 8.0, U)]), plain, T2)
    assert maintain_silver(spark, spec, root) > 0
    assert rows_of(spec, root) == rows_of(PS, plain)
