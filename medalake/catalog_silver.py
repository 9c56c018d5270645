"""Silver-layer queries (registered on import) and their SQL oracles."""

from __future__ import annotations

import dataclasses
from typing import NamedTuple

from medalake import oracle as O
from medalake.catalog import query
from medalake.operators import scd2 as S
from medalake.operators.quarantine import split_quarantine
from medalake.plans.silver import active, current_or_empty, silver_job
from medalake.plans.specs import SPECS
from medalake.session import shared_dir
from medalake.sinks.tables import read_silver
from medalake.sources import adapters as A

SCD2_TABLES = ("customers", "orders", "order_items", "product_suppliers")
SRC_FRAG = {"customers": "customers_src", "orders": "orders_src", "order_items": "items_src",
            "product_suppliers": "product_suppliers_src"}
BATCH_SQL_CHANGE = {"customers": "{c} || '!'", "orders": "{c} + 1", "order_items": "{c} + 1",
                    "product_suppliers": "{c} + 1"}


# --- SQL generation -----------------------------------------------------------

class Oracle(NamedTuple):
    """What the SQL states about a table, written out here on its own: the code under test is not consulted."""
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    compare: tuple[str, ...] = ()
    watermark: str | None = None
    required: tuple[str, ...] = ()          # a NULL in any of these sets is_quarantined
    inserts_by_key: bool = False            # as coded: new keys are inserted after the first load


# Columns, keys, compared columns and required columns of the silver jobs.
ORACLES = {
    "customers": Oracle(("customer_id", "name", "email", "updated_at"), ("customer_id",),
                        ("name", "email", "updated_at"), "updated_at", ("customer_id", "email", "name"), True),
    "orders": Oracle(("order_id", "customer_id", "order_date", "total_amount", "updated_at"), ("order_id",),
                     ("customer_id", "order_date", "total_amount", "updated_at"), "updated_at"),
    "order_items": Oracle(("order_item_id", "order_id", "product_id", "quantity", "price", "updated_at"),
                          ("order_item_id",), ("order_id", "product_id", "quantity", "price", "updated_at"),
                          "updated_at"),
    "product_suppliers": Oracle(("supplier_id", "product_id", "supply_price", "last_updated"), ("supplier_id", "product_id"),
                                ("supply_price", "last_updated"), "last_updated"),
    "products": Oracle(("product_id", "name", "category_id", "price", "updated_at"), ("product_id",),
                       required=("category_id", "name")),
    "categories": Oracle(("category_id", "name", "updated_at"), ("category_id",), required=("category_id", "name")),
    "suppliers": Oracle(("supplier_id", "supplier_name", "contact_name", "phone", "email", "address", "city", "country",
                         "created_at"), ("supplier_id",), required=("supplier_id", "supplier_name")),
}


def _cols(t):
    return list(ORACLES[t].columns)


def _silver_cols(t):
    flag = ["is_quarantined"] if ORACLES[t].required else []
    return [*_cols(t), *flag, "effective_start_date", "effective_end_date", "is_active"]


def _qflag(t):
    required = ORACLES[t].required
    return ", (" + " OR ".join(f"{c} IS NULL" for c in required) + ") AS is_quarantined" if required else ""


def _dedup(t, frag):
    spec = ORACLES[t]
    rest = [c for c in _cols(t) if c not in spec.keys and c != spec.watermark]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [spec.watermark] + rest)
    notnull = " AND ".join(f"{k} IS NOT NULL" for k in spec.keys)
    return (f"SELECT * FROM {frag} WHERE {notnull} QUALIFY row_number() OVER "
            f"(PARTITION BY {', '.join(spec.keys)} ORDER BY {order}) = 1")


# selector, changed column, negated key, nulled column of the second batch
BATCH_SQL_RULES = {
    "customers": ("customer_id", "name", "customer_id", "email"),
    "orders": ("order_id", "total_amount", "order_id", "customer_id"),
    "order_items": ("order_id", "quantity", "order_item_id", "price"),
    "product_suppliers": ("product_id", "supply_price", "product_id", "last_updated"),
}


def _batch_sql(t):
    sel, changed, key, nulled = BATCH_SQL_RULES[t]
    d = f"({sel} % 10)"
    out = []
    for c in _cols(t):
        e = c
        if c == changed:
            e = f"CASE WHEN {d} = 0 THEN {BATCH_SQL_CHANGE[t].format(c=c)} ELSE {c} END"
        if c == key:
            e = f"CASE WHEN {d} = 2 THEN -{c} ELSE {c} END"
        if c == nulled:
            e = f"CASE WHEN {d} = 3 THEN NULL ELSE {c} END"
        out.append(f"{e} AS {c}")
    return f"SELECT {', '.join(out)} FROM {SRC_FRAG[t]} WHERE {d} < 4"


def _stamped(frag, t, as_of, end):
    return f"SELECT {', '.join(_cols(t))}{_qflag(t)}, {as_of} AS effective_start_date, {end} AS effective_end_date, TRUE AS is_active FROM {frag}"


for _t in SCD2_TABLES:
    O.register(f"{_t}_dedup", (SRC_FRAG[_t],), _dedup(_t, SRC_FRAG[_t]))
    # standard first load at T0: every (deduplicated) row opens a version
    O.register(f"{_t}_init", (f"{_t}_dedup",), _stamped(f"{_t}_dedup", _t, O.T0, O.NULL_TS))
    O.register(f"{_t}_batch", (SRC_FRAG[_t],), _batch_sql(_t))
    O.register(f"{_t}_inc", (f"{_t}_batch",), _dedup(_t, f"{_t}_batch"))
    # as-coded: first load = the batch stamped with start = end = load time
    O.register(f"{_t}_init_ac", (SRC_FRAG[_t],), _stamped(SRC_FRAG[_t], _t, O.T0, O.T0))
    O.register(f"{_t}_b_ac", (f"{_t}_batch",), _stamped(f"{_t}_batch", _t, O.T1, O.T1))


def scd2_standard_sql(t, cur=None, inc=None, as_of=O.T1):
    spec = ORACLES[t]
    cur, inc = cur or f"{t}_init", inc or f"{t}_inc"
    keys = list(spec.keys)
    payload = [c for c in _cols(t) if c not in keys] + (["is_quarantined"] if spec.required else [])
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    chg = " OR ".join(f"t_{c} IS DISTINCT FROM s_{c}" for c in spec.compare)
    j = (f"SELECT {', '.join(f'coalesce(t.{k}, s.{k}) AS {k}' for k in keys)}, "
         f"{', '.join(f't.{c} AS t_{c}' for c in payload)}, "
         f"t.effective_start_date AS t_start, t.effective_end_date AS t_end, "
         f"{', '.join(f's.{c} AS s_{c}' for c in payload)}, "
         f"t.{keys[0]} IS NOT NULL AS t_present, s.{keys[0]} IS NOT NULL AS s_present "
         f"FROM (SELECT * FROM {cur} WHERE is_active) t FULL OUTER JOIN "
         f"(SELECT {', '.join(_cols(t))}{_qflag(t)} FROM {inc}) s ON {on}")
    c = f"SELECT *, (t_present AND s_present AND ({chg})) AS chg FROM j"
    body = f"""
WITH j AS ({j}), c AS ({c})
SELECT {', '.join(keys)}, {', '.join(f't_{p} AS {p}' for p in payload)}, t_start AS effective_start_date,
       CASE WHEN chg THEN {as_of} ELSE t_end END AS effective_end_date, NOT chg AS is_active
FROM c WHERE t_present
UNION ALL
SELECT {', '.join(keys)}, {', '.join(f's_{p} AS {p}' for p in payload)}, {as_of} AS effective_start_date,
       {O.NULL_TS} AS effective_end_date, TRUE AS is_active
FROM c WHERE s_present AND (NOT t_present OR chg)
UNION ALL
SELECT {', '.join(_silver_cols(t))} FROM {cur} WHERE NOT coalesce(is_active, FALSE)"""
    return O.with_(f"SELECT * FROM ({body})", cur, inc)


def _changed_keys_sql(t, a, b, null_safe=True):
    spec = ORACLES[t]
    on = " AND ".join(f"t.{k} = s.{k}" for k in spec.keys)
    op = "IS DISTINCT FROM" if null_safe else "<>"
    diff = " OR ".join(f"t.{c} {op} s.{c}" for c in spec.compare)
    return f"SELECT {', '.join(f't.{k} AS {k}' for k in spec.keys)} FROM {a} t JOIN {b} s ON {on} WHERE t.is_active AND ({diff})"


def _expired_sql(t, a, changed_sql, as_of=O.T1):
    spec = ORACLES[t]
    cols = [c for c in _silver_cols(t) if c not in ("effective_end_date", "is_active")]
    on = " AND ".join(f"a.{k} = c.{k}" for k in spec.keys)
    return (f"SELECT {', '.join(cols)}, {as_of} AS effective_end_date, FALSE AS is_active FROM {a} a "
            f"WHERE a.is_active AND EXISTS (SELECT 1 FROM ({changed_sql}) c WHERE {on})")


def scd2_as_coded_sql(t):
    spec = ORACLES[t]
    a, b = f"{t}_init_ac", f"{t}_b_ac"
    cols = ", ".join(_silver_cols(t))
    expired = _expired_sql(t, a, _changed_keys_sql(t, a, b, null_safe=False))
    if spec.inserts_by_key:
        on = " AND ".join(f"x.{k} = b.{k}" for k in spec.keys)
        new = f"SELECT {cols} FROM {b} b WHERE NOT EXISTS (SELECT 1 FROM {a} x WHERE x.is_active AND {on})"
    else:
        new = f"SELECT {cols} FROM {b} b WHERE NOT EXISTS (SELECT 1 FROM {a} x WHERE x.is_active)"
    body = f"""
SELECT * FROM (
  (SELECT {cols} FROM {a} WHERE is_active EXCEPT SELECT {cols} FROM ({expired}))
  UNION ALL SELECT {cols} FROM ({expired})
  UNION ALL {new})"""
    return O.with_(body, a, b)


# --- Spark side -------------------------------------------------------------

def _source(spark, sf, t):
    return A.source(spark, sf, t)


def _init(spark, sf, t):
    spec = SPECS[t]
    return S.scd2_merge(None, _source(spark, sf, t), spec, A.T0).table   # first load


def _batch(spark, sf, t):
    return A.second_batch(_source(spark, sf, t), t)


def _init_as_coded(spark, sf, t):
    spec = SPECS[t]
    return S.scd2_merge_as_coded(S.empty_silver(spark, spec), _source(spark, sf, t), spec, A.T0)


def _register_scd2(t):
    @query(f"silver_scd2_{t}", scd2_standard_sql(t))
    def q_std(spark, sf):
        return S.scd2_merge(_init(spark, sf, t), _batch(spark, sf, t), SPECS[t], A.T1).table

    @query(f"silver_scd2_{t}_as_coded", scd2_as_coded_sql(t))
    def q_ac(spark, sf):
        return S.scd2_merge_as_coded(_init_as_coded(spark, sf, t), _batch(spark, sf, t), SPECS[t], A.T1)

    @query(f"silver_changed_{t}",
           O.with_(_changed_keys_sql(t, f"{t}_init", f"{t}_batch"), f"{t}_init", f"{t}_batch"))
    def q_changed(spark, sf):
        spec = SPECS[t]
        return S.changed_keys(_init(spark, sf, t), S.prepare(_batch(spark, sf, t), spec),
                              spec.keys, spec.compare, null_safe=True)


for _t in SCD2_TABLES:
    _register_scd2(_t)


def _expired_query(t):
    sql = O.with_(_expired_sql(t, f"{t}_init", _changed_keys_sql(t, f"{t}_init", f"{t}_batch")),
                  f"{t}_init", f"{t}_batch")

    def q(spark, sf):
        spec = SPECS[t]
        a = _init(spark, sf, t)
        changed = S.changed_keys(a, S.prepare(_batch(spark, sf, t), spec), spec.keys, spec.compare)
        return S.expire(a, changed, spec.keys, A.T1)
    return sql, q


_sql, _q = _expired_query("customers")
query("silver_expired", _sql)(_q)
_sql, _q = _expired_query("product_suppliers")
query("silver_expired_composite", _sql)(_q)


@query("silver_new_by_key", O.with_(
    f"SELECT {', '.join(_silver_cols('customers'))} FROM customers_b_ac b WHERE NOT EXISTS "
    "(SELECT 1 FROM customers_init x WHERE x.is_active AND x.customer_id = b.customer_id)",
    "customers_b_ac", "customers_init"))
def q_new_by_key(spark, sf):
    spec = SPECS["customers"]
    b = S.stamp(S.prepare(_batch(spark, sf, "customers"), spec), A.T1, open_end=False)
    return S.new_by_key(b, _init(spark, sf, "customers"), spec.keys)


@query("silver_new_bootstrap_only", O.with_(
    f"SELECT {', '.join(_silver_cols('orders'))} FROM orders_init_ac "
    f"UNION ALL SELECT {', '.join(_silver_cols('orders'))} FROM orders_b_ac b "
    "WHERE NOT EXISTS (SELECT 1 FROM orders_init_ac x WHERE x.is_active)",
    "orders_init_ac", "orders_b_ac"))
def q_new_bootstrap_only(spark, sf):
    """First load (empty target: every row) then second load (no row)."""
    spec = SPECS["orders"]
    first = S.stamp(S.prepare(_source(spark, sf, "orders"), spec), A.T0, open_end=False)
    run1 = S.new_bootstrap_only(first, S.empty_silver(spark, spec))
    second = S.stamp(S.prepare(_batch(spark, sf, "orders"), spec), A.T1, open_end=False)
    run2 = S.new_bootstrap_only(second, _init_as_coded(spark, sf, "orders"))
    return run1.unionByName(run2)


@query("silver_subtract", O.with_(
    f"SELECT * FROM (SELECT {', '.join(_silver_cols('customers'))} FROM customers_init_ac WHERE is_active "
    f"EXCEPT SELECT {', '.join(_silver_cols('customers'))} FROM ("
    + _expired_sql("customers", "customers_init_ac",
                   _changed_keys_sql("customers", "customers_init_ac", "customers_b_ac", null_safe=False))
    + "))", "customers_init_ac", "customers_b_ac"))
def q_subtract(spark, sf):
    spec = SPECS["customers"]
    a = _init_as_coded(spark, sf, "customers")
    b = S.stamp(S.prepare(_batch(spark, sf, "customers"), spec), A.T1, open_end=False)
    expired = S.expire(a, S.changed_keys(a, b, spec.keys, spec.compare, null_safe=False), spec.keys, A.T1)
    return S.subtract_positional(a, expired, spec.silver_schema.fieldNames())


@query("silver_union", scd2_as_coded_sql("customers"))
def q_union(spark, sf):
    """The three as-coded parts, each in a different column order."""
    spec = SPECS["customers"]
    order = spec.silver_schema.fieldNames()
    a = _init_as_coded(spark, sf, "customers")
    b = S.stamp(S.prepare(_batch(spark, sf, "customers"), spec), A.T1, open_end=False)
    expired = S.expire(a, S.changed_keys(a, b, spec.keys, spec.compare, null_safe=False), spec.keys, A.T1)
    unchanged = S.subtract_positional(a, expired, order).select(*reversed(order))
    return unchanged.unionByName(expired).unionByName(S.new_by_key(b, a, spec.keys))


@query("silver_active_filter", f"SELECT * FROM ({scd2_standard_sql('customers')}) WHERE is_active")
def q_active_filter(spark, sf):
    return active(S.scd2_merge(_init(spark, sf, "customers"), _batch(spark, sf, "customers"),
                               SPECS["customers"], A.T1).table)


@query("silver_bootstrap", O.with_("SELECT * FROM customers_init", "customers_init"))
def q_bootstrap(spark, sf):
    """A table folder that does not exist yet reads as empty; the
    first load merges into that empty relation."""
    spec = SPECS["customers"]
    current = current_or_empty(spark, shared_dir(spark, "bootstrap", "customers"), spec)
    return S.scd2_merge(current, _source(spark, sf, "customers"), spec, A.T0).table


@query("silver_scd_stamp", O.with_(_stamped("orders_src", "orders", O.T0, O.NULL_TS), "orders_src"))
def q_scd_stamp(spark, sf):
    spec = SPECS["orders"]
    return S.stamp(S.prepare(_source(spark, sf, "orders"), spec), A.T0)


@query("silver_write_readback", scd2_standard_sql("customers"))
def q_write_readback(spark, sf):
    """K7: two runs of the customers job through versioned storage."""
    spec = SPECS["customers"]
    root = shared_dir(spark, "silver_write_readback")
    silver_job(spark, spec, _source(spark, sf, "customers"), root, A.T0)
    silver_job(spark, spec, _batch(spark, sf, "customers"), root, A.T1)
    return read_silver(spark, f"{root}/customers", spec.silver_schema)


# --- quarantine ---------------------------------------------------------------

QUARANTINE_INPUT = {
    "customers": ("customers_src", lambda spark, sf: A.customers(spark, sf)),
    "categories": ("categories_q", lambda spark, sf: A.categories(spark, sf, quarantine_case=True)),
    "products": ("products_q", lambda spark, sf: A.products(spark, sf, quarantine_case=True)),
    "suppliers": ("suppliers_q", lambda spark, sf: A.suppliers(spark, sf, quarantine_case=True)),
}


def _register_quarantine(t):
    frag, fn = QUARANTINE_INPUT[t]
    spec = SPECS[t]
    cond = " OR ".join(f"{c} IS NULL" for c in ORACLES[t].required)

    @query(f"quarantine_{t}", O.with_(
        f"SELECT {', '.join(_cols(t))}, TRUE AS is_quarantined FROM {frag} WHERE {cond}", frag))
    def q(spark, sf):
        return split_quarantine(fn(spark, sf).select(*_cols(t)), spec.required).bad


for _t in QUARANTINE_INPUT:
    _register_quarantine(_t)


# handy for other groups
def scd2_initial(spark, sf, t):
    return _init(spark, sf, t)


__all__ = ["scd2_standard_sql", "scd2_as_coded_sql", "scd2_initial"]


# --- streaming ---------------------------------------------------------------

@query("silver_stream_customers", scd2_standard_sql("customers"))
def q_stream_customers(spark, sf):
    """Two landed batches, each picked up by its own incremental stream run."""
    from medalake.sinks.landing import land_json
    from medalake.streaming.incremental import run_incremental_silver
    spec = SPECS["customers"]
    root = shared_dir(spark, "silver_stream_customers")
    land_json(_source(spark, sf, "customers"), f"{root}/landing", "customers", A.T0)
    run_incremental_silver(spark, spec, f"{root}/landing", f"{root}/silver", A.T0)
    land_json(_batch(spark, sf, "customers"), f"{root}/landing", "customers", A.T1)
    run_incremental_silver(spark, spec, f"{root}/landing", f"{root}/silver", A.T1)
    return read_silver(spark, f"{root}/silver/customers", spec.silver_schema)


def _register_small_batch(t):
    @query(f"silver_scd2_{t}_small_batch", scd2_standard_sql(t))
    def q(spark, sf):
        """The stored two-run job with the batch staged as files first; how the
        join is run is left to adaptive execution."""
        spec = SPECS[t]
        root = shared_dir(spark, f"silver_scd2_{t}_small_batch")
        silver_job(spark, spec, _source(spark, sf, t), root, A.T0)
        staged = f"{root}/_batch"
        _batch(spark, sf, t).write.mode("overwrite").parquet(staged)
        silver_job(spark, spec, spark.read.schema(spec.source_schema).parquet(staged), root, A.T1)
        return read_silver(spark, f"{root}/{t}", spec.silver_schema)


for _t in ("customers", "product_suppliers"):
    _register_small_batch(_t)


@query("silver_scd2_product_suppliers_bucketed", scd2_standard_sql("product_suppliers"))
def q_bucketed(spark, sf):
    """The stored two-run job on a table bucketed by its keys: the second run's batch is dealt into the buckets, the
    table isn't shuffled."""
    spec = dataclasses.replace(SPECS["product_suppliers"], buckets=16)
    root = shared_dir(spark, "silver_scd2_product_suppliers_bucketed")
    silver_job(spark, spec, _source(spark, sf, "product_suppliers"), root, A.T0)
    silver_job(spark, spec, _batch(spark, sf, "product_suppliers"), root, A.T1)
    return read_silver(spark, f"{root}/product_suppliers", spec.silver_schema)
