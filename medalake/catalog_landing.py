"""Landing, bronze, refresh, expression and end-to-end queries (registered on
import) and their SQL oracles. Writers use a fresh folder under the
session's shared checkpoint directory and return what they read back."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from medalake import oracle as O
from medalake import schemas
from medalake.catalog import query
from medalake.catalog_silver import ORACLES, scd2_standard_sql
from medalake.functions import expressions as X
from medalake.operators.refresh import from_landing
from medalake.operators.sales import sales_summary
from medalake.plans import landing as L
from medalake.plans.config import RETAILER_CONFIG, SUPPLIER_CONFIG, TEST_EXTRA, config_frame
from medalake.plans.gold import read_current
from medalake.plans.medallion import lake_paths, run_medallion
from medalake.plans.silver import silver_from_landing, silver_job
from medalake.plans.specs import SPECS
from medalake.session import shared_dir
from medalake.sinks import landing as K
from medalake.sinks.gold import newest_build, read_gold, read_months, write_gold
from medalake.sinks.tables import read_silver
from medalake.sources import adapters as A
from medalake.sources.bronze import canonical, read_bronze, read_bronze_reviews, silver_view

ALL_TABLES = ("products", "categories", "customers", "orders", "order_items", "suppliers",
              "product_suppliers")
SRC = {"customers": "customers_src", "orders": "orders_src", "order_items": "items_src",
       "products": "products_src", "categories": "categories_src", "suppliers": "suppliers_src",
       "product_suppliers": "product_suppliers_src"}
CONFIG_ROWS = RETAILER_CONFIG + SUPPLIER_CONFIG
CFG = {r[2]: r for r in CONFIG_ROWS}


def _landing_cols(t):
    times = schemas.TIME_COLUMNS[t]
    return ", ".join(f"(epoch_us({c}) // 1000) AS {c}" if c in times else c
                     for c in schemas.SOURCE[t].fieldNames())


def _landing_select(t, frag, where=""):
    return f"SELECT {_landing_cols(t)} FROM {frag} {where}"


def _landing_sql(t, frag=None, where=""):
    frag = frag or SRC[t]
    return O.with_(_landing_select(t, frag, where), frag)


def _sources(spark, sf):
    return lambda t: A.source(spark, sf, t)


def _cfg(t, loadtype=None):
    r = CFG[t]
    return dict(zip(schemas.CONFIG.fieldNames(), r if loadtype is None else r[:3] + (loadtype,) + r[4:]))


# --- rows of different tables in one relation ---------------------------------

#: (Spark type, DuckDB type) -> how many columns of that type a row of any table needs.
SLOTS = {("bigint", "BIGINT"): 5, ("double", "DOUBLE"): 1, ("timestamp_ntz", "TIMESTAMP"): 4,
         ("boolean", "BOOLEAN"): 2, ("string", "VARCHAR"): 8}


def _slots(typed: dict[str, str]) -> list[tuple[str, str, str, str | None]]:
    """(slot, Spark type, DuckDB type, column that fills it or None) for the columns ``name -> Spark type``."""
    out = []
    for (kind, sql), n in SLOTS.items():
        names = [c for c, k in typed.items() if k == kind]
        assert len(names) <= n, (kind, names)
        out += [(f"{kind}_{i + 1}", kind, sql, names[i] if i < len(names) else None) for i in range(n)]
    assert sum(c is not None for *_, c in out) == len(typed)
    return out


def _as_slots(df, table):
    return df.select(F.lit(table).alias("table_name"), *[
        (F.lit(None).cast(kind) if c is None else F.col(c)).alias(slot)
        for slot, kind, _, c in _slots(dict(df.dtypes))])


def _slots_sql(table, typed, frag):
    cols = ", ".join(f"CAST({c or 'NULL'} AS {sql}) AS {slot}" for slot, _, sql, c in _slots(typed))
    return f"SELECT '{table}' AS table_name, {cols} FROM {frag}"


def _source_types(t):
    """Stated columns of a source table with their types, told by the names."""
    def kind(c):
        if c.endswith("_at") or c in ("order_date", "last_updated"):
            return "timestamp_ntz"
        if c in ("price", "total_amount", "supply_price"):
            return "double"
        return "bigint" if c.endswith("_id") or c == "quantity" else "string"
    return {c: kind(c) for c in ORACLES[t].columns}


# --- landing ------------------------------------------------------------------

@query("land_extract_full", _landing_sql("orders"))
def q_extract_full(spark, sf):
    root = shared_dir(spark, "land_extract_full")
    path = K.land_json(L.extract(A.orders(spark, sf), "full", None, None), root, "orders", A.T0)
    return read_bronze(spark, root, "orders", path)


INCR_CUT = "TIMESTAMP '2000-01-01 00:00:00'"


@query("land_extract_incremental", _landing_sql(
    "order_items", where=f"WHERE updated_at > (SELECT max(updated_at) FROM items_src WHERE updated_at <= {INCR_CUT})"))
def q_extract_incremental(spark, sf):
    """Two incremental runs: the first sees the source as it stood at the
    cut-off, the second extracts only rows past the recorded high-watermark."""
    paths = lake_paths(shared_dir(spark, "land_extract_incremental"))
    items = A.source(spark, sf, "order_items")
    log = L.RunLog(A.T0)
    cfg = _cfg("order_items")
    L.ingest_table(spark, items.filter(F.col("updated_at") <= X.ts_literal("2000-01-01 00:00:00")),
                   cfg, paths, A.T0, log)
    L.ingest_table(spark, items, cfg, paths, A.T1, log)
    newest = K.landed_batches(spark, paths.landing, "order_items")[-1]
    return read_bronze(spark, paths.landing, "order_items", f"{paths.landing}/order_items/{newest}")


def _two_runs_one_day(spark, sf, name):
    """Customers ingested twice on one day, before silver: the second run takes what came after the first."""
    paths = lake_paths(shared_dir(spark, name))
    rows, cfg, log = A.customers(spark, sf), _cfg("customers"), L.RunLog(A.T0)
    L.ingest_table(spark, rows.filter(F.col("updated_at") <= X.ts_literal("2024-01-01 10:00:00")), cfg, paths, A.T0, log)
    L.ingest_table(spark, rows, cfg, paths, A.T0 + dt.timedelta(hours=6), log)
    return paths


@query("land_two_runs_one_day", _landing_sql("customers"))
def q_two_runs_one_day(spark, sf):
    """Both batches lie in the landing area: the second run keeps the first one's."""
    return read_bronze(spark, _two_runs_one_day(spark, sf, "land_two_runs_one_day").landing, "customers")


@query("silver_after_two_ingests", O.with_(
    "SELECT *, email IS NULL OR name IS NULL AS is_quarantined, TIMESTAMP '2024-07-01 00:00:00' AS effective_start_date, "
    f"{O.NULL_TS} AS effective_end_date, TRUE AS is_active FROM customers_src", "customers_src"))
def q_silver_after_two_ingests(spark, sf):
    """One silver run after two ingests merges both batches."""
    from medalake.plans.silver import silver_from_landing
    from medalake.sinks.tables import read_silver
    paths = _two_runs_one_day(spark, sf, "silver_after_two_ingests")
    root = shared_dir(spark, "silver_after_two_ingests", "silver")
    silver_from_landing(spark, paths.landing, root, A.T1, tables=["customers"])
    return read_silver(spark, f"{root}/customers", SPECS["customers"].silver_schema)


@query("land_json_roundtrip", O.with_("SELECT * FROM customers_src", "customers_src"))
def q_json_roundtrip(spark, sf):
    root = shared_dir(spark, "land_json_roundtrip")
    path = K.land_json(A.customers(spark, sf), root, "customers", A.T0)
    return from_landing(read_bronze(spark, root, "customers", path), SPECS["customers"])


WATERMARKS_SQL = O.with_("""
SELECT n.tablename AS tablename,
       coalesce(max(a.high_watermark), TIMESTAMP '1900-01-01 00:00:00') AS latest_watermark
FROM (SELECT DISTINCT tablename FROM audit_src UNION SELECT 'never_loaded') n
LEFT JOIN (SELECT * FROM audit_src WHERE status = 'SUCCESS') a ON a.tablename = n.tablename
GROUP BY n.tablename""", "audit_src")


@query("land_watermark_lookup", WATERMARKS_SQL)
def q_watermark_lookup(spark, sf):
    path = shared_dir(spark, "audit_log")
    A.audit_history(spark, sf).write.mode("overwrite").parquet(path)
    audit = spark.read.schema(schemas.AUDIT).parquet(path)
    names = audit.select("tablename").unionByName(
        spark.createDataFrame([("never_loaded",)], "tablename string"))
    return L.latest_watermarks(audit, names)


@query("land_watermark_state", WATERMARKS_SQL)
def q_watermark_state(spark, sf):
    """S4/A1 as a run looks it up: table by table (control plane), from the stored audit's partitions and footers."""
    path = shared_dir(spark, "audit_state")
    history = A.audit_history(spark, sf)
    L.append_audit(history, path)
    names = [r.tablename for r in history.select("tablename").distinct().collect()] + ["never_loaded"]
    return spark.createDataFrame([(n, L.lookup_watermark(spark, path, n, "events")) for n in names],
                                 "tablename string, latest_watermark timestamp_ntz")


def _ingest_run(spark, sf, name):
    paths = lake_paths(shared_dir(spark, name))
    log = L.ingest_all(spark, config_frame(spark, CONFIG_ROWS + TEST_EXTRA), _sources(spark, sf),
                       paths, A.T0)
    return paths, log


def _audit_sql():
    parts = []
    for t in ALL_TABLES:
        _, ds, _, lt, w, _, _ = CFG[t]
        high = f"max({w})" if lt == "Incremental" else O.NULL_TS
        parts.append(f"SELECT '{t}' AS tablename, '{lt}' AS load_type, count(*) AS record_count, "
                     f"{O.T0} AS load_timestamp, 'SUCCESS' AS status, '{ds}' AS datasource, "
                     f"{high} AS high_watermark FROM {SRC[t]}")
    return O.with_("\nUNION ALL ".join(parts), *SRC.values())


@query("land_audit_append", _audit_sql())
def q_audit_append(spark, sf):
    paths, _ = _ingest_run(spark, sf, "land_audit_append")
    return spark.read.schema(schemas.AUDIT).parquet(paths.audit)


def _run_log_sql():
    n_cfg = len(CONFIG_ROWS + TEST_EXTRA)
    parts = [f"SELECT {O.T0} AS timestamp, 'INFO' AS event_type, 'config: {n_cfg} rows' AS message, "
             "CAST(NULL AS VARCHAR) AS \"table\""]
    for r in CONFIG_ROWS + TEST_EXTRA:
        t, lt, active = r[2], r[3], r[5]
        if active != "1":
            continue
        if t not in SRC:
            parts.append(f"SELECT {O.T0}, 'ERROR', '{t}: failed with KeyError: ''{t}''', '{t}'")
            continue
        if lt == "Incremental":
            parts.append(f"SELECT {O.T0}, 'INFO', '{t}: loading changes after 1900-01-01 00:00:00', '{t}'")
        parts.append(f"SELECT {O.T0}, 'SUCCESS', '{t}: landed ' || CAST(count(*) AS VARCHAR) "
                     f"|| ' rows', '{t}' FROM {SRC[t]}")
        parts.append(f"SELECT {O.T0}, 'SUCCESS', '{t}: audit row written', '{t}'")
        parts.append(f"SELECT {O.T0}, 'INFO', '{t}: nothing to archive', '{t}'")
    events = "\nUNION ALL ".join(parts)
    return O.with_(f"SELECT kept_in, e.* FROM ({events}) e, (VALUES ('table'), ('document')) k(kept_in)", *SRC.values())


@query("land_run_log", _run_log_sql())
def q_run_log(spark, sf):
    """K4 and K5: the run's events in the log table and in the JSON document named by the run's time."""
    paths, log = _ingest_run(spark, sf, "land_run_log")
    documents = f"{paths.logs}-documents"
    log.save(spark, paths.logs, documents)
    table = spark.read.schema(schemas.RUN_LOG).parquet(paths.logs)
    document = spark.read.schema(schemas.RUN_LOG).json(f"{documents}/pipeline_log_20240601000000.json")
    return table.withColumn("kept_in", F.lit("table")).unionByName(document.withColumn("kept_in", F.lit("document")))


@query("land_archive", O.with_(
    f"SELECT {_landing_cols('customers')}, '2024' AS year, '06' AS month, '01' AS day FROM customers_src",
    "customers_src"))
def q_archive(spark, sf):
    """Day 1 lands customers; day 2's run archives day 1's batch by the date in its name (the reference's order,
    which doesn't wait for silver)."""
    paths = lake_paths(shared_dir(spark, "land_archive"))
    log = L.RunLog(A.T0)
    src = A.customers(spark, sf)
    cfg = _cfg("customers", "Full Load")
    L.ingest_table(spark, src, cfg, paths, A.T0, log)
    L.ingest_table(spark, src, cfg, paths, A.T1, log, archive_unmerged=True)
    return L.read_archive(spark, paths.archive, "customers")


def _payload(spark, sf, name, predicate=None):
    path = shared_dir(spark, name, "payload")
    df = A.review_payload(spark, sf)
    if predicate is not None:
        df = df.filter(predicate)
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


@query("land_reviews_batch", O.with_("SELECT * FROM reviews_src", "reviews_src"))
def q_reviews_batch(spark, sf):
    root = shared_dir(spark, "land_reviews_batch")
    L.land_reviews_batch(spark, _payload(spark, sf, "land_reviews_batch"), root, A.T0)
    return read_bronze_reviews(spark, root)


def _ingest_all_sql():
    counts = " UNION ALL ".join(f"SELECT '{t}' AS tablename, count(*) AS n FROM {SRC[t]}" for t in ALL_TABLES)
    vals = ", ".join(f"('{r[2]}', '{r[5]}')" for r in CONFIG_ROWS + TEST_EXTRA)
    return O.with_(f"""
SELECT c.tablename AS tablename, c.is_active AS is_active,
       CASE WHEN c.is_active <> '1' THEN 'SKIPPED' WHEN n.n IS NOT NULL THEN 'SUCCESS' ELSE 'ERROR' END AS outcome,
       CAST(n.n AS BIGINT) AS landed_rows
FROM (VALUES {vals}) c(tablename, is_active) LEFT JOIN ({counts}) n ON n.tablename = c.tablename""",
                   *SRC.values())


@query("land_ingest_all", _ingest_all_sql())
def q_ingest_all(spark, sf):
    """Outcome per config row: inactive rows are skipped, a failing table does
    not stop the others; landed rows are counted from the landing area."""
    paths, _ = _ingest_run(spark, sf, "land_ingest_all")
    audit = spark.read.schema(schemas.AUDIT).parquet(paths.audit).select(
        "tablename", F.col("record_count").alias("landed_rows"))
    cfg = config_frame(spark, CONFIG_ROWS + TEST_EXTRA).select("tablename", "is_active")
    return cfg.join(audit, "tablename", "left").select(
        "tablename", "is_active",
        F.when(F.col("is_active") != "1", "SKIPPED").when(F.col("landed_rows").isNotNull(), "SUCCESS")
        .otherwise("ERROR").alias("outcome"),
        "landed_rows")


DISPATCH_ROWS = CONFIG_ROWS + [("retailer", "retailer_db", "orders", "Delta", "updated_at", "1", "x")]


#: The load mode that each stated load type means.
STATED_MODES = {"Full Load": "full", "Incremental": "incremental", "Delta": "invalid"}


def _dispatch_sql():
    parts = []
    for r in DISPATCH_ROWS:
        t, lt, w = r[2], r[3], r[4]
        mode = STATED_MODES[lt]
        if mode == "full":
            n = f"(SELECT count(*) FROM {SRC[t]})"
        elif mode == "incremental":
            n = f"(SELECT count(*) FROM {SRC[t]} WHERE {w} > {INCR_CUT})"
        else:
            n = "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT '{t}' AS tablename, '{lt}' AS loadtype, '{mode}' AS load_mode, {n} AS extracted_rows")
    return O.with_("\nUNION ALL ".join(parts), *SRC.values())


@query("land_load_type_dispatch", _dispatch_sql())
def q_load_type_dispatch(spark, sf):
    """Per config row, the dispatched load mode and the rows it extracts
    (incremental from a fixed watermark); an unknown type extracts nothing."""
    with_mode = L.with_load_mode(config_frame(spark, DISPATCH_ROWS))
    parts = []
    for r in DISPATCH_ROWS:   # one lazy count per config row, unioned into one job
        t, lt, w = r[2], r[3], r[4]
        mode = L.load_mode(lt)
        if mode == "invalid":
            n = F.lit(None).cast("bigint")
            base = spark.range(1)
        else:
            base = L.extract(A.source(spark, sf, t), mode, w, "2000-01-01 00:00:00").agg(
                F.count(F.lit(1)).alias("n"))
            n = F.col("n")
        parts.append(base.select(F.lit(t).alias("tablename"), F.lit(lt).alias("loadtype"), n.alias("extracted_rows")))
    counts = reduce(lambda a, b: a.unionByName(b), parts)
    modes = with_mode.select("tablename", "loadtype", "load_mode").distinct()
    return counts.join(modes, ["tablename", "loadtype"]).select(
        "tablename", "loadtype", "load_mode", "extracted_rows")


# --- bronze -------------------------------------------------------------------

def _register_bronze(t):
    @query(f"bronze_{t}", _landing_sql(t))
    def q(spark, sf):
        root = shared_dir(spark, f"bronze_{t}")
        K.land_json(A.source(spark, sf, t), root, t, A.T0)
        return read_bronze(spark, root, t)


for _t in ALL_TABLES:
    _register_bronze(_t)


@query("bronze_customer_reviews", O.with_("SELECT * FROM reviews_src", "reviews_src"))
def q_bronze_reviews(spark, sf):
    """Two dated review batches; the declared table reads every dated file."""
    root = shared_dir(spark, "bronze_customer_reviews")
    for i, day in enumerate((A.T0, A.T1)):
        payload = _payload(spark, sf, "bronze_customer_reviews", F.col("id").cast("bigint") % 2 == i)
        L.land_reviews_batch(spark, payload, root, day)
    return read_bronze_reviews(spark, root)


def _bronze_scan_sql(t):
    types = {c: "bigint" if k == "timestamp_ntz" else k for c, k in _source_types(t).items()}
    return _slots_sql(t, types, f"({_landing_select(t, SRC[t])})")


@query("bronze_json_scan", O.with_(" UNION ALL ".join(map(_bronze_scan_sql, ALL_TABLES)), *SRC.values()))
def q_bronze_json_scan(spark, sf):
    """Every row and value of the seven landed tables."""
    paths, _ = _ingest_run(spark, sf, "bronze_json_scan")
    return reduce(lambda a, b: a.unionByName(b),
                  [_as_slots(read_bronze(spark, paths.landing, t), t) for t in ALL_TABLES])


@query("silver_column_order", _landing_sql("orders"))
def q_column_order(spark, sf):
    """A read whose columns come back sorted by name (as JSON inference
    returns them) put back into the declared order."""
    root = shared_dir(spark, "silver_column_order")
    K.land_json(A.orders(spark, sf), root, "orders", A.T0)
    sorted_schema = schemas.struct(*sorted((f.name, f.dataType) for f in schemas.BRONZE["orders"].fields))
    df = spark.read.schema(sorted_schema).json(K.landed_glob(root, "orders"))
    return canonical(df, schemas.BRONZE["orders"])


# --- silver full refresh + declared reads ---------------------------------------

REFRESH_INPUT = {
    "categories": ("categories_q", lambda spark, sf: A.categories(spark, sf, quarantine_case=True)),
    "products": ("products_q", lambda spark, sf: A.products(spark, sf, quarantine_case=True)),
    "suppliers": ("suppliers_q", lambda spark, sf: A.suppliers(spark, sf, quarantine_case=True)),
}


def _register_refresh(t):
    frag, fn = REFRESH_INPUT[t]
    spec, stated = SPECS[t], ORACLES[t]
    flag = " OR ".join(f"{c} IS NULL" for c in stated.required)
    cols = ", ".join(stated.columns)

    @query(f"silver_refresh_{t}", O.with_(
        f"SELECT {cols}, ({flag}) AS is_quarantined, {O.T0} AS effective_start_date, "
        f"{O.NULL_TS} AS effective_end_date, TRUE AS is_active FROM {frag}", frag))
    def q(spark, sf):
        root = shared_dir(spark, f"silver_refresh_{t}")
        K.land_json(fn(spark, sf), f"{root}/landing", t, A.T0)
        incoming = from_landing(read_bronze(spark, f"{root}/landing", t), spec)
        silver_job(spark, spec, incoming, f"{root}/silver", A.T0)
        return read_silver(spark, f"{root}/silver/{t}", spec.silver_schema)


for _t in REFRESH_INPUT:
    _register_refresh(_t)


#: What the declared silver tables show beside the source columns.
STATED_VIEWS = {"customers": ("flag", "scd"), "orders": ("scd",), "order_items": ("scd",), "products": ("flag",),
                "categories": ("flag",), "product_suppliers": ("scd",), "suppliers": ()}


def _tables_read_sql(t):
    types, select = _source_types(t), ", ".join(ORACLES[t].columns)
    if "flag" in STATED_VIEWS[t]:
        types["is_quarantined"] = "boolean"
        select += ", (" + " OR ".join(f"{c} IS NULL" for c in ORACLES[t].required) + ") AS is_quarantined"
    if "scd" in STATED_VIEWS[t]:
        types |= {"effective_start_date": "timestamp_ntz", "effective_end_date": "timestamp_ntz",
                  "is_active": "boolean"}
        select += f", {O.T0} AS effective_start_date, {O.NULL_TS} AS effective_end_date, TRUE AS is_active"
    return _slots_sql(t, types, f"(SELECT {select} FROM {SRC[t]})")


@query("silver_tables_read", O.with_(" UNION ALL ".join(map(_tables_read_sql, ALL_TABLES)), *SRC.values()))
def q_tables_read(spark, sf):
    """Land, run the seven silver jobs, read each declared silver table."""
    root = shared_dir(spark, "silver_tables_read")
    paths = lake_paths(root)
    L.ingest_all(spark, config_frame(spark), _sources(spark, sf), paths, A.T0)
    silver_from_landing(spark, paths.landing, f"{root}/silver", A.T0)
    return reduce(lambda a, b: a.unionByName(b),
                  [_as_slots(silver_view(read_current(spark, f"{root}/silver", t), t), t) for t in ALL_TABLES])


# --- gold sink + end to end ---------------------------------------------------

@query("gold_rerun_idempotent", O.gold_sql())
def q_gold_rerun(spark, sf):
    """K9: the gold job written twice into the same table equals one run."""
    gold_dir = shared_dir(spark, "gold_rerun_idempotent")
    df = sales_summary(A.orders(spark, sf, with_status_flag=True), A.order_items(spark, sf),
                       A.products(spark, sf), A.categories(spark, sf))
    write_gold(df, spark, gold_dir)
    write_gold(df, spark, gold_dir)
    return read_gold(spark, gold_dir)


@query("medallion_end_to_end", O.gold_sql("orders_src", "items_src", "TRUE"))
def q_end_to_end(spark, sf):
    """Landing (seven tables and the reviews feed) -> silver -> gold."""
    root = shared_dir(spark, "medallion_end_to_end")
    return run_medallion(spark, _sources(spark, sf), root, A.T0,
                         reviews_payload=_payload(spark, sf, "medallion_end_to_end"))


def _as_coded_days_sql():
    day = O.gold_sql("orders_src", "items_src", "TRUE")
    second = day.replace("p.name AS product_name", "p.name || '!' AS product_name")
    return f"SELECT * FROM ({day}) UNION ALL SELECT * FROM ({second})"


@query("medallion_as_coded_two_days", _as_coded_days_sql())
def q_as_coded_days(spark, sf):
    """C9 as coded on two days; products are renamed in between. Each day's batch replaces the last one's in the
    landing area, orders and items bring nothing after the first day, and gold is appended to."""
    root = shared_dir(spark, "medallion_as_coded_two_days")

    def renamed(t):
        df = A.source(spark, sf, t)
        return df.withColumn("name", F.concat("name", F.lit("!"))) if t == "products" else df

    run_medallion(spark, _sources(spark, sf), root, A.T0, mode="as_coded")
    return run_medallion(spark, renamed, root, A.T1, mode="as_coded")


# --- scalar expressions ---------------------------------------------------------

@query("expr_epoch_ms", O.with_(
    "SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch_ms(epoch_us(ts) // 1000) AS ts_ms FROM events"))
def q_epoch_ms(spark, sf):
    e = A.table(spark, sf, "events")
    ms = X.ts_to_epoch_ms("ts")
    return e.select("event_id", ms.alias("ms"), X.epoch_ms_to_ts(ms).alias("ts_ms"))


@query("expr_to_date", "SELECT 'order' AS kind, o_orderkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders "
                       "UNION ALL SELECT 'event', event_id, CAST(ts AS DATE) FROM events")
def q_to_date(spark, sf):
    """Both tables whole, one row each."""
    o = A.table(spark, sf, "orders").select(
        F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), X.to_day("o_orderdate").alias("day"))
    e = A.table(spark, sf, "events").select(
        F.lit("event").alias("kind"), F.col("event_id").alias("id"), X.to_day("ts").alias("day"))
    return o.unionByName(e)


@query("expr_file_date", """
SELECT order_id, file_name, file_day, strftime(file_day, '%Y') AS year, strftime(file_day, '%m') AS month,
       strftime(file_day, '%d') AS day
FROM (SELECT order_id, file_name,
             CAST(strptime(regexp_extract(file_name, '_(\\d{8})(\\.json)?(/[^/]*)?$', 1), '%d%m%Y') AS DATE) AS file_day
      FROM (SELECT o_orderkey AS order_id, 'orders_' || strftime(o_orderdate, '%d%m%Y') || '.json' AS file_name
            FROM orders))""")
def q_file_date(spark, sf):
    o = A.table(spark, sf, "orders")
    named = o.select(F.col("o_orderkey").alias("order_id"),
                     F.concat(F.lit("orders_"), X.stamp_name("o_orderdate", X.DB_FILE_DATE), F.lit(".json"))
                     .alias("file_name"))
    d = X.file_date("file_name")
    return named.select("order_id", "file_name", d.alias("file_day"), F.date_format(d, "yyyy").alias("year"),
                        F.date_format(d, "MM").alias("month"), F.date_format(d, "dd").alias("day"))


@query("expr_date_format", """
SELECT event_id, strftime(ts, '%d%m%Y') AS db_stamp, strftime(ts, '%Y%m%d') AS reviews_stamp,
       strftime(ts, '%Y%m%d%H%M%S') AS log_stamp
FROM events""")
def q_date_format(spark, sf):
    e = A.table(spark, sf, "events")
    return e.select("event_id", X.stamp_name("ts", X.DB_FILE_DATE).alias("db_stamp"),
                    X.stamp_name("ts", X.REVIEWS_FILE_DATE).alias("reviews_stamp"),
                    X.stamp_name("ts", X.LOG_FILE_STAMP).alias("log_stamp"))



def _gold_two_runs_sql():
    return O.with_(f"""
SELECT CAST(o.order_date AS DATE) AS order_date, p.category_id AS category_id, c.name AS category_name,
       i.product_id AS product_id, p.name AS product_name,
       CAST(sum(i.quantity) AS BIGINT) AS total_units_sold,
       CAST(sum(CAST(i.price AS DECIMAL(12,2)) * i.quantity) AS DOUBLE) AS total_sales,
       CAST(count(DISTINCT o.customer_id) AS BIGINT) AS unique_customers
FROM ({scd2_standard_sql("orders")}) o
JOIN ({scd2_standard_sql("order_items")}) i ON o.order_id = i.order_id
JOIN products_src p ON i.product_id = p.product_id
JOIN categories_src c ON p.category_id = c.category_id
WHERE o.is_active AND i.is_active
GROUP BY 1, 2, 3, 4, 5""", "products_src", "categories_src")


def _gold_two_runs(spark, sf, name):
    """Two daily runs: the second merges the changed orders and items into
    silver, and gold counts only those changes. Returns the gold folder."""
    from medalake.plans.gold import gold_job
    root = shared_dir(spark, name)
    silver, gold = f"{root}/silver", f"{root}/gold"
    cats = A.categories(spark, sf)
    dims = {"products": A.products(spark, sf, cats=cats), "categories": cats}
    for t in ("products", "categories"):
        silver_job(spark, SPECS[t], dims[t], silver, A.T0)
    for t in ("orders", "order_items"):
        silver_job(spark, SPECS[t], A.source(spark, sf, t), silver, A.T0)
    gold_job(spark, silver, gold, as_of=A.T0, incremental=True)
    for t in ("products", "categories"):
        silver_job(spark, SPECS[t], dims[t], silver, A.T1)          # refreshed, same content
    for t in ("orders", "order_items"):
        silver_job(spark, SPECS[t], A.second_batch(A.source(spark, sf, t), t), silver, A.T1)
    gold_job(spark, silver, gold, as_of=A.T1, incremental=True)
    return gold


@query("gold_incremental_two_runs", _gold_two_runs_sql())
def q_gold_incremental(spark, sf):
    return read_gold(spark, _gold_two_runs(spark, sf, "gold_incremental_two_runs"))


@query("gold_counts_two_runs", O.with_(f"""
SELECT CAST(o.order_date AS DATE) AS day, i.product_id AS product_id, o.customer_id AS customer_id, count(*) AS n,
       CAST(coalesce(sum(i.quantity), 0) AS BIGINT) AS units,
       CAST(coalesce(sum(CAST(i.price AS DECIMAL(12,2)) * i.quantity), 0) AS DOUBLE) AS sales
FROM ({scd2_standard_sql("orders")}) o JOIN ({scd2_standard_sql("order_items")}) i ON o.order_id = i.order_id
WHERE o.is_active AND i.is_active
GROUP BY 1, 2, 3"""))
def q_gold_counts(spark, sf):
    """The counts that gold is derived from, after two runs: what the second one added and subtracted leaves just
    the lines that are active now."""
    gold = _gold_two_runs(spark, sf, "gold_counts_two_runs")
    counts = read_months(spark, gold, newest_build(spark, gold).counts, schemas.GOLD_COUNTS)
    each = counts.groupBy("day", "product_id", "customer_id").agg(
        F.sum("n").alias("n"), F.sum("units").alias("units"), F.sum("sales").cast("double").alias("sales"))
    return each.where("n <> 0 OR units <> 0 OR sales <> 0")
