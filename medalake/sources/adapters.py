"""Map the provided test tables onto the retail model (the operational databases).

In production the sources are JDBC relations (``sources.jdbc``); for tests
and benchmarks the generated TPC-H-like parquet tables stand in for them.
All mappings are column expressions over full scans, so Catalyst prunes
columns and pushes predicates into the parquet readers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed load times of the two test batches.
T0 = dt.datetime(2024, 6, 1, 0, 0, 0)
T1 = dt.datetime(2024, 7, 1, 0, 0, 0)
BASE_TIME = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
# An order line's id has this many places for line numbers in an order, and for
# distinct (part, supplier) pairs on a line. Beyond either, ids would meet, so the
# adapter fails instead.
LINES_PER_ORDER, PAIRS_PER_LINE = 1000, 1000


_READERS: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given (read-only) test table. The reader DataFrame is reused within a
    session: resolving a parquet relation lists files and reads footers on
    the driver, which is worth doing once per table, not once per use."""
    key = (str(spark._jsparkSession.sessionUUID()), sf_dir.rstrip("/"), name)
    df = _READERS.get(key)
    if df is None:
        df = _READERS[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df


def _minutes_after_base(c: str):
    return F.timestamp_add("MINUTE", F.col(c), F.expr(BASE_TIME))


def _mail(c: str):
    return F.concat(F.lower(F.regexp_replace(F.col(c), "#", "")), F.lit("@example.com"))


def customers(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 17 != 0, _mail("c_name")).alias("email"),
        _minutes_after_base("c_custkey").alias("updated_at"))


def orders(spark, sf_dir, with_status_flag: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cols = [F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("total_amount"),
            F.col("o_orderdate").alias("updated_at")]
    if with_status_flag:
        # gold test input: an order counts as active unless fulfilled
        cols.append((F.col("o_orderstatus") != "F").alias("is_active"))
    return o.select(*cols)


def _below(c, limit: int, what: str):
    return F.when((c >= 0) & (c < limit), c).when(c.isNotNull(), F.raise_error(F.lit(f"more {what} than ids")).cast("long"))


def order_items(spark, sf_dir, dedup: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    # the id counts the distinct (part, supplier) pairs of an order line, so it
    # is free of collisions whatever the size of the part and supplier keys
    line = ["l_orderkey", "l_linenumber"]
    place = F.dense_rank().over(Window.partitionBy(*line).orderBy("l_partkey", "l_suppkey"))
    if dedup:
        # the lines of an order lie together: one shuffle serves the window and the aggregate, and packs well
        li = li.repartition("l_orderkey")
    df = li.select(*line, place.cast("long").alias("place"), F.col("l_partkey").alias("product_id"),
                   F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_extendedprice").alias("price"),
                   F.col("l_shipdate").alias("updated_at"))
    if dedup:
        # one row per id: latest updated_at, then largest quantity
        from medalake.operators.dedup import latest_per_key
        df = latest_per_key(df, [*line, "place"], ["updated_at", "quantity"])
    number = _below(F.col("l_linenumber").cast("long"), LINES_PER_ORDER, "lines in an order")
    return df.select(
        ((F.col("l_orderkey") * LINES_PER_ORDER + number) * PAIRS_PER_LINE
         + _below(F.col("place"), PAIRS_PER_LINE, "part and supplier pairs in an order line")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"), "product_id", "quantity", "price", "updated_at")


def categories(spark, sf_dir, quarantine_case: bool = False) -> DataFrame:
    # The ranking window runs over the distinct type list only, never over the
    # part table: the distinct is a distributed aggregate, and its output is
    # bounded by the generator's fixed type vocabulary (6 values here), so
    # the single-partition window sees a handful of rows.
    types = table(spark, sf_dir, "part").select("p_type").distinct()
    ranked = types.select(
        F.dense_rank().over(Window.orderBy("p_type")).cast("bigint").alias("category_id"),
        F.col("p_type").alias("name"))
    name = F.col("name")
    if quarantine_case:
        name = F.when(F.col("category_id") != 6, F.col("name"))
    return ranked.select("category_id", name.alias("name"),
                         _minutes_after_base("category_id").alias("updated_at"))


def products(spark, sf_dir, quarantine_case: bool = False, cats: DataFrame | None = None) -> DataFrame:
    p = table(spark, sf_dir, "part")
    cats = (cats if cats is not None else categories(spark, sf_dir)).select(
        "category_id", F.col("name").alias("p_type"))
    name = F.col("p_name")
    if quarantine_case:
        name = F.when(F.col("p_partkey") % 13 != 0, F.col("p_name"))
    # join strategy left to AQE: the category list is broadcast only when its
    # measured size is under the broadcast threshold
    return p.join(cats, "p_type").select(
        F.col("p_partkey").alias("product_id"),
        name.alias("name"),
        F.col("category_id"),
        F.col("p_retailprice").alias("price"),
        _minutes_after_base("p_partkey").alias("updated_at"))


def suppliers(spark, sf_dir, quarantine_case: bool = False) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    name = F.col("s_name")
    if quarantine_case:
        name = F.when(F.col("s_suppkey") % 9 != 0, F.col("s_name"))
    key = F.col("s_suppkey").cast("string")
    return s.join(geo, s.s_nationkey == geo.n_nationkey).select(
        F.col("s_suppkey").alias("supplier_id"),
        name.alias("supplier_name"),
        F.concat(F.lit("Contact "), key).alias("contact_name"),
        F.concat(F.lit("+"), (F.col("s_nationkey") + 10).cast("string"), F.lit("-"),
                 F.lpad(key, 7, "0")).alias("phone"),
        _mail("s_name").alias("email"),
        F.concat(key, F.lit(" Market Street")).alias("address"),
        F.col("r_name").alias("city"),
        F.col("n_name").alias("country"),
        _minutes_after_base("s_suppkey").alias("created_at"))


def product_suppliers(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_suppkey").alias("supplier_id"), F.col("l_partkey").alias("product_id"))
            .agg(F.min("l_extendedprice").alias("supply_price"),
                 F.max("l_shipdate").alias("last_updated")))


def review_payload(spark, sf_dir) -> DataFrame:
    """The reviews feed, as the fetched records would arrive (one per event)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("product_id"),
        (F.col("event_id") % 5 + 1).alias("rating"),
        F.col("event_type").alias("review_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("review_date"))


def audit_history(spark, sf_dir) -> DataFrame:
    """An audit log with history: one SUCCESS row per event."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("tablename"),
        F.lit("Incremental").alias("load_type"),
        F.floor("value").cast("bigint").alias("record_count"),
        F.col("ts").alias("load_timestamp"),
        F.lit("SUCCESS").alias("status"),
        F.lit("events").alias("datasource"),
        F.col("ts").alias("high_watermark"))


SOURCES = {
    "customers": customers,
    "orders": orders,
    "order_items": lambda spark, sf_dir: order_items(spark, sf_dir, dedup=True),
    "products": products,
    "categories": categories,
    "suppliers": suppliers,
    "product_suppliers": product_suppliers,
}


def source(spark, sf_dir, name: str) -> DataFrame:
    return SOURCES[name](spark, sf_dir)


# --- the second SCD2 batch --------------------------------------------------
# selector digit d = (selector column) % 10:
#   0 value changed, 1 identical, 2 key moved to a new one, 3 value -> NULL,
#   4..9 absent from the batch.
BATCH_RULES = {
    # table: (selector, changed column, change, negated key, nulled column); real
    # keys are not negative, so a negated one is new at every scale
    "customers": ("customer_id", "name", lambda c: F.concat(c, F.lit("!")), "customer_id", "email"),
    "orders": ("order_id", "total_amount", lambda c: c + 1, "order_id", "customer_id"),
    "order_items": ("order_id", "quantity", lambda c: c + 1, "order_item_id", "price"),
    "product_suppliers": ("product_id", "supply_price", lambda c: c + 1, "product_id", "last_updated"),
}


def second_batch(df: DataFrame, table_name: str) -> DataFrame:
    sel, changed, change, key, nulled = BATCH_RULES[table_name]
    d = F.col(sel) % 10
    out = []
    for c in df.columns:
        e = F.col(c)
        if c == changed:
            e = F.when(d == 0, change(e)).otherwise(e)
        if c == key:
            e = F.when(d == 2, -e).otherwise(e)
        if c == nulled:
            e = F.when(d == 3, F.lit(None).cast(df.schema[c].dataType)).otherwise(e)
        out.append(e.alias(c))
    return df.filter(d < 4).select(*out)
