"""Explicit schemas for every layer. No read in this package infers a schema.

Types: integer keys and counts are ``long``; money is ``double`` at table
boundaries (``decimal(12,2)`` inside sums); times are ``timestamp_ntz`` from
silver on (the source DATETIME is zone-less) and epoch-milliseconds ``long``
in the landing JSON.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType)

L, D, S, B, TS, DT = LongType(), DoubleType(), StringType(), BooleanType(), TimestampNTZType(), DateType()


def struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# --- source relations (as extracted from the operational databases) --------
SOURCE = {
    "customers": struct(("customer_id", L), ("name", S), ("email", S), ("updated_at", TS)),
    "orders": struct(("order_id", L), ("customer_id", L), ("order_date", TS),
                     ("total_amount", D), ("updated_at", TS)),
    "order_items": struct(("order_item_id", L), ("order_id", L), ("product_id", L),
                          ("quantity", L), ("price", D), ("updated_at", TS)),
    "products": struct(("product_id", L), ("name", S), ("category_id", L), ("price", D),
                       ("updated_at", TS)),
    "categories": struct(("category_id", L), ("name", S), ("updated_at", TS)),
    "suppliers": struct(("supplier_id", L), ("supplier_name", S), ("contact_name", S),
                        ("phone", S), ("email", S), ("address", S), ("city", S),
                        ("country", S), ("created_at", TS)),
    "product_suppliers": struct(("supplier_id", L), ("product_id", L), ("supply_price", D),
                                ("last_updated", TS)),
}

# time columns that travel as epoch-milliseconds through the landing JSON
TIME_COLUMNS = {
    "customers": ("updated_at",),
    "orders": ("order_date", "updated_at"),
    "order_items": ("updated_at",),
    "products": ("updated_at",),
    "categories": ("updated_at",),
    "suppliers": ("created_at",),
    "product_suppliers": ("last_updated",),
}


def landing_schema(table: str) -> StructType:
    """Bronze declared schema: the source schema with times as epoch-ms longs."""
    times = TIME_COLUMNS[table]
    return StructType([StructField(f.name, L if f.name in times else f.dataType, True)
                       for f in SOURCE[table].fields])


BRONZE = {t: landing_schema(t) for t in SOURCE}

REVIEWS = struct(("id", S), ("customer_id", L), ("product_id", L), ("rating", L),
                 ("review_text", S), ("review_date", S))

SCD_STAMPS = (("effective_start_date", TS), ("effective_end_date", TS), ("is_active", B))
QUARANTINE_FLAG = ("is_quarantined", B)


def silver_schema(table: str, quarantine: bool) -> StructType:
    extra = ((QUARANTINE_FLAG,) if quarantine else ()) + SCD_STAMPS
    return StructType(list(SOURCE[table].fields) + [StructField(n, t, True) for n, t in extra])


GOLD_SALES = struct(("order_date", DT), ("category_id", L), ("category_name", S),
                    ("product_id", L), ("product_name", S), ("total_units_sold", L),
                    ("total_sales", D), ("unique_customers", L))

#: What gold is counted from: order lines, units and sales per day, product and customer (of several folders: added).
GOLD_COUNTS = struct(("day", DT), ("product_id", L), ("customer_id", L), ("n", L), ("n_units", L), ("units", L),
                     ("n_sales", L), ("sales", DecimalType(38, 2)))

CONFIG = struct(("database", S), ("datasource", S), ("tablename", S), ("loadtype", S),
                ("watermark", S), ("is_active", S), ("targetpath", S))

AUDIT = struct(("tablename", S), ("load_type", S), ("record_count", L), ("load_timestamp", TS),
               ("status", S), ("datasource", S), ("high_watermark", TS))

RUN_LOG = struct(("timestamp", TS), ("event_type", S), ("message", S), ("table", S))
