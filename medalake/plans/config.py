"""The ingest config relation (control plane: one row per source table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medalake import schemas

# The two config files of the source system, in file order
# (database, datasource, tablename, loadtype, watermark, is_active, targetpath).
RETAILER_CONFIG = [
    ("retailer", "retailer_db", "products", "Full Load", None, "1", "landing/retailer-db/products"),
    ("retailer", "retailer_db", "categories", "Full Load", None, "1", "landing/retailer-db/categories"),
    ("retailer", "retailer_db", "customers", "Incremental", "updated_at", "1", "landing/retailer-db/customers"),
    ("retailer", "retailer_db", "orders", "Incremental", "updated_at", "1", "landing/retailer-db/orders"),
    ("retailer", "retailer_db", "order_items", "Incremental", "updated_at", "1",
     "landing/retailer-db/order_items"),
]
SUPPLIER_CONFIG = [
    ("supplier-db", "mysql-db", "suppliers", "Full Load", "created_at", "1", "supplier"),
    ("supplier-db", "mysql-db", "product_suppliers", "Incremental", "last_updated", "1", "supplier"),
]

# Extra rows the tests add: an inactive table and one whose source is missing.
TEST_EXTRA = [
    ("retailer", "retailer_db", "returns", "Incremental", "updated_at", "0", "landing/retailer-db/returns"),
    ("retailer", "retailer_db", "missing_table", "Full Load", None, "1", "landing/retailer-db/missing_table"),
]


def config_frame(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows if rows is not None else RETAILER_CONFIG + SUPPLIER_CONFIG,
                                 schemas.CONFIG)


def write_config_csv(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
