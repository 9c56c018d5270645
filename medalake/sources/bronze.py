"""Declared-schema reads of the landing area and silver tables.

No schema inference anywhere: an empty incremental batch reads as zero rows
of the declared schema instead of failing downstream, and the scan needs no
extra inference pass over the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalake import schemas
from medalake.sinks.landing import landed_glob

BATCH_COLUMN = "_batch"      # the landed batch that a row comes from

# columns the declared silver views expose (the files may carry more)
SILVER_VIEWS = {
    "customers": schemas.silver_schema("customers", True).fieldNames(),
    "orders": schemas.silver_schema("orders", False).fieldNames(),
    "order_items": schemas.silver_schema("order_items", False).fieldNames(),
    "products": schemas.SOURCE["products"].fieldNames() + ["is_quarantined"],
    "categories": schemas.SOURCE["categories"].fieldNames() + ["is_quarantined"],
    "product_suppliers": schemas.silver_schema("product_suppliers", False).fieldNames(),
    "suppliers": schemas.SOURCE["suppliers"].fieldNames(),
}


def read_bronze(spark: SparkSession, landing_root: str, table: str,
                path: str | list[str] | None = None, with_batch: bool = False) -> DataFrame:
    """Landed JSON of ``table`` (every landed batch, or those at ``path``); ``with_batch`` adds the batch's name."""
    df = spark.read.schema(schemas.BRONZE[table]).json(path or landed_glob(landing_root, table))
    return df.withColumn(BATCH_COLUMN, F.element_at(F.split("_metadata.file_path", "/"), -2)) if with_batch else df


def read_bronze_reviews(spark: SparkSession, landing_root: str) -> DataFrame:
    """The dated reviews parquet, declared schema (``load_date`` dropped)."""
    return (spark.read.schema(schemas.REVIEWS)
            .parquet(f"{landing_root.rstrip('/')}/customer_reviews/load_date=*"))


def silver_view(df: DataFrame, table: str) -> DataFrame:
    """The declared projection of a silver table."""
    return df.select(*SILVER_VIEWS[table])


def canonical(df: DataFrame, schema) -> DataFrame:
    """Columns in the declared order and types, whatever order they arrive in."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
