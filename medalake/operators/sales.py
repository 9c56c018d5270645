"""Daily sales per product and category (the gold table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalake import schemas

MONEY = "decimal(12,2)"


def sales_summary(orders: DataFrame, items: DataFrame, products: DataFrame,
                  categories: DataFrame, active_items_only: bool = False,
                  exclude_quarantined: bool = False) -> DataFrame:
    """orders ⋈ items ⋈ products ⋈ categories, active orders only, grouped by

    (order_date, category, product): units, sales, distinct customers.

    Plan shape, chosen for scale:
    * the active filter and the column pruning reach the parquet scans;
    * facts are aggregated to (order_date, product_id) *before* the dimension
      joins (product -> category and names are functional dependencies of
      product_id, keys of their source tables), so the dimension join sees
      one row per day and product instead of one per line item and the
      line-item rows are shuffled once by order_id and once, as they come out
      of the join, by day and product, which serves both the distinct
      customers and the sums;
    * money is summed as decimal(12,2) and turned into double at the end, so
      the result does not depend on summation order;
    * join strategies are left to AQE, which broadcasts a dimension only when
      its measured size is below the threshold and splits skewed partitions.
    """
    o = orders.filter(F.col("is_active"))
    if exclude_quarantined and "is_quarantined" in orders.columns:
        o = o.filter(~F.col("is_quarantined"))
    o = o.select("order_id", "customer_id", F.to_date("order_date").alias("order_date"))
    i = items
    if active_items_only and "is_active" in items.columns:
        i = i.filter(F.col("is_active"))
    i = i.select("order_id", "product_id", "quantity", "price")

    # only prices of lines that count become money: one out of its range elsewhere is no error
    facts = (o.join(i, "order_id").withColumn("price", F.col("price").cast(MONEY)).repartition("order_date", "product_id")
             .groupBy("order_date", "product_id")
             .agg(F.sum("quantity").alias("total_units_sold"),
                  F.sum(F.col("price") * F.col("quantity")).alias("_sales"),
                  F.count_distinct("customer_id").alias("unique_customers")))

    return with_dimensions(facts, products, categories)


def with_dimensions(facts: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Facts per day and product (units, ``_sales``, customers) with the products' and categories' names."""
    p = products.select("product_id", "category_id", F.col("name").alias("product_name"))
    c = categories.select("category_id", F.col("name").alias("category_name"))
    # categories meet products first: no fact row is ever partitioned by the few category keys
    out = facts.join(p.join(c, "category_id"), "product_id")
    return out.select(
        "order_date", "category_id", "category_name", "product_id", "product_name",
        F.col("total_units_sold").cast("bigint").alias("total_units_sold"),
        F.col("_sales").cast("double").alias("total_sales"),
        F.col("unique_customers").cast("bigint").alias("unique_customers"))


GOLD_COLUMNS = schemas.GOLD_SALES.fieldNames()
