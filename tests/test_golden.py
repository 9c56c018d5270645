"""Golden result: seed rows -> landing (through JDBC) -> silver -> gold."""

import datetime as dt

from pyspark.sql import functions as F

from medalake.plans.config import RETAILER_CONFIG, config_frame
from medalake.plans.medallion import run_medallion
from medalake.sources.jdbc import read_table
from seeds import LOAD, frames

DERBY = {"url": "jdbc:derby:memory:retailer;create=true",
         "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}

EXPECTED = [  # order_date, category_id, category_name, product_id, product_name, units, sales, customers
    (1, "Electronics", 101, "Laptop", 1, 1000.0, 1),
    (1, "Electronics", 111, "Headphones", 1, 150.0, 1),
    (2, "Clothing", 102, "T-Shirt", 2, 40.0, 2),
    (3, "Home Appliances", 113, "Microwave", 1, 200.0, 1),
    (5, "Toys", 115, "Toy Car", 1, 35.0, 1),
    (6, "Furniture", 116, "Dining Table", 1, 450.0, 1),
    (8, "Health & Beauty", 118, "Perfume", 1, 60.0, 1),
    (9, "Automotive", 119, "Engine Oil", 1, 120.0, 1),
    (10, "Grocery", 120, "Coffee Beans", 1, 75.0, 1),
]


def _load_derby(spark):
    for name, df in frames(spark).items():
        df.write.mode("overwrite").jdbc(DERBY["url"], name, properties={"driver": DERBY["driver"]})


def test_golden_seed_run_through_jdbc(spark, root):
    _load_derby(spark)
    sources = lambda t: read_table(spark, DERBY, t)
    gold = run_medallion(spark, sources, root, LOAD, config=config_frame(spark, RETAILER_CONFIG))
    rows = sorted(tuple(r)[1:] for r in gold.collect())
    assert rows == sorted(EXPECTED)
    assert {r.order_date for r in gold.collect()} == {LOAD.date()}
    tot = gold.agg(F.sum("total_units_sold"), F.sum("total_sales")).first()
    assert (tot[0], tot[1]) == (10, 2130.0)


def test_jdbc_incremental_filter_is_pushed(spark):
    _load_derby(spark)
    df = read_table(spark, DERBY, "orders").filter(F.col("updated_at") > F.lit(dt.datetime(2000, 1, 1)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "updated_at" in plan
    assert df.count() == 10


def test_jdbc_partitioned_read(spark):
    _load_derby(spark)
    df = read_table(spark, DERBY, "order_items", partition_column="order_item_id",
                    lower_bound=1, upper_bound=10, num_partitions=3)
    assert df.rdd.getNumPartitions() == 3
    assert df.count() == 10
