"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver repeats this on sf0.01), plus expected counts from FIXTURES.md."""

import os

import pytest

import __spark_entry__ as E
from medalake import catalog
from tools.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"
# the llm part has tests of its own, and may be absent
KEYS = sorted(catalog.queries())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(KEYS) == set(catalog.oracle_sql()) and set(KEYS) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    n, problems = compare(spark, con, key, SF)
    assert not problems, problems


EXPECTED_SF0001 = {
    "gold_sales_summary": 3941,
    "silver_scd2_customers": 195, "silver_scd2_orders": 1950, "silver_scd2_order_items": 7784,
    "silver_scd2_product_suppliers": 2474,
    "silver_scd2_customers_as_coded": 180, "silver_scd2_orders_as_coded": 1650,
    "silver_scd2_order_items_as_coded": 6603, "silver_scd2_product_suppliers_as_coded": 2093,
    "quarantine_customers": 9, "quarantine_products": 16, "quarantine_suppliers": 2,
    "land_extract_incremental": None, "land_watermark_lookup": 6, "land_reviews_batch": 1000,
}


@pytest.mark.parametrize("key", sorted(k for k, v in EXPECTED_SF0001.items() if v is not None))
def test_expected_counts(spark, key):
    assert E.queries()[key](spark, SF).count() == EXPECTED_SF0001[key]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["order_date", "category_id", "category_name", "product_id", "product_name",
                          "total_units_sold", "total_sales", "unique_customers"]
    assert df.count() == 3941
