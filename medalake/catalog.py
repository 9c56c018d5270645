"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus their SQL oracles.

Each query reads the given test tables (through ``sources.adapters``) and
runs one operator or composite job of the library over the whole tables.
Queries that exercise a sink write into a fresh folder under the session's
shared checkpoint directory and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from medalake import oracle as O
from medalake.operators.sales import sales_summary
from medalake.sources import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --- gold -------------------------------------------------------------------

@query("gold_sales_summary", O.gold_sql())
def q_gold_sales_summary(spark, sf_dir):
    cats = A.categories(spark, sf_dir)
    return sales_summary(A.orders(spark, sf_dir, with_status_flag=True),
                         A.order_items(spark, sf_dir),
                         A.products(spark, sf_dir, cats=cats), cats)


def _load_modules():
    # the other query groups register themselves on import
    from medalake import catalog_silver, catalog_landing  # noqa: F401


def queries() -> dict[str, Query]:
    _load_modules()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_modules()
    return dict(ORACLES)
