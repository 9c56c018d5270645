"""Independent DuckDB SQL for every registered query.

The fragments below restate the adapters (test tables -> retail model) in
plain SQL; each oracle is ``WITH <needed fragments> <body>``. Every computed
column carries the same alias as the Spark result.
"""

from __future__ import annotations

T0 = "TIMESTAMP '2024-06-01 00:00:00'"
T1 = "TIMESTAMP '2024-07-01 00:00:00'"
BASE = "TIMESTAMP '2024-01-01 00:00:00'"
NULL_TS = "CAST(NULL AS TIMESTAMP)"


def _mins(c: str) -> str:
    return f"({BASE} + to_minutes(CAST({c} AS BIGINT)))"


def _ms(c: str) -> str:
    return f"epoch_ms({c})"


# name -> (dependencies, body)
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {
    "customers_src": ((), f"""
        SELECT c_custkey AS customer_id, c_name AS name,
               CASE WHEN c_custkey % 17 <> 0 THEN lower(replace(c_name, '#', '')) || '@example.com' END AS email,
               {_mins('c_custkey')} AS updated_at
        FROM customer"""),
    "orders_src": ((), """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
               o_totalprice AS total_amount, o_orderdate AS updated_at
        FROM orders"""),
    "orders_status": ((), """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
               o_totalprice AS total_amount, o_orderdate AS updated_at,
               (o_orderstatus <> 'F') AS is_active
        FROM orders"""),
    "items_all": ((), """
        SELECT (l_orderkey * 1000 + l_linenumber) * 1000 + dense_rank() OVER (
                   PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS order_item_id,
               l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               l_extendedprice AS price, l_shipdate AS updated_at
        FROM lineitem"""),
    "items_src": (("items_all",), """
        SELECT * FROM items_all
        QUALIFY row_number() OVER (PARTITION BY order_item_id
            ORDER BY updated_at DESC NULLS LAST, quantity DESC NULLS LAST, order_id DESC NULLS LAST,
                     product_id DESC NULLS LAST, price DESC NULLS LAST) = 1"""),
    "categories_src": ((), f"""
        SELECT category_id, name, {_mins('category_id')} AS updated_at
        FROM (SELECT CAST(dense_rank() OVER (ORDER BY p_type) AS BIGINT) AS category_id, p_type AS name
              FROM (SELECT DISTINCT p_type FROM part))"""),
    "categories_q": (("categories_src",), """
        SELECT category_id, CASE WHEN category_id <> 6 THEN name END AS name, updated_at
        FROM categories_src"""),
    "products_src": (("categories_src",), f"""
        SELECT p_partkey AS product_id, p_name AS name, c.category_id AS category_id,
               p_retailprice AS price, {_mins('p_partkey')} AS updated_at
        FROM part JOIN categories_src c ON c.name = part.p_type"""),
    "products_q": (("products_src",), """
        SELECT product_id, CASE WHEN product_id % 13 <> 0 THEN name END AS name, category_id, price, updated_at
        FROM products_src"""),
    "suppliers_src": ((), f"""
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
               'Contact ' || CAST(s_suppkey AS VARCHAR) AS contact_name,
               '+' || CAST(s_nationkey + 10 AS VARCHAR) || '-' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS phone,
               lower(replace(s_name, '#', '')) || '@example.com' AS email,
               CAST(s_suppkey AS VARCHAR) || ' Market Street' AS address,
               r_name AS city, n_name AS country, {_mins('s_suppkey')} AS created_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "suppliers_q": (("suppliers_src",), """
        SELECT supplier_id, CASE WHEN supplier_id % 9 <> 0 THEN supplier_name END AS supplier_name,
               contact_name, phone, email, address, city, country, created_at
        FROM suppliers_src"""),
    "product_suppliers_src": ((), """
        SELECT l_suppkey AS supplier_id, l_partkey AS product_id, min(l_extendedprice) AS supply_price,
               max(l_shipdate) AS last_updated
        FROM lineitem GROUP BY l_suppkey, l_partkey"""),
    "reviews_src": ((), """
        SELECT CAST(event_id AS VARCHAR) AS id, user_id AS customer_id,
               TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
               event_id % 5 + 1 AS rating, event_type AS review_text,
               strftime(ts, '%Y-%m-%d') AS review_date
        FROM events"""),
    "audit_src": ((), """
        SELECT event_type AS tablename, 'Incremental' AS load_type, CAST(floor(value) AS BIGINT) AS record_count,
               ts AS load_timestamp, 'SUCCESS' AS status, 'events' AS datasource, ts AS high_watermark
        FROM events"""),
}


def with_(body: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``body``."""
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for dep in FRAGMENTS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({FRAGMENTS[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


def register(name: str, deps: tuple[str, ...], body: str) -> None:
    """Add a derived fragment (used by the query-specific oracles)."""
    FRAGMENTS[name] = (deps, body)


def gold_sql(orders_frag: str = "orders_status", items_frag: str = "items_all",
             extra_where: str = "o.is_active") -> str:
    return with_(f"""
SELECT CAST(o.order_date AS DATE) AS order_date, p.category_id AS category_id, c.name AS category_name,
       i.product_id AS product_id, p.name AS product_name,
       CAST(sum(i.quantity) AS BIGINT) AS total_units_sold,
       CAST(sum(CAST(i.price AS DECIMAL(12,2)) * i.quantity) AS DOUBLE) AS total_sales,
       CAST(count(DISTINCT o.customer_id) AS BIGINT) AS unique_customers
FROM {orders_frag} o
JOIN {items_frag} i ON o.order_id = i.order_id
JOIN products_src p ON i.product_id = p.product_id
JOIN categories_src c ON p.category_id = c.category_id
WHERE {extra_where}
GROUP BY 1, 2, 3, 4, 5""", orders_frag, items_frag, "products_src", "categories_src")
