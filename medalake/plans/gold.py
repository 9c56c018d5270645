"""C8 job: silver -> gold daily sales summary table.

Full mode derives gold from the silver tables. Incremental mode (standard SCD2
inputs) keeps it up to date by counting. The state is a table of counts, one
row per (day, product, customer): how many active order lines, units and
sales. Rows that silver opened since the last build add to it, rows that it
closed subtract:

    change = dO x I + O x dI - dO x dI

with O and I the active orders and items now and dO, dI the signed changes, all
of it from one inner join on order_id. A distinct customer is one whose lines don't
cancel out. Changes are netted first: a row closed and opened again with the
same values in the columns that count is no change at all.

A run reads the changed rows from the deltas' own files, the orders and items
of their bands of order ids (``PartitionFilters`` on both tables), and the
counts of the months it touches, from which these months are derived anew. It
appends its change to the counts. Dimension
columns are fingerprinted; if they change, gold is derived again from the
counts, without the facts. A whole load of a fact table, deltas dropped by
maintenance, or a missing state make it count everything again.

Counts, gold rows and the silver versions they stand for are published
together by one rename (``sinks.gold``): a run that dies leaves the last build
as it was, and the next run takes up from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalake import schemas
from medalake.operators.sales import MONEY, sales_summary, with_dimensions
from medalake.plans.specs import SPECS
from medalake.sinks.gold import (GOLD_PARTITION, Build, month_of, newest_build, publish, read_gold, read_months,
                                 write_gold, write_months)
from medalake.sinks.tables import bands_in, changes_since, committed_versions, read_silver, rows_signed

SUMS = ("n", "n_units", "units", "n_sales", "sales")
FACTS = ("orders", "order_items")
SLICES = 16         # tasks that may share a month's counts


def read_current(spark: SparkSession, silver_root: str, table: str, upto: int | None = None,
                 bands: list[int] | None = None) -> DataFrame:
    df = read_silver(spark, f"{silver_root.rstrip('/')}/{table}", SPECS[table].silver_schema, upto, bands)
    if df is None:
        raise FileNotFoundError(f"silver table {table} has no committed version under {silver_root}")
    return df


def dims_fingerprint(products: DataFrame, categories: DataFrame) -> list[int]:
    """Order-independent fingerprint of the dimension columns gold uses (one
    small aggregate job per dimension): row count and sums of both halves of
    the rows' hashes. Sums keep repeated rows apart; NULLs are hashed as such."""
    out = []
    for df, cols in ((products.filter(F.col("is_active")), ["product_id", "category_id", "name"]),
                     (categories.filter(F.col("is_active")), ["category_id", "name"])):
        h = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in cols])
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftrightunsigned(h, 32)).alias("a"),
                   F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("b")).first()
        out += [int(r["n"]), int(r["a"] or 0), int(r["b"] or 0)]
    return out


# --- counts -------------------------------------------------------------------------

def _weighted(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows netted by the columns that count: how often each is active ``now``, and how often it came or, below 0, went
    (``change``). They lie by order_id, as the join that follows needs them."""
    return (rows.select(*columns, "now", "change").where("order_id IS NOT NULL").repartition("order_id").groupBy(*columns)
            .agg(F.sum("now").alias("now"), F.sum("change").alias("change")).where("now <> 0 OR change <> 0"))


def _lines(orders: DataFrame, items: DataFrame, weight) -> DataFrame:
    """Order lines, each with ``n`` = how often it counts."""
    return orders.join(items, "order_id").select(
        F.to_date("order_date").alias("day"), "product_id", "customer_id", "quantity",
        F.col("price").cast(MONEY).alias("price"), weight.cast("long").alias("n"))


def _counted(lines: DataFrame) -> DataFrame:
    """Lines summed by day, product and customer; how many values were not NULL is kept, as a sum of none is NULL.

    Lines are shuffled once, by month and one of ``SLICES`` parts of a month that a (day, product) falls into: the sums
    are taken there, and written from there into the month's folder. So a large month is several tasks' work."""
    def value(c):
        return F.coalesce(F.col(c), F.lit(0))

    def known(c):
        return F.when(F.col(c).isNotNull(), F.col("n")).otherwise(0)

    month, part = month_of("day"), F.pmod(F.xxhash64("day", "product_id"), F.lit(SLICES))
    # both follow from what is shuffled, so they are not shuffled themselves
    slices = lines.repartition(month, part).withColumns(
        {GOLD_PARTITION: month, "_slice": part, "amount": F.col("price") * F.col("quantity")})
    return slices.groupBy(GOLD_PARTITION, "_slice", "day", "product_id", "customer_id").agg(
        F.sum("n").alias("n"), F.sum(known("quantity")).alias("n_units"),
        F.sum(value("quantity") * F.col("n")).alias("units"), F.sum(known("amount")).alias("n_sales"),
        F.sum((value("amount") * F.col("n")).cast("decimal(30,2)")).cast("decimal(38,2)").alias("sales")).drop("_slice")


ORDER_COLUMNS = ["order_id", "order_date", "customer_id"]
ITEM_COLUMNS = ["order_id", "product_id", "quantity", "price"]


def counts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The counts of all active order lines."""
    return _counted(_lines(orders.filter("is_active").select(*ORDER_COLUMNS),
                           items.filter("is_active").select(*ITEM_COLUMNS), F.lit(1)))


def changed_counts(spark: SparkSession, silver_root: str, since: dict, seen: dict) -> DataFrame | None:
    """What the silver versions after ``since`` up to ``seen`` add to the counts; None where they can't tell."""
    deltas = [changes_since(spark, f"{silver_root.rstrip('/')}/{t}", SPECS[t].silver_schema, since[t], seen[t])
              for t in FACTS]
    if any(d is None for d in deltas):
        return None
    bands = [bands_in(d, SPECS[t].silver_schema) for t, d in zip(FACTS, deltas)]
    # what changed meets the other table's rows: those in its bands are all it can meet
    orders, items = (_weighted(rows_signed(spark, f"{silver_root.rstrip('/')}/{t}", SPECS[t].silver_schema, since[t],
                                           seen[t], b), c)
                     for t, b, c in zip(FACTS, reversed(bands), (ORDER_COLUMNS, ITEM_COLUMNS)))
    o_now, o_change = (F.col(c) for c in ("now", "change"))
    i_now, i_change = (F.col(c) for c in ("i_now", "i_change"))
    found = _lines(orders, items.withColumnsRenamed({"now": "i_now", "change": "i_change"}),
                   o_change * i_now + o_now * i_change - o_change * i_change).where("n <> 0")
    return _counted(found).where(" OR ".join(f"{c} <> 0" for c in SUMS))


def summary_of(counted: DataFrame, products: DataFrame, categories: DataFrame, summed: bool = False) -> DataFrame:
    """Gold rows of counts: (day, product) pairs with lines left, customers whose lines don't cancel out. ``summed``:
    each (day, product, customer) has one row already."""
    each = counted if summed else counted.repartition("day", "product_id").groupBy(
        "day", "product_id", "customer_id").agg(*[F.sum(c).alias(c) for c in SUMS])      # shuffled once for both sums
    facts = each.groupBy("day", "product_id").agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.count(F.when(F.col("n") > 0, F.col("customer_id"))).alias("unique_customers")).where("n > 0")
    return with_dimensions(facts.select(
        F.col("day").alias("order_date"), "product_id",
        F.when(F.col("n_units") > 0, F.col("units")).alias("total_units_sold"),
        F.when(F.col("n_sales") > 0, F.col("sales")).alias("_sales"), "unique_customers"), products, categories)


def _incremental(spark: SparkSession, silver_root: str, gold_dir: str, products: DataFrame,
                 categories: DataFrame) -> None:
    old = newest_build(spark, gold_dir)
    # noted before the tables are read, and read up to there: a version committed meanwhile is left to the next run
    seen = {t: max(committed_versions(spark, f"{silver_root.rstrip('/')}/{t}"), default=0) for t in FACTS}
    state = {"dims": dims_fingerprint(products, categories), **seen}
    if old.state == state:
        return
    change = changed_counts(spark, silver_root, old.state, seen) if old.state else None
    new = Build(old.number + 1, counts=dict(old.counts), state=state)

    def write(df: DataFrame) -> dict:
        return write_months(df, spark, gold_dir, "counts", "day")

    if change is None:
        new.counts = write(counts(*(read_current(spark, silver_root, t, seen[t]) for t in FACTS)))
    else:
        added = write(change)
        for month, folders in added.items():
            new.counts[month] = new.counts.get(month, []) + folders
    if change is None or old.state["dims"] != state["dims"]:
        rows = summary_of(read_months(spark, gold_dir, new.counts, schemas.GOLD_COUNTS), products, categories,
                          summed=all(len(folders) == 1 for folders in new.counts.values()))
        new.gold = write_months(rows, spark, gold_dir, "gold", "order_date")
    else:
        new.gold = dict(old.gold)
        if added:
            # a touched month is written whole, and derived whole: its counts are shuffled once, whatever the change
            months = list(added)
            rows = summary_of(read_months(spark, gold_dir, new.counts, schemas.GOLD_COUNTS, months), products, categories)
            written = write_months(rows, spark, gold_dir, "gold", "order_date")
            for month in months:
                new.gold.pop(month, None)
            new.gold |= written
    publish(spark, gold_dir, new)


def maintain_gold(spark: SparkSession, gold_dir: str) -> None:
    """Write the counts of months that lie in several folders as one folder, without what has cancelled out."""
    old = newest_build(spark, gold_dir)
    months = [m for m, folders in old.counts.items() if len(folders) > 1]
    if months:
        each = read_months(spark, gold_dir, old.counts, schemas.GOLD_COUNTS, months).groupBy(
            "day", "product_id", "customer_id").agg(*[F.sum(c).alias(c) for c in SUMS])
        kept = {m: f for m, f in old.counts.items() if m not in months}
        merged = write_months(each.where(" OR ".join(f"{c} <> 0" for c in SUMS)).select(
            *schemas.GOLD_COUNTS.fieldNames()), spark, gold_dir, "counts", "day")
        publish(spark, gold_dir, Build(old.number + 1, old.gold, kept | merged, old.state))


def gold_job(spark: SparkSession, silver_root: str, gold_dir: str, mode: str = "standard",
             write_mode: str = "overwrite", as_of=None, incremental: bool = False,
             exclude_quarantined: bool = False) -> DataFrame:
    """Standard: every SCD2 input restricted to its current versions (D11) and
    an idempotent per-month overwrite. ``as_coded``: orders' flag only, append.

    ``incremental=True`` (standard mode) brings gold up to date by counting.
    ``exclude_quarantined`` leaves out flagged products and categories."""
    products = read_current(spark, silver_root, "products")
    categories = read_current(spark, silver_root, "categories")
    if exclude_quarantined:
        products, categories = (d.filter(~F.coalesce("is_quarantined", F.lit(False))) for d in (products, categories))
    if mode == "standard" and incremental:
        _incremental(spark, silver_root, gold_dir, products, categories)
    else:
        orders, items = (read_current(spark, silver_root, t) for t in FACTS)
        df = sales_summary(orders, items, products, categories, active_items_only=mode == "standard")
        write_gold(df, spark, gold_dir, write_mode if mode == "standard" else "append")
    return read_gold(spark, gold_dir)
