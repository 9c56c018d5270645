"""Table specs: the seven silver tables as data instead of seven scripts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructField, StructType

from medalake import schemas


@dataclass(frozen=True)
class TableSpec:
    name: str
    kind: str                      # "scd2" | "refresh"
    keys: tuple[str, ...]
    compare: tuple[str, ...] = ()  # change-detection columns (scd2)
    watermark: str | None = None   # source change column; newest wins in a batch
    required: tuple[str, ...] = ()  # NULL in any -> is_quarantined (empty: no flag)
    new_rows_as_coded: str = "by_key"  # reference behaviour: "by_key" | "bootstrap_only"
    load_type: str = "Full Load"
    datasource: str = "retailer_db"
    band: tuple[str, int] | None = None   # stored by this id divided by that number (see sinks.tables)
    buckets: int = 0               # whole versions are bucketed by the keys (to be sized to the table; 0: not)

    @property
    def source_schema(self):
        return schemas.SOURCE[self.name]

    @property
    def quarantined(self) -> bool:
        return bool(self.required)

    @property
    def silver_schema(self):
        """The silver columns; key fields and the band's are marked in their metadata."""
        plain = schemas.silver_schema(self.name, self.quarantined)

        def marks(name: str) -> dict:
            own = {"key": True} if name in self.keys else {}
            return own | ({"band": self.band[1]} if self.band and self.band[0] == name else {})

        return StructType([StructField(f.name, f.dataType, f.nullable, marks(f.name)) for f in plain.fields])

    @property
    def time_columns(self):
        return schemas.TIME_COLUMNS[self.name]


#: Order ids in a band, the same for orders and their items: about as many rows as a good file holds.
ORDERS_IN_BAND = 1 << 20

SPECS = {s.name: s for s in [
    TableSpec("products", "refresh", ("product_id",), required=("category_id", "name"),
              watermark="updated_at"),
    TableSpec("categories", "refresh", ("category_id",), required=("category_id", "name"),
              watermark="updated_at"),
    TableSpec("customers", "scd2", ("customer_id",), ("name", "email", "updated_at"), "updated_at",
              required=("customer_id", "email", "name"), new_rows_as_coded="by_key",
              load_type="Incremental"),
    TableSpec("orders", "scd2", ("order_id",), ("customer_id", "order_date", "total_amount", "updated_at"),
              "updated_at", new_rows_as_coded="bootstrap_only", load_type="Incremental",
              band=("order_id", ORDERS_IN_BAND)),
    TableSpec("order_items", "scd2", ("order_item_id",),
              ("order_id", "product_id", "quantity", "price", "updated_at"), "updated_at",
              new_rows_as_coded="bootstrap_only", load_type="Incremental", band=("order_id", ORDERS_IN_BAND)),
    TableSpec("suppliers", "refresh", ("supplier_id",), required=("supplier_id", "supplier_name"),
              watermark="created_at", datasource="supplier_db"),
    TableSpec("product_suppliers", "scd2", ("supplier_id", "product_id"), ("supply_price", "last_updated"),
              "last_updated", new_rows_as_coded="bootstrap_only", load_type="Incremental",
              datasource="supplier_db"),
]}

# Job order of the reference's orchestration: landing, then silver, then gold.
SILVER_ORDER = ("categories", "products", "suppliers", "customers", "orders", "order_items",
                "product_suppliers")
