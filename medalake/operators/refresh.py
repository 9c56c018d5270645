"""Full-refresh silver tables (categories, products, suppliers)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalake.functions.expressions import epoch_ms_to_ts
from medalake.operators.scd2 import prepare, stamp
from medalake.plans.specs import TableSpec
from medalake.sources.bronze import BATCH_COLUMN


def from_landing(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """Landed epoch-ms columns back to timestamps, in source column order (behind them the batch, if named)."""
    return bronze.select(*[epoch_ms_to_ts(c).alias(c) if c in spec.time_columns else F.col(c)
                           for c in spec.source_schema.fieldNames()], *[c for c in bronze.columns if c == BATCH_COLUMN])


def full_refresh(source: DataFrame, spec: TableSpec, as_of, open_end: bool = True) -> DataFrame:
    """Flag quarantine and stamp every row as the current version.

    A pure projection: no shuffle; the caller overwrites the target."""
    return stamp(prepare(source, spec), as_of, open_end=open_end).select(*spec.silver_schema.fieldNames())
