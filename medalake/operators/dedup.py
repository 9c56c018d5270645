"""Latest row per key, as an aggregate (not a window).

``max(struct(order..., row))`` is an ordinary aggregate with a partial
(map-side) phase, so a key that holds a third of all rows is combined inside
each input task before anything is shuffled; a ``row_number`` window would
send the whole hot key to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per ``keys``: greatest ``order`` columns, ties broken by the

    remaining columns (greatest wins; NULL sorts lowest), so the pick is
    deterministic whatever the input order."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    # order + rest covers every non-key column once: the struct is both the
    # sort key and the payload, so nothing is shuffled twice
    picked = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_m"))
    # the keys stay the aggregate's own output columns, so its hash
    # partitioning on them is reused by a following join on the same keys
    return picked.select(*[F.col(c) if c in keys else F.col(f"_m.{c}").alias(c) for c in df.columns])
