"""Quarantine flag and good/bad split."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalake.functions.expressions import any_null


class Split(NamedTuple):
    good: DataFrame
    bad: DataFrame


def flag_quarantine(df: DataFrame, required, flag: str = "is_quarantined") -> DataFrame:
    """Add ``flag``: true when any required column is NULL (rows stay in place)."""
    return df.withColumn(flag, any_null(required))


def split_quarantine(df: DataFrame, required, flag: str = "is_quarantined") -> Split:
    """Flag, then split into rows passing the check and quarantined rows.

    Both halves are plain filters over the same flagged plan (no shuffle);
    ``good.count() + bad.count() == df.count()``."""
    flagged = flag_quarantine(df, required, flag)
    return Split(flagged.filter(~F.col(flag)), flagged.filter(F.col(flag)))
