"""Scalar column helpers (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Fixed values that must equal the reference's
DEFAULT_WATERMARK = "1900-01-01 00:00:00"   # used when a table was never loaded
DB_FILE_DATE = "ddMMyyyy"                   # <table>_<ddMMyyyy>.json landing names
REVIEWS_FILE_DATE = "yyyyMMdd"              # customer_reviews_<yyyyMMdd>.parquet
LOG_FILE_STAMP = "yyyyMMddHHmmss"           # pipeline_log_<yyyyMMddHHmmss>.json


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(c: str | Column) -> Column:
    """Epoch-milliseconds -> timestamp_ntz, exact and independent of the session zone."""
    return F.timestamp_add("MILLISECOND", col_(c), F.expr(EPOCH_NTZ))


def ts_to_epoch_ms(c: str | Column) -> Column:
    """timestamp_ntz -> epoch-milliseconds (what the landing JSON carries)."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), col_(c))


def to_day(c: str | Column) -> Column:
    """Timestamp -> date."""
    return F.to_date(col_(c))


def ts_literal(value: _dt.datetime | str) -> Column:
    """A zone-less timestamp literal (used for ``as_of`` and watermarks)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def stamp_name(c: str | Column, fmt: str) -> Column:
    """Date text used in landed file names."""
    return F.date_format(col_(c), fmt)


def file_date(path: str | Column) -> Column:
    """The ddMMyyyy date of a landed batch, taken from the last ``_`` before ``.``

    in the batch's name (``.../<table>_<ddMMyyyy>.json/part-...``)."""
    return F.to_date(F.regexp_extract(col_(path), r"_(\d{8})(\.json)?(/[^/]*)?$", 1), DB_FILE_DATE)


def any_null(cols) -> Column:
    """True when any of ``cols`` is NULL."""
    return reduce(lambda a, b: a | b, [col_(c).isNull() for c in cols])


def any_differs(pairs, null_safe: bool = True) -> Column:
    """OR-chain of inequalities between (target, source) column pairs.

    ``null_safe=False`` reproduces plain ``!=``, under which NULL <-> value
    changes are missed unless another column differs."""
    if null_safe:
        terms = [~col_(a).eqNullSafe(col_(b)) for a, b in pairs]
    else:
        terms = [col_(a) != col_(b) for a, b in pairs]
    return reduce(lambda a, b: a | b, terms)


def normalized_load_type(c: str | Column) -> Column:
    """Case-folded load type -> 'full' | 'incremental' | 'invalid'."""
    lt = F.lower(F.trim(col_(c)))
    return (F.when(lt == "full load", F.lit("full"))
            .when(lt == "incremental", F.lit("incremental"))
            .otherwise(F.lit("invalid")))
