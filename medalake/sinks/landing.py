"""K1/K2/K6: landing sinks.

Layout: ``<root>/<table>/<table>_[<HHmmssffffff>_]<ddMMyyyy>.json/part-*.json.gz``
(one folder per run: a second run on a day never overwrites the first; a run
at midnight has the bare daily name), ``<root>/_merged/<table>`` (the ledger of
batches that silver has committed) and
``<root>/customer_reviews/load_date=<yyyyMMdd>/part-*.parquet``. Every write
is a distributed Spark write; nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalake import schemas
from medalake.functions.expressions import DB_FILE_DATE, REVIEWS_FILE_DATE, ts_to_epoch_ms
from medalake.session import list_dir, path_exists

#: Rows in a landed file. One task reads a packed file, so its size is bounded whatever the size of the tasks that write.
ROWS_IN_FILE = 1_000_000


def _py_fmt(fmt: str) -> str:
    return fmt.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d").replace(
        "HH", "%H").replace("mm", "%M").replace("ss", "%S")


def batch_name(table: str, load_time: dt.datetime) -> str:
    """``<table>_<ddMMyyyy>.json``, with the run's time of day before the date."""
    time = load_time.strftime("%H%M%S%f")
    run = "" if int(time) == 0 else f"{time}_"
    return f"{table}_{run}{load_time.strftime(_py_fmt(DB_FILE_DATE))}.json"


def batch_order(name: str) -> tuple[str, str]:
    """Sort key of batch names: (yyyyMMdd, time of day)."""
    *_, time, day = ["", *name.removesuffix(".json").split("_")]
    return day[4:] + day[2:4] + day[:2], time if len(time) == 12 and time.isdigit() else ""


def landed_batches(spark: SparkSession, root: str, table: str) -> list[str]:
    """Names of the committed batches in the landing area, oldest run first."""
    base = f"{root.rstrip('/')}/{table}"
    names = [n for n in list_dir(spark, base) if n.startswith(f"{table}_") and n.endswith(".json")
             and path_exists(spark, f"{base}/{n}/_SUCCESS")]
    return sorted(names, key=batch_order)


def merged_batches(spark: SparkSession, root: str, table: str) -> set[str]:
    """The ledger: batches of ``table`` that a silver run has committed (one row per batch)."""
    path = f"{root.rstrip('/')}/_merged/{table}"
    if not list_dir(spark, path):
        return set()
    return {r["batch"] for r in spark.read.schema("batch string").parquet(path).collect()}


def mark_merged(spark: SparkSession, root: str, table: str, batches: list[str]) -> None:
    if batches:
        (spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1)
         .write.mode("append").parquet(f"{root.rstrip('/')}/_merged/{table}"))


def to_landing_rows(df: DataFrame, table: str) -> DataFrame:
    """Times to epoch-ms longs, columns in declared order."""
    times = schemas.TIME_COLUMNS[table]
    return df.select(*[ts_to_epoch_ms(c).alias(c) if c in times else F.col(c)
                       for c in schemas.SOURCE[table].fieldNames()])


def land_json(df: DataFrame, root: str, table: str, load_time: dt.datetime) -> str:
    """K1: write one landed batch as JSON lines, NULLs written explicitly, in gzip files of bounded size: the names
    that every line repeats take up no room."""
    path = f"{root.rstrip('/')}/{table}/{batch_name(table, load_time)}"
    (to_landing_rows(df, table).write.mode("overwrite")
     .option("ignoreNullFields", "false").option("compression", "gzip").option("maxRecordsPerFile", ROWS_IN_FILE)
     .json(path))
    return path


def landed_glob(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/{table}_*.json"


def land_reviews(payload: DataFrame, root: str, load_time: dt.datetime) -> str:
    """K2: dated parquet landing of a reviews batch (partition ``load_date``)."""
    path = f"{root.rstrip('/')}/customer_reviews"
    stamp = load_time.strftime(_py_fmt(REVIEWS_FILE_DATE))
    (payload.select(*schemas.REVIEWS.fieldNames()).withColumn("load_date", F.lit(stamp))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_date").parquet(path))
    return path


def read_payload(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A saved reviews payload (JSON lines, or JSON arrays per file with
    ``multi_line``; each file is still read by its own task). A record that is
    no JSON object of this shape fails the read instead of becoming NULLs."""
    return (spark.read.schema(schemas.REVIEWS).option("multiLine", multi_line)
            .option("mode", "FAILFAST").json(path))
