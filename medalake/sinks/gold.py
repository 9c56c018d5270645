"""K9: the gold table as published builds.

A build writes folders of its own and is published by one small file,
``_builds/<n>.json``, written beside and renamed into place: for each month,
the folders that hold it. A reader takes the newest published build and sees
all of it or all of the one before, never a month missing. Months that a build
doesn't touch keep the folders of earlier builds. Nothing that a published
build names is changed afterwards; ``vacuum_gold`` drops the folders that the
kept builds don't name.

The same file names the folders of the counts that gold is derived from (see
``plans.gold``) and the silver versions they hold, so table and state can't
part. One writer at a time is assumed, as in the reference.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medalake import schemas
from medalake.session import delete_path, hadoop_fs, list_dir

GOLD_PARTITION = "order_month"


@dataclass
class Build:
    """Month -> folders (below the table's), of the gold rows and of the counts; the state they stand for."""
    number: int = 0
    gold: dict[str, list[str]] = field(default_factory=dict)
    counts: dict[str, list[str]] = field(default_factory=dict)
    state: dict | None = None


def month_of(day: str):
    return F.date_format(day, "yyyy-MM")


def builds(spark: SparkSession, table_dir: str) -> list[int]:
    """Numbers of the published builds, oldest first."""
    return sorted(int(n[:-5]) for n in list_dir(spark, f"{table_dir.rstrip('/')}/_builds")
                  if n.endswith(".json") and n[:-5].isdigit())


def read_build(spark: SparkSession, table_dir: str, number: int) -> Build:
    text = spark.read.option("wholetext", True).text(f"{table_dir.rstrip('/')}/_builds/{number:010d}.json").first()[0]
    return Build(number, **json.loads(text))


def newest_build(spark: SparkSession, table_dir: str) -> Build:
    """The newest published build; an empty one before the first."""
    found = builds(spark, table_dir)
    return read_build(spark, table_dir, found[-1]) if found else Build()


def publish(spark: SparkSession, table_dir: str, build: Build) -> None:
    """Make ``build`` the table, in one rename."""
    fs, base = hadoop_fs(spark, f"{table_dir.rstrip('/')}/_builds")
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(base)
    beside, name = Path(base, f".{uuid.uuid4().hex}"), Path(base, f"{build.number:010d}.json")
    out = fs.create(beside, False)
    out.write(bytearray(json.dumps({"gold": build.gold, "counts": build.counts, "state": build.state}).encode()))
    out.close()
    if fs.exists(name) or not fs.rename(beside, name):
        raise IOError(f"build {build.number} is already published")


def write_months(df: DataFrame, spark: SparkSession, table_dir: str, kind: str, day: str) -> dict[str, list[str]]:
    """Write rows into a fresh folder, a sub-folder for each month of ``day``; returns month -> [folder]. Rows that
    have the month as a column already lie by it, in as many tasks as they need, and are not shuffled again.

    The ``rebalance`` hint lets AQE split a hot month over several tasks and
    merge small ones, so files are neither tiny nor unbounded; rows are
    sorted by day and product inside each file so day filters skip row groups."""
    name = f"{kind}_{uuid.uuid4().hex[:12]}"
    if GOLD_PARTITION not in df.columns:
        # shuffled by the month as a number: its name follows from the day
        df = (df.withColumn("_month", F.year(day) * 12 + F.month(day)).hint("rebalance", "_month").drop("_month")
              .withColumn(GOLD_PARTITION, month_of(day)))
    (df.sortWithinPartitions(GOLD_PARTITION, day, "product_id")
     .write.partitionBy(GOLD_PARTITION).option("compression", "zstd").parquet(f"{table_dir.rstrip('/')}/{name}"))
    prefix = f"{GOLD_PARTITION}="
    return {n[len(prefix):]: [f"{name}/{n}"] for n in list_dir(spark, f"{table_dir.rstrip('/')}/{name}")
            if n.startswith(prefix)}


def read_months(spark: SparkSession, table_dir: str, folders: dict[str, list[str]], schema: StructType,
                months=None) -> DataFrame:
    """The rows in the folders of some months (default: all)."""
    paths = [f"{table_dir.rstrip('/')}/{p}" for m in (folders if months is None else months)
             for p in folders.get(m, [])]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths).select(*schema.fieldNames())


def read_gold(spark: SparkSession, table_dir: str) -> DataFrame:
    return read_months(spark, table_dir, newest_build(spark, table_dir).gold, schemas.GOLD_SALES)


def write_gold(df: DataFrame, spark: SparkSession, table_dir: str, mode: str = "overwrite") -> None:
    """``overwrite`` replaces the months produced, so a rerun is idempotent;
    ``append`` adds to them, the reference's behaviour. The counts are withdrawn, as they don't hold these rows."""
    old = newest_build(spark, table_dir)
    new = write_months(df.select(*schemas.GOLD_SALES.fieldNames()), spark, table_dir, "gold", "order_date")
    if mode == "append":
        new = {m: old.gold.get(m, []) + p for m, p in new.items()}
    publish(spark, table_dir, Build(old.number + 1, old.gold | new))


def vacuum_gold(spark: SparkSession, table_dir: str, keep: int = 2) -> int:
    """Drop all but the newest ``keep`` builds and the folders that these don't name; returns the folders removed.
    To be run when neither a writer nor a reader of an older build is at work."""
    root = table_dir.rstrip("/")
    known = builds(spark, root)
    named = {p.split("/")[0] for n in known[-keep:] for b in [read_build(spark, root, n)]
             for folders in (b.gold, b.counts) for own in folders.values() for p in own}
    for n in known[:-keep]:
        delete_path(spark, f"{root}/_builds/{n:010d}.json")
    gone = [n for n in list_dir(spark, root) if n.startswith(("gold_", "counts_")) and n not in named]
    return sum(delete_path(spark, f"{root}/{n}") for n in gone)
