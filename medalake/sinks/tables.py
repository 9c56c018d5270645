"""K7/K8: silver table sinks.

Silver tables are versioned and never overwrite what a run reads. Each run
writes one version folder, partitioned by ``is_active``:

* ``snap_<n>``: the whole table (first load, full refresh, as-coded runs);
* ``ver_<n>``: a delta, only the rows opened and closed by run ``n``, so a run
  writes in proportion to its batch, not to the table;
* ``comp_<n>``: the whole table again, written by maintenance; no new change.

Spark's job commit writes ``_SUCCESS`` last; a version counts only once it is
there. The table = closed rows of the chain (the newest whole version and the
deltas after it) + its open rows, less those that a later delta of the chain
closed: an anti join on the keys and the opening time. Its small side, the
rows closed since the last whole version, is broadcast by Catalyst while its
files are small. A failed run leaves the previous version current. This
replaces the reference's overwrite of the folder being read (which loses the
table).

A version written for a stream's micro-batch carries the stream's id and the
epoch in its name, so both are committed in one step: a replayed epoch is told
by ``committed_epoch`` and writes nothing. Retention keeps each stream's newest.

Buckets: the whole versions of a table may be bucketed and sorted by its keys.
A merge then meets them without shuffling them: the keys of the batch, dealt
into as many buckets, are semi-joined to every version of the chain on its own
(``touching``), and only what they hit goes on. The number of buckets is kept in
the version's name, so it may change from one whole version to the next. It
should be a multiple of the files that fit the table, and not below
``spark.sql.shuffle.partitions``, or Catalyst shuffles both sides after all.
Spark reads buckets through its catalog, so a bucketed folder is declared there
as an external table, named by its path; ``vacuum_silver`` drops it again.

Bands: a table whose schema names a band column (orders and their items, both
by ``order_id``) is also partitioned by that id divided by the band's size. The
band follows from a row's own key, so a row never waits for another table,
and both tables are cut at the same ids. A reader that knows which ids it
needs passes their bands, and only those folders are scanned
(``PartitionFilters``): new orders have neighbouring ids, so a day's batch
falls into few bands. As-coded runs read and write whole tables only, so their
versions have no bands; a reader of bands takes such a version whole.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medalake.session import delete_path, list_dir

DELTA_PREFIX, SNAPSHOT_PREFIX, COMPACTION_PREFIX = "ver_", "snap_", "comp_"
VERSION_COLUMN, BAND_COLUMN = "_version", "_band"
_NAME = re.compile(f"({DELTA_PREFIX}|{SNAPSHOT_PREFIX}|{COMPACTION_PREFIX})(\\d+)(?:--([0-9a-f-]+)@(\\d+))?(?:~(\\d+))?")


class Delivery(NamedTuple):
    """A micro-batch of a stream."""
    stream: str     # the streaming query's id, as its checkpoint keeps it (hex digits and dashes)
    epoch: int


class Version(NamedTuple):
    number: int
    prefix: str
    name: str
    flags: frozenset      # the is_active folders it has
    delivery: Delivery | None = None
    buckets: int = 0

    @property
    def snapshot(self) -> bool:
        """Whether it holds the whole table."""
        return self.prefix != DELTA_PREFIX


def versions(spark: SparkSession, table_dir: str, upto: int | None = None) -> list[Version]:
    """Committed versions, oldest first, up to number ``upto``. Each folder is listed once."""
    out = []
    for name in list_dir(spark, table_dir):
        m = _NAME.fullmatch(name)
        if m and (upto is None or int(m[2]) <= upto):
            held = list_dir(spark, f"{table_dir}/{name}")
            if "_SUCCESS" in held:
                flags = frozenset(f for f in (True, False) if f"is_active={str(f).lower()}" in held)
                out.append(Version(int(m[2]), m[1], name, flags, Delivery(m[3], int(m[4])) if m[3] else None,
                                   int(m[5] or 0)))
    return sorted(out, key=lambda v: (v.number, v.prefix))


def committed_epoch(spark: SparkSession, table_dir: str, stream: str) -> int:
    """The newest epoch of a stream that a version holds; -1 before the first."""
    return max((v.delivery.epoch for v in versions(spark, table_dir) if v.delivery and v.delivery.stream == stream),
               default=-1)


def committed_versions(spark: SparkSession, table_dir: str) -> list[int]:
    return [v.number for v in versions(spark, table_dir)]


def _chain(vs: list[Version]) -> list[Version]:
    """The newest whole version and the deltas after it."""
    start = max((i for i, v in enumerate(vs) if v.snapshot), default=0)
    return vs[start:]


def deltas_since_snapshot(spark: SparkSession, table_dir: str) -> int:
    return len(_chain(versions(spark, table_dir))) - 1


def band_of(schema: StructType) -> tuple[str, int] | None:
    """The band column of a silver schema and the ids in a band, as its field metadata say."""
    return next(((f.name, f.metadata["band"]) for f in schema.fields if f.metadata.get("band")), None)


def band(schema: StructType):
    """The band of a row: its id divided by the band's size, rounded down."""
    name, size = band_of(schema)
    return F.expr(f"({name} - pmod({name}, {size})) DIV {size}")


def bands_in(df: DataFrame, schema: StructType) -> list[int]:
    """The bands that rows of ``df`` fall into. They are folders of the table, so their number is bounded."""
    return sorted(r[0] for r in df.select(band(schema).alias("b")).where("b IS NOT NULL").distinct().collect())


def keys_of(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get("key")]


def _bucket_table(folder: str) -> str:
    return f"medalake_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"


def _bucketed(spark: SparkSession, folder: str, stored: StructType, keys: list[str], buckets: int) -> DataFrame:
    """A folder of files bucketed and sorted by ``keys``, read as such."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_bucket_table(folder)} ({columns}) USING parquet "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return spark.table(_bucket_table(folder))


def _read_flag(spark: SparkSession, table_dir: str, vs: list[Version], schema: StructType, flag: bool,
               bands: list[int] | None = None, touching: DataFrame | None = None) -> DataFrame | None:
    """Rows that the versions ``vs`` opened (``flag``) or closed, with their version; None without any."""
    folder = f"is_active={str(flag).lower()}"
    paths = [f"{table_dir}/{v.name}/{folder}" for v in vs if flag in v.flags and not v.buckets]
    in_buckets = [v for v in vs if flag in v.flags and v.buckets]
    if not paths and not in_buckets:
        return None
    stored = StructType([f for f in schema.fields if f.name != "is_active"]).add(VERSION_COLUMN, "long")
    if band_of(schema):
        stored = stored.add(BAND_COLUMN, "long")
    # every version is a root of its own, whose sub-folders are bands
    parts = [spark.read.schema(stored).parquet(p) for p in paths] if band_of(schema) else \
        [spark.read.schema(stored).parquet(*paths)] if paths else []
    parts += [_bucketed(spark, f"{table_dir}/{v.name}/{folder}", stored, keys_of(schema), v.buckets) for v in in_buckets]
    if touching is not None:
        parts = [p.join(touching, keys_of(schema), "left_semi") for p in parts]
    df = reduce(DataFrame.unionByName, parts)
    if bands is not None:
        # a version without bands is read whole
        df = df.filter(F.col(BAND_COLUMN).isin(bands) | F.col(BAND_COLUMN).isNull() if bands else F.lit(False))
    return df.withColumn("is_active", F.lit(flag))


def _union(spark: SparkSession, parts: list[DataFrame | None], schema: StructType) -> DataFrame:
    parts = [p.select(*schema.fieldNames()) for p in parts if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read_silver(spark: SparkSession, table_dir: str, schema: StructType, upto: int | None = None,
                bands: list[int] | None = None, touching: DataFrame | None = None) -> DataFrame | None:
    """The table as of version ``upto`` (default: the newest), or None when it has no committed version yet; with
    ``bands``, just the rows in those, with ``touching`` (keys), just the rows of these keys. The keys are the fields of
    ``schema`` whose metadata say so."""
    chain = _chain(versions(spark, table_dir, upto))
    if not chain:
        return None
    opened = _read_flag(spark, table_dir, chain, schema, True, bands, touching)
    closed = _read_flag(spark, table_dir, chain, schema, False, bands, touching)
    ended = _read_flag(spark, table_dir, chain[1:], schema, False, bands, touching)
    if opened is not None and ended is not None:
        same = keys_of(schema) + ["effective_start_date"]
        ended = ended.select(*[F.col(c).alias(f"ended_{c}") for c in (*same, VERSION_COLUMN)])
        match = [F.col(c) == F.col(f"ended_{c}") for c in same]
        match.append(F.col(VERSION_COLUMN) < F.col(f"ended_{VERSION_COLUMN}"))
        opened = opened.join(ended, match, "left_anti")
    return _union(spark, [opened, closed], schema)


def rows_signed(spark: SparkSession, table_dir: str, schema: StructType, number: int, upto: int | None = None,
                bands: list[int] | None = None) -> DataFrame:
    """Rows as sums, for readers that count. ``now`` gives the open rows: 1 for what the chain opened, -1 for what its deltas
    closed of that; ``change`` what the versions after ``number`` opened (1) and closed (-1), as ``changes_since``. A closed
    row repeats the values of the open one, so the two cancel out; nothing is joined, and a delta that counts in both
    is one row. ``bands`` limits the rows that are no change."""
    known = versions(spark, table_dir, upto)
    chain, later = _chain(known), [v for v in known if v.number > number and not v.snapshot]
    both = [v for v in chain[1:] if v in later]
    parts = []
    for vs, now, change in (([v for v in chain if v not in both], 1, 0), (both, 1, 1), ([v for v in later if v not in both], 0, 1)):
        for flag, sign in ((True, 1), (False, -1)):
            if not (flag or change):
                vs = [v for v in vs if v != chain[0]]
            df = _read_flag(spark, table_dir, vs, schema, flag, None if change else bands)
            if df is not None:
                parts.append(df.select(*schema.fieldNames(), F.lit(sign * now).alias("now"), F.lit(sign * change).alias("change")))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema).select(
        "*", F.lit(0).alias("now"), F.lit(0).alias("change"))


def changes_since(spark: SparkSession, table_dir: str, schema: StructType, number: int,
                  upto: int | None = None) -> DataFrame | None:
    """Rows opened or closed by the versions after ``number`` up to ``upto``; None where the
    versions kept can't tell (a whole load since, or deltas already dropped)."""
    known = versions(spark, table_dir, upto)
    later = [v for v in known if v.number > number]
    newest = max((v.number for v in known), default=0)
    if (number > newest or len({v.number for v in later}) != newest - number
            or any(v.prefix == SNAPSHOT_PREFIX for v in later)):
        return None
    deltas = [v for v in later if not v.snapshot]
    return _union(spark, [_read_flag(spark, table_dir, deltas, schema, f) for f in (True, False)], schema)


def write_silver_version(df: DataFrame, spark: SparkSession, table_dir: str, schema: StructType,
                         prefix: str = SNAPSHOT_PREFIX, delivery: Delivery | None = None, buckets: int = 0,
                         banded: bool = True) -> str:
    """Write the next version: the whole table (in ``buckets``, if any), or
    with ``DELTA_PREFIX`` the rows opened and closed by this run. Without ``banded``, rows are written
    from where they lie, not shuffled into bands."""
    vs = versions(spark, table_dir)
    n = (vs[-1].number + 1) if vs else 1
    path = f"{table_dir}/{prefix}{n:010d}" + (f"--{delivery.stream}@{delivery.epoch}" if delivery else "")
    by = ["is_active"]
    df = df.withColumn(VERSION_COLUMN, F.lit(n).cast("long"))
    if band_of(schema) and banded:
        # rows of a band meet in few tasks, so that a band gets few files; a large band is split by AQE
        by.append(BAND_COLUMN)
        df = df.withColumn(BAND_COLUMN, band(schema)).hint("rebalance", *by)
    if buckets and prefix != DELTA_PREFIX:
        path += f"~{buckets}"
        keys = keys_of(schema)
        table = _bucket_table(path)
        # as many tasks as buckets, by the same hash: one file for each
        (df.repartition(buckets, *keys).write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "static")
         .partitionBy(*by).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")            # external: the files stay
        return path
    # a fresh folder: static mode, so the job commit leaves _SUCCESS at its root
    (df.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "static")
     .partitionBy(*by).parquet(path))
    return path


def vacuum_silver(spark: SparkSession, table_dir: str) -> int:
    """Retention: versions older than the second-newest whole version are
    dropped, so a reader still on the previous chain keeps its files; the
    newest one of every stream stays. Returns the number of folders removed."""
    vs = versions(spark, table_dir)
    whole = [i for i, v in enumerate(vs) if v.snapshot]
    cut = whole[-2] if len(whole) >= 2 else 0
    newest = {v.delivery.stream: v for v in sorted((v for v in vs if v.delivery), key=lambda v: v.delivery.epoch)}
    gone = [v for v in vs[:cut] if v not in newest.values()]
    for v in gone:
        for flag in ("true", "false") if v.buckets else ():
            spark.sql(f"DROP TABLE IF EXISTS {_bucket_table(f'{table_dir}/{v.name}/is_active={flag}')}")
    return sum(delete_path(spark, f"{table_dir}/{v.name}") for v in gone)


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by=()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
