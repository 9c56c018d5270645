"""Source tables -> landing area, with audit and run log.

Per active config row: look up the high-watermark (incremental loads),
extract (a filter the source can push down), land the batch as JSON with a
distributed write, count and measure it while writing (an ``Observation``:
only two scalars reach the driver), append the audit row, then archive the previous
batches of the table (as coded: first of all). A failing table is logged as ERROR and the next one
runs. The loop runs over the config relation (one row per table), i.e. over
the control plane; each iteration is a set of Spark jobs over the data.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medalake import schemas
from medalake.functions.expressions import DEFAULT_WATERMARK, EPOCH_NTZ, normalized_load_type, ts_literal
from medalake.session import concurrently, hadoop_fs, list_dir
from medalake.sinks import landing as K
from medalake.sinks.tables import write_table
from medalake.sources.json_array import read_payload_files

#: Two jobs must not commit into one folder at a time: each commit clears the folder's temporary files.
_AUDIT_LOCK = threading.Lock()

SourceFn = Callable[[str], DataFrame]   # table name -> source relation


# --- S1 / P1 / P2: config ---------------------------------------------------

def read_config(spark: SparkSession, path: str) -> DataFrame:
    """The ingest config, header CSV, all strings, declared schema."""
    return spark.read.schema(schemas.CONFIG).option("header", True).csv(path)


def active_tables(config: DataFrame) -> DataFrame:
    """Rows with ``is_active == '1'``."""
    return config.filter(F.col("is_active") == "1")


def with_load_mode(config: DataFrame) -> DataFrame:
    """Adds ``load_mode`` in {full, incremental, invalid}."""
    return config.withColumn("load_mode", normalized_load_type("loadtype"))


def load_mode(load_type: str | None) -> str:
    lt = (load_type or "").strip().lower()
    return {"full load": "full", "incremental": "incremental"}.get(lt, "invalid")


# --- S4 / A1 / E10: high-watermark --------------------------------------------

def latest_watermarks(audit: DataFrame, tables: DataFrame, as_coded: bool = False) -> DataFrame:
    """Latest watermark per table name in ``tables`` (column ``tablename``).

    Standard: max ``high_watermark`` of SUCCESS rows. ``as_coded``: max
    ``load_timestamp`` of any row with that name (the reference). Tables never
    loaded get the default. The audit side is aggregated (map-side combined)
    before the join, so its size does not matter; the name list is small."""
    if as_coded:
        agg = audit.groupBy("tablename").agg(F.max("load_timestamp").alias("latest_watermark"))
    else:
        agg = (audit.filter(F.col("status") == "SUCCESS").groupBy("tablename")
               .agg(F.max("high_watermark").alias("latest_watermark")))
    return (tables.select("tablename").distinct().join(agg, "tablename", "left")
            .select("tablename", F.coalesce("latest_watermark", ts_literal(DEFAULT_WATERMARK))
                    .alias("latest_watermark")))


AUDIT_PARTITIONS = ("datasource", "tablename", "status")
NO_WATERMARK = -(1 << 62)
#: Columns of a stored audit file, then its partitions. Footers are read by a column's place, so a reader that pushes
#: aggregates down must state all of them in this order.
AUDIT_STORED = schemas.struct(
    *[(f.name, f.dataType) for f in schemas.AUDIT.fields if f.name not in AUDIT_PARTITIONS],
    ("load_us", schemas.L), ("high_us", schemas.L), *[(c, schemas.S) for c in AUDIT_PARTITIONS])


def append_audit(rows: DataFrame, path: str) -> None:
    """K3: audit rows, partitioned by what a watermark is looked up by. Beside the stated columns, both times are
    kept as microseconds, whose extremes Parquet footers hold."""
    def micros(c):
        return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), F.col(c))

    # a file of NULLs alone has no extremes: a run that found no rows has a mark below all times
    stored = rows.withColumn("load_us", micros("load_timestamp")).withColumn(
        "high_us", F.coalesce(micros("high_watermark"), F.lit(NO_WATERMARK)))
    write_table(stored.select(*AUDIT_STORED.fieldNames()), path, "append", AUDIT_PARTITIONS)


def watermark_state(spark: SparkSession, audit_path: str, table: str, datasource: str | None = None,
                    as_coded: bool = False) -> DataFrame:
    """The maximum that a watermark is, in microseconds: the partitions of one table are listed, and the maximum is
    taken from the footers of their files (``PushedAggregation``), so no audit row is read however many runs there
    were. Aggregate pushdown is a feature of the second file reader, which a session of its own turns on."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    audit = session.read.schema(AUDIT_STORED).parquet(audit_path).filter(F.col("tablename") == table)
    if datasource is not None:
        audit = audit.filter(F.col("datasource") == datasource)
    if as_coded:
        return audit.agg(F.max("load_us").alias("w"))
    return audit.filter(F.col("status") == "SUCCESS").agg(F.max("high_us").alias("w"))


def lookup_watermark(spark: SparkSession, audit_path: str | None, table: str,
                     datasource: str | None = None, as_coded: bool = False) -> dt.datetime:
    """One table's watermark as a scalar (reads the audit table if present):
    the newest ``high_watermark`` of SUCCESS rows, or ``as_coded`` the newest
    ``load_timestamp`` of any row, as the reference looks it up."""
    default = dt.datetime.strptime(DEFAULT_WATERMARK, "%Y-%m-%d %H:%M:%S")
    if not audit_path or not list_dir(spark, audit_path):
        return default
    w = watermark_state(spark, audit_path, table, datasource, as_coded).first()["w"]
    return default if w is None or w == NO_WATERMARK else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=w)


# --- S2 / S3 / P3: extraction -------------------------------------------------

def extract(source: DataFrame, mode: str, watermark_col: str | None, last) -> DataFrame:
    if mode == "full":
        return source
    if mode == "incremental":
        if not watermark_col:
            raise ValueError("incremental load without a watermark column")
        return source.filter(F.col(watermark_col) > ts_literal(last))
    raise ValueError("unknown load type")


# --- C4: run log ------------------------------------------------------------------

@dataclass
class RunLog:
    as_of: dt.datetime
    entries: list = field(default_factory=list)

    def event(self, event_type: str, message: str, table: str | None = None):
        self.entries.append((self.as_of, event_type, message, table))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries, schemas.RUN_LOG)

    def save(self, spark: SparkSession, log_table: str, json_root: str | None = None) -> None:
        """K4/K5: append to the log table (skipped when empty) and write the
        run's JSON document named with the run time."""
        if not self.entries:
            return
        df = self.frame(spark)
        write_table(df, log_table, "append")
        if json_root:
            stamp = self.as_of.strftime("%Y%m%d%H%M%S")
            df.coalesce(1).write.mode("overwrite").json(f"{json_root}/pipeline_log_{stamp}.json")


# --- K6: archive ------------------------------------------------------------------

def batch_day(batch_name: str) -> dt.date:
    """E7 on a batch name: the ddMMyyyy date after the last ``_`` (the same rule
    as ``functions.file_date`` for path columns)."""
    stamp = batch_name.rsplit("_", 1)[-1].split(".", 1)[0]
    return dt.datetime.strptime(stamp, "%d%m%Y").date()


def archive_landed(spark: SparkSession, landing_root: str, archive_root: str, table: str,
                   keep: set[str] = frozenset(), log: RunLog | None = None,
                   only: set[str] | None = None) -> int:
    """Move landed batches of ``table`` (except ``keep``; with ``only``, no others) to
    ``archive/<table>/year=/month=/day=/batch=`` by the date in the batch name.

    A batch is a folder, and one rename moves it whole (metadata-only on HDFS):
    no row passes through the cluster or the driver, and the driver's calls per
    batch don't depend on its files. A batch archived before under the same
    name (a same-day rerun) is replaced. A run that dies before the rename
    leaves the batch in the landing area, and the next run archives it."""
    fs, base = hadoop_fs(spark, f"{landing_root.rstrip('/')}/{table}")
    Path = spark._jvm.org.apache.hadoop.fs.Path
    batches = [n for n in list_dir(spark, str(base))
               if n.startswith(f"{table}_") and n.endswith(".json") and n not in keep
               and (only is None or n in only)]
    if not batches and log:
        log.event("INFO", f"{table}: nothing to archive", table)
    for b in batches:
        day = Path(f"{archive_root.rstrip('/')}/{table}/year={batch_day(b):%Y}/month={batch_day(b):%m}/day={batch_day(b):%d}")
        target = Path(day, f"batch={b}")
        fs.mkdirs(day)
        fs.delete(target, True)
        if not fs.rename(Path(base, b), target):
            raise IOError(f"could not archive {b}")
        if log:
            log.event("INFO", f"{table}: archived batch {b}", table)
    return len(batches)


def read_archive(spark: SparkSession, archive_root: str, table: str) -> DataFrame:
    schema = StructType(list(schemas.BRONZE[table].fields))   # copy: add() mutates
    for c in ("year", "month", "day", "batch"):
        schema = schema.add(c, "string")
    return spark.read.schema(schema).json(f"{archive_root.rstrip('/')}/{table}").drop("batch")


# --- C1 / C2: ingestion ---------------------------------------------------------

@dataclass
class LakePaths:
    landing: str
    archive: str
    audit: str
    logs: str


def ingest_table(spark: SparkSession, source: DataFrame, cfg: dict, paths: LakePaths,
                 as_of: dt.datetime, log: RunLog, as_coded_watermark: bool = False,
                 archive_unmerged: bool = False) -> dict:
    """Land one table. Earlier batches are archived once the ledger says that silver has committed them;
    ``archive_unmerged`` archives them regardless, and before the extraction, as the reference does: the landing
    area then holds just this run's batch."""
    table = cfg["tablename"]
    mode = load_mode(cfg.get("loadtype"))
    wcol = cfg.get("watermark") or None
    last = None
    if archive_unmerged:
        archive_landed(spark, paths.landing, paths.archive, table, log=log)
    if mode == "incremental":
        last = lookup_watermark(spark, paths.audit, table,
                                None if as_coded_watermark else cfg.get("datasource"), as_coded_watermark)
        log.event("INFO", f"{table}: loading changes after {last:%Y-%m-%d %H:%M:%S}", table)
    batch = extract(source, mode, wcol, last)
    # row count and high-watermark are observed while the batch is written:
    # no second pass over the landed files, only two scalars reach the driver
    obs = Observation(f"landed_{table}")
    measures = [F.count(F.lit(1)).alias("n")]
    if mode == "incremental":
        measures.append(F.max(wcol).alias("w"))
    landed = K.land_json(batch.observe(obs, *measures), paths.landing, table, as_of)
    metrics = obs.get
    n = int(metrics.get("n") or 0)
    high = metrics.get("w") if mode == "incremental" else None
    log.event("SUCCESS", f"{table}: landed {n} rows", table)
    audit_row = [(table, cfg.get("loadtype"), n, as_of, "SUCCESS", cfg.get("datasource"), high)]
    with _AUDIT_LOCK:
        append_audit(spark.createDataFrame(audit_row, schemas.AUDIT), paths.audit)
    log.event("SUCCESS", f"{table}: audit row written", table)
    if not archive_unmerged:
        archive_landed(spark, paths.landing, paths.archive, table, keep={landed.rsplit('/', 1)[-1]}, log=log,
                       only=K.merged_batches(spark, paths.landing, table))
    return {"tablename": table, "record_count": n, "high_watermark": high}


def ingest_all(spark: SparkSession, config: DataFrame, sources: SourceFn, paths: LakePaths,
               as_of: dt.datetime, log: RunLog | None = None, parallel: int = 4, as_coded: bool = False) -> RunLog:
    """Every active config row, ``parallel`` tables at a time; one failure does not stop the rest.

    ``as_coded``: the reference's watermark (the newest load time of any row of that name) and its order, archive
    before extraction."""
    log = log or RunLog(as_of)
    rows = [r.asDict() for r in config.collect()]   # one row per table (control plane)
    log.event("INFO", f"config: {len(rows)} rows")

    def one(cfg: dict) -> RunLog:
        table, own = cfg["tablename"], RunLog(as_of)
        try:
            ingest_table(spark, sources(table), cfg, paths, as_of, own, as_coded, as_coded)
        except Exception as e:  # noqa: BLE001  (the reference isolates failures per table)
            own.event("ERROR", f"{table}: failed with {type(e).__name__}: {e}", table)
        return own

    # tables don't depend on each other; their events are logged in config order
    for own in concurrently(spark, one, [cfg for cfg in rows if cfg.get("is_active") == "1"], parallel):
        log.entries += own.entries
    return log


def land_reviews_batch(spark: SparkSession, payload_path: str, landing_root: str,
                       as_of: dt.datetime, log: RunLog | None = None) -> int:
    """Saved reviews payload -> dated parquet landing; returns the record count.

    Takes files of JSON lines and of one JSON array each, a large array in
    several tasks. Raises when the payload cannot be read or holds a malformed
    record (the reference exits with success). The count is observed during
    the write."""
    payload = read_payload_files(spark, payload_path, schemas.REVIEWS)
    obs = Observation("landed_reviews")
    K.land_reviews(payload.observe(obs, F.count(F.lit(1)).alias("n")), landing_root, as_of)
    n = int(obs.get.get("n") or 0)
    if log:
        log.event("SUCCESS", f"customer_reviews: landed {n} records", "customer_reviews")
    return n
