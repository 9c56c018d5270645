"""The whole run in the reference's job order: landing (databases, then
reviews) -> silver (seven tables) -> gold. A plain function, no scheduler."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from medalake.plans.config import config_frame
from medalake.plans.gold import gold_job, maintain_gold
from medalake.plans.landing import LakePaths, RunLog, ingest_all, land_reviews_batch
from medalake.plans.silver import maintain_silver, silver_from_landing
from medalake.plans.specs import SILVER_ORDER, SPECS
from medalake.sinks.gold import vacuum_gold


def lake_paths(root: str) -> LakePaths:
    root = root.rstrip("/")
    return LakePaths(landing=f"{root}/landing", archive=f"{root}/archive",
                     audit=f"{root}/audit_log", logs=f"{root}/pipeline_logs")


def run_medallion(spark: SparkSession, sources, root: str, as_of: dt.datetime,
                  config: DataFrame | None = None, reviews_payload: str | None = None,
                  mode: str = "standard", maintain: bool = False) -> DataFrame:
    """One run; returns gold. ``maintain`` (standard mode) also compacts silver and gold's counts and drops what the
    newest two versions don't need, to be asked for now and then, when no reader holds an older one."""
    paths = lake_paths(root)
    log = RunLog(as_of)
    config = config if config is not None else config_frame(spark)
    active = {r["tablename"] for r in config.filter("is_active = '1'").select("tablename").collect()}
    try:
        ingest_all(spark, config, sources, paths, as_of, log, as_coded=mode == "as_coded")
        if reviews_payload:
            land_reviews_batch(spark, reviews_payload, paths.landing, as_of, log)
        silver_root = f"{root.rstrip('/')}/silver"
        silver_from_landing(spark, paths.landing, silver_root, as_of,
                            tables=[t for t in SILVER_ORDER if t in active], mode=mode)
        gold_dir = f"{root.rstrip('/')}/gold"
        gold = gold_job(spark, silver_root, gold_dir, mode=mode, as_of=as_of, incremental=(mode == "standard"))
        if maintain and mode == "standard":
            for t in SILVER_ORDER:
                if t in active:
                    maintain_silver(spark, SPECS[t], silver_root)
            maintain_gold(spark, gold_dir)
            vacuum_gold(spark, gold_dir)
        return gold
    except Exception as e:
        log.event("ERROR", f"run failed with {type(e).__name__}: {e}")
        raise
    finally:
        log.save(spark, paths.logs, f"{root.rstrip('/')}/temp/pipeline_logs")
