"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

# Settings every job relies on. Cluster-specific sizing (executor memory,
# shuffle partition count at 100 TB) belongs to the cluster's own config; these
# only fix semantics and turn on runtime re-planning.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # gold reruns replace only the order_date partitions they produce
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "medalake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A private folder is made only for a local master, where driver and
    executors are one process; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="medalake-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint root, for tables a job writes."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "medalake", *parts, uuid.uuid4().hex[:12]])


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for ``path`` through the JVM's Hadoop client."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.delete(p, True))


def concurrently(spark: SparkSession, fn, items, parallel: int) -> list:
    """``fn`` of each item, up to ``parallel`` at a time on driver threads that only submit Spark jobs; results in
    order. The first failure is raised once all have ended."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(fn), i) for i in items]]
