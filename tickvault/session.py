"""Session factory (S13) and the shared scratch location.

All hosts, credentials and sizes come from arguments; nothing is read from the environment.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours carries. Timestamps in the engine are UTC wall-clock
# TIMESTAMP_NTZ values, so the session zone only matters for LTZ inputs; pin it anyway.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # map-side top-n per group (WindowGroupLimit) also for the batch limit of 5000 posts per keyword
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.ui.enabled": "false",
    # listing a day-partitioned table: at most 256 listing tasks (not one task per directory)
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def get_session(app_name: str = "tickvault", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults plus ``conf``.

    ``conf`` carries whatever the deployment needs (object-store endpoint, catalog
    extension, executor sizes); the reference hard-coded those, we take them as options.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for an expected input volume (pass to ``get_session(conf=...)``).

    Scan splits of 256 MB; initial shuffle partitions so each holds about ``partition_bytes``
    (never fewer than 2 per core), which AQE then coalesces toward the advisory size. For 100 TB
    on 1,000 executors x 8 cores this gives 819,200 partitions of 128 MB before coalescing: each
    fits an executor's memory share and spills in bounded pieces.
    """
    parts = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder from the session. Only in local mode, when none is
    configured (tests), a temporary folder is set; on a cluster a missing setting is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(staging tables and stream checkpoints live there)")
        d = tempfile.mkdtemp(prefix="tickvault-ckpt-")   # single-machine runs and tests only
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder name below the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tickvault/{kind}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Best-effort recursive delete through the Hadoop file system of ``path``."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # pragma: no cover - cleanup must never fail a job
        pass


def path_exists(spark: SparkSession, path: str) -> bool:
    """Through the Hadoop file system, so a scheme-less path resolves against ``fs.defaultFS``
    (HDFS on a cluster), exactly as Spark's readers and writers resolve it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` (on the same file system) in the place of ``path``: the old folder
    is set aside, the new one renamed, then the old one deleted. At every moment one complete copy
    exists; after a crash between the two renames ``restore_path`` puts the old one back."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    old = p.suffix(f".old-{uuid.uuid4().hex}")
    if fs.exists(p) and not fs.rename(p, old):
        raise OSError(f"cannot set aside {path}")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(new), p):
        fs.rename(old, p)
        raise OSError(f"cannot rename {new} to {path}")
    fs.delete(old, True)


def restore_path(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist? A copy set aside by an interrupted ``swap_in`` is put back first."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return True
    found = fs.globStatus(p.suffix(".old-*"))
    return bool(found) and len(found) > 0 and fs.rename(found[0].getPath(), p)
