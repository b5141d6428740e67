"""Quarantine of messages and documents that cannot be stored (ST5).

One layout for streams and batch jobs: rows (reason, payload) under ``source=<what>/run=<run>``. A
stream's run is its query and epoch, a batch's run is the content of its bad rows, so whatever is
written again after a failure or a second run replaces itself and touches nothing else. The payload
is the message or document as it came.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickvault import schemas


def write_quarantine(bad: DataFrame, path: str, source: str, run: str) -> None:
    """Write ``bad`` (reason, payload) as the partition (source, run), replacing only that one."""
    (bad.select("reason", "payload", F.lit(source).alias("source"), F.lit(run).alias("run"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*schemas.QUARANTINE_PARTITION).parquet(path))


def batch_run(bad: DataFrame) -> str | None:
    """A run name made of the rows themselves (None without rows): the same rows, the same name."""
    h = F.xxhash64("reason", "payload")
    n, a, b = bad.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first()
    return f"batch-{n}-{a & (2**64 - 1):016x}-{b}" if n else None


def quarantine_batch(bad: DataFrame, path: str, source: str) -> None:
    """Write the bad rows of a batch job; ``bad`` should be a staged table (it is read twice)."""
    run = batch_run(bad)
    if run is not None:
        write_quarantine(bad, path, source, run)
