"""Partition-keyed overwrite and key-merge upsert (K1, K2, K3, ST6).

``upsert`` keeps one row per key in a parquet table:

0. the batch is reduced to the last version of each key by ``order`` (the position of the message:
   sequence, time, offset; ``max_by``, pre-combined map-side) and staged as a parquet table in the
   shared checkpoint folder - it is computed once;
1. the stored side is read with the batch's distinct partition values as literals in the filter
   (``PartitionFilters``: only those folders are listed and scanned), or with their range and a
   semi-join when they are many; when none of the batch's keys exist there (new ticks - the normal
   case), the batch is appended and nothing rewritten;
2. otherwise: stored rows whose key is not in the batch (a left-anti join against the batch's keys,
   broadcast by size) plus the batch; the table holds one row per key and the batch always wins,
   so this equals the full merge ``merge_frames``;
3. the result is staged (cuts the lineage, so a lost executor recomputes from the staged files,
   never from a half-replaced target);
4. the touched partitions are dynamically overwritten from the staged copy; an unpartitioned table
   is written beside the old one and swapped in (``session.swap_in``).

Versioned tables: with ``version`` the table keeps, beside each row, where its message stood in the
order of all messages (``message_version``: its own sequence number, then time, partition and offset of
the transport). A batch row then replaces a stored one only if its version is greater, so an older
message that is delivered again in a later batch loses, whatever the batch sizes; partitions that only
hold such rows are not rewritten at all. Rows stored without a version lose to any batch. Readers that
ask for the table's declared schema do not see the column.

Merging the same batch twice gives the same table (idempotent), which is what makes stream
redelivery harmless. One writer per table is assumed; plain parquet has no atomic multi-partition
swap, so readers may briefly see a mix of old and new partitions.
"""
from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tickvault.operators.topn import latest_per_key
from tickvault.session import delete_path, restore_path, scratch_path, swap_in
from tickvault.sources.files import estimated_bytes

SRC = "_tv_src"
VERSION = "_version"
VERSION_TYPE = T.StructType([T.StructField("seq", T.LongType()), T.StructField("at", T.TimestampType()),
                             T.StructField("part", T.IntegerType()), T.StructField("offset", T.LongType())])


def message_version(seq: Column | None = None, at: Column | None = None, part: Column | None = None, offset: Column | None = None) -> Column:
    """Where a message stands among all versions of its key; parts not given are NULL, which sorts
    first. Without any part it is NULL: such a row replaces only rows that have no version either."""
    given = [(F.lit(None) if c is None else c).cast(f.dataType) for c, f in zip((seq, at, part, offset), VERSION_TYPE.fields)]
    known = functools.reduce(Column.__or__, [c.isNotNull() for c in given])
    return F.when(known, F.struct(*[c.alias(f.name) for c, f in zip(given, VERSION_TYPE.fields)]))


def overwrite_partitions(df: DataFrame, path: str, partition_cols: str | list[str] | None,
                         fmt: str = "parquet", clustered: bool = False) -> None:
    """K1: replace only the partitions present in ``df`` (dynamic partition overwrite).

    Rows are clustered by partition value first (unless ``clustered``), so each partition is
    written by one task: one file per partition instead of one per task and partition.
    """
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols or [])
    if cols and not clustered:
        df = df.repartition(*cols)
    w = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*cols) if cols else w).save(path)


def merge_frames(existing: DataFrame, batch: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """The merge core (K2 without I/O): batch rows win over stored rows with the same key."""
    both = existing.withColumn(SRC, F.lit(0)).unionByName(batch.withColumn(SRC, F.lit(1)))
    return latest_per_key(both, key, [SRC] + list(order or [])).drop(SRC)


WRITE_TASK_BYTES = 256 * 1024 * 1024
BROADCAST_BYTES = 64 * 1024 * 1024      # stored size of records that are broadcast to the rows that share them
MAX_LITERALS = 1000          # distinct partition values of a batch that become filter literals


def _write_tasks(df: DataFrame) -> int:
    """Write tasks for ``df``: one per ~256 MB of its estimated size, at least one per core."""
    spark = df.sparkSession
    size = estimated_bytes(df)
    if size is None:  # pragma: no cover - statistics unavailable
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, -(-size // WRITE_TASK_BYTES))


def _layout(df: DataFrame, parts: list[str], key: list[str], shared: bool = False) -> DataFrame:
    """Range-partition by (partition columns, key) into a size-derived number of write tasks.

    Each task gets a contiguous slice, so a small partition is written as one file by one task,
    a hot partition (one day holding a third of the rows) is split by key range across many
    tasks, and the task count is not coalesced away by AQE for small inputs. With ``shared`` (wide
    columns are joined later) there is a task per shuffle partition, its rows sorted by the partition columns, so
    that the writer need not sort the wide ones (the optimizer drops a sort below a join unless they are observed).
    """
    by = [F.col(c) for c in parts + key]
    if not shared:
        return df.repartitionByRange(_write_tasks(df), *by)
    tasks = max(_write_tasks(df), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartitionByRange(tasks, *by).sortWithinPartitions(*by).observe(f"laid_out_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def _broadcastable(records: DataFrame) -> bool:
    size = estimated_bytes(records)
    return size is not None and size <= BROADCAST_BYTES


def _with_records(rows: DataFrame, records: DataFrame, on: str) -> DataFrame:
    """``rows`` with their records; up to ``BROADCAST_BYTES`` of records are broadcast, so the rows keep their layout."""
    return rows.join(F.broadcast(records) if _broadcastable(records) else records, on)


def _stage(df: DataFrame, schema: T.StructType, stages: list[str]) -> DataFrame:
    """Write ``df`` as an unpartitioned parquet table in the shared checkpoint folder and read it
    back: one job computes it once, and the lineage of what follows starts at these files."""
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    stages.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def replace_keys(stored: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Stored rows whose key is not in ``batch``, plus ``batch`` (both one row per key): the merge
    when the batch wins. The batch keys are the small side of a left-anti join, broadcast by
    size, so the stored rows are filtered where they are read, never shuffled."""
    return stored.join(batch.select(*key), key, "left_anti").unionByName(batch)


def newer(batch: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """The batch rows that no stored row of their key is at least as new as. Only keys and versions of the
    touched partitions are read; of those the older ones' keys leave the batch by an anti join."""
    known = stored.filter(F.col(VERSION).isNotNull()).select(*key, F.col(VERSION).alias("_tv_stored"))
    kept = F.col(VERSION).isNull() | (F.col("_tv_stored") >= F.col(VERSION))
    older = batch.select(*key, VERSION).join(known, key).filter(kept).select(*key)
    return batch.join(older, key, "left_anti")


def _overlaps(batch: DataFrame, stored: DataFrame, key: list[str]) -> bool:
    """Does any batch key already exist in the touched partitions? Reads only the key columns."""
    return bool(batch.select(*key).join(stored.select(*key), key, "left_semi").limit(1).count())


def touched(stored: DataFrame, fresh: DataFrame, parts: list[str]) -> DataFrame:
    """The stored partitions that ``fresh`` touches. Up to ``MAX_LITERALS`` distinct values become
    literals in the filter, so the scan is pruned when it is planned; beyond that the range of the
    first partition column prunes, and a semi-join does the rest."""
    values = fresh.select(*parts).distinct()
    some = values.limit(MAX_LITERALS + 1).collect()
    if len(some) <= MAX_LITERALS:
        for c in parts:
            stored = stored.filter(F.col(c).isin(sorted({r[c] for r in some if r[c] is not None})))
        return stored if len(parts) == 1 else stored.join(values, parts, "left_semi")
    low, high = values.agg(F.min(parts[0]), F.max(parts[0])).first()
    return stored.filter(F.col(parts[0]).between(low, high)).join(values, parts, "left_semi")


def upsert(batch: DataFrame, path: str, key: list[str], schema: T.StructType,
           partition_cols: list[str] | None = None, order: list[str] | None = None,
           stats: bool = False, insert_only: bool = True, version: Column | None = None,
           records: tuple[DataFrame, str] | None = None) -> dict | None:
    """K2/K3: merge ``batch`` into the table at ``path`` by ``key``; the last write wins.

    ``order``: columns of ``batch`` (they need not be stored) that say which of several versions of a
    key came last inside the batch. ``version`` (``message_version`` over columns of ``batch``) says it
    for all batches: it is stored, and the greater one wins whichever comes in first. ``partition_cols`` must be non-null functions of the key (e.g. ``date`` of
    ``read_timestamp``), so a key never moves between partitions; callers quarantine rows
    without them. With ``stats`` it returns the written row count
    (observed during the write, no second pass) and whether it appended or merged.

    ``records`` (a stored frame, one row per its id, and the id's name): columns that many rows of a batch share.
    ``batch`` then has one row per key already and lacks them; it is staged and laid out without them, and they are
    joined where the table is written, so a wide record is never shuffled once per row that shares it.
    """
    spark = batch.sparkSession
    parts = list(partition_cols or [])
    if version is not None:
        batch, order = batch.withColumn(VERSION, version), [VERSION]
        schema = T.StructType([*schema.fields, T.StructField(VERSION, VERSION_TYPE)])
    names = schema.fieldNames()
    position = [c for c in order or [] if c not in names]
    shared = [] if records is None else [c for c in records[0].columns if c != records[1]]
    slim = T.StructType([f for f in schema.fields if f.name not in shared])
    batch = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in slim.fields], *position)
    whole = lambda df: df if records is None else _with_records(df, *records).select(*names)
    exists = restore_path(spark, path)
    stages: list[str] = []
    try:
        # the batch is computed once: de-duplicated by key and staged as a table in the shared
        # checkpoint folder, which also cuts its lineage (a lost executor re-reads these files)
        fresh = _stage((latest_per_key(batch, key, list(order or [])) if records is None else batch).select(*slim.fieldNames()), slim, stages)
        stored = spark.read.schema(schema).parquet(path).select(*names) if exists else None
        if stored is not None and parts:
            stored = touched(stored, fresh, parts)
        if stored is not None and version is not None:
            fresh = _stage(newer(fresh, stored, key), slim, stages)
            if fresh.isEmpty():
                return {"rows": 0, "mode": "none"} if stats else None
            stored = touched(stored, fresh, parts) if parts else stored
        append = stored is None or (insert_only and not _overlaps(fresh, stored, key))
        # new keys only (the normal hourly case): write the batch, rewrite nothing; else the merge is
        # staged before the overwrite replaces what it was read from
        if append and records is not None and _broadcastable(records[0]):
            laid_out = whole(_layout(fresh, parts, key, shared=True))
        else:
            laid_out = _layout(whole(fresh) if append else _stage(replace_keys(stored, whole(fresh), key), schema, stages), parts, key)
        obs = None
        if stats:
            # A1: count the written rows on the way out (no second pass over the data)
            obs = Observation(f"upsert_{uuid.uuid4().hex}")
            laid_out = laid_out.observe(obs, F.count(F.lit(1)).alias("rows"))
        if append:
            w = laid_out.write.mode("append" if exists else "overwrite")
            (w.partitionBy(*parts) if parts else w).parquet(path)
        elif parts:
            overwrite_partitions(laid_out, path, parts, clustered=True)
        else:
            new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
            stages.append(new)
            laid_out.write.parquet(new)
            swap_in(spark, new, path)
        return {"rows": obs.get["rows"], "mode": "append" if append else "merge"} if stats else None
    finally:
        for st in stages:
            delete_path(spark, st)
