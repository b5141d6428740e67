"""Top-n per group that survives a hot group (O3, K2 helpers).

``row_number() <= n`` over a window already gets a map-side ``WindowGroupLimit (Partial)`` in
Spark 4, so each map task ships at most n rows per group. With ``salt_buckets`` the groups are
first split by a hash of the row id: stage 1 keeps n rows per (group, salt), stage 2 ranks the
at most ``salt_buckets * n`` survivors of a group. The result is exact (the global top n of a
group is inside the union of the per-salt top n), and no task ever sorts a whole hot group.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int,
                    salt_on: list[str] | None = None, salt_buckets: int = 0,
                    rank_col: str | None = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each ``keys`` group in ``order`` (which must be total)."""
    tmp = "_tv_rn"
    if salt_buckets and salt_on:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_on]), F.lit(salt_buckets))
        w1 = Window.partitionBy(*keys, "_tv_salt").orderBy(*order)
        df = (df.withColumn("_tv_salt", salt)
                .withColumn(tmp, F.row_number().over(w1)).filter(F.col(tmp) <= n)
                .drop(tmp, "_tv_salt"))
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(tmp, F.row_number().over(w)).filter(F.col(tmp) <= n)
    return out.withColumnRenamed(tmp, rank_col) if rank_col else out.drop(tmp)


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return False
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return True


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the remaining orderable columns
    (deterministic unless two versions differ only inside a map).

    ``max_by(row, ordering)`` is a decomposable aggregate: every map task combines the versions
    of a key before the shuffle, so a key holding a third of all rows still ships one row per task.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordering = F.struct(*[F.col(f"`{c}`") for c in order + [c for c in rest if _orderable(types[c])]])
    value = F.struct(*[F.col(f"`{c}`") for c in order + rest])
    packed = F.max_by(value, ordering).alias("_tv_v")
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(packed).select(
        *[F.col(f"`{k}`") for k in keys], *[F.col(f"_tv_v.`{c}`").alias(c) for c in order + rest])
