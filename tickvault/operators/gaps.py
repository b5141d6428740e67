"""Holes in stored price histories, and what fills them.

Ticks are first reduced to the intervals they fall into (a distinct with a map-side part, so a hot coin costs
a row per interval, not per tick); everything after that is bounded by the number of intervals of a coin
in the asked range.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickvault.operators.aggregate import INTERVALS, _bucket


def _step(interval: str) -> Column:
    return F.expr(f"INTERVAL {INTERVALS.get(interval, interval)}")


def _at(ts: str | Column) -> Column:
    return (F.lit(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def covered(ticks: DataFrame, key: str, ts: str, interval: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The distinct (key, bucket_start) that hold a tick, of the buckets that begin in [start, end)."""
    rows = ticks.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    rows = rows.select(key, _bucket(ts, interval).alias("bucket_start")).distinct()
    rows = rows.filter(F.col("bucket_start") >= _at(start)) if start else rows
    return rows.filter(F.col("bucket_start") < _at(end)) if end else rows


def missing_ranges(ids: DataFrame, ticks: DataFrame, start: str, end: str, interval: str = "1d", key: str = "coin_id",
                   ts: str = "read_timestamp") -> DataFrame:
    """(key, from_ts, to_ts, n_missing): the maximal runs of intervals in [start, end) without a tick, of every id;
    an id without any tick misses all of it. ``start`` and ``end`` must be bounds of intervals. Islands of stored
    intervals end where the next one does not follow at once; the hole up to the next is the range."""
    step = _step(interval)
    wanted = ids.select(key).filter(F.col(key).isNotNull()).distinct()
    have = covered(ticks, key, ts, interval, start, end).join(wanted, key, "left_semi")
    before = wanted.select(key, (_at(start) - step).alias("bucket_start"))            # a stored interval just before the range
    follows = F.lead("bucket_start", 1, None).over(Window.partitionBy(key).orderBy("bucket_start"))
    holes = have.unionByName(before).select(key, (F.col("bucket_start") + step).alias("from_ts"), F.coalesce(follows, _at(end)).alias("to_ts")).filter("from_ts < to_ts")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    width = micros(F.lit("1970-01-01").cast("timestamp") + step)
    return holes.withColumn("n_missing", F.floor((micros(F.col("to_ts")) - micros(F.col("from_ts"))) / width))


def only_missing(points: DataFrame, ticks: DataFrame, start: str | None, end: str | None, interval: str = "1d", key: str = "coin_id",
                 ts: str = "read_timestamp") -> DataFrame:
    """The points that fall into missing intervals: an anti join on (key, interval), no range join."""
    rows = points.withColumn("_tv_bucket", _bucket(ts, interval))
    rows = rows.filter(F.col("_tv_bucket") >= _at(start)) if start else rows
    rows = rows.filter(F.col("_tv_bucket") < _at(end)) if end else rows
    have = covered(ticks, key, ts, interval, start, end).withColumnRenamed("bucket_start", "_tv_bucket")
    return rows.join(have, [key, "_tv_bucket"], "left_anti").drop("_tv_bucket")


def filled(bars: DataFrame, values: list[str], interval: str, key: str = "coin_id", bucket: str = "bucket_start", until: str | None = None) -> DataFrame:
    """Bars with every interval from a key's first to its last (or up to ``until``): values of intervals without a tick
    are the last ones before them. Each bar is repeated up to the next one, so nothing is carried row by row."""
    step = _step(interval)
    follows = F.lead(bucket).over(Window.partitionBy(key).orderBy(bucket))
    last = F.greatest(_at(until) - step, F.col(bucket)) if until else F.col(bucket)
    rows = bars.select(key, bucket, *values, F.coalesce(follows - step, last).alias("_tv_last"))
    each = F.explode(F.sequence(F.col(bucket), F.col("_tv_last"), step)).alias("_tv_at")
    return rows.select(key, bucket, *values, each).select(key, F.col("_tv_at").alias(bucket), *values, (F.col("_tv_at") != F.col(bucket)).alias("is_filled"))
