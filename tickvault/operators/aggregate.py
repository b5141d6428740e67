"""Counts, distinct ids, resampling and bars (A1-A4, §2.14)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# API interval spellings -> Spark window durations.
INTERVALS = {"5m": "5 minutes", "10m": "10 minutes", "15m": "15 minutes", "30m": "30 minutes",
             "45m": "45 minutes", "1h": "1 hour", "2h": "2 hours", "3h": "3 hours", "6h": "6 hours",
             "12h": "12 hours", "24h": "1 day", "1d": "1 day", "7d": "7 days", "14d": "14 days",
             "30d": "30 days", "90d": "90 days", "365d": "365 days"}


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """A1/A3: one-row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_ids(df: DataFrame, key: str = "coin_id") -> DataFrame:
    """A2."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def _bucket(ts: str, interval: str) -> Column:
    return F.window(F.col(ts), INTERVALS.get(interval, interval)).start.cast("timestamp_ntz")


def resample_last(df: DataFrame, key: str, ts: str, values: list[str], interval: str = "1d",
                  tiebreak: list[str] | None = None) -> DataFrame:
    """A4: the last observation per key and interval bucket (what the API's ``interval`` returns).

    ``max_by`` over (ts, tiebreak) is decomposable: each map task keeps one row per
    (key, bucket) before the shuffle, so a hot coin costs one row per task, not its history.
    """
    order = F.struct(F.col(ts), *[F.col(c) for c in (tiebreak or [])])
    aggs = [F.max_by(F.col(v), order).alias(v) for v in values]
    return (df.groupBy(F.col(key), _bucket(ts, interval).alias("bucket_start"))
              .agg(F.max(F.col(ts)).alias(ts), *aggs))


def ohlc(df: DataFrame, key: str, ts: str, price: str, interval: str = "1d",
         tiebreak: list[str] | None = None) -> DataFrame:
    """Open/high/low/close bars per key and bucket (§2.14 "aggregates data"); decomposable."""
    order = F.struct(F.col(ts), *[F.col(c) for c in (tiebreak or [])])
    return (df.groupBy(F.col(key), _bucket(ts, interval).alias("bucket_start"))
              .agg(F.min_by(F.col(price), order).alias("open"), F.max(price).alias("high"),
                   F.min(price).alias("low"), F.max_by(F.col(price), order).alias("close"),
                   F.count(F.lit(1)).alias("n_ticks")))


def indicators(bars: DataFrame, key: str, ts: str, close: str = "close", span: int = 7) -> DataFrame:
    """Rolling features over bars (§2.14): previous close, return, moving average and stddev.

    A window per coin over its bars; bars are already one row per coin and interval, so a
    partition holds one coin's bar history (days, not ticks).
    """
    w = Window.partitionBy(key).orderBy(ts)
    roll = w.rowsBetween(-(span - 1), 0)
    prev = F.lag(close).over(w)
    return bars.select("*", prev.alias("prev_close"),
                       F.try_divide(F.col(close) - prev, prev).alias("ret"),
                       F.avg(close).over(roll).alias(f"ma_{span}"),
                       F.stddev_samp(close).over(roll).alias(f"sd_{span}"))
