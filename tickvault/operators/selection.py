"""Filters, ranking, limits and set operations.

Limits here are the feature itself (a top-k report, a preview); each has a total order ending in
the key, so ties at the cut are broken by id and results are deterministic. ``orderBy().limit()``
plans as TakeOrderedAndProject: a k-row heap per task, k rows per task to the final merge.
"""
from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, functions as F


def rank_range(coins: DataFrame, n: int) -> DataFrame:
    """``rank > 0 AND rank <= n``."""
    return coins.filter((F.col("rank") > 0) & (F.col("rank") <= n))


def new_and_active(coins: DataFrame) -> DataFrame:
    """``is_new AND is_active``."""
    return coins.filter(F.col("is_new") & F.col("is_active"))


def top_k(df: DataFrame, k: int, order: list[str | Column], key: str = "coin_id") -> DataFrame:
    """Sort + head k with the key as the final tie-breaker."""
    return df.orderBy(*order, F.col(key).asc()).limit(k)


def new_active_top(coins: DataFrame, n: int) -> DataFrame:
    """F2 + O1 + H1: the ``n // 2`` best-ranked new and active coins."""
    return top_k(new_and_active(coins), n // 2, [F.col("rank").asc()])


def universe(coins: DataFrame, n: int, distinct: bool = False) -> DataFrame:
    """U1 (duplicates kept) / U2 (once per coin): top-n by rank together with the new-coin top-k."""
    u = rank_range(coins, n).unionByName(new_active_top(coins, n))
    return u.dropDuplicates(["coin_id"]) if distinct else u


def preview(df: DataFrame, k: int = 5, order: list[str | Column] | None = None, key: str = "coin_id") -> DataFrame:
    """First k rows in a stated order (k=1 is ``first()``)."""
    return top_k(df, k, order or [], key)


def monitored(meta: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """monitored coins (F3 with ``is_monitored = true``), optional projection (P5)."""
    df = meta.filter(F.col("is_monitored") == F.lit(True))
    return df.select(*columns) if columns else df


def time_range(df: DataFrame, ts: str, after=None, before=None, within=None, anchor=None) -> DataFrame:
    """``after < ts < before``; or the relative window ``ts >= anchor - within`` (e.g. '7 days').

    Bounds are parameters; a query never reads the wall clock.
    """
    c = F.col(ts)
    if after is not None:
        df = df.filter(c > F.lit(after).cast("timestamp_ntz"))
    if before is not None:
        df = df.filter(c < F.lit(before).cast("timestamp_ntz"))
    if within is not None:
        df = df.filter(c >= F.lit(anchor).cast("timestamp_ntz") - _interval(within))
    return df


_INTERVAL_TEXT = re.compile(r"^\s*(\d+)\s*(day|hour|minute|second)s?\s*$", re.IGNORECASE)


def _interval(within) -> Column:
    """A typed interval literal from a ``timedelta`` or text like '7 days' / '12 hours' / '7d'."""
    if isinstance(within, dt.timedelta):
        return F.lit(within)
    text = str(within).strip()
    short = {"d": "day", "h": "hour", "m": "minute", "s": "second"}
    if text[:-1].isdigit() and text[-1:] in short:
        text = f"{text[:-1]} {short[text[-1]]}"
    m = _INTERVAL_TEXT.match(text)
    if not m:
        raise ValueError(f"not an interval: {within!r}")
    n, unit = int(m.group(1)), m.group(2).lower()
    return F.lit(dt.timedelta(**{unit + "s": n}))


def language(df: DataFrame, lang: str, col: str = "lang") -> DataFrame:
    """F9."""
    return df.filter(F.col(col) == F.lit(lang))


def community(df: DataFrame, subreddit: str = "all", col: str = "subreddit") -> DataFrame:
    """'all' means no filter."""
    return df if subreddit == "all" else df.filter(F.col(col) == F.lit(subreddit))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Set difference (EXCEPT DISTINCT)."""
    return left.subtract(right)
