"""Recursive indicators over ticks: exponential averages, MACD, RSI (§2.14).

``e[t] = (1 - a) e[t-1] + a x[t]`` (``e`` starts at the first value) is an affine step, and affine steps compose. So a
coin's ticks are cut into blocks of time, and of at most ``ROWS`` ticks, which are worked on apart:

1. inside a block the average from a start of 0 is a window sum of ``x q^-k``, scaled back by ``q^k`` (q = 1 - a);
2. a block is summed up by two numbers for each average: what it makes of the value before it, ``A e + B``;
3. the value before a block follows from the blocks before it. After ``DECADES`` powers of ten of decay nothing is
   left of older ones, so a bounded frame of block summaries gives it;
4. each tick is its block's own part plus the decayed value before the block.

A coin with a third of all ticks is spread over tasks by block; only block summaries are ordered per coin. ``block``
should be so short that a coin's ticks in it are a small part of a task's memory.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickvault.operators.aggregate import INTERVALS

ROWS, DECADES = 512, 20


def _blocks(df: DataFrame, key: str, ts: str, tie: list[str], block: str, rows: int) -> DataFrame:
    """With _tv_block (time, number of the part of ROWS ticks in it) and _tv_k, the place in the part."""
    start = F.window(F.col(ts), INTERVALS.get(block, block)).start.cast("timestamp_ntz")
    df = df.withColumn("_tv_t", start)
    place = F.row_number().over(Window.partitionBy(key, "_tv_t").orderBy(ts, *tie)) - 1
    return (df.withColumn("_tv_n", place).withColumn("_tv_block", F.struct("_tv_t", F.floor(F.col("_tv_n") / rows).alias("part")))
            .withColumn("_tv_k", F.col("_tv_n") % rows).drop("_tv_t", "_tv_n"))


def ema(df: DataFrame, key: str, ts: str, tie: list[str], columns: dict[str, tuple[str, float]], block: str = "1d") -> DataFrame:
    """``df`` with one exponential average for each of ``columns`` (name -> (value column, a)), in the order of
    (``ts``, ``tie``), which must be total for each key. Values must not be null; 0 < a < 1."""
    decay = {out: math.log10(1 - a) for out, (_, a) in columns.items()}
    rows = int(max(1, min([ROWS] + [250 / -d for d in decay.values()])))            # q^-k stays a double
    reach = math.ceil(DECADES / min(-d for d in decay.values()))
    parts = _blocks(df, key, ts, tie, block, rows)
    inside = Window.partitionBy(key, "_tv_block").orderBy("_tv_k").rowsBetween(Window.unboundedPreceding, 0)
    k = F.col("_tv_k").cast("double")
    for out, (x, a) in columns.items():
        q = F.lit(1 - a)
        parts = parts.withColumn(out, a * F.pow(q, k) * F.sum(F.col(x) * F.pow(q, -k)).over(inside))
    # a block: its number of ticks, and for each average its own part at the end and its first value
    ends = [F.struct(F.max_by(out, "_tv_k").alias("own"), F.min_by(x, "_tv_k").alias("first")).alias(out) for out, (x, _) in columns.items()]
    blocks = parts.groupBy(key, "_tv_block").agg(F.count(F.lit(1)).cast("double").alias("n"), *ends)
    order = Window.partitionBy(key).orderBy("_tv_block")
    number, earlier = F.row_number().over(order), F.collect_list(F.struct("_tv_i", "n", *columns)).over(order.rowsBetween(-reach, -1))
    blocks = blocks.withColumn("_tv_i", number).withColumn("_tv_before", earlier)

    def before(out: str, a: float) -> Column:
        step = lambda e, s: F.when(s["_tv_i"] == 1, s[out]["first"]).otherwise(e) * F.pow(F.lit(1 - a), s["n"]) + s[out]["own"]
        return F.when(F.col("_tv_i") == 1, F.col(f"{out}.first")).otherwise(F.aggregate("_tv_before", F.lit(0.0), step)).alias(f"_tv_{out}")
    carried = blocks.select(key, "_tv_block", *[before(out, a) for out, (_, a) in columns.items()])
    done = parts.join(carried, [key, "_tv_block"])
    return done.select(*df.columns, *[(F.col(out) + F.pow(F.lit(1 - a), k + 1) * F.col(f"_tv_{out}")).alias(out) for out, (_, a) in columns.items()])


def changes(df: DataFrame, key: str, ts: str, tie: list[str], value: str, out: str, block: str = "1d") -> DataFrame:
    """``df`` with the change from the tick before (0 for a key's first), across blocks: a block's first tick takes the
    last value of the block before."""
    parts = _blocks(df, key, ts, tie, block, ROWS)
    last = parts.groupBy(key, "_tv_block").agg(F.max_by(value, "_tv_k").alias("_tv_last"))
    last = last.select(key, "_tv_block", F.lag("_tv_last").over(Window.partitionBy(key).orderBy("_tv_block")).alias("_tv_last"))
    inside = F.lag(value).over(Window.partitionBy(key, "_tv_block").orderBy("_tv_k"))
    return (parts.withColumn("_tv_prev", inside).join(last, [key, "_tv_block"])
            .select(*df.columns, F.coalesce(F.col(value) - F.coalesce("_tv_prev", "_tv_last"), F.lit(0.0)).alias(out)))


def trend(ticks: DataFrame, key: str = "coin_id", ts: str = "read_timestamp", tie: list[str] | None = None, price: str = "price",
          fast: int = 12, slow: int = 26, signal: int = 9, span: int = 14, block: str = "1d") -> DataFrame:
    """``ticks`` with ema_fast, ema_slow, macd, macd_signal and rsi: averages over n ticks (a = 2 / (n + 1)); RSI by
    Wilder's smoothing (a = 1 / n) of gains and losses, NULL where there was no change yet."""
    tie, over = list(tie or []), lambda n: 2.0 / (n + 1)
    rows = changes(ticks.filter(F.col(price).isNotNull() & F.col(ts).isNotNull()), key, ts, tie, price, "_tv_change", block)
    rows = rows.withColumn("_tv_gain", F.greatest("_tv_change", F.lit(0.0))).withColumn("_tv_loss", F.greatest(-F.col("_tv_change"), F.lit(0.0)))
    rows = ema(rows, key, ts, tie, {"ema_fast": (price, over(fast)), "ema_slow": (price, over(slow)),
                                    "_tv_up": ("_tv_gain", 1.0 / span), "_tv_down": ("_tv_loss", 1.0 / span)}, block)
    rows = ema(rows.withColumn("macd", F.col("ema_fast") - F.col("ema_slow")), key, ts, tie, {"macd_signal": ("macd", over(signal))}, block)
    rsi = F.try_divide(100 * F.col("_tv_up"), F.col("_tv_up") + F.col("_tv_down"))
    return rows.select(*ticks.columns, "ema_fast", "ema_slow", "macd", "macd_signal", rsi.alias("rsi"))
