"""Distinct ids over time from stored sketches (A2).

One HyperLogLog sketch per day is kept in a table; days are united for any range without reading a tick
again. A sketch is a set: merging the same ticks twice changes nothing, so redelivery and replays are
harmless, and late ticks are just united into their day. Sketches are built map-side (one per task and
day is shuffled, 4 KB at ``LG_K`` 12), whatever number of ticks a coin or a day has.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickvault.session import delete_path, path_exists, scratch_path
from tickvault.sinks.merge import overwrite_partitions, touched

LG_K = 12                        # 2^12 registers
# fixed value: relative standard error of such a sketch is about 1.04 / sqrt(2^LG_K); three of them
ERROR_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)
TABLE = T.StructType([T.StructField("date", T.DateType()), T.StructField("sketch", T.BinaryType())])


def daily_sketches(ticks: DataFrame, key: str = "coin_id", ts: str = "read_timestamp") -> DataFrame:
    """(date, sketch) of the distinct non-null keys of each day."""
    rows = ticks.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return rows.groupBy(F.to_date(ts).alias("date")).agg(F.hll_sketch_agg(key, F.lit(LG_K)).alias("sketch"))


def add_ticks(ticks: DataFrame, path: str, key: str = "coin_id", ts: str = "read_timestamp") -> None:
    """Unite a batch's ticks into the table at ``path`` (partitioned by date); other days are not read."""
    spark, stages = ticks.sparkSession, []

    def staged(df: DataFrame) -> DataFrame:
        stages.append(scratch_path(spark, "sketches"))
        df.write.parquet(stages[-1])
        return spark.read.schema(TABLE).parquet(stages[-1])
    try:
        fresh = staged(daily_sketches(ticks, key, ts))
        if path_exists(spark, path):
            stored = touched(spark.read.schema(TABLE).parquet(path), fresh, ["date"]).select("date", "sketch")
            both = stored.unionByName(fresh).groupBy("date").agg(F.hll_union_agg("sketch").alias("sketch"))
            overwrite_partitions(staged(both), path, "date")
        else:
            overwrite_partitions(fresh, path, "date")
    finally:
        for p in stages:
            delete_path(spark, p)


def distinct_trailing(spark: SparkSession, path: str, days: int) -> DataFrame:
    """(date, n_distinct): for every stored date the estimated number of keys in the ``days`` days that end there. Each
    sketch goes to the dates it counts for (at most ``days``); no tick is read."""
    stored = spark.read.schema(TABLE).parquet(path)
    ahead = F.explode(F.sequence(F.col("date"), F.date_add("date", days - 1))).alias("until")
    spread = stored.select(ahead, "sketch").groupBy("until").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
    return spread.join(stored.select(F.col("date").alias("until")), "until").select(F.col("until").alias("date"), "n_distinct")
