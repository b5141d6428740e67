"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickvault.session import delete_path, scratch_path


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also when ``body`` is a lambda that
    reads it for every element (Catalyst would otherwise inline and repeat the expression)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ship(module: str) -> None:
    """Send this module's functions to the executors with each job, so that the package need not be
    installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, dropping: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back: computed once,
    lineage cut, readable by every executor. The folder is appended to ``dropping`` if given, so
    that the caller can delete it once nothing reads it any more."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    if dropping is not None:
        dropping.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession, paths: list[str]) -> None:
    while paths:
        delete_path(spark, paths.pop())


def text_key(text: Column) -> Column:
    """128-bit identity of a text (null: empty): two documents share it if their texts are equal."""
    return F.md5(F.coalesce(text, F.lit("")))


def positions(df: DataFrame, group: list[str], bucket: list[str], order: list[Column], name: str) -> DataFrame:
    """Gapless positions (from 0) of the rows inside each ``group``, ordered by the ``bucket``
    columns, then by ``order`` inside a bucket.

    No task ever holds a whole group: rows are counted per (group, bucket), running totals are
    taken over those counts only, and rows are numbered inside their bucket. A bucket must be
    bounded by its definition (a hash range, or a salted part of a hot key)."""
    keys = group + bucket
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (df.join(offsets, keys)
            .withColumn(name, F.col("__before") + F.row_number().over(inside) - 1)
            .drop("__before"))
