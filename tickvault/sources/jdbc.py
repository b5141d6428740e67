"""JDBC source and sink.

Equality clauses become Column filters that Spark pushes into the remote WHERE clause
(``PushedFilters``); values are never spliced into SQL text.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.sources.files import apply_filters


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra) -> dict[str, str]:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_jdbc(spark: SparkSession, options: dict[str, str], columns: list[str] | None = None,
              clauses: dict | None = None, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """S9 + F4: projection and typed equality conjunction over a JDBC table.

    For large tables give a numeric ``partition_column`` with bounds so the read is split into
    ``num_partitions`` parallel range queries instead of one task.
    """
    reader = spark.read.format("jdbc").options(**options)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    df = apply_filters(reader.load(), clauses)
    return df.select(*columns) if columns else df


def id_exists(df: DataFrame, id_col: str, id_val) -> DataFrame:
    """F8: how many rows carry ``id_val`` (one-row frame ``n``)."""
    return df.filter(F.col(id_col) == F.lit(id_val)).agg(F.count(F.lit(1)).alias("n"))


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append", batch_size: int = 10000) -> None:
    """K4: append rows; each partition writes in its own connection and batches."""
    df.write.format("jdbc").options(**options).option("batchsize", batch_size).mode(mode).save()
