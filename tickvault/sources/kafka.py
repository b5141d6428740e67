"""Kafka message source and sink options (S10, K7, ST4).

The Kafka connector jar is not part of this build; these builders produce the exact options and
the JSON value columns, and the stream code runs the same plan over file sources in tests.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickvault.functions.nested import encode


def kafka_source_options(bootstrap: str, topic: str, group: str | None = None,
                         starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> dict:
    """S10/ST4: read from the earliest offset; progress lives in the query checkpoint. Lost offsets
    fail the query (Spark's default)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group:
        opts["kafka.group.id"] = group
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_sink_options(bootstrap: str, topic: str) -> dict:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def read_kafka_stream(spark: SparkSession, options: dict) -> DataFrame:
    """Messages as (value STRING, topic, partition, offset, timestamp)."""
    return (spark.readStream.format("kafka").options(**options).load()
            .select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp"))


def json_value(df: DataFrame, key: str | Column | None = None) -> DataFrame:
    """K7: one JSON message per row (``value``), optional message key."""
    cols = [encode(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")]
    if key is not None:
        cols.insert(0, (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"))
    return df.select(*cols)
