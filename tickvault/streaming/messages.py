"""JSON message shapes (B1, B2, K7, ST2): array messages built from rows and decoded again."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickvault.functions.nested import decode


def array_messages(df: DataFrame, group_cols: list[str], ordinal: str, max_items: int,
                   payload_cols: list[str] | None = None) -> DataFrame:
    """One JSON array message per group and block of ``max_items`` consecutive ordinals.

    The block is ``floor(ordinal / max_items)`` - a projection, no window - so with a unique
    (group, ordinal) no message holds more than ``max_items`` rows however large a group gets.
    """
    cols = [F.col(f"`{c}`") for c in (payload_cols or df.columns)]
    block = F.floor(F.col(ordinal) / F.lit(max_items)).alias("_tv_block")
    g = df.select(*group_cols, block, F.struct(F.col(ordinal).alias("_o"), F.struct(*cols).alias("r")).alias("_e"))
    packed = g.groupBy(*group_cols, "_tv_block").agg(F.sort_array(F.collect_list("_e")).alias("_es"))
    return packed.select(F.to_json(F.transform("_es", lambda e: e["r"])).alias("value"))


def decode_messages(msgs: DataFrame, schema, value: str = "value") -> DataFrame:
    """B1: ``value`` -> ``msg`` (NULL when the text is not JSON of that shape), raw text kept."""
    return msgs.select(F.col(value).alias("payload"), decode(value, schema).alias("msg"))


def explode_messages(msgs: DataFrame, schema, value: str = "value") -> DataFrame:
    """B1: each element of an array message becomes a row (the post stream, which must lose nothing,
    uses ``ingest.decode_posts``)."""
    d = decode_messages(msgs, schema, value)
    return d.filter(F.col("msg").isNotNull()).select(F.explode("msg").alias("e")).select("e.*")
