"""Balanced label propagation: documents linked by a shared hub (an equal text, a cluster id, ...)
are drawn into one shard, under exact capacity quotas.

A label is a shard. Links are given as a hub column: two rows with the same hub are neighbours, so
a link list of millions of copies is one hub and not a quadratic number of pairs. Every round

1. each hub counts its rows by shard, and its rows ask for the shard where most of their neighbours
   are (rows without a neighbour stay where they are);
2. each shard seats the rows that ask for it up to its quota: linked rows first, rows without
   neighbours last;
3. the rows left over take the free places of other shards in hub order.

A hub of more rows than a shard holds is dealt in near-equal parts to as few neighbouring shards as
can hold it, and its rows stay there.

Quotas are ``floor(n / shards)`` or one more, so after every round the shards' row counts are at
most one apart (law ``rows``), and a slot is the row's seat: gapless from 0 in each shard. Rounds only
move rows that asked for a move or had to make place. A group is split only if no shard can hold it.

DataFrame functions only; state is staged each round; nothing but one count per shard reaches the
driver. Null hubs link nothing. Empty input gives an empty result. Ids may repeat or be null: each
row gets its own slot.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickvault.llm.common import drop_stages, positions, stage

SHARDS, ROUNDS = 24, 3
#: Rows a bucket of the seating order is meant to hold; larger hubs are salted into several.
BUCKET_ROWS = 2000
_ORDER = ["__class", "__big", "__prefix", "__salt"]


def _buckets(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """Columns that order the rows and cut that order into bounded buckets."""
    prefixes = max(1, n // shards // BUCKET_ROWS)
    big = F.col("hub_rows") > BUCKET_ROWS
    return rows.withColumns({
        "__class": F.when(F.col("hub_rows") > n // shards, 0).when(F.col("hub_rows") > 1, 1).otherwise(2), "__big": big.cast("int"),
        "__prefix": F.when(big, F.col("hub")).otherwise(F.pmod(F.xxhash64("hub", F.when(F.col("hub_rows") <= 1, F.col("row_salt"))), F.lit(prefixes))),
        "__salt": F.when(big, F.pmod(F.col("row_salt"), F.ceil(F.col("hub_rows") / BUCKET_ROWS))).otherwise(0)})


def _seat(rows: DataFrame, n: int, shards: int, spent: list[str]) -> DataFrame:
    """Give each row (column ``want``) a shard and a slot under the quotas."""
    order = [F.col("hub"), F.col("row_salt")]
    ranked = stage(positions(_buckets(rows, n, shards), ["want"], _ORDER, order, "rank"), "shard-rank", spent)
    asked = dict(ranked.groupBy("want").count().collect())                       # one row per shard
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    full = F.element_at(F.array(*[F.lit(q) for q in quota]), F.col("want") + 1)
    seated = ranked.filter(F.col("rank") < full).withColumn("shard", F.col("want")).withColumn("slot", F.col("rank"))
    free = sorted(((quota[s] - min(quota[s], asked.get(s, 0)), s) for s in range(shards)), reverse=True)
    left = (positions(ranked.filter(F.col("rank") >= full).drop("rank").withColumn("__first", -F.col("__big")), [],
                      ["__first", *_ORDER], order, "rank").drop("__first"))
    shard, slot, before = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for places, s in free:
        here = (F.col("rank") >= before) & (F.col("rank") < before + places)
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, F.col("rank") - before + min(quota[s], asked.get(s, 0))).otherwise(slot)
        before += places
    keep = ["id", "size", "text_crc32", "hub", "hub_rows", "row_salt", "shard", "slot"]
    return (seated.select(*keep).unionByName(left.withColumn("shard", shard).withColumn("slot", slot).select(*keep)))


def _ask(rows: DataFrame, quota: int) -> DataFrame:
    """``want``: the shard of most of a row's neighbours (ties: the lowest), else its own."""
    linked = rows.filter((F.col("hub_rows") > 1) & (F.col("hub_rows") <= quota))
    by_shard = linked.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
    most = by_shard.groupBy("hub").agg(F.max_by("shard", F.struct(F.col("n"), -F.col("shard"))).alias("want"))
    return (rows.join(most, "hub", "left").withColumn("want", F.coalesce("want", "shard")).drop("shard", "slot"))


def balanced_shards(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (id, size, text_crc32, hub) with shard and slot."""
    spark, spent = rows.sparkSession, []
    counts = rows.filter("hub IS NOT NULL").groupBy("hub").agg(F.count(F.lit(1)).alias("hub_rows")).filter("hub_rows > 1")
    state = rows.join(counts, "hub", "left").fillna(1, ["hub_rows"]).withColumn("row_salt", F.xxhash64("id", "size", "text_crc32"))
    state = stage(state, "shard-rows", spent)
    n = state.count()
    quota = max(1, n // shards)
    parts = F.ceil(F.col("hub_rows") * 1.02 / quota)          # of a hub larger than a shard
    own = (F.when(F.col("hub_rows") > quota, F.pmod(F.xxhash64("hub"), F.lit(shards)) + F.pmod(F.col("row_salt"), parts))
           .when(F.col("hub_rows") > 1, F.xxhash64("hub")).otherwise(F.col("row_salt")))
    state = state.withColumn("want", F.pmod(own, F.lit(shards)).cast("int"))
    for r in range(rounds):
        old, spent = spent, []
        state = _seat(state if r == 0 else _ask(state, quota), n, shards, spent)
        state = stage(state, "shard-seats", spent)
        drop_stages(spark, old)
    return state


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Each document's shard and slot; documents of equal text are linked (null text: no link)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    rows = docs.select(F.col("doc_id").alias("id"), size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                       F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("hub"))
    return balanced_shards(rows, shards, rounds).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "hub_rows")
