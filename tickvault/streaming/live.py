"""Streams that keep state: repeated messages, live bars with late data, posts paired with prices.

* ``suppress_repeats``: a message that is delivered again within a horizon is dropped. Its state is bounded by
  the horizon (``dropDuplicatesWithinWatermark`` over the time of arrival, so nothing new is ever too late).
* ``start_bar_stream``: OHLC bars in event time, each written once, when the watermark has passed its end;
  rows that come after that go to a side table. The rule is exact and the same in every replay: in a
  micro-batch a row is late if the end of its interval is no later than ``delay`` before the greatest event
  time of all earlier batches.
* ``start_pair_stream``: each post with the prices of its coin in the time after it, an interval join of two
  streams. State on both sides is bounded by the watermarks; a post without a price comes out once the
  watermark has passed its interval.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickvault import schemas
from tickvault.operators import flatten
from tickvault.operators.aggregate import INTERVALS
from tickvault.session import delete_path, path_exists, scratch_path
from tickvault.streaming import ingest

BAR_KEY = ["coin_id", "bucket_start"]
STATE_PARTITIONS = 8           # of the registered queries; a stream's number is fixed by its first run


@contextmanager
def state_partitions(spark: SparkSession, n: int | None) -> Iterator[None]:
    """Streams started inside keep their state in ``n`` partitions (a stream takes the setting when it starts
    and its checkpoint keeps it); None: the session's number."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if n:
        spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# ---- repeated messages ---------------------------------------------------------------------

def suppress_repeats(msgs: DataFrame, horizon: str, value: str = "value") -> DataFrame:
    """ST6: each distinct message once within ``horizon`` of its last new delivery, by the 128-bit digest of
    its text. Keyed state is spread by digest, so a message repeated any number of times is one entry."""
    seen = msgs.withColumn("_arrived", F.current_timestamp()).withColumn("_digest", F.unhex(F.md5(F.col(value))))
    return seen.withWatermark("_arrived", horizon).dropDuplicatesWithinWatermark(["_digest"]).drop("_arrived", "_digest")


def start_message_archive(spark: SparkSession, source: str | dict, path: str, checkpoint: str, horizon: str, max_per_trigger: int | None = None):
    """Every message of a topic once, as it came, appended to a table."""
    msgs = suppress_repeats(ingest.message_stream(spark, source, max_per_trigger), horizon)
    return msgs.select("value").writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


# ---- live bars -----------------------------------------------------------------------------

def _bucket(ts: Column, interval: str) -> Column:
    return F.window(ts, interval).start.cast("timestamp_ntz")


def partial_bars(rows: DataFrame, interval: str) -> DataFrame:
    """Mergeable bars of price rows: first and last tick with their place in time, extremes, count. One row per
    map task and bar is shuffled, so a hot coin costs a row per task."""
    at = F.struct("read_timestamp", F.col("_seq").alias("seq"))
    return (rows.groupBy("coin_id", _bucket(F.col("read_timestamp"), interval).alias("bucket_start"))
            .agg(F.min(F.struct(at.alias("at"), "price")).alias("first"), F.max(F.struct(at.alias("at"), "price")).alias("last"),
                 F.max("price").alias("high"), F.min("price").alias("low"), F.count(F.lit(1)).alias("n_ticks")))


def merge_bars(bars: DataFrame) -> DataFrame:
    """One partial bar per key."""
    return bars.groupBy(*BAR_KEY).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"),
                                      F.min("low").alias("low"), F.sum("n_ticks").alias("n_ticks"))


def finished(bars: DataFrame) -> DataFrame:
    return bars.select(*BAR_KEY, F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"), "n_ticks")


def bar_batch_writer(bars_path: str, late_path: str, state_path: str, interval: str, delay: str):
    """foreachBatch body. Before batch n the open bars and the watermark are in ``state_path``/n; the batch writes
    its closed bars, its late rows and the next state each into a folder of its number, so a repeated batch
    replaces its own output. The last two states are kept."""
    interval = INTERVALS.get(interval, interval)
    end = F.col("bucket_start") + F.expr(f"INTERVAL {interval}")

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        here, there = f"{state_path}/{epoch}", f"{state_path}/{epoch + 1}"
        rows = batch.filter(F.col("problem").isNull()).select("coin_id", "read_timestamp", "price", "_seq")
        batch_path = f"{state_path}/batch-{epoch}"
        rows.withColumn("bucket_start", _bucket(F.col("read_timestamp"), interval)).write.mode("overwrite").parquet(batch_path)
        rows = spark.read.parquet(batch_path)                            # read three times, computed once
        known = path_exists(spark, f"{here}/mark")
        mark = spark.read.parquet(f"{here}/mark").first()[0] if known else None       # one value
        newest = rows.agg(F.max("read_timestamp") - F.expr(f"INTERVAL {delay}")).first()[0]
        after = max((m for m in (mark, newest) if m is not None), default=None)
        late = end <= F.lit(mark).cast("timestamp_ntz") if mark is not None else F.lit(False)
        closed = end <= F.lit(after).cast("timestamp_ntz") if after is not None else F.lit(False)
        parts = partial_bars(rows.filter(~late), interval)
        merged = merge_bars(parts.unionByName(spark.read.parquet(f"{here}/open"))) if known else parts
        merged.withColumn("closed", closed).write.mode("overwrite").parquet(f"{state_path}/merged-{epoch}")
        merged = spark.read.parquet(f"{state_path}/merged-{epoch}")
        finished(merged.filter("closed")).write.mode("overwrite").parquet(f"{bars_path}/batch={epoch}")
        rows.filter(late).write.mode("overwrite").parquet(f"{late_path}/batch={epoch}")
        merged.filter("NOT closed").drop("closed").write.mode("overwrite").parquet(f"{there}/open")
        spark.createDataFrame([(after,)], "mark timestamp_ntz").write.mode("overwrite").parquet(f"{there}/mark")
        for old in (f"{state_path}/{epoch - 1}", f"{state_path}/merged-{epoch}", batch_path):
            delete_path(spark, old)
    return write


def start_bar_stream(spark: SparkSession, source: str | dict, bars_path: str, late_path: str, checkpoint: str, interval: str = "1h",
                     delay: str = "1 hour", available_now: bool = True, trigger: str | None = None, max_per_trigger: int | None = None):
    """Price messages -> bars, appended as the watermark passes them; late rows -> ``late_path``."""
    rows = ingest.decode_prices(ingest.message_stream(spark, source, max_per_trigger))
    write = bar_batch_writer(bars_path, late_path, f"{checkpoint.rstrip('/')}-bars", interval, delay)
    w = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger or "60 seconds")).start()


# ---- posts with the prices after them --------------------------------------------------------

def pair_posts_with_prices(posts: DataFrame, prices: DataFrame, within: str, post_delay: str, price_delay: str) -> DataFrame:
    """ST7: posts left outer join prices of the same coin in [created, created + within)."""
    p = (posts.select(F.col("coin_id").alias("_coin"), "submission_id", F.col("created_utc").cast("timestamp").alias("_created"))
         .withWatermark("_created", post_delay))
    t = prices.select("coin_id", F.col("read_timestamp").cast("timestamp").alias("_read"), "price").withWatermark("_read", price_delay)
    on = (F.col("_coin") == F.col("coin_id")) & (F.col("_read") >= F.col("_created")) & (F.col("_read") < F.col("_created") + F.expr(f"INTERVAL {within}"))
    return p.join(t, on, "left_outer").select(F.col("_coin").alias("coin_id"), "submission_id", F.col("_created").cast("timestamp_ntz").alias("created_utc"),
                                              F.col("_read").cast("timestamp_ntz").alias("read_timestamp"), "price")


def start_pair_stream(spark: SparkSession, price_source: str | dict, post_source: str | dict, path: str, checkpoint: str,
                      within: str = "1 hour", post_delay: str = "1 hour", price_delay: str = "1 hour", max_per_trigger: int | None = None):
    """The price and the post topic joined into an appended table."""
    prices = ingest.decode_prices(ingest.message_stream(spark, price_source, max_per_trigger)).filter("problem IS NULL")
    msgs = ingest.message_stream(spark, post_source, max_per_trigger).withColumnRenamed("value", "payload")
    posts = ingest.decode_posts(msgs).filter("problem IS NULL")
    pairs = pair_posts_with_prices(posts, prices, within, post_delay, price_delay)
    return pairs.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


# ---- registered stream queries (run over the test tables) --------------------------------

DELIVERIES, HORIZON = 3, "7 days"


def stream_distinct_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6 in the stream: every event message is delivered three times, in batches of one file; the archive
    holds each once."""
    from tickvault.plans import tables as tb
    topic, table, ckpt = (scratch_path(spark, k) for k in ("topic", "archive", "ckpt"))
    for _ in range(DELIVERIES):
        ingest.publish(tb.table(spark, sf_dir, "events").select("event_id", "user_id", "value").coalesce(1), topic)
    with state_partitions(spark, STATE_PARTITIONS):
        q = start_message_archive(spark, topic, table, ckpt, HORIZON, max_per_trigger=1)
    q.awaitTermination()
    sent = F.from_json("value", "event_id bigint, user_id bigint, value double")
    return spark.read.schema("value string").parquet(table).select(sent.alias("m")).select("m.*")


STREAM_DISTINCT_SQL = "SELECT event_id, user_id, value FROM events"

BAR_INTERVAL, BAR_DELAY, SLICE_DAYS = "6 hours", "1 day", 5


def stream_live_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.14 live windows with late data: event messages in slices of five days, every tenth one a slice too
    late. Closed bars with the number of late rows of their interval (from the side table)."""
    from tickvault.plans import tables as tb
    topic, bars, late, ckpt = (scratch_path(spark, k) for k in ("topic", "bars", "late", "ckpt"))
    t = tb.price_ticks(spark, sf_dir)
    slice_ = F.floor((F.dayofmonth("ts") - 1) / SLICE_DAYS) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    keyed = t.join(tb.table(spark, sf_dir, "events").select("event_id", slice_.alias("slice")), "event_id")
    sent = scratch_path(spark, "sent")
    keyed.select("slice", "id", "last_updated", "quotes", "event_id").repartition("slice").write.partitionBy("slice").parquet(sent)
    slices = spark.read.parquet(sent)
    for n in sorted(r[0] for r in slices.select("slice").distinct().collect()):           # at most 8
        ingest.publish(slices.filter(F.col("slice") == n).drop("slice").coalesce(1), topic)
    start_bar_stream(spark, topic, bars, late, ckpt, BAR_INTERVAL, BAR_DELAY, max_per_trigger=1).awaitTermination()
    made = spark.read.parquet(bars).drop("batch")
    missed = spark.read.parquet(late).groupBy(*BAR_KEY).agg(F.count(F.lit(1)).alias("n_late"))
    return made.join(missed, BAR_KEY, "full_outer").withColumn("n_late", F.coalesce("n_late", F.lit(0)))


STREAM_BARS_SQL = f"""
WITH e AS (
  SELECT CAST(user_id AS VARCHAR) AS coin_id, ts, value AS price, event_id,
         time_bucket(INTERVAL {BAR_INTERVAL}, ts, TIMESTAMP '1970-01-01') AS bucket_start,
         (day(ts) - 1) // {SLICE_DAYS} + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS batch
  FROM events),
tops AS (SELECT batch, max(ts) AS top FROM e GROUP BY batch),
marks AS (SELECT a.batch, max(b.top) - INTERVAL {BAR_DELAY} AS mark FROM tops a LEFT JOIN tops b ON b.batch < a.batch GROUP BY a.batch),
flagged AS (SELECT e.*, coalesce(bucket_start + INTERVAL {BAR_INTERVAL} <= mark, FALSE) AS late FROM e JOIN marks USING (batch)),
bars AS (SELECT coin_id, bucket_start, arg_min(price, struct_pack(ts := ts, e := event_id)) AS open, max(price) AS high, min(price) AS low,
                arg_max(price, struct_pack(ts := ts, e := event_id)) AS close, count(*) AS n_ticks
         FROM flagged WHERE NOT late AND bucket_start + INTERVAL {BAR_INTERVAL} <= (SELECT max(top) - INTERVAL {BAR_DELAY} FROM tops)
         GROUP BY coin_id, bucket_start),
missed AS (SELECT coin_id, bucket_start, count(*) AS n_late FROM flagged WHERE late GROUP BY coin_id, bucket_start)
SELECT coin_id, bucket_start, open, high, low, close, n_ticks, coalesce(n_late, 0) AS n_late
FROM bars FULL OUTER JOIN missed USING (coin_id, bucket_start)"""

PAIR_SLICES, PAIR_COINS, PAIR_WITHIN, FAR_AHEAD = 3, 150, "1 hour", "2100-01-01T00:00:00Z"


def stream_post_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST7 as a join: every post (its coin is the document's number modulo 150) with the prices of the hour after
    it, or alone. Both topics come in three slices of time; a last message far ahead on each moves the
    watermarks past everything."""
    from tickvault.operators.search import SORT_TOP
    from tickvault.plans import tables as tb
    from tickvault.streaming.messages import array_messages
    topic, posts, table, ckpt, sent = (scratch_path(spark, k) for k in ("topic", "post-topic", "pairs", "ckpt", "sent"))
    coin = (F.col("id") % PAIR_COINS).cast("string")
    subs = flatten.submission_rows(tb.raw_posts(spark, sf_dir), coin, SORT_TOP).withColumn("selftext", F.lit("")).withColumn("title", F.lit(""))
    ticks = tb.price_ticks(spark, sf_dir).select("id", "last_updated", "quotes", "event_id")
    for kind, df, ts in (("posts", subs, "created_utc"), ("prices", ticks, "last_updated")):
        stored = df.repartitionByRange(PAIR_SLICES, ts)
        stored.withColumn("slice", F.spark_partition_id()).write.partitionBy("slice").parquet(f"{sent}/{kind}")
    # one array message for each post block, one file for each slice and topic
    for n in range(PAIR_SLICES):
        own = spark.read.parquet(f"{sent}/posts").filter(F.col("slice") == n).drop("slice").withColumn("_ord", F.col("submission_id").cast("long"))
        array_messages(own, ["coin_id"], "_ord", 1200, payload_cols=subs.columns).coalesce(1).write.mode("append").text(posts)
        ingest.publish(spark.read.parquet(f"{sent}/prices").filter(F.col("slice") == n).drop("slice").coalesce(1), topic)
    quote = F.create_map(F.lit("USD"), F.struct(F.lit(1.0).alias("price"), F.lit(1.0).alias("volume_24h"), F.lit(1.0).alias("market_cap")))
    last = spark.range(1).select(F.lit("~").alias("id"), F.lit(FAR_AHEAD).alias("last_updated"), quote.alias("quotes"))
    ingest.publish(last.coalesce(1), topic)
    end = spark.range(1).select(F.lit("~").alias("coin_id"), F.lit("~").alias("submission_id"), F.lit(FAR_AHEAD).alias("created_utc"), F.lit(0).alias("_ord"))
    array_messages(end, ["coin_id"], "_ord", 8, payload_cols=["coin_id", "submission_id", "created_utc"]).coalesce(1).write.mode("append").text(posts)
    with state_partitions(spark, STATE_PARTITIONS):
        q = start_pair_stream(spark, topic, posts, table, ckpt, PAIR_WITHIN, max_per_trigger=1)
    q.awaitTermination()
    return spark.read.parquet(table).filter("submission_id <> '~'")


STREAM_PAIRS_SQL = f"""
WITH posts AS (SELECT CAST(doc_id AS VARCHAR) AS submission_id, CAST(doc_id % {PAIR_COINS} AS VARCHAR) AS coin_id,
                      make_timestamp((1704067200 + doc_id * 3600) * 1000000) AS created_utc FROM documents),
ticks AS (SELECT CAST(user_id AS VARCHAR) AS coin_id, ts AS read_timestamp, value AS price FROM events)
SELECT p.coin_id, p.submission_id, p.created_utc, t.read_timestamp, t.price
FROM posts p LEFT JOIN ticks t ON p.coin_id = t.coin_id AND t.read_timestamp >= p.created_utc
                              AND t.read_timestamp < p.created_utc + INTERVAL {PAIR_WITHIN}"""
