"""Price and post streams (ST1-ST8).

Transport is Kafka in production (``sources.kafka``); the same plans run over a folder of JSON
message files, which is how they are tested here. Each micro-batch is decoded, split into
storable rows and quarantine rows, and merged by key with ``sinks.merge.upsert`` inside
``foreachBatch``. The tables keep each row's message position, so the table is the same for any size of
micro-batch and a redelivered message, in whichever batch, changes nothing (ST6); progress is the query
checkpoint (ST4).
"""
from __future__ import annotations

import logging
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from tickvault import schemas
from tickvault.functions import times
from tickvault.operators import flatten
from tickvault.sinks.merge import message_version, upsert
from tickvault.sinks.quarantine import write_quarantine
from tickvault.session import scratch_path

log = logging.getLogger("tickvault.streaming")

MESSAGE = T.StructType([T.StructField("value", T.StringType())])


ORDER = ["_seq", "_sent_at", "_part", "_offset"]     # position of a message, for the last write per key
FILES_PER_TRIGGER = 1000                               # bound of one micro-batch (files, or offsets below)
OFFSETS_PER_TRIGGER = 5_000_000


def encoded(df: DataFrame, key=None, files: int | None = None) -> DataFrame:
    """One JSON message per row; with ``files`` dealt to that many tasks (by key, else by message) once it is
    encoded, so few files do not mean few encoders."""
    from tickvault.sources.kafka import json_value
    msgs = json_value(df, key)
    return msgs if files is None else msgs.repartition(files, "value" if key is None else "key")


def publish(df: DataFrame, target: str | dict, key=None, files: int | None = None) -> None:
    """K7: one JSON message per row, to a Kafka topic (``target`` = Kafka sink options) or
    appended to a message folder (``target`` = path; the file transport used in tests), there as ``files`` files."""
    msgs = encoded(df, key, files)
    if isinstance(target, dict):
        msgs.write.format("kafka").options(**target).save()
    else:
        msgs.select("value").write.mode("append").text(target)


def start_publisher(landed: DataFrame, target: str | dict, checkpoint: str, interval: str | None = None,
                    key=None, epoch_column: str | None = None):
    """ST3: publish a stream of landed documents on a processing-time trigger (3600 s in the source;
    ``interval=None`` publishes what is there and stops). In a folder each micro-batch is its own
    subfolder, replaced when the batch is repeated."""
    def write(batch: DataFrame, epoch: int) -> None:
        if isinstance(target, dict):
            publish(batch, target, key)
        else:
            from tickvault.sources.kafka import json_value
            json_value(batch, key).select("value").write.mode("overwrite").text(f"{target.rstrip('/')}/epoch-{epoch:010d}")
    w = landed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)).start()


def message_stream(spark: SparkSession, source: str | dict, max_per_trigger: int | None = None) -> DataFrame:
    """Messages as a stream of ``value`` strings with their position (``ORDER``): from Kafka
    (``source`` = Kafka source options, see ``sources.kafka.kafka_source_options``) or from a folder
    of JSON message files. A micro-batch is bounded by ``max_per_trigger`` offsets or files."""
    if isinstance(source, dict):
        from tickvault.sources.kafka import read_kafka_stream
        opts = {"maxOffsetsPerTrigger": str(max_per_trigger or OFFSETS_PER_TRIGGER), **source}
        m = read_kafka_stream(spark, opts)
        return m.select("value", F.col("timestamp").alias("_sent_at"), F.col("partition").alias("_part"), F.col("offset").alias("_offset"))
    m = (spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", max_per_trigger or FILES_PER_TRIGGER)
         .option("recursiveFileLookup", "true").text(source))
    return m.select("value", F.col("_metadata.file_modification_time").alias("_sent_at"), F.lit(0).alias("_part"),
                    F.col("_metadata.file_block_start").alias("_offset"))


def _sequence(payload: str) -> Column:
    return F.get_json_object(F.col(payload), "$.event_id").try_cast("long")


def _position(msgs: DataFrame, payload: str) -> list[Column]:
    """The ORDER columns: the message's own sequence number (``event_id``) if it has one, then where
    the transport put it. Missing ones are NULL, which sorts first."""
    have = {c: F.col(c) for c in ORDER if c in msgs.columns}
    return [_sequence(payload).alias("_seq"), *[have.get(c, F.lit(None).cast("timestamp" if c == "_sent_at" else "long")).alias(c) for c in ORDER[1:]]]


def _version(rows: DataFrame) -> Column:
    """The ORDER columns that the rows (still) have, as a stored version."""
    return message_version(*[F.col(c) if c in rows.columns else None for c in ORDER])


def decode_prices(msgs: DataFrame) -> DataFrame:
    """ST1 decode: ticker message -> price row + ``problem`` (NULL when storable) + raw payload + position.

    M2: a message without a USD quote, with an unusable ``last_updated``, with a field of the wrong type
    or not JSON at all is not an error that stops the stream; it gets a ``problem`` and goes to
    quarantine.
    """
    options = {"columnNameOfCorruptRecord": schemas.CORRUPT}
    doc = msgs.select(F.col("value").alias("payload"), F.from_json("value", schemas.PRICE_MESSAGE, options).alias("t"), *_position(msgs, "value"))
    q = strict_quote(F.col("t.quotes"))
    corrupt, empty = F.col(f"t.{schemas.CORRUPT}").isNotNull(), F.coalesce(F.col("t.id"), F.col("t.last_updated")).isNull() & F.col("t.quotes").isNull()
    out = doc.select("payload", (F.col("t").isNull() | empty).alias("_bad"), corrupt.alias("_field"), *ORDER,
                     *flatten.price_rows_from(F.col("t.id"), F.col("t.last_updated"), q["price"],
                                              q["volume_24h"], q["market_cap"]))
    problem = (F.when(F.col("payload").isNull(), F.lit("null message"))
                .when(F.col("_bad"), F.lit("not decodable"))
                .when(F.col("_field"), F.lit("bad field"))
                .otherwise(flatten.price_row_problem()))
    return out.withColumn("problem", problem).drop("_bad", "_field")


def strict_quote(quotes: Column, currency: str = "USD") -> Column:
    """M2: the quote of a currency; NULL sends the message to quarantine."""
    return F.try_element_at(quotes, F.lit(currency))


def _decoded_once(rows: DataFrame) -> DataFrame:
    """Decoded messages, cached: the storable rows and the rest are two reads, and a filter on ``problem`` that reached
    the decoder would parse every message again for each field it looks at. Only the rest keep their payload."""
    return rows.withColumn("payload", F.when(F.col("problem").isNotNull(), F.col("payload"))).persist()


def price_batch_writer(table_path: str, quarantine_path: str, partition_cols=None, query: str = "prices"):
    """foreachBatch body: storable rows -> key merge, the rest -> quarantine (per query and micro-batch)."""
    parts = schemas.PRICE_PARTITION if partition_cols is None else partition_cols

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch = _decoded_once(batch)
        try:
            good = batch.filter(F.col("problem").isNull())
            upsert(good, table_path, schemas.PRICE_KEY, schemas.PRICE_TABLE, parts, version=_version(good))
            bad = batch.filter(F.col("problem").isNotNull()).select(F.col("problem").alias("reason"), "payload")
            write_quarantine(bad, quarantine_path, "prices", f"{query}-{epoch_id:010d}")
        finally:
            batch.unpersist()
    return write


def query_name(kind: str, table_path: str, checkpoint: str) -> str:
    """Stable over restarts of one query (its checkpoint), different for any other."""
    return f"{kind}_{zlib.crc32(table_path.encode()):08x}_{zlib.crc32(checkpoint.encode()):08x}"


def start_price_stream(spark: SparkSession, source: str | dict, table_path: str, quarantine_path: str,
                       checkpoint: str, available_now: bool = True, interval: str | None = None,
                       partition_cols=None, transform=None, max_per_trigger: int | None = None):
    """ST1: start the price ingest query (``availableNow`` or a processing-time trigger).

    ``transform`` is the extension point (a ``DataFrame -> DataFrame`` applied with
    ``df.transform`` to the decoded rows before they are merged).
    """
    rows = decode_prices(message_stream(spark, source, max_per_trigger))
    if transform is not None:
        rows = rows.transform(transform)
    name = query_name("prices", table_path, checkpoint)
    w = (rows.writeStream.foreachBatch(price_batch_writer(table_path, quarantine_path, partition_cols, name))
             .option("checkpointLocation", checkpoint).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "3600 seconds")
    return w.start()


def decode_posts(msgs: DataFrame) -> DataFrame:
    """ST2 decode: array messages -> one row per element with its raw text, position and ``problem``. An
    element with a field of the wrong type is a problem, never a silent NULL."""
    elements = F.from_json("payload", "array<string>")
    dec = msgs.select("payload", elements.alias("m"), *_position(msgs, "payload"))
    one = F.explode(F.when(F.col("m").isNotNull(), F.col("m")).otherwise(F.array(F.col("payload")))).alias("element")
    rows = dec.select(F.col("m").isNull().alias("_junk"), *ORDER, one)
    rows = rows.withColumn("_seq", F.coalesce(_sequence("element"), "_seq"))      # an element's own number, if it has one
    s = F.from_json("element", schemas.POST_MESSAGE, {"columnNameOfCorruptRecord": schemas.CORRUPT})
    rows = rows.select("_junk", *ORDER, F.col("element").alias("payload"), s.alias("s")).select("_junk", *ORDER, "payload", "s.*")
    rows = rows.withColumn("created_utc", times.parse_iso("created_utc"))
    rows = rows.withColumn("created_date", F.to_date("created_utc")).withColumn("created_month", times.month("created_date"))
    problem = (F.when(F.col("_junk"), F.lit("not decodable")).when(F.col(schemas.CORRUPT).isNotNull(), F.lit("bad field"))
                .when(F.col("coin_id").isNull() | F.col("submission_id").isNull(), F.lit("missing key"))
                .when(F.col("created_utc").isNull(), F.lit("missing or bad created_utc")))
    return rows.withColumn("problem", problem).drop("_junk", schemas.CORRUPT)


def post_batch_writer(table_path: str, quarantine_path: str, transform=None, query: str = "posts"):
    """foreachBatch body: decode array messages, explode, optional ``transform``, key merge;
    what cannot be stored -> quarantine, as it came."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        rows = _decoded_once(decode_posts(batch))
        try:
            good = rows.filter(F.col("problem").isNull()).drop("problem", "payload")
            if transform is not None:
                good = good.transform(transform)
            upsert(good, table_path, schemas.POST_KEY, schemas.POST_TABLE, schemas.POST_PARTITION, version=_version(good))
            bad = rows.filter(F.col("problem").isNotNull()).select(F.col("problem").alias("reason"), "payload")
            write_quarantine(bad, quarantine_path, "posts", f"{query}-{epoch_id:010d}")
        finally:
            rows.unpersist()
    return write


def start_post_stream(spark: SparkSession, source: str | dict, table_path: str, quarantine_path: str,
                      checkpoint: str, available_now: bool = True, interval: str | None = None,
                      transform=None, max_per_trigger: int | None = None):
    """ST2: array messages of posts -> key merge on (coin_id, submission_id)."""
    msgs = message_stream(spark, source, max_per_trigger).withColumnRenamed("value", "payload")
    name = query_name("posts", table_path, checkpoint)
    w = (msgs.writeStream.foreachBatch(post_batch_writer(table_path, quarantine_path, transform, name))
             .option("checkpointLocation", checkpoint).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "43200 seconds")
    return w.start()


class ErrorListener(StreamingQueryListener):
    """Logs query failures and progress (the reference's exception logger, for streams)."""

    def onQueryStarted(self, event):
        log.info("stream %s started", event.name)

    def onQueryProgress(self, event):
        p = event.progress
        log.info("stream %s batch %s rows %s", p.name, p.batchId, p.numInputRows)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            log.error("stream %s failed: %s", event.id, event.exception)


# ---- registered stream queries (run over the test tables) --------------------------------

def _price_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticker messages: error events have an empty time, signups no USD quote, clicks a price
    that is no number; a purchase is followed by a correction of half the price (a later event). The events are
    dealt to all tasks, however few files or row groups hold them, and the messages staged, as they are sent twice."""
    from tickvault.plans import tables as tb
    t = tb.price_ticks(spark, sf_dir, tb.table(spark, sf_dir, "events").repartition("event_id", "ts"))
    sent = t.select("id", F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("last_updated")).alias("last_updated"),
                    F.transform_keys("quotes", lambda k, v: F.when(F.col("event_type") == "signup", F.lit("EUR")).otherwise(k)).alias("quotes"),
                    (F.col("event_id") * 2).alias("event_id"))
    later = t.filter("event_type = 'purchase'").select("id", "last_updated", F.transform_values(
        "quotes", lambda k, v: F.struct((v["price"] / 2).alias("price"), v["volume_24h"].alias("volume_24h"), v["market_cap"].alias("market_cap"))).alias("quotes"),
        (F.col("event_id") * 2 + 1).alias("event_id"))
    messages, path = sent.unionByName(later), scratch_path(spark, "messages")
    messages.write.parquet(path)
    return spark.read.schema(messages.schema).parquet(path)


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """ST7: the price and the post stream side by side on one quarantine; every price message is
    delivered twice. Returns the price table, the post table and the quarantine."""
    from tickvault.plans import tables as tb
    from tickvault.operators.search import SORT_TOP
    from tickvault.streaming.messages import array_messages
    topic, posts, table, post_table, quarantine, c1, c2 = (scratch_path(spark, k) for k in (
        "topic", "post-topic", "table", "post-table", "quarantine", "ckpt", "post-ckpt"))
    events = tb.table(spark, sf_dir, "events").filter("event_type = 'click'")
    broken = events.select(F.concat(F.lit('{"event_id": '), (F.col("event_id") * 2).cast("string"), F.lit(', "id": "'), F.col("user_id").cast("string"),
                                    F.lit('", "quotes": {"USD": {"price": "n/a"}}}')).alias("value"))
    messages = _price_messages(spark, sf_dir)
    for _ in range(2):
        publish(messages, topic)
        broken.write.mode("append").text(topic)
    raw = tb.raw_posts(spark, sf_dir, with_labels=True)
    subs = flatten.submission_rows(raw, F.col("subreddit"), SORT_TOP).withColumn("_ord", F.col("submission_id").cast("long"))
    toxic = tb.table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("submission_id"))
    for part in (subs.join(toxic, "submission_id", "left_anti"), subs.join(toxic, "submission_id", "left_semi").withColumn("score", F.lit("n/a"))):
        array_messages(part, ["coin_id"], "_ord", 8, payload_cols=subs.drop("_ord").columns).write.mode("append").text(posts)
    q1 = start_price_stream(spark, topic, table, quarantine, c1)
    q2 = start_post_stream(spark, posts, post_table, quarantine, c2)
    q1.awaitTermination()
    q2.awaitTermination()
    return table, post_table, quarantine


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5 + ST7: what two streams side by side could not store, with the id of the raw message."""
    _, _, quarantine = _streamed(spark, sf_dir)
    rows = spark.read.schema(schemas.QUARANTINE).parquet(quarantine)
    ref = F.coalesce(F.get_json_object("payload", "$.event_id"), F.get_json_object("payload", "$.submission_id"))
    return rows.select("source", "reason", ref.alias("ref"), F.get_json_object("payload", "$.score").alias("score"))


STREAM_QUARANTINE_SQL = """
WITH e AS (SELECT event_type, CAST(event_id * 2 AS VARCHAR) AS ref FROM events),
twice AS (SELECT unnest([1, 2]) AS n)
SELECT 'prices' AS source,
       CASE event_type WHEN 'error' THEN 'missing or bad last_updated' WHEN 'signup' THEN 'missing USD quote' ELSE 'bad field' END AS reason,
       ref, CAST(NULL AS VARCHAR) AS score
FROM e, twice WHERE event_type IN ('error', 'signup', 'click')
UNION ALL
SELECT 'posts', 'bad field', CAST(d.doc_id AS VARCHAR), 'n/a'
FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.toxic = 1"""


def stream_price_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 + ST3 + ST6: events published as ticker messages and streamed with ``availableNow`` into
    the price table. Every message is delivered twice, and a purchase has a later correction to a lower
    price: the table holds the last version of each key, as after one delivery."""
    folder, table, quarantine, ckpt = (scratch_path(spark, k) for k in ("topic", "table", "quarantine", "ckpt"))
    messages = _price_messages(spark, sf_dir)
    publish(messages, folder)
    publish(messages, folder)                       # every message is delivered twice
    q = start_price_stream(spark, folder, table, quarantine, ckpt)
    q.awaitTermination()
    return spark.read.schema(schemas.PRICE_TABLE).parquet(table).select(*schemas.PRICE_TABLE.fieldNames())


STREAM_PRICE_SQL = """
WITH p AS (
  SELECT CAST(user_id AS VARCHAR) AS coin_id, ts AS read_timestamp,
         CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
         CASE WHEN event_type = 'purchase' THEN value / 2 ELSE value END AS price,
         value * CAST(json_extract(props, '$.k') AS BIGINT) AS volume_24h,
         CAST(json_extract(props, '$.k') AS DOUBLE) * 1000.0 AS market_cap, event_id
  FROM events WHERE event_type NOT IN ('error', 'signup'))
SELECT coin_id, read_timestamp, date, hour, price, volume_24h, market_cap FROM (
  SELECT *, row_number() OVER (PARTITION BY coin_id, read_timestamp ORDER BY event_id DESC) AS rn
  FROM p) WHERE rn = 1"""


ORDER_FILES = 6


def stream_price_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6 across micro-batches: one file per trigger; corrections come first, the messages they correct in
    later batches, and in the last ones everything once more. The stored versions decide, so the table is
    the one that ``stream_price_ingest`` gets from a single batch."""
    folder, table, quarantine, ckpt = (scratch_path(spark, k) for k in ("topic", "table", "quarantine", "ckpt"))
    messages = _price_messages(spark, sf_dir)
    for part in (messages.filter("event_id % 2 = 1"), messages.filter("event_id % 2 = 0"), messages):
        publish(part, folder, key="event_id", files=ORDER_FILES // 3)
    start_price_stream(spark, folder, table, quarantine, ckpt, max_per_trigger=1).awaitTermination()
    return spark.read.schema(schemas.PRICE_TABLE).parquet(table).select(*schemas.PRICE_TABLE.fieldNames())


def stream_posts_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: posts published as array messages (<= 8 posts per message, per subreddit), streamed
    into the post table keyed by (coin_id, submission_id)."""
    from tickvault.plans import tables as tb
    from tickvault.streaming.messages import array_messages
    from tickvault.operators.search import SORT_TOP
    raw = tb.raw_posts(spark, sf_dir, with_labels=True)
    subs = flatten.submission_rows(raw, F.col("subreddit"), SORT_TOP)
    msgs = array_messages(subs.withColumn("_ord", F.col("submission_id").cast("long")), ["coin_id"], "_ord", 8,
                          payload_cols=subs.columns)
    folder, table, quarantine, ckpt = (scratch_path(spark, k) for k in ("topic", "table", "quarantine", "ckpt"))
    msgs.write.mode("append").text(folder)
    q = start_post_stream(spark, folder, table, quarantine, ckpt)
    q.awaitTermination()
    return spark.read.schema(schemas.POST_TABLE).parquet(table).select(
        "coin_id", "submission_id", "title", "score", "num_comments", "created_utc", "author", "flair")


STREAM_POSTS_SQL = """
WITH raw_posts AS (
  SELECT d.doc_id AS id, d.source AS subreddit, d.n_chars AS score, d.lang, d.text,
         CASE WHEN l.quality IS NULL THEN NULL WHEN l.quality = 0 THEN '' ELSE split_part(d.text, chr(10), 1) END AS title,
         len(string_split(d.text, chr(10))) - 1 AS num_comments, 1704067200 + d.doc_id * 3600 AS created_utc,
         CASE WHEN d.lang = 'de' THEN NULL ELSE 'user_' || d.source END AS author
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT subreddit AS coin_id, CAST(id AS VARCHAR) AS submission_id, coalesce(nullif(title, ''), '') AS title,
       CAST(score AS INTEGER) AS score, CAST(num_comments AS INTEGER) AS num_comments,
       make_timestamp(CAST(created_utc AS BIGINT) * 1000000) AS created_utc, author,
       coalesce(nullif(lang, ''), '') AS flair
FROM raw_posts"""
