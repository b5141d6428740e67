"""Test tables -> the engine's domain frames (survey §7.3 mapping).

part -> coin list; customer -> metadata documents; orders -> tickers and price history;
events -> price ticks (props ``{"k": int}`` is the quote document); documents (+ labels) ->
posts; conversations -> tweets and array messages. Every adapter is a projection (plus, for
tickers, one decomposable aggregate), so its cost grows with the table, nothing else.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickvault.functions import times

# Anchors of the derived time columns.
POST_EPOCH_START = 1704067200          # 2024-01-01T00:00:00Z, first post; one post per hour of doc_id
META_START = "2010-01-01 00:00:00"     # started_at = META_START + c_custkey hours


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso_z(ts: Column) -> Column:
    return times.to_text(ts, times.ISO_Z)


# ---- coins ------------------------------------------------------------------------------

def coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 coin list: id, name, symbol, rank, is_new, is_active, type."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("coin_id"),
        F.col("p_name").alias("name"),
        F.upper(F.regexp_extract("p_name", r"([^ ]+)$", 1)).alias("symbol"),
        F.col("p_size").alias("rank"),
        (F.col("p_type") == "PROMO").alias("is_new"),
        (F.col("p_retailprice") >= 950.0).alias("is_active"),
        F.lower("p_type").alias("type"),
    )


# ---- metadata and ticker documents --------------------------------------------------------

def meta_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 metadata documents (subset of META with the fields the row builder reads)."""
    c = table(spark, sf_dir, "customer")
    started = F.timestamp_add("HOUR", F.col("c_custkey"), F.lit(META_START).cast("timestamp_ntz"))
    return c.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("symbol"),
        F.col("c_nationkey").alias("rank"),
        (F.col("c_acctbal") < 0).alias("is_new"),
        (F.col("c_mktsegment") != "AUTOMOBILE").alias("is_active"),
        F.when(F.col("c_nationkey") < 12, "coin").otherwise("token").alias("type"),
        F.when(F.col("c_acctbal") > 5000, F.lit(None))
         .otherwise(F.concat_ws(" / ", "c_name", "c_mktsegment")).alias("description"),
        F.when(F.col("c_nationkey") == 0, F.lit(None)).otherwise(iso_z(started)).alias("started_at"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit(None)).otherwise(F.lit("Working product"))
         .alias("development_status"),
        (F.col("c_acctbal") > 8000).alias("hardware_wallet"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Proof of Work")
         .when(F.col("c_mktsegment") == "MACHINERY", "Proof of Stake").alias("proof_type"),
        F.lit("Decentralized").alias("org_structure"),
        F.when(F.col("c_nationkey") % 2 == 0, "SHA256").alias("hash_algorithm"),
    )


def ticker_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 ticker documents: one per customer from its orders (the latest order is the quote).

    A decomposable aggregate (max_by / min / max / count) - no order list is ever collected.
    """
    o = table(spark, sf_dir, "orders")
    order = F.struct("o_orderdate", "o_orderkey")
    g = o.groupBy("o_custkey").agg(
        F.max_by("o_totalprice", order).alias("price"),
        F.max_by("o_orderstatus", order).alias("status"),
        F.max_by("o_orderpriority", order).alias("priority"),
        F.max("o_orderdate").alias("last"),
        F.min("o_orderdate").alias("first"),
        F.max("o_totalprice").alias("vol"),
        F.count(F.lit(1)).alias("n"),
    )
    quote = F.struct(F.col("price").alias("price"), F.col("vol").alias("volume_24h"),
                     (F.col("price") * F.col("n")).alias("market_cap"))
    return g.select(
        F.col("o_custkey").cast("string").alias("id"),
        F.when(F.col("priority") == "5-LOW", F.lit(None)).otherwise(F.substring("priority", 3, 100)).alias("symbol"),
        F.col("n").cast("int").alias("rank"),
        (F.col("n") * 1000).cast("bigint").alias("total_supply"),
        F.when(F.col("n") > 10, F.lit(0)).otherwise(F.col("n") * 2000).cast("bigint").alias("max_supply"),
        iso_z(F.col("first")).alias("first_data_at"),
        F.when(F.col("status") == "P", F.lit("")).otherwise(iso_z(F.col("last"))).alias("last_updated"),
        F.create_map(F.lit("USD"), quote).alias("quotes"),
    )


def price_ticks(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events (``events``, else the table) as ticker messages: coin = user_id, quote from value and the props document."""
    e = table(spark, sf_dir, "events") if events is None else events
    k = F.from_json("props", "k BIGINT").k
    quote = F.struct(F.col("value").alias("price"), (F.col("value") * k).alias("volume_24h"),
                     (k * F.lit(1000.0)).alias("market_cap"))
    return e.select(
        F.col("user_id").cast("string").alias("id"),
        times.to_text(F.col("ts"), times.ISO_MICROS_Z).alias("last_updated"),
        F.create_map(F.lit("USD"), quote).alias("quotes"),
        "event_id", "event_type", "props",
    )


def history_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 history documents: each order is a two-point series (order time, +12 hours);
    the second point of a finished order has an empty timestamp (a bad point)."""
    o = table(spark, sf_dir, "orders")
    later = F.timestamp_add("HOUR", F.lit(12), F.col("o_orderdate"))
    p1 = F.struct(iso_z(F.col("o_orderdate")).alias("timestamp"), F.col("o_totalprice").alias("price"),
                  F.col("o_totalprice").alias("volume_24h"), (F.col("o_totalprice") * 10).alias("market_cap"))
    p2 = F.struct(F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(iso_z(later)).alias("timestamp"),
                  (F.col("o_totalprice") * 1.01).alias("price"), F.col("o_totalprice").alias("volume_24h"),
                  (F.col("o_totalprice") * 10).alias("market_cap"))
    return o.select(F.col("o_custkey").cast("string").alias("coin_id"), F.array(p1, p2).alias("points"))


# ---- posts ------------------------------------------------------------------------------

def raw_posts(spark: SparkSession, sf_dir: str, with_labels: bool = True) -> DataFrame:
    """Raw post records (the API objects before P4) from documents, optionally left-joined with
    labels to manufacture missing ('' and NULL) titles and bodies."""
    d = table(spark, sf_dir, "documents")
    first_line = F.substring_index("text", "\n", 1)
    if with_labels:
        lab = table(spark, sf_dir, "labels")
        d = d.join(lab, "doc_id", "left")
        title = (F.when(F.col("quality").isNull(), F.lit(None)).when(F.col("quality") == 0, F.lit(""))
                  .otherwise(first_line))
        body = F.when(F.col("toxic") == 1, F.lit("")).otherwise(F.col("text"))
    else:
        title, body = first_line, F.col("text")
    return d.select(
        F.col("doc_id").alias("id"),
        title.alias("title"),
        F.col("n_chars").alias("score"),
        F.concat(F.lit("https://www.reddit.com/r/"), F.col("source"), F.lit("/comments/"),
                 F.col("doc_id").cast("string")).alias("url"),
        (F.size(F.split("text", "\n")) - 1).alias("num_comments"),
        (F.lit(POST_EPOCH_START) + F.col("doc_id") * 3600).alias("created_utc"),
        body.alias("selftext"),
        F.col("source").alias("subreddit"),
        F.when(F.col("lang") == "de", F.lit(None)).otherwise(F.concat(F.lit("user_"), F.col("source"))).alias("author"),
        F.col("lang").alias("link_flair_text"),
        F.col("lang"),
        F.col("text"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored-post shape used by search: submission_id, title, score, created_utc (TIMESTAMP_NTZ),
    subreddit, lang, text."""
    r = raw_posts(spark, sf_dir, with_labels=False)
    return r.select(F.col("id").cast("string").alias("submission_id"), "title", "score",
                    times.epoch_to_ts("created_utc").alias("created_utc"), "subreddit", "lang", "text")


def raw_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tweet objects from conversations (one tweet per turn)."""
    c = table(spark, sf_dir, "conversations")
    created = F.timestamp_add("MINUTE", F.col("turn"),
                             F.timestamp_add("HOUR", F.col("conv_id"), F.lit(META_START).cast("timestamp_ntz")))
    words = F.split("text", " ")
    return c.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id_str"),
        created.alias("created_at"),
        F.col("text").alias("full_text"),
        F.struct(F.col("role").alias("screen_name"), F.col("conv_id").cast("string").alias("id_str"),
                 (F.col("turn") * 10).alias("followers_count"),
                 (F.col("role") == "assistant").alias("verified")).alias("user"),
        F.length("text").alias("retweet_count"),
        F.col("turn").alias("favorite_count"),
        F.struct(F.transform(words, lambda w: F.struct(w.alias("text"))).alias("hashtags")).alias("entities"),
        F.lit("conv").alias("coin"),
        F.upper("role").alias("symbol"),
        F.lit("en").alias("lang"),
        F.when(F.col("turn") > 0, F.struct(F.col("conv_id").alias("id"))).alias("retweeted_status"),
    )
