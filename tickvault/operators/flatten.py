"""Row builders: nested documents -> flat typed rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickvault.functions import nulls, times
from tickvault.functions.nested import quote_field, field_of_each, present


def _text_default(c: str, defaults: bool) -> Column:
    return nulls.default(c, nulls.DEFAULT_STRING) if defaults else F.col(c)


def _ts_or_default(c: str, defaults: bool) -> Column:
    """Absent -> epoch default (when ``defaults``); present but unparseable ('' / junk) -> NULL."""
    parsed = times.parse_iso(c)
    if not defaults:
        return parsed
    return F.when(F.col(c).isNull(), F.lit(nulls.DEFAULT_TIMESTAMP).cast("timestamp_ntz")).otherwise(parsed)


def metadata_rows(doc: DataFrame, defaults: bool = True, monitored: bool = True) -> DataFrame:
    """Merged metadata+ticker document -> the 19-column metadata table row.

    ``defaults=True`` reproduces the typed defaults of the source row builder (N1); with
    ``False`` missing values stay NULL (§7.4 D15).
    """
    def num(c, typ, dflt):
        v = F.col(c).cast(typ)
        return F.coalesce(v, F.lit(dflt).cast(typ)) if defaults else v

    price = quote_field("quotes", "price").cast("double")
    return doc.select(
        F.col("id").cast("string").alias("coin_id"),                      # P7 rename
        _text_default("name", defaults).alias("name"),
        _text_default("symbol", defaults).alias("symbol"),
        num("rank", "int", nulls.DEFAULT_INT).alias("rank"),               # C1
        num("is_new", "boolean", nulls.DEFAULT_BOOL).alias("is_new"),
        num("is_active", "boolean", nulls.DEFAULT_BOOL).alias("is_active"),
        _text_default("type", defaults).alias("type"),
        _text_default("description", defaults).alias("description"),
        _ts_or_default("started_at", defaults).alias("started_at"),         # T1 + X1
        _text_default("development_status", defaults).alias("development_status"),
        num("hardware_wallet", "boolean", nulls.DEFAULT_BOOL).alias("hardware_wallet"),
        _text_default("proof_type", defaults).alias("proof_type"),
        _text_default("org_structure", defaults).alias("org_structure"),
        _text_default("hash_algorithm", defaults).alias("hash_algorithm"),
        num("total_supply", "bigint", nulls.DEFAULT_INT).alias("total_supply"),
        num("max_supply", "bigint", nulls.DEFAULT_INT).alias("max_supply"),
        _ts_or_default("last_updated", defaults).alias("last_updated"),
        (F.coalesce(price, F.lit(nulls.DEFAULT_FLOAT)) if defaults else price).alias("price_usd"),  # M1
        F.lit(monitored).alias("is_monitored"),                              # P6 constant
    )


def notebook_rows(doc: DataFrame) -> DataFrame:
    """P6-P9 + N4 (explicit-schema path): price from the map-of-maps, parsed times, constant
    flag, ``quotes`` dropped, string nulls filled with 'NA', explicit 18-column order."""
    df = (doc.withColumn("price_usd", F.col("quotes")["USD"]["price"].cast("double"))
             .withColumn("started_at", times.parse_iso("started_at"))
             .withColumn("last_updated", times.parse_iso("last_updated"))
             .withColumn("is_monitored", F.lit(True))
             .drop("quotes"))
    df = nulls.fill_strings(df, "NA")
    return df.select("id", "name", "symbol", "rank", "is_new", "is_active", "type", "description",
                     "started_at", "development_status", "hardware_wallet", "proof_type",
                     "org_structure", "hash_algorithm", "total_supply", "max_supply", "last_updated",
                     "price_usd")


def price_rows_from(coin_id: Column, ts_text: Column, price: Column, volume: Column, cap: Column) -> list[Column]:
    ts = times.parse_iso(ts_text)
    return [coin_id.cast("string").alias("coin_id"), ts.alias("read_timestamp"),
            times.ts_date(ts).alias("date"), times.ts_hour(ts).alias("hour"),
            price.cast("double").alias("price"), volume.cast("double").alias("volume_24h"),
            cap.cast("double").alias("market_cap")]


def price_points(tickers: DataFrame, currency: str = "USD", carry: tuple[str, ...] = ()) -> DataFrame:
    """Ticker document -> (coin_id, read_timestamp, date, hour, price, volume_24h, market_cap),
    then the ``carry`` columns (message order, raw payload) as they are.

    Rows whose key time or quote is missing keep NULLs here; ``price_row_problem`` names them.
    """
    q = F.try_element_at(F.col("quotes"), F.lit(currency))
    return tickers.select(*price_rows_from(F.col("id"), F.col("last_updated"), q["price"],
                                           q["volume_24h"], q["market_cap"]), *carry)


def historic_points(history: DataFrame, payload: bool = False) -> DataFrame:
    """(coin_id, points ARRAY<STRUCT>) -> one price row per point (``explode``); with ``payload``
    also the raw point as JSON, for the quarantine."""
    p = history.select("coin_id", F.explode("points").alias("p"))
    raw = [F.to_json(F.struct("coin_id", F.col("p").alias("point"))).alias("payload")] if payload else []
    return p.select(*price_rows_from(F.col("coin_id"), F.col("p.timestamp"), F.col("p.price"),
                                     F.col("p.volume_24h"), F.col("p.market_cap")), *raw)


def price_row_problem() -> Column:
    """Why a price row cannot be stored (NULL when it can): the key or the price is missing."""
    return (F.when(F.col("coin_id").isNull(), F.lit("missing coin_id"))
             .when(F.col("read_timestamp").isNull(), F.lit("missing or bad last_updated"))
             .when(F.col("price").isNull(), F.lit("missing USD quote")))


def submission_rows(raw: DataFrame, coin_id: Column, sort_type: str) -> DataFrame:
    """Raw post -> 12-field submission row.

    ``raw`` holds (id, title, score, url, num_comments, created_utc epoch seconds, selftext,
    subreddit, author, link_flair_text).
    """
    return raw.select(
        coin_id.cast("string").alias("coin_id"),
        F.col("id").cast("string").alias("submission_id"),
        nulls.falsy_default("title").alias("title"),                          # N2
        F.col("score").cast("int").alias("score"),
        nulls.falsy_default("url").alias("url"),
        F.col("num_comments").cast("int").alias("num_comments"),
        times.iso_from_epoch("created_utc").alias("created_utc"),             # T3
        nulls.first_non_empty("selftext", "title").alias("selftext"),         # N3
        F.col("subreddit").alias("subreddit"),
        F.col("author").cast("string").alias("author"),                       # X3 (NULL stays NULL)
        F.lit(sort_type).alias("sort_type"),
        nulls.falsy_default("link_flair_text").alias("flair"),
    )


# The tweet link format.
TWEET_URL = "https://twitter.com/%s/status/%s"


def tweet_rows(raw: DataFrame) -> DataFrame:
    """P10: raw tweet -> 15-field tweet row."""
    return raw.select(
        F.col("id_str").alias("tweet_id"),
        times.to_text("created_at", times.ISO_SPACE).alias("created_at"),
        F.col("full_text").alias("text"),
        F.col("user.screen_name").alias("user"),
        F.col("user.id_str").alias("user_id"),
        F.col("user.followers_count").cast("int").alias("user_followers_count"),
        F.col("user.verified").alias("user_verified"),
        F.col("retweet_count").cast("int").alias("retweet_count"),
        F.col("favorite_count").cast("int").alias("favorite_count"),
        field_of_each("entities.hashtags", "text").alias("hashtags"),
        F.col("coin"), F.col("symbol"),
        F.format_string(TWEET_URL, F.col("user.screen_name"),
                        F.col("id_str")).alias("tweet_url"),
        F.col("lang"),
        present("retweeted_status").alias("is_retweet"),
    )


def index_rows(posts: DataFrame, symbol: Column | None = None) -> DataFrame:
    """K8: the typed 8-field search-index projection of stored posts; ``sentiment_score`` is NULL unless the
    posts have it (``operators.sentiment``)."""
    return posts.select(
        F.col("coin_id").cast("string").alias("coin_id"),
        (symbol if symbol is not None else F.col("symbol")).cast("string").alias("symbol"),
        F.col("title").cast("string").alias("title"),
        F.col("selftext").cast("string").alias("selftext"),
        F.col("score").cast("int").alias("score"),
        F.col("num_comments").cast("int").alias("num_comments"),
        times.parse_iso(F.col("created_utc").cast("string")).alias("created_utc"),
        (F.col("sentiment_score") if "sentiment_score" in posts.columns else F.lit(None)).cast("float").alias("sentiment_score"),
    )

