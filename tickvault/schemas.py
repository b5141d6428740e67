"""Declared schemas (§1 of the survey). Every source reads with one of these; nothing is inferred.

Rule: prices, volumes and caps are DOUBLE, ranks INT, supplies BIGINT, engine timestamps
TIMESTAMP_NTZ holding UTC wall-clock time.
"""
from pyspark.sql import types as T

S, I, L, D, B, F = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.FloatType()
TS = T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- landed source documents -------------------------------------------------------------

COIN_LIST = _st(("id", S), ("name", S), ("symbol", S), ("rank", I), ("is_new", B),
                ("is_active", B), ("type", S))

QUOTE = _st(("price", D), ("volume_24h", D), ("volume_24h_change_24h", D), ("market_cap", D),
            ("market_cap_change_24h", D), ("percent_change_15m", D), ("percent_change_30m", D),
            ("percent_change_1h", D), ("percent_change_6h", D), ("percent_change_12h", D),
            ("percent_change_24h", D), ("percent_change_7d", D), ("percent_change_30d", D),
            ("percent_change_1y", D), ("ath_price", D), ("ath_date", S), ("percent_from_price_ath", D))

TICKER = _st(("id", S), ("name", S), ("symbol", S), ("rank", I), ("total_supply", L),
             ("max_supply", L), ("beta_value", D), ("first_data_at", S), ("last_updated", S),
             ("quotes", T.MapType(S, QUOTE)))

META = _st(("id", S), ("name", S), ("symbol", S), ("rank", I), ("is_new", B), ("is_active", B),
           ("type", S), ("contract", S), ("platform", S),
           ("contracts", T.ArrayType(_st(("contract", S), ("platform", S), ("type", S)))),
           ("logo", S), ("parent", _st(("id", S), ("name", S), ("symbol", S))),
           ("tags", T.ArrayType(_st(("id", S), ("name", S), ("coin_counter", L), ("ico_counter", L)))),
           ("team", T.ArrayType(S)), ("description", S), ("message", S), ("open_source", B),
           ("started_at", S), ("development_status", S), ("hardware_wallet", B), ("proof_type", S),
           ("org_structure", S), ("hash_algorithm", S), ("links", T.MapType(S, T.ArrayType(S))),
           ("links_extended", T.ArrayType(_st(("url", S), ("type", S), ("stats", T.MapType(S, L))))),
           ("whitepaper", _st(("link", S), ("thumbnail", S))), ("first_data_at", S), ("last_data_at", S))

# metadata document merged with its ticker: meta fields, then ticker-only fields
META_TICKER = T.StructType(list(META.fields) + [f for f in TICKER.fields if f.name not in META.fieldNames()])

HISTORIC_POINT = _st(("timestamp", S), ("price", D), ("volume_24h", D), ("market_cap", D))
HISTORIC = T.ArrayType(HISTORIC_POINT)
# a landed history file: one coin per line with its points
HISTORIC_DOC = _st(("coin_id", S), ("points", HISTORIC))

SUBMISSION = _st(("coin_id", S), ("submission_id", S), ("title", S), ("score", I), ("url", S),
                 ("num_comments", I), ("created_utc", S), ("selftext", S), ("subreddit", S),
                 ("author", S), ("sort_type", S), ("flair", S))
SUBMISSION_MESSAGE = T.ArrayType(SUBMISSION)

TWEET = _st(("tweet_id", S), ("created_at", S), ("text", S), ("user", S), ("user_id", S),
            ("user_followers_count", I), ("user_verified", B), ("retweet_count", I),
            ("favorite_count", I), ("hashtags", T.ArrayType(S)), ("coin", S), ("symbol", S),
            ("tweet_url", S), ("lang", S), ("is_retweet", B))

# explicit 18-field notebook schema (S11); dates stay text, quotes a map of maps
NOTEBOOK = _st(("id", S), ("name", S), ("symbol", S), ("rank", I), ("is_new", B), ("is_active", B),
               ("type", S), ("description", S), ("started_at", S), ("development_status", S),
               ("hardware_wallet", B), ("proof_type", S), ("org_structure", S), ("hash_algorithm", S),
               ("total_supply", L), ("max_supply", L), ("last_updated", S),
               ("quotes", T.MapType(S, T.MapType(S, S))))

# ---- stored tables (K11, K12, K8) --------------------------------------------------------

METADATA_TABLE = _st(("coin_id", S), ("name", S), ("symbol", S), ("rank", I), ("is_new", B),
                     ("is_active", B), ("type", S), ("description", S), ("started_at", TS),
                     ("development_status", S), ("hardware_wallet", B), ("proof_type", S),
                     ("org_structure", S), ("hash_algorithm", S), ("total_supply", L),
                     ("max_supply", L), ("last_updated", TS), ("price_usd", D), ("is_monitored", B))
METADATA_KEY = ["coin_id"]

PRICE_TABLE = _st(("coin_id", S), ("read_timestamp", TS), ("date", T.DateType()), ("hour", I),
                  ("price", D), ("volume_24h", D), ("market_cap", D))
PRICE_KEY = ["coin_id", "read_timestamp"]
PRICE_PARTITION = ["date"]

POST_TABLE = _st(*[(f.name, f.dataType) for f in SUBMISSION.fields if f.name != "created_utc"],
                 ("created_utc", TS), ("created_date", T.DateType()), ("created_month", T.DateType()))
POST_KEY = ["coin_id", "submission_id"]
# a post's creation time never changes (a function of its id): re-fetched recent posts only
# touch recent months, so a merge rewrites those, not the whole post table. A day of posts is often a few
# rows, and opening a file costs more than writing them
POST_PARTITION = ["created_month"]

INDEX_PARTITION = ["created_date"]
INDEX_TABLE = _st(("coin_id", S), ("symbol", S), ("title", S), ("selftext", S), ("score", I),
                  ("num_comments", I), ("created_utc", TS), ("sentiment_score", F))

# partitioned by source and run (a stream's query and epoch, or a batch's content)
QUARANTINE = _st(("reason", S), ("payload", S), ("source", S), ("run", S))
QUARANTINE_PARTITION = ["source", "run"]
CORRUPT = "_corrupt"

# the part of a ticker message that a price row needs; a field of another type fills CORRUPT
PRICE_MESSAGE = _st(("id", S), ("last_updated", S),
                    ("quotes", T.MapType(S, _st(("price", D), ("volume_24h", D), ("market_cap", D)))), (CORRUPT, S))
POST_MESSAGE = T.StructType(SUBMISSION.fields + [T.StructField(CORRUPT, S)])

# sink-side decimal types of the stores (the engine computes in DOUBLE)
SQL_STORE_PRICE = T.DecimalType(20, 8)
KV_STORE_DECIMAL = T.DecimalType(38, 8)


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE ... (<ddl>)``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
