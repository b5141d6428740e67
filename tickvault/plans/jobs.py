"""Composed batch jobs (W1-W4) and the key-merge writer run end to end (K2).

Each job is one DataFrame chain from sources to the key-merge writer - no driver loop over coins
and no per-coin Spark job. Over the test tables the jobs write into fresh tables in the shared
checkpoint folder and return the table as read back.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickvault import schemas
from tickvault.functions import times
from tickvault.operators import flatten, joins, search, selection
from tickvault.plans import tables as tb
from tickvault.plans.oracle_ctes import COINS, HISTORY, META, POSTS, PRICES, TICK, with_
from tickvault.session import delete_path, scratch_path
from tickvault.errors import logged
from tickvault.operators.topn import latest_per_key
from tickvault.sinks.merge import VERSION as VERSION_COLUMN, message_version, upsert
from tickvault.sinks.quarantine import quarantine_batch
from tickvault.sources.files import history_range

TOP_N = 20
SEARCH_LIMIT = 500
VERSION = ["landed_at", "event_id"]      # columns that order several versions of a document, where present
CORRECTION_FROM = "2024-01-10 00:00:00"
STORED_UNTIL = "2024-01-20 00:00:00"


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


# ---- W1 ---------------------------------------------------------------------------------

@logged("jobs.load_metadata")
def load_metadata(coins: DataFrame, meta: DataFrame, tickers: DataFrame, path: str, n: int = TOP_N) -> None:
    """S1 -> F1 u (F2, O1) -> latest document per coin on each side -> J1 -> P1 -> K3
    (merge by coin_id; rank is a plain column)."""
    ids = selection.universe(coins, n, distinct=True).select(F.col("coin_id").alias("id"))
    docs = joins.merge_right_wins(joins.latest_docs(meta.join(ids, "id", "left_semi")),
                                  joins.latest_docs(tickers.join(ids, "id", "left_semi")), "id")
    rows = flatten.metadata_rows(docs, defaults=True)
    upsert(rows, path, schemas.METADATA_KEY, schemas.METADATA_TABLE)


def job_metadata(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "metadata")
    load_metadata(tb.coins(spark, d), tb.meta_docs(spark, d), tb.ticker_docs(spark, d), path)
    return read_table(spark, path, schemas.METADATA_TABLE)


JOB_METADATA_SQL = with_(COINS, META, TICK) + f""",
uni AS (SELECT coin_id FROM coins WHERE rank > 0 AND rank <= {TOP_N}
        UNION
        SELECT coin_id FROM (SELECT * FROM coins WHERE is_new AND is_active ORDER BY rank, coin_id LIMIT {TOP_N // 2}))
SELECT m.id AS coin_id, coalesce(m.name, '') AS name, coalesce(t.symbol, '') AS symbol, t.rank, m.is_new, m.is_active,
       coalesce(m.type, '') AS type, coalesce(m.description, '') AS description,
       coalesce(m.started_at, TIMESTAMP '1970-01-01 00:00:00') AS started_at,
       coalesce(m.development_status, '') AS development_status, m.hardware_wallet,
       coalesce(m.proof_type, '') AS proof_type, coalesce(m.org_structure, '') AS org_structure,
       coalesce(m.hash_algorithm, '') AS hash_algorithm, t.total_supply, t.max_supply, t.last_updated,
       coalesce(t.price, 0.0) AS price_usd, TRUE AS is_monitored
FROM meta m JOIN tick t ON m.id = t.id WHERE m.id IN (SELECT coin_id FROM uni)"""


# ---- K2 end to end ------------------------------------------------------------------------

def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    """K2: the price table holds ticks up to 01-20; a correction batch (prices halved, and each tick
    sent a second time as a later event at a quarter) for 01-10 on is merged in. Overlapping keys take the
    batch's last version; one row per key."""
    rows = flatten.price_points(tb.price_ticks(spark, d), carry=("event_id",))
    stored = rows.filter(F.col("read_timestamp") < F.lit(STORED_UNTIL).cast("timestamp_ntz"))
    batch = rows.filter(F.col("read_timestamp") >= F.lit(CORRECTION_FROM).cast("timestamp_ntz"))
    last = batch.withColumn("price", F.col("price") / 4).withColumn("event_id", F.col("event_id") * 2 + 1)
    batch = batch.withColumn("price", F.col("price") / 2).withColumn("event_id", F.col("event_id") * 2).unionByName(last)
    path = scratch_path(spark, "prices")
    for b in (stored, batch):
        upsert(b, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, schemas.PRICE_PARTITION, order=["event_id"])
    return read_table(spark, path, schemas.PRICE_TABLE)


UPSERT_LATEST_SQL = with_(PRICES) + f""",
cand AS (
  SELECT coin_id, read_timestamp, date, hour, price, volume_24h, market_cap, 0 AS src, event_id FROM prices
  WHERE read_timestamp < TIMESTAMP '{STORED_UNTIL}'
  UNION ALL
  SELECT coin_id, read_timestamp, date, hour, price / 4, volume_24h, market_cap, 1 AS src, event_id FROM prices
  WHERE read_timestamp >= TIMESTAMP '{CORRECTION_FROM}')
SELECT coin_id, read_timestamp, date, hour, price, volume_24h, market_cap FROM (
  SELECT *, row_number() OVER (PARTITION BY coin_id, read_timestamp ORDER BY src DESC, event_id DESC) AS rn
  FROM cand) WHERE rn = 1"""


# ---- W3 ---------------------------------------------------------------------------------

def _version(order: list[str]) -> Column:
    """The stored version of a landed document, in one order with the streams' messages."""
    return message_version(seq=F.col("event_id") if "event_id" in order else None, at=F.col("landed_at") if "landed_at" in order else None)


def _store(rows: DataFrame, path: str, quarantine: str, source: str, order: list[str]) -> None:
    """Price rows with ``problem`` and ``payload`` -> price table and quarantine. Staged first, so both
    sides see the same rows and the table may be one the rows were chosen by."""
    spark = rows.sparkSession
    stage = scratch_path(spark, source)
    try:
        rows.write.mode("overwrite").parquet(stage)
        staged = spark.read.schema(rows.schema).parquet(stage)
        upsert(staged.filter(F.col("problem").isNull()), path, schemas.PRICE_KEY, schemas.PRICE_TABLE,
               schemas.PRICE_PARTITION, version=_version(order))
        quarantine_batch(staged.filter(F.col("problem").isNotNull()).select(F.col("problem").alias("reason"), "payload"), quarantine, source)
    finally:
        delete_path(spark, stage)


@logged("jobs.refresh_prices")
def refresh_prices(monitored_ids: DataFrame, tickers: DataFrame, path: str, quarantine: str) -> None:
    """F7 -> J5 (monitored coins x their landed tickers) -> P2 -> K2 into the price table;
    tickers without a usable time or USD quote go to quarantine, as they came."""
    order = [c for c in VERSION if c in tickers.columns]
    ticks = tickers.join(monitored_ids.select(F.col("coin_id").alias("id")).distinct(), "id", "left_semi")
    ticks = ticks.withColumn("payload", F.to_json(F.struct(*[c for c in tickers.columns if c not in VERSION])))
    rows = flatten.price_points(ticks, carry=("payload", *order)).withColumn("problem", flatten.price_row_problem())
    _store(rows, path, quarantine, "tickers", order)


def monitored_coins(spark: SparkSession, d: str) -> DataFrame:
    """F7 over the test tables: the monitored, active coins of the metadata table."""
    docs = joins.merge_right_wins(tb.meta_docs(spark, d), tb.ticker_docs(spark, d), "id")
    return selection.monitored(flatten.metadata_rows(docs)).filter("is_active").select("coin_id", "name", "symbol")


def job_price_refresh(spark: SparkSession, d: str) -> DataFrame:
    """W3 over the test tables: the monitored coins' tick messages into a fresh price table."""
    path, quarantine = scratch_path(spark, "prices"), scratch_path(spark, "quarantine")
    refresh_prices(monitored_coins(spark, d).select("coin_id"), tb.price_ticks(spark, d), path, quarantine)
    return read_table(spark, path, schemas.PRICE_TABLE)


JOB_PRICE_REFRESH_SQL = with_(PRICES, META, TICK) + """
SELECT coin_id, read_timestamp, date, hour, price, volume_24h, market_cap FROM (
  SELECT *, row_number() OVER (PARTITION BY coin_id, read_timestamp ORDER BY event_id DESC) AS rn
  FROM prices WHERE coin_id IN (SELECT m.id FROM meta m JOIN tick t ON m.id = t.id WHERE m.is_active)) WHERE rn = 1"""


# ---- W2 ---------------------------------------------------------------------------------

@logged("jobs.backfill")
def backfill(monitored_ids: DataFrame, history: DataFrame, path: str, quarantine: str,
             start_date: str | None = None, interval: str | None = None) -> None:
    """F7 -> J2 (coins without stored prices) -> S4 history of those from ``start_date`` on, one
    point per ``interval`` (A4) -> P3 -> K2.

    Points with a missing time (part of the key) go to quarantine instead of the table. "Missing" is
    decided against the table as it is now (``_store`` stages the points before the table changes).
    """
    from tickvault.sources.files import read_or_empty
    stored = read_or_empty(monitored_ids.sparkSession, path, schemas.PRICE_TABLE)
    missing = joins.missing_ids(monitored_ids, stored, "coin_id")
    if "payload" not in history.columns:
        history = history.withColumn("payload", F.to_json(F.struct("*")))
    points = history_range(history.join(missing, "coin_id", "left_semi"), start_date, interval)
    order = [c for c in VERSION if c in history.columns]
    _store(points.withColumn("problem", flatten.price_row_problem()), path, quarantine, "history", order)


@logged("jobs.fill_gaps")
def fill_gaps(monitored_ids: DataFrame, history: DataFrame, path: str, quarantine: str, start: str, end: str, interval: str = "1d") -> DataFrame:
    """W2 for holes inside a coin's history: the ranges of intervals in [start, end) that the monitored coins
    have no price in are found, and exactly those are filled from ``history`` (one point per interval).
    Returns the ranges asked for (key, from_ts, to_ts, n_missing)."""
    from tickvault.operators import gaps
    from tickvault.sources.files import read_or_empty
    spark = monitored_ids.sparkSession
    stored = read_or_empty(spark, path, schemas.PRICE_TABLE)
    asked = scratch_path(spark, "ranges")
    gaps.missing_ranges(monitored_ids, stored, start, end, interval).write.parquet(asked)      # before the table changes
    ranges = spark.read.parquet(asked)
    if "payload" not in history.columns:
        history = history.withColumn("payload", F.to_json(F.struct("*")))
    wanted = history.join(monitored_ids.select("coin_id").distinct(), "coin_id", "left_semi")
    order = [c for c in VERSION if c in history.columns]
    points = history_range(gaps.only_missing(wanted.filter(F.col("read_timestamp").isNotNull()), stored, start, end, interval), None, interval)
    points = points.unionByName(wanted.filter(F.col("read_timestamp").isNull()))               # for the quarantine
    _store(points.withColumn("problem", flatten.price_row_problem()), path, quarantine, "history", order)
    return ranges


START_DATE, INTERVAL = "1995-01-01", "1d"
GAPS_FROM, GAPS_TO = "1996-01-01 00:00:00", "1996-03-01 00:00:00"


def job_fill_gaps(spark: SparkSession, d: str) -> DataFrame:
    """W2 over the test tables: the table holds every coin's even history days; the holes of two months are
    filled from the whole history, one point a day."""
    path, quarantine = scratch_path(spark, "prices"), scratch_path(spark, "quarantine")
    history = flatten.historic_points(tb.history_docs(spark, d), payload=True)
    even = history.filter((F.datediff("date", F.lit("1970-01-01")) % 2 == 0) & F.col("date").between(GAPS_FROM[:10], GAPS_TO[:10]))
    upsert(even, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, schemas.PRICE_PARTITION)
    ids = tb.meta_docs(spark, d).select(F.col("id").alias("coin_id"))
    fill_gaps(ids, history, path, quarantine, GAPS_FROM, GAPS_TO, INTERVAL)
    return read_table(spark, path, schemas.PRICE_TABLE)


JOB_FILL_GAPS_SQL = with_(META, HISTORY) + f""",
good AS (SELECT DISTINCT coin_id, read_timestamp, CAST(read_timestamp AS DATE) AS date, CAST(hour(read_timestamp) AS INTEGER) AS hour,
                price, volume_24h, market_cap FROM points WHERE read_timestamp IS NOT NULL),
keyed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, read_timestamp ORDER BY price DESC, volume_24h DESC, market_cap DESC) AS n FROM good) WHERE n = 1),
stored AS (SELECT * FROM keyed WHERE date_diff('day', DATE '1970-01-01', date) % 2 = 0 AND date BETWEEN DATE '{GAPS_FROM[:10]}' AND DATE '{GAPS_TO[:10]}'),
holes AS (SELECT * FROM (SELECT k.*, row_number() OVER (PARTITION BY k.coin_id, k.date ORDER BY read_timestamp DESC) AS last FROM keyed k
                         WHERE read_timestamp >= TIMESTAMP '{GAPS_FROM}' AND read_timestamp < TIMESTAMP '{GAPS_TO}'
                           AND coin_id IN (SELECT id FROM meta) AND (coin_id, date) NOT IN (SELECT (coin_id, date) FROM stored)) WHERE last = 1)
SELECT coin_id, read_timestamp, date, hour, price, volume_24h, market_cap FROM stored
UNION ALL SELECT coin_id, read_timestamp, date, hour, price, volume_24h, market_cap FROM holes"""


def job_backfill(spark: SparkSession, d: str) -> DataFrame:
    path, quarantine = scratch_path(spark, "prices"), scratch_path(spark, "quarantine")
    upsert(flatten.price_points(tb.price_ticks(spark, d), carry=("event_id",)), path, schemas.PRICE_KEY, schemas.PRICE_TABLE,
           schemas.PRICE_PARTITION, order=["event_id"])
    docs = joins.merge_right_wins(tb.meta_docs(spark, d), tb.ticker_docs(spark, d), "id")
    monitored = selection.monitored(flatten.metadata_rows(docs), ["coin_id"])
    backfill(monitored, flatten.historic_points(tb.history_docs(spark, d), payload=True), path, quarantine, START_DATE, INTERVAL)
    return read_table(spark, path, schemas.PRICE_TABLE)


JOB_BACKFILL_SQL = with_(PRICES, META, TICK, HISTORY) + f""",
existing AS (SELECT coin_id, read_timestamp, date, hour, price, volume_24h, market_cap, event_id FROM prices),
missing AS (SELECT DISTINCT m.id FROM meta m JOIN tick t ON m.id = t.id
            WHERE m.id NOT IN (SELECT coin_id FROM existing)),
hist AS (SELECT coin_id, read_timestamp, CAST(read_timestamp AS DATE) AS date,
                CAST(hour(read_timestamp) AS INTEGER) AS hour, price, volume_24h, market_cap, 0 AS event_id
         FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, CAST(read_timestamp AS DATE)
                                            ORDER BY read_timestamp DESC, price DESC, volume_24h DESC, market_cap DESC) AS last
               FROM points WHERE coin_id IN (SELECT id FROM missing) AND read_timestamp >= TIMESTAMP '{START_DATE} 00:00:00')
         WHERE last = 1),
cand AS (SELECT * FROM existing UNION ALL SELECT * FROM hist)
SELECT coin_id, read_timestamp, date, hour, price, volume_24h, market_cap FROM (
  SELECT *, row_number() OVER (PARTITION BY coin_id, read_timestamp ORDER BY event_id DESC) AS rn
  FROM cand) WHERE rn = 1"""


# ---- W4 ---------------------------------------------------------------------------------

@logged("jobs.load_posts")
def load_posts(coins: DataFrame, posts: DataFrame, records: DataFrame, path: str,
               limit: int = SEARCH_LIMIT, sort_type: str = search.SORT_TOP, since=None, until=None) -> None:
    """Monitored coins -> posts created after ``since`` and before ``until`` (F6) -> keyword search
    (J3/O3) -> full records (J4) -> P4 -> K2 on (coin_id, submission_id): a post found by both keywords
    of a coin is stored once (D9).

    The records of the found posts are read once each; the many (coin, post) pairs travel without them and meet
    them where the table is written."""
    spark, stages = posts.sparkSession, []

    def staged(df: DataFrame) -> DataFrame:
        stages.append(scratch_path(spark, "found"))
        df.write.parquet(stages[-1])
        return spark.read.schema(df.schema).parquet(stages[-1])
    posts = selection.time_range(posts, "created_utc", after=since, before=until)
    ck = search.coin_keywords(coins)
    try:
        best = staged(search.best_posts(posts, ck, F.col("text"), limit, sort_type).select("kw", "submission_id"))
        records = records.drop("coin_id", "sort_type").withColumn("created_utc", times.parse_iso("created_utc")) \
            .withColumn("created_date", F.to_date("created_utc")).withColumn("created_month", times.month("created_date"))
        records = records.join(best.select("submission_id").distinct(), "submission_id", "left_semi") \
            .withColumn(VERSION_COLUMN, _version([c for c in VERSION if c in records.columns]))
        stored = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.POST_TABLE.fields if f.name in records.columns]
        records = staged(latest_per_key(records.select(*stored, VERSION_COLUMN), ["submission_id"], [VERSION_COLUMN]))
        found = search.per_coin(best, ck, limit).select("coin_id", "submission_id").dropDuplicates()
        narrow = records.select("submission_id", "created_month", VERSION_COLUMN)
        rows = joins.lookup(found, narrow, "submission_id").withColumn("sort_type", F.lit(sort_type))
        upsert(rows, path, schemas.POST_KEY, schemas.POST_TABLE, schemas.POST_PARTITION, version=F.col(VERSION_COLUMN),
               records=(records.drop("created_month", VERSION_COLUMN), "submission_id"))
    finally:
        for p in stages:
            delete_path(spark, p)


POSTS_SINCE, POSTS_UNTIL = "2024-01-03 00:00:00", "2024-02-01 00:00:00"


def job_posts(spark: SparkSession, d: str) -> DataFrame:
    """W4 over the test tables: the coins W1 monitors, posts of one month."""
    path = scratch_path(spark, "posts")
    coins = selection.universe(tb.coins(spark, d), TOP_N, distinct=True)
    records = flatten.submission_rows(tb.raw_posts(spark, d, with_labels=False), F.lit(None).cast("string"),
                                      search.SORT_TOP)
    load_posts(coins, tb.posts(spark, d), records, path, since=POSTS_SINCE, until=POSTS_UNTIL)
    return read_table(spark, path, schemas.POST_TABLE).select(
        "coin_id", "submission_id", "title", "score", "num_comments", "created_utc", "subreddit", "author",
        "sort_type", "flair")


JOB_POSTS_SQL = with_(COINS, POSTS) + f""",
ck AS (SELECT coin_id, keyword, lower(keyword) AS kw FROM (
         SELECT coin_id, unnest([name, symbol]) AS keyword FROM (
           SELECT * FROM coins WHERE rank > 0 AND rank <= {TOP_N}
           UNION (SELECT * FROM coins WHERE is_new AND is_active ORDER BY rank, coin_id LIMIT {TOP_N // 2})))
       WHERE keyword IS NOT NULL AND keyword <> ''),
kws AS (SELECT DISTINCT kw FROM ck),
pairs AS (SELECT p.submission_id, p.score, k.kw FROM posts p JOIN kws k ON contains(lower(p.text), k.kw)
          WHERE p.created_utc > TIMESTAMP '{POSTS_SINCE}' AND p.created_utc < TIMESTAMP '{POSTS_UNTIL}'),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kw ORDER BY score DESC NULLS LAST, submission_id) AS rn
                        FROM pairs) WHERE rn <= {SEARCH_LIMIT}),
found AS (SELECT DISTINCT c.coin_id, b.submission_id FROM best b JOIN ck c ON b.kw = c.kw)
SELECT f.coin_id, f.submission_id, split_part(d.text, chr(10), 1) AS title, CAST(d.n_chars AS INTEGER) AS score,
       CAST(len(string_split(d.text, chr(10))) - 1 AS INTEGER) AS num_comments,
       make_timestamp((1704067200 + d.doc_id * 3600) * 1000000) AS created_utc, d.source AS subreddit,
       CASE WHEN d.lang = 'de' THEN NULL ELSE 'user_' || d.source END AS author, 'top' AS sort_type,
       d.lang AS flair
FROM found f JOIN documents d ON f.submission_id = CAST(d.doc_id AS VARCHAR)"""

