"""The registered query set: one entry per operator group of the survey's inventory, each a
Spark plan over the test tables plus an independent DuckDB SQL oracle with the same columns.

Every query reads whole tables; limits appear only where the limit is the feature (top-k
reports, previews, a per-keyword search limit).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickvault.functions import nulls, times
from tickvault.functions.nested import quote_field
from tickvault.operators import aggregate, flatten, joins, search, selection
from tickvault.plans import tables as tb
from tickvault.plans.oracle_ctes import COINS, HISTORY, META, POSTS, PRICES, RAW_POSTS, TICK, with_

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed parameters of the query set.
TOP_N = 20                 # coins per metadata load (top-n by rank plus n // 2 new ones)
SEARCH_LIMIT = 500         # posts per keyword (the source's default)
SINCE_ANCHOR = "1999-01-01"
SINCE_DAYS = 364


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- price points and time functions (events) --------------------------------------------

@query("price_point", with_(PRICES) + """
SELECT coin_id, read_timestamp, date, hour, price, volume_24h, market_cap FROM prices""")
def price_point(spark, d):
    """P2 + T2: ticker message -> price row."""
    return flatten.price_points(tb.price_ticks(spark, d))


@query("nested_quote", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value AS usd_price,
       CAST(NULL AS DOUBLE) AS eur_price
FROM events""")
def nested_quote(spark, d):
    """M1 + B1: decode the props document; map lookup with a present and an absent currency."""
    t = tb.price_ticks(spark, d)
    return t.select("event_id", F.from_json("props", "k BIGINT").k.alias("k"),
                    quote_field("quotes", "price", "USD").alias("usd_price"),
                    quote_field("quotes", "price", "EUR").alias("eur_price"))


@query("iso_parse", """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS iso_text,
       CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS parsed,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS stripped,
       date_trunc('second', ts) AS parsed_space,
       ts - INTERVAL 2 HOUR AS parsed_zone, CAST(NULL AS TIMESTAMP) AS parsed_junk
FROM events""")
def iso_parse(spark, d):
    """T1 + X1: ISO text (with an empty value) -> timestamp; 'T'/'Z' stripping."""
    e = tb.table(spark, d, "events")
    full = times.to_text("ts", times.ISO_MICROS_Z)
    iso = F.when(F.col("event_type") == "error", F.lit("")).otherwise(full)
    return e.select("event_id", iso.alias("iso_text"), times.to_text("ts", times.ISO_Z).alias("z"),
                    times.to_text("ts", times.ISO_SPACE).alias("space"), full.alias("full")).select(
        "event_id", "iso_text", times.parse_iso("iso_text").alias("parsed"),
        times.strip_iso("z").alias("stripped"), times.parse_iso("space").alias("parsed_space"),
        times.parse_iso(F.replace("full", F.lit("Z"), F.lit("+02:00"))).alias("parsed_zone"),
        times.parse_iso(F.concat("full", F.lit(" x"))).alias("parsed_junk"))


@query("epoch_iso", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
       strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS created_utc
FROM events""")
def epoch_iso(spark, d):
    """Epoch seconds -> ISO text with 'Z'."""
    e = tb.table(spark, d, "events")
    secs = F.timestamp_diff("SECOND", F.expr(times.EPOCH_NTZ), F.col("ts"))
    return e.select("event_id", secs.alias("epoch_s")).select(
        "event_id", "epoch_s", times.iso_from_epoch("epoch_s").alias("created_utc"))


@query("resample_interval", with_(PRICES) + """
SELECT coin_id, date_trunc('day', read_timestamp) AS bucket_start, read_timestamp, price, volume_24h FROM (
  SELECT *, row_number() OVER (PARTITION BY coin_id, date_trunc('day', read_timestamp)
                               ORDER BY read_timestamp DESC, event_id DESC) AS rn
  FROM prices) WHERE rn = 1""")
def resample_interval(spark, d):
    """A4: last price per coin and day (interval '1d'), ties broken by message id."""
    ticks = tb.price_ticks(spark, d)
    rows = ticks.select("event_id", *flatten.price_rows_from(
        F.col("id"), F.col("last_updated"), quote_field("quotes", "price"),
        quote_field("quotes", "volume_24h"), quote_field("quotes", "market_cap")))
    return aggregate.resample_last(rows, "coin_id", "read_timestamp", ["price", "volume_24h"], "1d",
                                   tiebreak=["event_id"])


@query("ohlc_bars", with_(PRICES) + """
SELECT coin_id, date_trunc('day', ts) AS bucket_start, first(price ORDER BY ts, event_id) AS open, max(price) AS high,
       min(price) AS low, last(price ORDER BY ts, event_id) AS close, count(*) AS n_ticks
FROM prices GROUP BY coin_id, date_trunc('day', ts)""")
def ohlc_bars(spark, d):
    """§2.14: daily open/high/low/close per coin."""
    e = tb.table(spark, d, "events").select(F.col("user_id").cast("string").alias("coin_id"), "ts",
                                            F.col("value").alias("price"), "event_id")
    return aggregate.ohlc(e, "coin_id", "ts", "price", "1d", tiebreak=["event_id"])


@query("price_indicators", with_(PRICES) + """,
bars AS (SELECT coin_id, date_trunc('day', ts) AS bucket_start, last(price ORDER BY ts, event_id) AS close
         FROM prices GROUP BY coin_id, date_trunc('day', ts))
SELECT coin_id, bucket_start, close,
       lag(close) OVER w AS prev_close,
       (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) AS ret,
       round(avg(close) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS ma_7
FROM bars WINDOW w AS (PARTITION BY coin_id ORDER BY bucket_start)""")
def price_indicators(spark, d):
    """§2.14: previous close, return and 7-bar moving average over daily bars."""
    e = tb.table(spark, d, "events").select(F.col("user_id").cast("string").alias("coin_id"), "ts",
                                            F.col("value").alias("price"), "event_id")
    bars = aggregate.ohlc(e, "coin_id", "ts", "price", "1d", tiebreak=["event_id"])
    out = aggregate.indicators(bars.select("coin_id", "bucket_start", "close"), "coin_id", "bucket_start")
    return out.select("coin_id", "bucket_start", "close", "prev_close", "ret", F.round("ma_7", 6).alias("ma_7"))


# ---- coin selection (part) ---------------------------------------------------------------

@query("top_rank", with_(COINS) + f"SELECT * FROM coins WHERE rank > 0 AND rank <= {TOP_N}")
def top_rank(spark, d):
    """F1."""
    return selection.rank_range(tb.coins(spark, d), TOP_N)


@query("new_active_topk", with_(COINS) + f"""
SELECT * FROM coins WHERE is_new AND is_active ORDER BY rank, coin_id LIMIT {TOP_N // 2}""")
def new_active_topk(spark, d):
    """F2 + O1 + H1."""
    return selection.new_active_top(tb.coins(spark, d), TOP_N)


@query("universe_union_all", with_(COINS) + f"""
SELECT * FROM coins WHERE rank > 0 AND rank <= {TOP_N}
UNION ALL
(SELECT * FROM coins WHERE is_new AND is_active ORDER BY rank, coin_id LIMIT {TOP_N // 2})""")
def universe_union_all(spark, d):
    """U1."""
    return selection.universe(tb.coins(spark, d), TOP_N)


@query("universe_distinct", with_(COINS) + f"""
SELECT DISTINCT * FROM (
  SELECT * FROM coins WHERE rank > 0 AND rank <= {TOP_N}
  UNION ALL
  (SELECT * FROM coins WHERE is_new AND is_active ORDER BY rank, coin_id LIMIT {TOP_N // 2}))""")
def universe_distinct(spark, d):
    """U2."""
    return selection.universe(tb.coins(spark, d), TOP_N, distinct=True)


@query("head_preview", with_(COINS) + """
SELECT * FROM coins ORDER BY rank DESC, coin_id LIMIT 5""")
def head_preview(spark, d):
    """First rows in a stated order."""
    return selection.preview(tb.coins(spark, d), 5, [F.col("rank").desc()])


@query("row_count", with_(COINS) + f"""
SELECT count(*) AS n_rows, count(DISTINCT coin_id) AS n_coins FROM (
  SELECT * FROM coins WHERE rank > 0 AND rank <= {TOP_N}
  UNION ALL
  (SELECT * FROM coins WHERE is_new AND is_active ORDER BY rank, coin_id LIMIT {TOP_N // 2}))""")
def row_count(spark, d):
    """A1 + A3: length of the selection."""
    u = selection.universe(tb.coins(spark, d), TOP_N)
    return u.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("coin_id").alias("n_coins"))


# ---- metadata (customer + orders) ---------------------------------------------------------

def _merged_docs(spark, d):
    return joins.merge_right_wins(tb.meta_docs(spark, d), tb.ticker_docs(spark, d), "id")


@query("meta_ticker_merge", with_(META, TICK) + """
SELECT m.id AS coin_id, m.name, t.symbol, t.rank, m.is_new, t.total_supply, t.max_supply,
       t.last_updated_text AS last_updated, t.price
FROM meta m JOIN tick t ON m.id = t.id""")
def meta_ticker_merge(spark, d):
    """Right (ticker) wins on shared fields, even when its value is NULL."""
    m = _merged_docs(spark, d)
    return m.select(F.col("id").alias("coin_id"), "name", "symbol", "rank", "is_new", "total_supply",
                    "max_supply", "last_updated", quote_field("quotes", "price").alias("price"))


_META_FLAT = with_(META, TICK) + """
SELECT m.id AS coin_id, {name} AS name, {symbol} AS symbol, t.rank, m.is_new, m.is_active,
       {type} AS type, {description} AS description, {started_at} AS started_at,
       {development_status} AS development_status, m.hardware_wallet, {proof_type} AS proof_type,
       {org_structure} AS org_structure, {hash_algorithm} AS hash_algorithm, t.total_supply, t.max_supply,
       t.last_updated, {price} AS price_usd, TRUE AS is_monitored
FROM meta m JOIN tick t ON m.id = t.id"""
_TEXT = ["name", "type", "description", "development_status", "proof_type", "org_structure", "hash_algorithm"]


@query("metadata_flatten", _META_FLAT.format(
    **{c: f"m.{c}" for c in _TEXT}, symbol="t.symbol", started_at="m.started_at", price="t.price"))
def metadata_flatten(spark, d):
    """P1 (+P6 constant, P7 rename, C1 casts, M1 quote, T1 times); missing values stay NULL."""
    return flatten.metadata_rows(_merged_docs(spark, d), defaults=False)


@query("metadata_defaults", _META_FLAT.format(
    **{c: f"coalesce(m.{c}, '')" for c in _TEXT}, symbol="coalesce(t.symbol, '')",
    started_at="coalesce(m.started_at, TIMESTAMP '1970-01-01 00:00:00')", price="coalesce(t.price, 0.0)"))
def metadata_defaults(spark, d):
    """Typed defaults for absent values ('' / 0 / 0.0 / false / epoch start); a present but
    empty time stays NULL, as in the source row builder."""
    return flatten.metadata_rows(_merged_docs(spark, d), defaults=True)


@query("active_coins", with_(META, TICK) + """
SELECT m.id AS coin_id, m.name, t.symbol FROM meta m JOIN tick t ON m.id = t.id WHERE m.is_active""")
def active_coins(spark, d):
    """S8 + F3 + F7 + P5: equality conjunction applied before the projection."""
    from tickvault.sources.files import apply_filters
    rows = flatten.metadata_rows(_merged_docs(spark, d), defaults=False)
    return apply_filters(rows, {"is_monitored": True, "is_active": True}).select("coin_id", "name", "symbol")


@query("missing_ids_anti", with_(META) + """
SELECT DISTINCT id AS coin_id FROM meta WHERE id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events)""")
def missing_ids_anti(spark, d):
    """Coins without stored prices (anti join on distinct ids)."""
    hist = tb.table(spark, d, "events").select(F.col("user_id").cast("string").alias("coin_id"))
    active = tb.meta_docs(spark, d).select(F.col("id").alias("coin_id"))
    return joins.missing_ids(active, hist, "coin_id", "anti")


@query("missing_ids_except", with_(META) + """
SELECT id AS coin_id FROM meta
EXCEPT
SELECT CAST(user_id AS VARCHAR) FROM events""")
def missing_ids_except(spark, d):
    """The same as a set difference."""
    hist = tb.table(spark, d, "events").select(F.col("user_id").cast("string").alias("coin_id"))
    active = tb.meta_docs(spark, d).select(F.col("id").alias("coin_id"))
    return joins.missing_ids(active, hist, "coin_id", "except")


@query("distinct_ids", """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS coin_id FROM events""")
def distinct_ids(spark, d):
    """A2."""
    hist = tb.table(spark, d, "events").select(F.col("user_id").cast("string").alias("coin_id"))
    return aggregate.distinct_ids(hist)


@query("id_exists", with_(META) + """
SELECT m.id AS coin_id, coalesce(h.n, 0) AS n_rows, h.n IS NOT NULL AS exists_flag
FROM meta m LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS coin_id, count(*) AS n FROM events GROUP BY 1) h ON m.id = h.coin_id""")
def id_exists(spark, d):
    """F8 for many ids at once: stored row count per coin (0 = absent)."""
    hist = tb.table(spark, d, "events").select(F.col("user_id").cast("string").alias("coin_id"))
    counts = hist.groupBy("coin_id").agg(F.count(F.lit(1)).alias("n"))
    m = tb.meta_docs(spark, d).select(F.col("id").alias("coin_id"))
    j = m.join(counts, "coin_id", "left")
    return j.select("coin_id", F.coalesce("n", F.lit(0)).alias("n_rows"), F.col("n").isNotNull().alias("exists_flag"))


@query("active_price_join", with_(META, PRICES) + """
SELECT p.coin_id, m.name, p.read_timestamp, p.price FROM meta m JOIN prices p ON m.id = p.coin_id
WHERE m.is_active""")
def active_price_join(spark, d):
    """J5 + W3: monitored, active coins joined with their ticks (the fetch loop as a join)."""
    meta = tb.meta_docs(spark, d).filter(F.col("is_active")).select(F.col("id").alias("coin_id"), "name")
    ticks = flatten.price_points(tb.price_ticks(spark, d))
    return joins.with_prices(meta, ticks).select("coin_id", "name", "read_timestamp", "price")


@query("fillna_strings", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END, 'NA') AS priority,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price,
       coalesce(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END, 'NA') AS status
FROM orders""")
def fillna_strings(spark, d):
    """Fill 'NA' into string columns only; the double keeps its NULLs."""
    o = tb.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("status"))
    return nulls.fill_strings(o, "NA")


TRAILING_DAYS = 7


@query("distinct_trailing", f"""
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events)
SELECT d.date, count(DISTINCT e.user_id) AS n_exact, TRUE AS within_bound
FROM days d JOIN events e ON CAST(e.ts AS DATE) BETWEEN d.date - {TRAILING_DAYS - 1} AND d.date GROUP BY d.date""")
def distinct_trailing(spark, d):
    """A2 over time: coins seen in the seven days up to each day, from daily sketches merged in two batches (one of them
    twice), against the exact number."""
    from tickvault.operators import sketches
    from tickvault.session import scratch_path
    ticks = flatten.price_points(tb.price_ticks(spark, d)).select("coin_id", "read_timestamp")
    path = scratch_path(spark, "sketches")
    odd = F.hour("read_timestamp") % 2 == 1
    for part in (ticks.filter(odd), ticks.filter(~odd), ticks.filter(odd)):
        sketches.add_ticks(part, path)
    estimate = sketches.distinct_trailing(spark, path, TRAILING_DAYS)
    each = ticks.select(F.to_date("read_timestamp").alias("day"), "coin_id").distinct()
    ahead = F.explode(F.sequence(F.col("day"), F.date_add("day", TRAILING_DAYS - 1))).alias("date")
    exact = each.select(ahead, "coin_id").distinct().groupBy("date").agg(F.count(F.lit(1)).alias("n_exact"))
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.greatest(F.lit(1.0), F.col("n_exact") * sketches.ERROR_BOUND)
    return estimate.join(exact, "date").select("date", "n_exact", near.alias("within_bound"))


@query("schema_drift", """
WITH d AS (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value FROM events),
n AS (SELECT count(*) AS all_, count(*) FILTER (WHERE event_type = 'signup') AS signups, count(*) FILTER (WHERE event_type = 'click') AS clicks,
             count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM d)
SELECT path, kind, status, n_docs FROM (
  SELECT '$.id' AS path, 'STRING' AS kind, 'known' AS status, all_ - errors AS n_docs FROM n
  UNION ALL SELECT '$.last_updated', 'STRING', 'known', all_ - errors - clicks FROM n
  UNION ALL SELECT '$.last_updated', 'BIGINT', 'type', clicks FROM n
  UNION ALL SELECT '$.quotes', 'OBJECT', 'known', all_ - errors FROM n
  UNION ALL SELECT '$.quotes.*', 'OBJECT', 'known', all_ - errors FROM n
  UNION ALL SELECT '$.quotes.*.market_cap', 'BIGINT', 'known', all_ - errors FROM n
  UNION ALL SELECT '$.quotes.*.volume_24h', 'BIGINT', 'known', all_ - errors - purchases FROM n
  UNION ALL SELECT '$.quotes.*.volume_24h', 'STRING', 'type', purchases FROM n
  UNION ALL SELECT '$.quotes.*.spread', 'OBJECT', 'new', signups FROM n
  UNION ALL SELECT '$.venue', 'ARRAY', 'new', signups FROM n
  UNION ALL SELECT '$', 'NOT JSON', 'type', errors FROM n) WHERE n_docs > 0""")
def schema_drift(spark, d):
    """What price messages hold against their declared schema, if signups come with new fields, clicks with a
    number as time, purchases with a text as volume and errors cut off."""
    from tickvault import schemas
    from tickvault.sources import drift
    e = tb.table(spark, d, "events")
    k = F.from_json("props", "k BIGINT").k.cast("string")
    is_ = lambda t: F.col("event_type") == t
    volume = F.when(is_("purchase"), F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k)
    spread = F.when(is_("signup"), F.lit(', "spread": {"bid": 1, "ask": 2.5}')).otherwise("")
    time = F.when(is_("click"), F.col("event_id").cast("string")).otherwise(F.lit('"2024-01-01T00:00:00Z"'))
    venue = F.when(is_("signup"), F.lit(', "venue": ["a", {"b": null}]')).otherwise("")
    whole = F.concat(F.lit('{"id": "'), F.col("user_id").cast("string"), F.lit('", "last_updated": '), time, F.lit(', "quotes": {"USD": {"market_cap": 7, "volume_24h": '),
                     volume, spread, F.lit("}}"), venue, F.lit("}"))
    messages = e.select(F.when(is_("error"), F.substring(whole, 1, 20)).otherwise(whole).alias("value"))
    return drift.drift(messages, schemas.PRICE_MESSAGE)


# ---- history (orders) -------------------------------------------------------------------

@query("historic_explode", with_(HISTORY) + """
SELECT coin_id, read_timestamp, CAST(read_timestamp AS DATE) AS date, CAST(hour(read_timestamp) AS INTEGER) AS hour,
       price, volume_24h, market_cap FROM points""")
def historic_explode(spark, d):
    """Array of points -> price rows (a bad point keeps a NULL time)."""
    return flatten.historic_points(tb.history_docs(spark, d))


@query("historic_since", with_(HISTORY) + f"""
SELECT coin_id, read_timestamp, CAST(read_timestamp AS DATE) AS date, CAST(hour(read_timestamp) AS INTEGER) AS hour,
       price, volume_24h, market_cap FROM points
WHERE read_timestamp >= CAST(DATE '{SINCE_ANCHOR}' - INTERVAL {SINCE_DAYS} DAY AS TIMESTAMP)""")
def historic_since(spark, d):
    """S4 + T5: history from ``anchor - 364 days`` on."""
    start = times.days_before(SINCE_ANCHOR, SINCE_DAYS)
    pts = flatten.historic_points(tb.history_docs(spark, d))
    return pts.filter(F.col("read_timestamp") >= start.cast("timestamp_ntz"))


# ---- posts (documents, labels) -----------------------------------------------------------

_SUBMISSION_SQL = """
SELECT CAST(NULL AS VARCHAR) AS coin_id, CAST(id AS VARCHAR) AS submission_id, coalesce(nullif(title, ''), '') AS title,
       CAST(score AS INTEGER) AS score, url, CAST(num_comments AS INTEGER) AS num_comments,
       strftime(make_timestamp(CAST(created_utc AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS created_utc,
       coalesce(nullif(selftext, ''), nullif(title, ''), '') AS selftext, subreddit, author,
       'top' AS sort_type, coalesce(nullif(link_flair_text, ''), '') AS flair
FROM raw_posts"""


@query("submission_flatten", with_(RAW_POSTS) + _SUBMISSION_SQL)
def submission_flatten(spark, d):
    """P4 + X3 + N2 + N3 + T3: raw post -> 12-field submission row."""
    return flatten.submission_rows(tb.raw_posts(spark, d), F.lit(None).cast("string"), search.SORT_TOP)


@query("falsy_default", with_(RAW_POSTS) + """
SELECT id AS doc_id, coalesce(nullif(title, ''), '') AS title,
       coalesce(nullif(selftext, ''), nullif(title, ''), '') AS body,
       title IS NULL AS title_was_null, title = '' AS title_was_empty
FROM raw_posts""")
def falsy_default(spark, d):
    """N2 + N3: ``x or ""`` and ``body or title or ""``."""
    r = tb.raw_posts(spark, d)
    return r.select(F.col("id").alias("doc_id"), nulls.falsy_default("title").alias("title"),
                    nulls.first_non_empty("selftext", "title").alias("body"),
                    F.col("title").isNull().alias("title_was_null"), (F.col("title") == "").alias("title_was_empty"))


def _search_sql(order: str, sort_type: str, where: str = "TRUE") -> str:
    return with_(COINS, POSTS) + f""",
ck AS (SELECT coin_id, keyword, lower(keyword) AS kw FROM (SELECT coin_id, unnest([name, symbol]) AS keyword FROM coins)
       WHERE keyword IS NOT NULL AND keyword <> ''),
kws AS (SELECT DISTINCT kw FROM ck),
pairs AS (SELECT p.submission_id, p.score, p.created_utc, k.kw,
                 CAST(floor((length(lower(p.text)) - length(replace(lower(p.text), k.kw, ''))) / length(k.kw)) AS INTEGER) AS hits
          FROM posts p JOIN kws k ON contains(lower(p.text), k.kw) WHERE {where}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kw ORDER BY {order}, submission_id) AS rank
                        FROM pairs) WHERE rank <= {SEARCH_LIMIT})
SELECT c.coin_id, c.keyword, b.submission_id, b.score, b.created_utc, b.hits, CAST(b.rank AS INTEGER) AS rank,
       '{sort_type}' AS sort_type
FROM best b JOIN ck c ON b.kw = c.kw"""


def _keyword_search(spark, d, sort_type, subreddit="all"):
    out = search.keyword_search(tb.posts(spark, d), tb.coins(spark, d), F.col("text"), SEARCH_LIMIT, sort_type, subreddit)
    return out.select("coin_id", "keyword", "submission_id", "score", "created_utc", "hits", "rank", "sort_type")


@query("keyword_search_topk", _search_sql("score DESC NULLS LAST", "top"))
def keyword_search_topk(spark, d):
    """S5 + F5 + F10 + J3 + O3 + R1 + U4: posts per coin keyword, best ``limit`` by score."""
    return _keyword_search(spark, d, search.SORT_TOP)


@query("keyword_search_hot", _search_sql("created_utc DESC NULLS LAST, score DESC NULLS LAST", "hot"))
def keyword_search_hot(spark, d):
    """O3, the source's default mode: the newest posts per keyword."""
    return _keyword_search(spark, d, search.SORT_HOT)


@query("keyword_search_relevance", _search_sql("hits DESC, score DESC NULLS LAST", "relevance", "p.subreddit = 'src0'"))
def keyword_search_relevance(spark, d):
    """O3 + F10: most occurrences first, in one community."""
    return _keyword_search(spark, d, search.SORT_RELEVANCE, "src0")


@query("search_and_fetch", with_(RAW_POSTS, POSTS) + """,
hits AS (SELECT submission_id, CAST(floor((length(lower(text)) - length(replace(lower(text), 'ring', ''))) / 4) AS INTEGER) AS hits
         FROM posts WHERE contains(lower(text), 'ring') AND created_utc > TIMESTAMP '2024-01-02 00:00:00'
                      AND created_utc < TIMESTAMP '2024-03-01 00:00:00'
         ORDER BY score DESC NULLS LAST, submission_id LIMIT 100)
SELECT CAST(r.id AS VARCHAR) AS submission_id, h.hits, coalesce(nullif(r.title, ''), '') AS title, CAST(r.score AS INTEGER) AS score, r.url,
       CAST(r.num_comments AS INTEGER) AS num_comments,
       strftime(make_timestamp(CAST(r.created_utc AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS created_utc,
       coalesce(nullif(r.selftext, ''), nullif(r.title, ''), '') AS selftext, r.subreddit, r.author, 'top' AS sort_type,
       coalesce(nullif(r.link_flair_text, ''), '') AS flair
FROM hits h JOIN raw_posts r ON h.submission_id = CAST(r.id AS VARCHAR)""")
def search_and_fetch(spark, d):
    """Query + time range + limit, then the full record of each post found."""
    records = flatten.submission_rows(tb.raw_posts(spark, d), F.lit(None).cast("string"), search.SORT_TOP).drop("coin_id")
    return search.search_and_fetch(tb.posts(spark, d), records, "ring", F.col("text"), 100,
                                   after="2024-01-02 00:00:00", before="2024-03-01 00:00:00")


@query("post_lookup", with_(POSTS) + """
SELECT p.submission_id, p.title, p.score, p.created_utc, p.subreddit
FROM (SELECT CAST(doc_id AS VARCHAR) AS submission_id FROM labels WHERE toxic = 1) h
JOIN posts p ON h.submission_id = p.submission_id""")
def post_lookup(spark, d):
    """Ids found elsewhere -> full post records."""
    hits = tb.table(spark, d, "labels").filter(F.col("toxic") == 1) \
        .select(F.col("doc_id").cast("string").alias("submission_id"))
    return joins.lookup(hits, tb.posts(spark, d), "submission_id") \
        .select("submission_id", "title", "score", "created_utc", "subreddit")


@query("time_range_filter", with_(POSTS) + """
SELECT submission_id, created_utc, lang FROM posts
WHERE created_utc > TIMESTAMP '2024-01-10 00:00:00' AND created_utc < TIMESTAMP '2024-02-01 00:00:00'""")
def time_range_filter(spark, d):
    """explicit after / before bounds (parameters, never the wall clock)."""
    p = tb.posts(spark, d)
    return selection.time_range(p, "created_utc", after="2024-01-10 00:00:00", before="2024-02-01 00:00:00") \
        .select("submission_id", "created_utc", "lang")


@query("lang_text_search", with_(POSTS) + """
SELECT submission_id, created_utc, score FROM posts
WHERE lang = 'en' AND contains(lower(text), 'that')
  AND created_utc >= TIMESTAMP '2024-01-05 00:00:00' AND created_utc < TIMESTAMP '2024-03-01 00:00:00'
ORDER BY created_utc DESC, submission_id LIMIT 100""")
def lang_text_search(spark, d):
    """S7 + F9 + O4: query text, language, since/until, at most n results (newest first)."""
    return search.text_search(tb.posts(spark, d), "That", "en", F.col("text"), 100, since="2024-01-05 00:00:00",
                              until="2024-03-01 00:00:00").select("submission_id", "created_utc", "score")


@query("index_projection", with_(RAW_POSTS) + """
SELECT CAST(NULL AS VARCHAR) AS coin_id, upper(lang) AS symbol, coalesce(nullif(title, ''), '') AS title,
       coalesce(nullif(selftext, ''), nullif(title, ''), '') AS selftext, CAST(score AS INTEGER) AS score,
       CAST(num_comments AS INTEGER) AS num_comments, make_timestamp(CAST(created_utc AS BIGINT) * 1000000) AS created_utc,
       CAST(NULL AS FLOAT) AS sentiment_score
FROM raw_posts""")
def index_projection(spark, d):
    """K6 + K8: the typed 8-field search-index row of each stored post."""
    raw = tb.raw_posts(spark, d)
    subs = flatten.submission_rows(raw, F.lit(None).cast("string"), search.SORT_TOP)
    return flatten.index_rows(subs, F.upper("flair"))      # the flair holds the post's language


@query("tweet_flatten", """
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS tweet_id,
       strftime(TIMESTAMP '2010-01-01 00:00:00' + to_hours(conv_id) + to_minutes(turn), '%Y-%m-%d %H:%M:%S') AS created_at,
       text, role AS "user", CAST(conv_id AS VARCHAR) AS user_id, CAST(turn * 10 AS INTEGER) AS user_followers_count,
       role = 'assistant' AS user_verified, CAST(length(text) AS INTEGER) AS retweet_count,
       CAST(turn AS INTEGER) AS favorite_count,
       array_to_string(string_split(text, ' '), '|') AS hashtags, 'conv' AS coin, upper(role) AS symbol,
       'https://twitter.com/' || role || '/status/' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS tweet_url,
       'en' AS lang, turn > 0 AS is_retweet
FROM conversations""")
def tweet_flatten(spark, d):
    """P10 + T4 + X2 + R2 + B3 (arrays compared as joined text)."""
    t = flatten.tweet_rows(tb.raw_tweets(spark, d))
    return t.withColumn("hashtags", F.array_join("hashtags", "|"))


# ---- holes in histories, recursive indicators (events) ----------------------------------------

GAP_START, GAP_END, GAP_STEP = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "6 hours"
_BUCKETS = f"""
ids AS (SELECT DISTINCT id AS coin_id FROM meta),
have AS (SELECT DISTINCT coin_id, time_bucket(INTERVAL {GAP_STEP}, read_timestamp, TIMESTAMP '1970-01-01') AS b FROM prices)"""


@query("missing_ranges", with_(META, PRICES).rstrip() + "," + _BUCKETS + f""",
grid AS (SELECT coin_id, unnest(generate_series(TIMESTAMP '{GAP_START}', TIMESTAMP '{GAP_END}' - INTERVAL {GAP_STEP}, INTERVAL {GAP_STEP})) AS b FROM ids),
holes AS (SELECT coin_id, b, row_number() OVER (PARTITION BY coin_id ORDER BY b) AS n FROM grid ANTI JOIN have USING (coin_id, b))
SELECT coin_id, min(b) AS from_ts, max(b) + INTERVAL {GAP_STEP} AS to_ts, count(*) AS n_missing
FROM holes GROUP BY coin_id, b - n * INTERVAL {GAP_STEP}""")
def missing_ranges(spark, d):
    """A4 + W2: the maximal ranges of intervals without a stored price, of every coin."""
    from tickvault.operators import gaps
    ids = tb.meta_docs(spark, d).select(F.col("id").alias("coin_id"))
    return gaps.missing_ranges(ids, flatten.price_points(tb.price_ticks(spark, d)), GAP_START, GAP_END, GAP_STEP)


@query("resample_filled", with_(PRICES) + f""",
bars AS (SELECT coin_id, time_bucket(INTERVAL {GAP_STEP}, read_timestamp, TIMESTAMP '1970-01-01') AS bucket_start,
                arg_max(price, read_timestamp) AS price FROM prices GROUP BY 1, 2),
grid AS (SELECT coin_id, unnest(generate_series(min(bucket_start), max(bucket_start), INTERVAL {GAP_STEP})) AS bucket_start FROM bars GROUP BY coin_id)
SELECT g.coin_id, g.bucket_start, b.price, b.bucket_start <> g.bucket_start AS is_filled
FROM grid g ASOF JOIN bars b ON g.coin_id = b.coin_id AND g.bucket_start >= b.bucket_start""")
def resample_filled(spark, d):
    """A4: one price per coin and interval, gaps filled by the last one before."""
    from tickvault.operators import gaps
    rows = flatten.price_points(tb.price_ticks(spark, d))
    bars = aggregate.resample_last(rows, "coin_id", "read_timestamp", ["price"], GAP_STEP)
    return gaps.filled(bars, ["price"], GAP_STEP)


@query("price_trend", "WITH RECURSIVE " + PRICES + f""",
t AS (SELECT coin_id, read_timestamp, price, row_number() OVER (PARTITION BY coin_id ORDER BY read_timestamp, event_id) AS n FROM prices),
r AS (SELECT coin_id, read_timestamp, price, n, price AS f, price AS s, CAST(0 AS DOUBLE) AS g, CAST(0 AS DOUBLE) AS l, CAST(0 AS DOUBLE) AS m FROM t WHERE n = 1
      UNION ALL
      SELECT t.coin_id, t.read_timestamp, t.price, t.n, f + 2.0::DOUBLE / 13 * (t.price - f), s + 2.0::DOUBLE / 27 * (t.price - s),
             g + 1.0::DOUBLE / 14 * (greatest(t.price - r.price, 0) - g), l + 1.0::DOUBLE / 14 * (greatest(r.price - t.price, 0) - l),
             m + 0.2::DOUBLE * ((f + 2.0::DOUBLE / 13 * (t.price - f)) - (s + 2.0::DOUBLE / 27 * (t.price - s)) - m)
      FROM r JOIN t ON t.coin_id = r.coin_id AND t.n = r.n + 1)
SELECT coin_id, read_timestamp, price, round(f, 6) AS ema_fast, round(s, 6) AS ema_slow, round(f - s, 6) AS macd, round(m, 6) AS macd_signal,
       round(CASE WHEN g + l > 0 THEN 100 * g / (g + l) END, 6) AS rsi
FROM r""")
def price_trend(spark, d):
    """§2.14 recursive indicators over every tick: EMA 12 / 26, MACD with signal, RSI 14."""
    from tickvault.operators import recurrence
    rows = flatten.price_points(tb.price_ticks(spark, d), carry=("event_id",)).select("coin_id", "read_timestamp", "price", "event_id")
    out = recurrence.trend(rows, tie=["event_id"], block="7 days")
    return out.select("coin_id", "read_timestamp", "price", *[F.round(c, 6).alias(c) for c in ("ema_fast", "ema_slow", "macd", "macd_signal", "rsi")])


# ---- relevance (documents, benchmark) --------------------------------------------------------

RELEVANT = 10


@query("search_bm25", r"""
WITH words AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lens AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
size AS (SELECT count(*) AS posts, avg(n) AS mean FROM lens),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS term FROM benchmark),
scored AS (SELECT a.query_id, t.doc_id, round(sum(ln(1 + (z.posts - d.df + 0.5::DOUBLE) / (d.df + 0.5::DOUBLE))
                  * (t.tf * 2.2::DOUBLE / (t.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * l.n / z.mean)))), 6) AS score
           FROM asked a JOIN df d USING (term) JOIN tf t USING (term) JOIN lens l ON l.doc_id = t.doc_id CROSS JOIN size z GROUP BY 1, 2)
SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored)
WHERE rank <= """ + str(RELEVANT))
def search_bm25(spark, d):
    """O3 + K6: a stored inverted index, filled in two merges (every third post first with its first line only,
    then as it is), searched with every benchmark item: the posts that BM25 ranks first."""
    from tickvault.session import scratch_path
    from tickvault.sinks import text_index
    posts = tb.posts(spark, d).select("submission_id", "title", "text")
    third = F.col("submission_id").cast("long") % 3 == 0
    path = scratch_path(spark, "text-index")
    text_index.update_index(posts.withColumn("text", F.when(third, F.col("title")).otherwise(F.col("text"))), path, text="text")
    text_index.update_index(posts.filter(third), path, text="text")
    return text_index.bm25_search(spark, path, tb.table(spark, d, "benchmark"), RELEVANT, query_id="item_id")


_NEGATIONS = "['" + "', '".join(["not", "no", "never", "none", "nothing", "neither", "nor", "without", "cannot", "nicht", "kein", "keine", "nie", "ne", "pas",
                                 "jamais", "sans", "nunca", "ni", "sin"]) + "']"


@query("post_sentiment", r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
marks AS (SELECT doc_id, max(toxic) = 0 AS positive FROM labels WHERE toxic IS NOT NULL GROUP BY doc_id),
seen AS (SELECT DISTINCT doc_id, positive, unnest(w) AS term FROM docs JOIN marks USING (doc_id)),
counts AS (SELECT term, CAST(count(*) FILTER (WHERE positive) AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE NOT positive) AS DOUBLE) AS n FROM seen GROUP BY term),
total AS (SELECT sum(p) AS tp, sum(n) AS tn, count(*) AS v FROM counts),
odds AS (SELECT term, p, n, ln((p + 0.5::DOUBLE) / (tp + 0.5::DOUBLE * v)) - ln((n + 0.5::DOUBLE) / (tn + 0.5::DOUBLE * v)) AS weight FROM counts, total),
lexicon AS (SELECT term, weight FROM odds WHERE abs(weight / sqrt(1 / (p + 0.5::DOUBLE) + 1 / (n + 0.5::DOUBLE))) >= 2),
tok AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS i, w FROM docs),
hits AS (SELECT doc_id, weight * CASE WHEN list_has_any(w[greatest(i - 3, 1):i - 1], """ + _NEGATIONS + r""") THEN -1 ELSE 1 END AS x FROM tok JOIN lexicon USING (term)),
means AS (SELECT doc_id, sum(x) / count(*) AS m, count(*) AS n_terms FROM hits GROUP BY doc_id)
SELECT CAST(d.doc_id AS VARCHAR) AS submission_id, coalesce(round(m / (1 + abs(m)), 5), 0) AS sentiment_score, coalesce(n_terms, 0) AS n_terms
FROM docs d LEFT JOIN means USING (doc_id)""")
def post_sentiment(spark, d):
    """§2.14 / K8: every post's score by the lexicon that the labelled posts give (toxic ones are negative)."""
    from tickvault.operators import sentiment
    posts = tb.posts(spark, d).select("submission_id", "text")
    marks = tb.table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("submission_id"), (F.col("toxic") == 0).alias("positive"))
    return sentiment.score(posts, sentiment.learn(posts, marks))


# ---- JSON messages (conversations) -------------------------------------------------------

MESSAGE_TURNS = 8   # a message carries at most this many turns of one conversation


@query("json_array_explode", """
SELECT conv_id, turn, role, text FROM conversations""")
def json_array_explode(spark, d):
    """B1 + ST2: array messages (<= 8 turns each) -> one row per element."""
    from tickvault.streaming.messages import array_messages, explode_messages
    c = tb.table(spark, d, "conversations")
    msgs = array_messages(c, ["conv_id"], "turn", MESSAGE_TURNS)
    schema = "array<struct<conv_id:bigint,turn:bigint,role:string,text:string>>"
    return explode_messages(msgs, schema).select("conv_id", "turn", "role", "text")


@query("json_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")
def json_roundtrip(spark, d):
    """B2 + K7: to_json(struct) -> from_json is the identity."""
    from tickvault.sources.kafka import json_value
    c = tb.table(spark, d, "conversations")
    v = json_value(c)
    return v.select(F.from_json("value", c.schema).alias("m")).select("m.*")


# ---- writers, jobs and streams (defined in their modules, registered here) ---------------

def _register_late():
    from tickvault.plans import jobs
    from tickvault.streaming import ingest, live
    for name, fn, sql in [
        ("upsert_latest", jobs.upsert_latest, jobs.UPSERT_LATEST_SQL),
        ("job_metadata", jobs.job_metadata, jobs.JOB_METADATA_SQL),
        ("job_backfill", jobs.job_backfill, jobs.JOB_BACKFILL_SQL),
        ("job_fill_gaps", jobs.job_fill_gaps, jobs.JOB_FILL_GAPS_SQL),
        ("job_price_refresh", jobs.job_price_refresh, jobs.JOB_PRICE_REFRESH_SQL),
        ("job_posts", jobs.job_posts, jobs.JOB_POSTS_SQL),
        ("stream_price_ingest", ingest.stream_price_ingest, ingest.STREAM_PRICE_SQL),
        ("stream_price_order", ingest.stream_price_order, ingest.STREAM_PRICE_SQL),
        ("stream_quarantine", ingest.stream_quarantine, ingest.STREAM_QUARANTINE_SQL),
        ("stream_distinct_messages", live.stream_distinct_messages, live.STREAM_DISTINCT_SQL),
        ("stream_live_bars", live.stream_live_bars, live.STREAM_BARS_SQL),
        ("stream_post_prices", live.stream_post_prices, live.STREAM_PAIRS_SQL),
        ("stream_posts_ingest", ingest.stream_posts_ingest, ingest.STREAM_POSTS_SQL),
    ]:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql


def registry() -> tuple[dict, dict]:
    if "upsert_latest" not in QUERIES:
        _register_late()
    return QUERIES, ORACLE

