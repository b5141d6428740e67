"""Jobs W1, W2 and W4 end to end from landed JSON documents (the production input shape)."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tickvault import schemas
from tickvault.operators import flatten, joins, search
from tickvault.plans import jobs
from tickvault.sources import files

COINS = [{"id": "btc-bitcoin", "name": "Bitcoin", "symbol": "BTC", "rank": 1, "is_new": False, "is_active": True},
         {"id": "eth-ethereum", "name": "Ethereum", "symbol": "ETH", "rank": 2, "is_new": False, "is_active": True},
         {"id": "new-coin", "name": "Newcoin", "symbol": "NEW", "rank": 0, "is_new": True, "is_active": True},
         {"id": "old-coin", "name": "Oldcoin", "symbol": "OLD", "rank": 50, "is_new": False, "is_active": False}]


def _land(tmp, name, docs, one_array=False):
    p = os.path.join(tmp, name)
    os.makedirs(p, exist_ok=True)
    if one_array:
        with open(os.path.join(p, "list.json"), "w") as f:
            json.dump(docs, f, indent=1)
    else:
        for i, d in enumerate(docs):
            with open(os.path.join(p, f"{i}.json"), "w") as f:
                json.dump(d, f, indent=1)
    return p


def test_coin_list_scan_is_a_json_array(spark, tmpdir_path):
    coins = files.read_coin_list(spark, _land(tmpdir_path, "coins", COINS, one_array=True))
    assert coins.count() == 4 and coins.schema == schemas.COIN_LIST


def test_metadata_backfill_and_posts_jobs(spark, tmpdir_path):
    coins = files.read_coin_list(spark, _land(tmpdir_path, "coins", COINS, one_array=True)) \
        .withColumnRenamed("id", "coin_id")
    meta_dir = _land(tmpdir_path, "meta", [{"id": c["id"], "name": c["name"], "symbol": c["symbol"],
                                            "rank": c["rank"]} for c in COINS])
    # an older fetch of bitcoin's metadata landed earlier in the same folder: the newer one wins
    with open(os.path.join(meta_dir, "old.json"), "w") as f:
        json.dump({"id": "btc-bitcoin", "name": "Old name", "symbol": "BTC", "rank": 1}, f)
    os.utime(os.path.join(meta_dir, "old.json"), (1_000_000_000, 1_000_000_000))
    meta = files.read_meta(spark, meta_dir, landed_at=True)
    tick = files.read_tickers(spark, _land(tmpdir_path, "tick", [
        {"id": c["id"], "name": c["name"], "symbol": c["symbol"], "rank": c["rank"],
         "last_updated": "2024-05-01T10:00:00Z",
         "quotes": {"USD": {"price": 1.0 + i, "volume_24h": 5, "market_cap": 7}}} for i, c in enumerate(COINS)]))
    meta_path, price_path, q_path = (f"{tmpdir_path}/{n}" for n in ("meta_t", "price_t", "quar"))

    # Top-2 by rank plus the best new coin; the inactive rank-50 coin is not loaded
    jobs.load_metadata(coins, meta, tick, meta_path, n=2)
    stored = {r.coin_id: r for r in spark.read.parquet(meta_path).collect()}
    assert sorted(stored) == ["btc-bitcoin", "eth-ethereum", "new-coin"]
    assert stored["btc-bitcoin"].price_usd == 1.0 and stored["btc-bitcoin"].is_monitored
    assert stored["btc-bitcoin"].name == "Bitcoin"

    # Btc already has prices; eth and new-coin get their landed history
    flatten_btc = flatten.price_points(tick.filter("id = 'btc-bitcoin'"))
    from tickvault.sinks.merge import upsert
    upsert(flatten_btc, price_path, schemas.PRICE_KEY, schemas.PRICE_TABLE, schemas.PRICE_PARTITION)
    hist_dir = os.path.join(tmpdir_path, "hist")
    os.makedirs(hist_dir)
    with open(os.path.join(hist_dir, "h.json"), "w") as f:
        for c in ["btc-bitcoin", "eth-ethereum", "new-coin"]:
            f.write(json.dumps({"coin_id": c, "points": [
                {"timestamp": "2024-04-01T00:00:00Z", "price": 10, "volume_24h": 1, "market_cap": 2},
                {"timestamp": "", "price": 11, "volume_24h": 1, "market_cap": 2}]}) + "\n")
    monitored = spark.read.parquet(meta_path).filter("is_monitored").select("coin_id")
    jobs.backfill(monitored, files.read_historic(spark, hist_dir), price_path, q_path)
    prices = sorted((r.coin_id, r.read_timestamp) for r in spark.read.parquet(price_path).collect())
    assert prices == [("btc-bitcoin", dt.datetime(2024, 5, 1, 10)), ("eth-ethereum", dt.datetime(2024, 4, 1)),
                      ("new-coin", dt.datetime(2024, 4, 1))]
    bad = spark.read.parquet(q_path).collect()            # the empty-timestamp points of eth and new-coin
    assert sorted((json.loads(r.payload)["coin_id"], json.loads(r.payload)["point"]["price"]) for r in bad) == [("eth-ethereum", 11.0), ("new-coin", 11.0)]

    # Posts for monitored coins, stored once per (coin, post) even when both keywords hit
    posts = spark.createDataFrame(
        [("p1", "Bitcoin BTC rally", 10, dt.datetime(2024, 1, 1), "crypto"),
         ("p2", "ethereum news", 3, dt.datetime(2024, 1, 2), "crypto")],
        "submission_id string, text string, score int, created_utc timestamp_ntz, subreddit string")
    records = posts.select("submission_id", F.lit("t").alias("title"), "score", F.lit("").alias("url"),
                           F.lit(0).alias("num_comments"), F.lit("2024-01-01T00:00:00Z").alias("created_utc"),
                           F.col("text").alias("selftext"), "subreddit", F.lit(None).cast("string").alias("author"),
                           F.lit("").alias("flair"))
    coins_kw = spark.read.parquet(meta_path).select("coin_id", "name", "symbol")
    post_path = f"{tmpdir_path}/posts_t"
    jobs.load_posts(coins_kw, posts, records, post_path, limit=10, sort_type=search.SORT_TOP)
    got = sorted((r.coin_id, r.submission_id) for r in spark.read.parquet(post_path).collect())
    jobs.load_posts(coins_kw, posts, records, post_path + "2", limit=10, since="2024-01-01 12:00:00", until="2024-01-03 00:00:00")
    assert {r.submission_id for r in spark.read.parquet(post_path + "2").collect()} == {"p2"}
    # 'news' holds 'new' (substring match, as in the source search): new-coin finds p2 too
    assert got == [("btc-bitcoin", "p1"), ("eth-ethereum", "p2"), ("new-coin", "p2")]


def test_backfill_from_a_start_date_and_interval(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "hist")
    os.makedirs(p)
    points = [{"timestamp": f"2024-04-0{d}T{h:02d}:00:00Z", "price": d * 100 + h} for d in (1, 2, 3) for h in (0, 5, 23)]
    with open(os.path.join(p, "h.json"), "w") as f:
        f.write(json.dumps({"coin_id": "a", "points": points}) + "\n")
    path = f"{tmpdir_path}/prices"
    jobs.backfill(spark.createDataFrame([("a",)], "coin_id string"), files.read_historic(spark, p), path, f"{tmpdir_path}/q",
                  start_date="2024-04-02", interval="1d")
    assert sorted(r.price for r in spark.read.parquet(path).collect()) == [223.0, 323.0]
    assert files.read_historic(spark, p, since="2024-04-03", interval="12h").count() == 2


def test_hourly_price_refresh_from_landed_tickers(spark, tmpdir_path):
    tick = files.read_tickers(spark, _land(tmpdir_path, "tick", [
        {"id": "btc-bitcoin", "last_updated": "2024-05-01T10:00:00Z", "quotes": {"USD": {"price": 60000.5}}},
        {"id": "eth-ethereum", "last_updated": "2024-05-01T10:00:00Z", "quotes": {"EUR": {"price": 3000.0}}},
        {"id": "old-coin", "last_updated": "2024-05-01T10:00:00Z", "quotes": {"USD": {"price": 1.0}}}]))
    monitored = spark.createDataFrame([("btc-bitcoin",), ("eth-ethereum",)], "coin_id string")
    path, quarantine = f"{tmpdir_path}/prices", f"{tmpdir_path}/quar"
    jobs.refresh_prices(monitored, tick, path, quarantine)
    jobs.refresh_prices(monitored, tick, path, quarantine)          # the next run re-reads the same landing
    got = [(r.coin_id, r.price, r.hour) for r in spark.read.parquet(path).collect()]
    assert got == [("btc-bitcoin", 60000.5, 10)]                       # old-coin not monitored, eth has no USD
    bad = spark.read.schema(schemas.QUARANTINE).parquet(quarantine).collect()
    assert [(r.source, r.reason) for r in bad] == [("tickers", "missing USD quote")]       # once, though the job ran twice
    assert json.loads(bad[0].payload)["quotes"]["EUR"]["price"] == 3000.0                 # the document as it landed


def test_pairs_of_coin_and_post_travel_without_the_post(spark, tmpdir_path, monkeypatch):
    """The rows that a shuffle lays out for the write have no text (before, every coin's row carried it); of several
    versions of a record the last one is stored, and a later load replaces it."""
    from tickvault.sinks import merge
    laid_out, real = [], merge._layout
    monkeypatch.setattr(merge, "_layout", lambda df, *args, **kw: (laid_out.append(df.columns), real(df, *args, **kw))[1])
    posts = spark.createDataFrame([("p1", "red bolt", 1, dt.datetime(2024, 1, 1), "s"), ("p2", "a bolt", 2, dt.datetime(2024, 1, 2), "s")],
                                  "submission_id string, text string, score int, created_utc timestamp_ntz, subreddit string")
    coins = spark.createDataFrame([(str(i), "red bolt", "BOLT") for i in range(50)] + [("7", "red bolt", "BOLT")], "coin_id string, name string, symbol string")

    def records(*versions):
        rows = spark.createDataFrame(list(versions), "submission_id string, event_id long, title string, created_utc string")
        return rows.select("*", F.lit(1).alias("score"), F.lit("").alias("url"), F.lit(0).alias("num_comments"), F.concat("title", F.lit(" body")).alias("selftext"),
                           F.lit("s").alias("subreddit"), F.lit(None).cast("string").alias("author"), F.lit("").alias("flair"))

    def stored():
        rows = spark.read.schema(schemas.POST_TABLE).parquet(f"{tmpdir_path}/posts").collect()
        return sorted((int(r.coin_id), r.submission_id, r.title, r.selftext) for r in rows)
    jobs.load_posts(coins, posts, records(("p1", 1, "old", "2024-01-01T00:00:00Z"), ("p1", 2, "new", "2024-01-01T00:00:00Z"), ("p2", 1, "b", "2024-01-02T00:00:00Z"),
                                          ("other", 1, "x", "2024-01-02T00:00:00Z")), f"{tmpdir_path}/posts")
    assert stored() == sorted((i, p, t, f"{t} body") for i in range(50) for p, t in (("p1", "new"), ("p2", "b")))
    assert laid_out and all("selftext" not in columns for columns in laid_out)
    jobs.load_posts(coins, posts, records(("p1", 1, "late", "2024-01-01T00:00:00Z"), ("p2", 2, "c", "2024-01-02T00:00:00Z")), f"{tmpdir_path}/posts")
    assert stored() == sorted((i, p, t, f"{t} body") for i in range(50) for p, t in (("p1", "new"), ("p2", "c")))
    monkeypatch.setattr(merge, "BROADCAST_BYTES", 0)                          # records too large to broadcast
    jobs.load_posts(coins, posts, records(("p1", 1, "a", "2024-01-01T00:00:00Z"), ("p2", 1, "b", "2024-01-02T00:00:00Z")), f"{tmpdir_path}/posts2")
    assert spark.read.parquet(f"{tmpdir_path}/posts2").filter("selftext IS NOT NULL").count() == 100
