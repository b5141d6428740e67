import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tickvault import schemas
from tickvault.operators import flatten, joins
from tickvault.sources import files

# FIXTURES edge rows, written as landed JSON documents
META_DOC = {"id": "usdz-usdz", "name": "USDZ", "symbol": "USDZ", "rank": 900, "is_new": False, "is_active": True,
            "type": "token", "contracts": [{"contract": "0xabc", "platform": "eth", "type": "ERC20"}],
            "parent": {"id": "p", "name": "P", "symbol": "P"}, "tags": [], "team": [],
            "description": "stable", "started_at": None, "development_status": None, "hardware_wallet": False,
            "proof_type": None, "org_structure": "Centralized", "hash_algorithm": "",
            "links": {"website": ["https://example.org"]}, "whitepaper": {"link": None, "thumbnail": None}}
META_DOC2 = {"id": "qpx-quipux", "name": "Quipux", "symbol": "QPX", "rank": 77, "is_new": True, "is_active": False,
             "type": "token", "started_at": "2031-07-09T00:00:00Z", "development_status": "Only a draft",
             "hardware_wallet": True, "proof_type": "Proof of Knots", "org_structure": "Village council",
             "hash_algorithm": "", "links_extended": [{"url": "https://x", "type": "website"}]}
TICK_USDZ = {"id": "usdz-usdz", "name": "USDZ", "symbol": "USDZ", "rank": 901, "total_supply": 100, "max_supply": 0,
             "beta_value": 0.1, "last_updated": "2024-10-01T12:00:05Z",
             "quotes": {"USD": {"price": 1.0001, "volume_24h": 12345.5, "market_cap": 100}}}
TICK_QPX = {"id": "qpx-quipux", "name": "Quipux", "symbol": None, "rank": 77, "total_supply": 5, "max_supply": 9,
            "last_updated": "", "quotes": {"EUR": {"price": 140.0}}}


def _land(tmp, name, docs):
    p = os.path.join(tmp, name)
    os.makedirs(p, exist_ok=True)
    for i, d in enumerate(docs):
        with open(os.path.join(p, f"{i}.json"), "w") as f:
            json.dump(d, f, indent=2)          # multi-line documents, one per file
    return p


def test_scan_meta_and_tickers_with_declared_schema(spark, tmpdir_path):
    meta = files.read_meta(spark, _land(tmpdir_path, "meta", [META_DOC, META_DOC2]))
    tick = files.read_tickers(spark, _land(tmpdir_path, "tick", [TICK_USDZ, TICK_QPX]))
    assert meta.schema == schemas.META and tick.schema == schemas.TICKER
    assert meta.count() == 2 and tick.count() == 2
    r = meta.filter("id = 'qpx-quipux'").first()
    assert r["contracts"] is None and r["parent"] is None       # missing optional fields -> NULL


def test_metadata_row_builder_defaults_and_right_wins(spark, tmpdir_path):
    meta = files.read_meta(spark, _land(tmpdir_path, "meta", [META_DOC, META_DOC2]))
    tick = files.read_tickers(spark, _land(tmpdir_path, "tick", [TICK_USDZ, TICK_QPX]))
    merged = joins.merge_right_wins(meta, tick, "id")
    rows = {r["coin_id"]: r for r in flatten.metadata_rows(merged, defaults=True).collect()}
    usdz, qpx = rows["usdz-usdz"], rows["qpx-quipux"]
    assert usdz["rank"] == 901                                   # ticker wins
    assert usdz["started_at"] == dt.datetime(1970, 1, 1)         # absent -> epoch default
    assert usdz["development_status"] == "" and usdz["proof_type"] == ""
    assert usdz["max_supply"] == 0 and usdz["price_usd"] == 1.0001
    assert usdz["last_updated"] == dt.datetime(2024, 10, 1, 12, 0, 5)
    assert qpx["symbol"] == ""                                   # ticker NULL wins, then default
    assert qpx["last_updated"] is None                           # present but empty -> NULL
    assert qpx["price_usd"] == 0.0                               # no USD quote -> default
    assert qpx["started_at"] == dt.datetime(2031, 7, 9)
    assert all(r["is_monitored"] for r in rows.values())
    strict = {r["coin_id"]: r for r in flatten.metadata_rows(merged, defaults=False).collect()}
    assert strict["usdz-usdz"]["started_at"] is None and strict["qpx-quipux"]["price_usd"] is None


def test_price_points_and_problems(spark, tmpdir_path):
    tick = files.read_tickers(spark, _land(tmpdir_path, "tick", [TICK_USDZ, TICK_QPX]))
    rows = flatten.price_points(tick).withColumn("problem", flatten.price_row_problem())
    got = {r["coin_id"]: r for r in rows.collect()}
    u = got["usdz-usdz"]
    assert (u["date"], u["hour"], u["price"], u["market_cap"]) == (dt.date(2024, 10, 1), 12, 1.0001, 100.0)
    assert u["problem"] is None
    assert got["qpx-quipux"]["problem"] == "missing or bad last_updated"


def test_historic_explode_mixed_int_and_float_volumes(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "hist")
    os.makedirs(p)
    with open(os.path.join(p, "h.json"), "w") as f:
        f.write(json.dumps({"coin_id": "btc-bitcoin", "points": [
            {"timestamp": "2024-01-01T00:00:00Z", "price": 42000.5, "volume_24h": 123, "market_cap": 800000000000},
            {"timestamp": "2024-01-02T00:00:00Z", "price": 43000, "volume_24h": 456.25, "market_cap": 1.5}]}) + "\n")
    pts = files.read_historic(spark, p)
    assert dict(pts.dtypes)["volume_24h"] == "double"
    assert [r["volume_24h"] for r in pts.orderBy("read_timestamp").collect()] == [123.0, 456.25]
    assert files.read_historic(spark, p, since="2024-01-02").count() == 1


def test_submission_rows_edges(spark):
    raw = spark.createDataFrame(
        [("a1", None, 5, None, 2, 1704067200, None, "btc", None, None),
         ("a2", "Title", 1, "u", 0, 1704067261, "", "btc", "bob", "News")],
        "id string, title string, score int, url string, num_comments int, created_utc long, selftext string, "
        "subreddit string, author string, link_flair_text string")
    rows = {r["submission_id"]: r for r in flatten.submission_rows(raw, F.lit("btc-bitcoin"), "hot").collect()}
    assert rows["a1"]["title"] == "" and rows["a1"]["selftext"] == "" and rows["a1"]["author"] is None
    assert rows["a1"]["url"] == "" and rows["a1"]["flair"] == ""
    assert rows["a2"]["selftext"] == "Title" and rows["a2"]["created_utc"] == "2024-01-01T00:01:01Z"
    assert rows["a2"]["sort_type"] == "hot" and rows["a2"]["coin_id"] == "btc-bitcoin"


def test_notebook_schema_path(spark):
    rec = [("qpx", "Quipux", "QPX", 77, False, True, "token", None, "2031-07-09T00:00:00Z", None, False, "PoK",
            None, "KNOT7", 5, 9, "2032-01-01T00:00:00Z", {"USD": {"price": "3.25"}})]
    df = files.frame_from_records(spark, rec, schemas.NOTEBOOK)
    r = flatten.notebook_rows(df).first()
    assert r["price_usd"] == 3.25 and r["description"] == "NA" and r["org_structure"] == "NA"
    assert r["started_at"] == dt.datetime(2031, 7, 9) and len(r) == 18
