import datetime as dt

from pyspark.sql import functions as F

from tickvault.operators import search
from tickvault.operators.topn import top_n_per_group

POSTS = [("p1", "Bitcoin to the moon", 10, dt.datetime(2024, 1, 1), "all1"),
         ("p2", "bitcoin bitcoin btc", 5, dt.datetime(2024, 1, 3), "crypto"),
         ("p3", "ether and BTC", 7, dt.datetime(2024, 1, 2), "crypto"),
         ("p4", "nothing here", 9, dt.datetime(2024, 1, 4), "crypto")]
PSCHEMA = "submission_id string, text string, score int, created_utc timestamp_ntz, subreddit string"
COINS = [("btc-bitcoin", "Bitcoin", "BTC"), ("eth-ethereum", "Ethereum", "ETH"), ("wbtc", "Wrapped", "BTC")]


def _run(spark, **kw):
    posts = spark.createDataFrame(POSTS, PSCHEMA)
    coins = spark.createDataFrame(COINS, "coin_id string, name string, symbol string")
    out = search.keyword_search(posts, coins, F.col("text"), **kw)
    return sorted((r.coin_id, r.keyword, r.submission_id, r.rank) for r in out.collect())


def test_keyword_search_top_limit_and_shared_keywords(spark):
    got = _run(spark, limit=2, sort_type=search.SORT_TOP)
    assert ("btc-bitcoin", "Bitcoin", "p1", 1) in got and ("btc-bitcoin", "Bitcoin", "p2", 2) in got
    assert ("btc-bitcoin", "BTC", "p1", 1) not in got           # 'btc' is not inside 'bitcoin to the moon'
    assert ("btc-bitcoin", "BTC", "p3", 1) in got and ("wbtc", "BTC", "p3", 1) in got   # shared keyword fans out
    assert {g[1] for g in got if g[0] == "eth-ethereum"} == {"ETH"}   # 'ether' holds 'eth', not 'ethereum'


def test_sort_modes(spark):
    hot = _run(spark, limit=1, sort_type=search.SORT_HOT)
    rel = _run(spark, limit=1, sort_type=search.SORT_RELEVANCE)
    assert ("btc-bitcoin", "Bitcoin", "p2", 1) in hot            # newest first
    assert ("btc-bitcoin", "Bitcoin", "p2", 1) in rel            # two occurrences


def test_subreddit_filter(spark):
    got = _run(spark, limit=5, subreddit="crypto")
    assert "p1" not in {g[2] for g in got}


def test_salted_top_n_equals_plain(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("sid"),
                                     ((F.col("id") * 7919) % 1000).alias("score"))
    order = [F.col("score").desc(), F.col("sid")]
    a = top_n_per_group(df, ["g"], order, 25, salt_on=["sid"], salt_buckets=16)
    b = top_n_per_group(df, ["g"], order, 25)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_thousand_keywords_equal_contains(spark):
    """Any number of keywords, of any length, next to plain ``contains``; scores keep their type."""
    import random
    random.seed(4)
    alphabet = "abcdeé "
    texts = [(f"p{i}", "".join(random.choice(alphabet) for _ in range(random.randint(0, 120))), 2**53 + 1 if i % 2 else None) for i in range(60)]
    texts += [("none", None, 1), ("short", "ab", 1)]
    words = sorted({"".join(random.choice("abcdeé") for _ in range(random.randint(1, 9))) for _ in range(1400)})[:1000]
    posts = spark.createDataFrame(texts, "submission_id string, text string, score long")
    kws = spark.createDataFrame([(w,) for w in words], "kw string")
    got = search.keyword_pairs(posts, F.col("text"), kws).select("submission_id", "kw", "score").collect()
    assert sorted((r.submission_id, r.kw) for r in got) == sorted((i, w) for i, t, _ in texts for w in words if t is not None and w in t)
    assert {r.score for r in got} <= {2**53 + 1, None, 1} and len(words) == 1000


def test_search_and_fetch_and_text_search(spark):
    posts = spark.createDataFrame(POSTS, PSCHEMA).withColumn("lang", F.lit("en"))
    records = posts.select("submission_id", F.upper("text").alias("body"))
    got = search.search_and_fetch(posts, records, "BTC", F.col("text"), limit=1, after="2024-01-01 00:00:00", before="2024-01-04 00:00:00")
    assert [(r.submission_id, r.hits, r.body) for r in got.collect()] == [("p3", 1, "ETHER AND BTC")]
    newest = search.text_search(posts, "bitcoin", "en", F.col("text"), 1, since="2024-01-01 00:00:00", until="2024-01-05 00:00:00")
    assert [r.submission_id for r in newest.collect()] == ["p2"]
    assert search.text_search(posts, "bitcoin", "de", F.col("text"), 1).count() == 0


def test_keywords_with_spaces_and_texts_without(spark):
    """Anchors lie in runs without a space: keywords with spaces, of spaces only, runs longer than ``RUN`` on either side."""
    texts = [("a", "x red bolt  y"), ("b", "redbolt"), ("c", "q" * 300 + "red" + "z" * 300), ("d", "名" * 400 + "bolt 中文"), ("e", ""), ("f", None), ("g", "ed")]
    words = ["red bolt", "red", "bolt", " ", "  ", " y", "中文", "名bolt", "q" * 280 + "", "ed", "d b"]
    posts = spark.createDataFrame(texts, "submission_id string, text string")
    got = search.keyword_pairs(posts, F.col("text"), spark.createDataFrame([(w,) for w in words], "kw string")).select("submission_id", "kw").collect()
    assert sorted(map(tuple, got)) == sorted((i, w) for i, t in texts for w in words if t is not None and w in t)


def test_a_keyword_shared_by_many_coins_is_written_by_many_tasks(spark):
    """The fan-out to the coins is split by coin, whatever keyword they share; before, one task wrote a shared keyword's rows."""
    posts = spark.createDataFrame(POSTS, PSCHEMA)
    coins = spark.range(4000).select(F.col("id").cast("string").alias("coin_id"), F.lit("Bitcoin").alias("name"), F.lit("BTC").alias("symbol"))
    out = search.keyword_search(posts, coins, F.col("text"), limit=2)
    sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 16000 and len(sizes) >= 8 and max(sizes) < 4000
    assert "BroadcastExchange" in out._jdf.queryExecution().executedPlan().toString()
