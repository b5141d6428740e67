"""Keyword search over posts with a limit per keyword.

Plan: coins -> (coin_id, keyword) rows via ``explode(array(name, symbol))``; the distinct
lower-cased keywords are matched against each post once; hits are cut to ``limit`` per keyword
in the requested sort mode (skew-safe top-n); only then are they fanned back out to the coins
that share a keyword (an equi-join on the keyword), the coins spread over the tasks by their id: a
keyword that very many coins share is written by many tasks.

Matching is ``contains(lower(text), lower(keyword))``, found through an equi-join: every keyword has
one anchor, the first ``GRAM`` characters of its longest run without a space (all of a shorter one), and
every post the grams of its distinct runs, of the anchor sizes in use. Only posts and keywords that share
an anchor are checked with ``contains``. Up to ``BROADCAST_ROWS`` keywords (or best posts) are broadcast,
more are shuffled; the result is the same for any number of keywords, and nothing passes through the
driver but the anchor sizes and how many keywords have each.
"""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from tickvault.functions.nested import keywords
from tickvault.operators.topn import top_n_per_group

# The sort modes of the post search.
SORT_HOT = "hot"
SORT_TOP = "top"
SORT_RELEVANCE = "relevance"

GRAM = 4                           # longest anchor
RUN = 256                          # longest run whose grams are cut out by position
BROADCAST_ROWS = 200_000           # most keywords, or best posts of keywords, that are broadcast
SALT_BUCKETS = 64                  # hot-keyword split for the per-keyword limit


def coin_keywords(coins: DataFrame, name: str = "name", symbol: str = "symbol") -> DataFrame:
    """One row per (coin, keyword); name and symbol are both keywords."""
    return (coins.select("coin_id", F.explode(keywords(name, symbol)).alias("keyword"))
                 .filter(F.col("keyword").isNotNull() & (F.col("keyword") != ""))
                 .withColumn("kw", F.lower("keyword")))


def _gram(chars: list[Column]) -> Column:
    """A character gram as a 64-bit hash (a collision costs one ``contains``, nothing else)."""
    return F.xxhash64(F.concat(*chars) if len(chars) > 1 else chars[0])


def _long_grams(text: Column, size: int) -> Column:
    """The distinct character grams of one size in a text (linear: over its characters, once)."""
    def of(chars: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(chars) - size), lambda i: _gram([F.get(chars, i + k) for k in range(size)])))
    grams = F.element_at(F.transform(F.array(F.split(text, "")), lambda c: F.when(F.size(c) >= size, of(c))), 1)
    return F.when(F.length(text) >= size, grams)


def _grams(texts: DataFrame, key: str, sizes: list[int]) -> DataFrame:
    """(key, _tv_gram) of the texts' runs without a space. A run of up to ``RUN`` characters is cut by position (a cut
    counts characters from the run's start; at its end grams are shorter), a longer one character by character."""
    runs = texts.select(key, F.explode(F.array_distinct(F.split("_tv_lc", " "))).alias("_tv_run"))
    short = runs.filter(F.length("_tv_run").between(1, RUN)).select(key, "_tv_run", F.explode(F.sequence(F.lit(1), F.length("_tv_run"))).alias("_tv_at"))
    cut = F.array(*[_gram([F.substring(F.col("_tv_run"), F.col("_tv_at"), F.lit(n))]) for n in sizes])
    long = runs.filter(F.length("_tv_run") > RUN)
    return short.select(key, F.explode(cut).alias("_tv_gram")).unionByName(
        long.select(key, F.explode(F.concat(*[_long_grams(F.col("_tv_run"), n) for n in sizes])).alias("_tv_gram")))


def _by_size(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast where it has few rows; else Spark chooses."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def keyword_pairs(posts: DataFrame, text: Column, kws: DataFrame, key: str = "submission_id") -> DataFrame:
    """every (post, keyword) with ``lower(keyword)`` inside ``lower(text)``; ``kws`` has ``kw``.

    Adds ``kw`` and the lower-cased text ``_tv_lc`` to ``posts``, whose ``key`` must be unique."""
    posts_lc = posts.withColumn("_tv_lc", F.lower(text))
    longest = F.array_max(F.transform(F.split("kw", " "), lambda r: F.struct(F.length(r).alias("n"), r.alias("run"))))
    anchors = kws.select("kw").filter(F.length("kw") > 0).distinct().select("kw", longest["run"].alias("_tv_run"), F.least(longest["n"], F.lit(GRAM)).alias("_tv_n"))
    sizes = {r[0]: r[1] for r in anchors.groupBy("_tv_n").count().collect()}       # at most GRAM + 1 rows
    held = sorted(n for n in sizes if n)
    maybe = []
    if held:
        first = F.lit(None).cast("long")
        for n in held:
            first = F.when(F.col("_tv_n") == n, _gram([F.substring("_tv_run", 1, n)])).otherwise(first)
        mine = _by_size(anchors.filter("_tv_n > 0").select("kw", first.alias("_tv_gram")), sum(sizes.values()))
        maybe.append(_grams(posts_lc.select(key, "_tv_lc"), key, held).join(mine, "_tv_gram").select(key, "kw"))
    if 0 in sizes:                                                                 # keywords of spaces only
        maybe.append(posts_lc.filter(F.col("_tv_lc").contains(" ")).select(key).crossJoin(anchors.filter("_tv_n = 0").select("kw")))
    if not maybe:
        return posts_lc.withColumn("kw", F.lit(None).cast("string")).limit(0)
    return posts_lc.join(functools.reduce(DataFrame.unionByName, maybe).distinct(), key).filter(F.col("_tv_lc").contains(F.col("kw")))


def sort_order(mode: str) -> list[Column]:
    """O3: the sort modes; every order ends in the post id so the cut is deterministic."""
    if mode == SORT_TOP:
        first = [F.col("score").desc_nulls_last()]
    elif mode == SORT_HOT:
        first = [F.col("created_utc").desc_nulls_last(), F.col("score").desc_nulls_last()]
    elif mode == SORT_RELEVANCE:
        first = [F.col("hits").desc(), F.col("score").desc_nulls_last()]
    else:
        raise ValueError(f"unknown sort mode {mode!r}")
    return first + [F.col("submission_id").asc()]


def keyword_search(posts: DataFrame, coins: DataFrame, text: Column, limit: int = 500,
                   sort_type: str = SORT_HOT, subreddit: str = "all",
                   salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """J3 + O3 + U4: per coin and keyword, the first ``limit`` matching posts in ``sort_type``.

    ``posts`` needs submission_id, score, created_utc (+ subreddit when filtered); output is
    ``posts`` columns + coin_id, keyword, hits (occurrences), rank, sort_type.
    """
    ck = coin_keywords(coins)
    best = best_posts(posts, ck, text, limit, sort_type, subreddit, salt_buckets)
    return per_coin(best, ck, limit).withColumn("sort_type", F.lit(sort_type))


def best_posts(posts: DataFrame, ck: DataFrame, text: Column, limit: int = 500, sort_type: str = SORT_HOT,
               subreddit: str = "all", salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """O3: per keyword (``kw`` of ``coin_keywords`` rows) the first ``limit`` matching posts in ``sort_type``."""
    from tickvault.operators.selection import community
    pairs = keyword_pairs(community(posts, subreddit), text, ck)
    occurrences = F.floor((F.length("_tv_lc") - F.length(F.replace(F.col("_tv_lc"), F.col("kw"), F.lit(""))))
                          / F.length("kw")).cast("int")
    pairs = pairs.withColumn("hits", occurrences).drop("_tv_lc")
    return top_n_per_group(pairs, ["kw"], sort_order(sort_type), limit,
                           salt_on=["submission_id"], salt_buckets=salt_buckets)


def per_coin(best: DataFrame, ck: DataFrame, limit: int) -> DataFrame:
    """The best posts of every coin's keywords. The result has up to ``limit`` rows per coin and keyword, far more
    than either side, so the coins are dealt to all tasks by their id (not by keyword: coins share few symbols)."""
    rows = ck.select("kw").distinct().limit(BROADCAST_ROWS // limit + 1).count() * limit
    tasks = int(ck.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _by_size(best, rows).join(ck.repartition(tasks, "coin_id"), "kw", "inner").drop("kw")


def search_and_fetch(posts: DataFrame, records: DataFrame, query: str, text: Column, limit: int = 500,
                     after=None, before=None, subreddit: str = "all", sort_type: str = SORT_TOP) -> DataFrame:
    """One query in a time range, at most ``limit`` posts, each with its full record."""
    from tickvault.operators.joins import lookup
    from tickvault.operators.selection import community, time_range
    p = time_range(community(posts, subreddit), "created_utc", after=after, before=before)
    q = F.lower(F.lit(query))
    p = p.withColumn("_tv_lc", F.lower(text)).filter(F.col("_tv_lc").contains(q))
    hits = F.floor((F.length("_tv_lc") - F.length(F.replace(F.col("_tv_lc"), q, F.lit("")))) / F.length(q)).cast("int")
    found = p.withColumn("hits", hits).orderBy(*sort_order(sort_type)).limit(limit).select("submission_id", "hits")
    return lookup(found, records, "submission_id")


def text_search(posts: DataFrame, query: str, lang: str, text: Column, n: int, since=None, until=None) -> DataFrame:
    """S7 + F9 + O4: posts of one language that hold ``query``, from ``since`` on and before ``until``, the ``n`` newest."""
    from tickvault.operators.selection import language, time_range, top_k
    p = time_range(language(posts, lang).filter(F.lower(text).contains(F.lower(F.lit(query)))), "created_utc", before=until)
    if since is not None:
        p = p.filter(F.col("created_utc") >= F.lit(since).cast("timestamp_ntz"))
    return top_k(p, n, [F.col("created_utc").desc()], key="submission_id")
