"""Holes and fills, recursive indicators, the text index: against plain Python versions."""
import collections
import datetime as dt
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tickvault import schemas
from tickvault.operators import gaps, recurrence
from tickvault.sinks import text_index
from tickvault.sinks.merge import upsert

T0 = dt.datetime(2024, 1, 1)


def hours(*h):
    return [T0 + dt.timedelta(hours=x) for x in h]


def ticks(spark, rows):
    return spark.createDataFrame(rows, "coin_id string, read_timestamp timestamp_ntz, price double")


def test_missing_ranges(spark):
    rows = [("a", t, 1.0) for t in hours(0.5, 0.7, 3, 4.2, 9, -5, 30)] + [("b", t, 1.0) for t in hours(*range(10))] + [(None, T0, 1.0), ("a", None, 1.0), ("z", T0, 1.0)]
    ids = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "coin_id string")
    got = gaps.missing_ranges(ids, ticks(spark, rows), "2024-01-01 00:00:00", "2024-01-01 10:00:00", "1h").collect()
    assert sorted((r.coin_id, r.from_ts.hour, r.to_ts.hour, r.n_missing) for r in got) == [("a", 1, 3, 2), ("a", 5, 9, 4), ("c", 0, 10, 10)]
    assert gaps.missing_ranges(ids.limit(0), ticks(spark, rows), "2024-01-01", "2024-01-02", "1h").count() == 0


def test_only_missing_intervals_are_filled_in(spark):
    stored = ticks(spark, [("a", t, 1.0) for t in hours(0.5, 3)])
    points = ticks(spark, [("a", t, 2.0) for t in hours(0.1, 1, 1.5, 3.9, 4, -1, 12)] + [("b", T0, 2.0)])
    got = gaps.only_missing(points, stored, "2024-01-01 00:00:00", "2024-01-01 10:00:00", "1h").collect()
    assert sorted((r.coin_id, (r.read_timestamp - T0).total_seconds() / 3600) for r in got) == [("a", 1.0), ("a", 1.5), ("a", 4.0), ("b", 0.0)]


def test_backfill_completes_a_coin_that_has_some_rows(spark, tmpdir_path):
    from tickvault.plans import jobs
    path = f"{tmpdir_path}/prices"
    row = lambda c, t, p: (c, t, t.date(), t.hour, p, 1.0, 1.0)
    upsert(spark.createDataFrame([row("a", t, 1.0) for t in hours(1, 49)], schemas.PRICE_TABLE), path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
    history = spark.createDataFrame([row(c, t, 2.0) for c in ("a", "b", "c") for t in hours(2, 26, 50, 74, 98)], schemas.PRICE_TABLE)
    ids = spark.createDataFrame([("a",), ("b",)], "coin_id string")
    asked = jobs.fill_gaps(ids, history, path, f"{tmpdir_path}/q", "2024-01-01", "2024-01-05", "1d")
    assert sorted((r.coin_id, r.from_ts.day, r.to_ts.day) for r in asked.collect()) == [("a", 2, 3), ("a", 4, 5), ("b", 1, 5)]
    got = sorted((r.coin_id, r.read_timestamp.day, r.price) for r in spark.read.schema(schemas.PRICE_TABLE).parquet(path).collect())
    assert got == [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 1.0), ("a", 4, 2.0), ("b", 1, 2.0), ("b", 2, 2.0), ("b", 3, 2.0), ("b", 4, 2.0)]
    again = jobs.fill_gaps(ids, history, path, f"{tmpdir_path}/q", "2024-01-01", "2024-01-05", "1d")
    assert again.count() == 0


def test_filled_bars(spark):
    bars = spark.createDataFrame([("a", t, p) for t, p in zip(hours(0, 1, 4), (1.0, None, 3.0))] + [("b", T0, 5.0)], "coin_id string, bucket_start timestamp_ntz, price double")
    got = sorted((r.coin_id, r.bucket_start.hour, r.price, r.is_filled) for r in gaps.filled(bars, ["price"], "1h").collect())
    assert got == [("a", 0, 1.0, False), ("a", 1, None, False), ("a", 2, None, True), ("a", 3, None, True), ("a", 4, 3.0, False), ("b", 0, 5.0, False)]
    assert gaps.filled(bars, ["price"], "1h", until="2024-01-01 06:00:00").filter("coin_id = 'b'").count() == 6


# ---- indicators --------------------------------------------------------------------------------

def sequential(rows):
    out, e = {}, None
    for n, x in rows:
        if e is None:
            e = dict(f=x, s=x, g=0.0, l=0.0, m=0.0)
        else:
            e["f"] += 2 / 13 * (x - e["f"])
            e["s"] += 2 / 27 * (x - e["s"])
            e["g"] += (max(x - last, 0) - e["g"]) / 14
            e["l"] += (max(last - x, 0) - e["l"]) / 14
            e["m"] += 0.2 * (e["f"] - e["s"] - e["m"])
        last = x
        out[n] = (e["f"], e["s"], e["f"] - e["s"], e["m"], 100 * e["g"] / (e["g"] + e["l"]) if e["g"] + e["l"] else None)
    return out


@pytest.mark.parametrize("rows_in_block,block", [(512, "1d"), (7, "1h"), (1, "30d")])
def test_trend_equals_the_sequential_recurrence(spark, monkeypatch, rows_in_block, block):
    monkeypatch.setattr(recurrence, "ROWS", rows_in_block)
    rng, data = random.Random(4), []
    for coin, n in (("hot", 900), ("b", 40), ("one", 1)):
        at = [rng.randrange(0, 86400 * 3) for _ in range(n)]
        data += [(coin, T0 + dt.timedelta(seconds=at[i]), rng.uniform(1, 1000), i) for i in range(n)]
    data += [("flat", T0 + dt.timedelta(hours=i), 3.0, i) for i in range(30)] + [("hot", None, 5.0, -1), ("hot", T0, None, -2)]
    df = spark.createDataFrame(data, "coin_id string, read_timestamp timestamp_ntz, price double, n int")
    got = collections.defaultdict(dict)
    for r in recurrence.trend(df, tie=["n"], block=block).collect():
        got[r.coin_id][r.n] = (r.ema_fast, r.ema_slow, r.macd, r.macd_signal, r.rsi)
    for coin in ("hot", "b", "one", "flat"):
        want = sequential([(n, x) for c, t, x, n in sorted((d for d in data if d[0] == coin and d[1] and d[2] is not None), key=lambda d: (d[1], d[3]))])
        assert got[coin].keys() == want.keys()
        for n in want:
            for a, b in zip(got[coin][n], want[n]):
                assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_hot_coins_are_not_ordered_tick_by_tick_in_one_window(spark):
    """Windows over ticks are partitioned by block too; only block summaries are ordered per coin."""
    df = spark.range(10).selectExpr("'a' AS coin_id", "timestamp_ntz '2024-01-01 00:00:00' AS read_timestamp", "1.0D AS price", "id AS n")
    plan = recurrence.trend(df, tie=["n"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    per_coin = [w for w in windows if re.search(r"\], \[coin_id#\d+\]", w)]
    assert windows and all("_tv_block" in w for w in per_coin)


# ---- text index ----------------------------------------------------------------------------------

WORD = re.compile(r"[^\W_]+")


def bm25(texts, query, n):
    bags = {d: collections.Counter(WORD.findall(t.lower())) for d, t in texts.items() if t and WORD.search(t)}
    mean = sum(b.total() for b in bags.values()) / len(bags)
    out = collections.Counter()
    for term in set(WORD.findall(query.lower())):
        df = sum(term in b for b in bags.values())
        for d, b in bags.items():
            if term in b:
                out[d] += math.log(1 + (len(bags) - df + 0.5) / (df + 0.5)) * b[term] * 2.2 / (b[term] + 1.2 * (0.25 + 0.75 * b.total() / mean))
    return [(d, round(s, 6)) for d, s in sorted(out.items(), key=lambda x: (-round(x[1], 6), x[0]))[:n]]


def test_index_merges_change_only_touched_buckets(spark, tmpdir_path):
    path, rng = f"{tmpdir_path}/index", random.Random(9)
    vocabulary = [f"w{i}" for i in range(40)] + ["Straße", "É", "中文", "x1"]
    texts = {str(i): " ".join(rng.choices(vocabulary, k=rng.randint(1, 30))) + rng.choice(["", "!", "\n"]) for i in range(80)}
    texts |= {"empty": "", "none": None, "signs": "?! --"}
    put = lambda t: text_index.update_index(spark.createDataFrame(list(t.items()), "submission_id string, selftext string"), path, buckets=32)
    queries = {1: "w1 W2 w2 straße", 2: "中文 nothing", 3: "É x1 w3 w4 w5", 4: "absent", 5: None}

    def check():
        found = collections.defaultdict(list)
        asked = spark.createDataFrame(list(queries.items()), "query_id int, text string")
        for r in text_index.bm25_search(spark, path, asked, 7, buckets=32).orderBy("query_id", "rank").collect():
            found[r.query_id].append((r.doc_id, r.score))
        for q, text in queries.items():
            assert [d for d, _ in found[q]] == [d for d, _ in bm25(texts, text or "", 7)]
            assert all(math.isclose(a[1], b[1], abs_tol=2e-6) for a, b in zip(found[q], bm25(texts, text or "", 7)))

    def files():
        return {f"{b}/{f}" for b in os.listdir(f"{path}/postings") if b.startswith("bucket=") for f in os.listdir(f"{path}/postings/{b}") if f.endswith(".parquet")}
    put(texts)
    check()
    before = files()
    assert put({k: texts[k] for k in ("1", "2", "3", "empty")}) == {"posts": 0, "buckets": []} and files() == before
    change = {"5": "w1 w1 brandnew", "new": "w2 w3", "7": None, "9": "..."}
    info = put(change)
    texts |= change
    check()
    kept = {f for f in before if int(f.split("=")[1].split("/")[0]) not in info["buckets"]}
    assert info["posts"] == 4 and kept and kept <= files()               # other buckets keep their files
    docs, postings = text_index.read_index(spark, path)
    assert {r.doc_id for r in docs.collect()} == {d for d, t in texts.items() if t and WORD.search(t)}
    assert postings.count() == sum(len(set(WORD.findall(t.lower()))) for t in texts.values() if t)


def test_a_merge_that_died_between_its_writes_is_repeated(spark, tmpdir_path, monkeypatch):
    path = f"{tmpdir_path}/index"
    put = lambda *rows: text_index.update_index(spark.createDataFrame(list(rows), "submission_id string, selftext string"), path)
    put(("a", "old words here"), ("b", "other text"))
    real, calls = text_index.overwrite_partitions, []

    def dies(df, target, *args, **kw):
        if target.endswith("/docs"):
            raise RuntimeError("lost driver")
        calls.append(target)
        return real(df, target, *args, **kw)
    monkeypatch.setattr(text_index, "overwrite_partitions", dies)
    with pytest.raises(RuntimeError):
        put(("a", "new words"))
    monkeypatch.setattr(text_index, "overwrite_partitions", real)
    put(("a", "new words"))
    docs, postings = text_index.read_index(spark, path)
    assert sorted((r.term, r.doc_id) for r in postings.collect()) == [("new", "a"), ("other", "b"), ("text", "b"), ("words", "a")]
    assert {r.doc_id: r.length for r in docs.collect()} == {"a": 2, "b": 2}


def test_search_of_an_empty_index(spark, tmpdir_path):
    asked = spark.createDataFrame([(1, "a")], "query_id int, text string")
    assert text_index.bm25_search(spark, f"{tmpdir_path}/none", asked, 5).collect() == []
    assert text_index.update_index(spark.createDataFrame([], "submission_id string, selftext string"), f"{tmpdir_path}/none") == {"posts": 0, "buckets": []}


def test_search_shuffles_a_posting_once_for_all_queries(spark, tmpdir_path):
    """Between the postings and the ranking there is one shuffle, by post; before, every (query, posting) pair was shuffled."""
    path = f"{tmpdir_path}/index"
    text_index.update_index(spark.createDataFrame([(str(i), f"common w{i % 3}") for i in range(30)], "submission_id string, selftext string"), path)
    asked = spark.createDataFrame([(q, f"common w{q % 3}") for q in range(40)], "query_id int, text string")
    found = text_index.bm25_search(spark, path, asked, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id#" in plan and not re.search(r"hashpartitioning\(query_id#\d+, doc_id#", plan)
    texts = {str(i): f"common w{i % 3}" for i in range(30)}
    got = {(r.query_id, r["rank"]): (r.doc_id, r.score) for r in found.collect()}
    for q in range(40):
        want = bm25(texts, f"common w{q % 3}", 3)
        assert [got[q, k + 1][0] for k in range(3)] == [d for d, _ in want]
