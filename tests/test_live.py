"""Stored versions, repeated messages, live bars and the post-price join."""
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tickvault import schemas
from tickvault.sinks.merge import message_version, upsert
from tickvault.streaming import ingest, live


def ticks(*rows):
    return [json.dumps({"id": c, "last_updated": t, "event_id": n, "quotes": {"USD": {"price": p, "volume_24h": 1.0, "market_cap": 1.0}}}) for c, t, n, p in rows]


def send(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    time.sleep(0.02)                                                     # files are read by modification time


def prices(spark, path):
    rows = spark.read.schema(schemas.PRICE_TABLE).parquet(path).collect()
    return sorted((r.coin_id, str(r.read_timestamp), r.price) for r in rows)


@pytest.mark.parametrize("per_trigger", [1, 1000])
def test_the_table_does_not_depend_on_the_batch_size(spark, tmpdir_path, per_trigger):
    """A correction that overtakes the message it corrects stays, however the messages fall into batches."""
    t1, t2, folder = "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z", f"{tmpdir_path}/topic"
    for i, m in enumerate([("btc", t1, 1, 10.0), ("btc", t1, 3, 5.0), ("btc", t1, 1, 10.0), ("btc", t2, 9, 7.0), ("btc", t2, 8, 6.0), ("eth", t1, 2, 1.0)]):
        send(folder, f"m{i}", ticks(m))
    path = f"{tmpdir_path}/prices"
    ingest.start_price_stream(spark, folder, path, f"{tmpdir_path}/q", f"{tmpdir_path}/c", max_per_trigger=per_trigger).awaitTermination()
    assert prices(spark, path) == [("btc", "2024-01-01 00:00:00", 5.0), ("btc", "2024-01-02 00:00:00", 7.0), ("eth", "2024-01-01 00:00:00", 1.0)]


def versioned(spark, *rows):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(c, t, t.date(), 0, p, 1.0, 1.0, n, at) for c, p, n, at in rows],
                                 "coin_id string, read_timestamp timestamp_ntz, date date, hour int, price double, volume_24h double, market_cap double, n long, at timestamp")


def put(df, path, seq="n"):
    version = message_version(seq=F.col(seq), at=F.col("at"))
    return upsert(df, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"], version=version, stats=True)


def test_versions_decide_between_batches(spark, tmpdir_path):
    import datetime as dt
    path, early, late = f"{tmpdir_path}/t", dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
    put(versioned(spark, ("a", 1.0, 5, None), ("b", 1.0, None, late), ("c", 1.0, None, None)), path)
    files = sorted(os.listdir(f"{path}/date=2024-01-01"))
    assert put(versioned(spark, ("a", 2.0, 4, late), ("a", 3.0, 5, None), ("b", 2.0, None, early)), path) == {"rows": 0, "mode": "none"}
    assert sorted(os.listdir(f"{path}/date=2024-01-01")) == files        # older messages rewrite nothing
    put(versioned(spark, ("a", 9.0, 6, None), ("b", 9.0, 1, None), ("c", 9.0, None, None)), path)
    assert [p for _, _, p in prices(spark, path)] == [9.0, 9.0, 9.0]
    put(versioned(spark, ("a", 0.0, None, None), ("c", 0.0, None, None)), path)      # no version: loses to one, replaces none
    assert [p for _, _, p in prices(spark, path)] == [9.0, 9.0, 0.0]
    upsert(versioned(spark, ("a", 4.0, 1, None)), path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])    # a job that does not care
    assert prices(spark, path)[0][2] == 4.0
    put(versioned(spark, ("a", 5.0, 1, None)), path)                     # such rows have no version: they lose
    assert prices(spark, path)[0][2] == 5.0


def archive(spark, base, horizon):
    live.start_message_archive(spark, f"{base}/topic", f"{base}/out", f"{base}/ckpt", horizon, max_per_trigger=1).awaitTermination()
    return sorted(r[0] for r in spark.read.schema("value string").parquet(f"{base}/out").collect())


def test_repeats_inside_the_horizon_are_dropped_also_after_a_restart(spark, tmpdir_path):
    base = tmpdir_path
    with live.state_partitions(spark, 2):
        send(f"{base}/topic", "1", ["a", "b", "a"])
        send(f"{base}/topic", "2", ["b", "not json", "c"])
        assert archive(spark, base, "1 hour") == ["a", "b", "c", "not json"]
        send(f"{base}/topic", "3", ["c", "a", "d"])
        assert archive(spark, base, "1 hour") == ["a", "b", "c", "d", "not json"]


def test_repeats_beyond_the_horizon_are_kept(spark, tmpdir_path):
    base = tmpdir_path
    with live.state_partitions(spark, 2):
        for name, lines, expected in (("1", ["a"], ["a"]), ("2", ["b"], ["a", "b"]), ("3", ["a", "b"], None)):
            send(f"{base}/topic", name, lines)
            got = archive(spark, base, "1 second")
            assert expected is None or got == expected
            time.sleep(4)
    assert got.count("a") == 2


def bars(spark, base):
    live.start_bar_stream(spark, f"{base}/topic", f"{base}/bars", f"{base}/late", f"{base}/ckpt", "1h", "30 minutes", max_per_trigger=1).awaitTermination()
    made = sorted((r.coin_id, r.bucket_start.hour, r.open, r.high, r.low, r.close, r.n_ticks) for r in spark.read.parquet(f"{base}/bars").collect())
    late = sorted((r.coin_id, str(r.read_timestamp.time()), r.price) for r in spark.read.parquet(f"{base}/late").collect())
    return made, late


def test_live_bars_close_once_and_late_rows_go_aside(spark, tmpdir_path):
    base, t = tmpdir_path, "2024-01-01T{}:00Z".format
    send(f"{base}/topic", "1", ticks(("a", t("00:10"), 1, 5.0), ("a", t("00:50"), 2, 7.0), ("b", t("01:20"), 3, 1.0)))
    send(f"{base}/topic", "2", ticks(("a", t("00:30"), 4, 9.0), ("a", t("01:40"), 5, 3.0)) + ["broken"])    # 01:20 - 30 min: hour 0 is open
    made, late = bars(spark, base)
    assert made == [("a", 0, 5.0, 9.0, 5.0, 7.0, 3)] and late == []      # 01:40 - 30 min closes hour 0
    send(f"{base}/topic", "3", ticks(("a", t("00:55"), 6, 99.0), ("b", t("01:59"), 7, 2.0), ("c", t("00:59"), 8, 4.0)))
    send(f"{base}/topic", "4", ticks(("a", t("03:00"), 9, 1.0)))
    made, late = bars(spark, base)                                       # restarted: open bars and watermark are kept
    assert made == [("a", 0, 5.0, 9.0, 5.0, 7.0, 3), ("a", 1, 3.0, 3.0, 3.0, 3.0, 1), ("b", 1, 1.0, 2.0, 1.0, 2.0, 2)]
    assert late == [("a", "00:55:00", 99.0), ("c", "00:59:00", 4.0)]


def test_a_repeated_micro_batch_replaces_its_own_output(spark, tmpdir_path):
    base, t = tmpdir_path, "2024-01-01T{}:00Z".format
    write = live.bar_batch_writer(f"{base}/bars", f"{base}/late", f"{base}/state", "1h", "30 minutes")
    batch = lambda *rows: ingest.decode_prices(spark.createDataFrame([(m,) for m in ticks(*rows)], "value string"))
    one, two = batch(("a", t("00:10"), 1, 5.0), ("a", t("01:10"), 2, 6.0)), batch(("a", t("01:50"), 3, 7.0), ("a", t("00:20"), 4, 8.0))
    for df, epoch in ((one, 0), (one, 0), (two, 1), (two, 1), (batch(), 2), (batch(("a", t("09:00"), 5, 1.0)), 3)):
        write(df, epoch)
    rows = sorted((r.bucket_start.hour, r.open, r.close, r.n_ticks) for r in spark.read.parquet(f"{base}/bars").collect())
    assert rows == [(0, 5.0, 8.0, 2), (1, 6.0, 7.0, 2)] and spark.read.parquet(f"{base}/late").count() == 0
    assert {n for n in os.listdir(f"{base}/state") if not n.startswith(".")} == {"3", "4"}


def test_posts_wait_for_the_prices_after_them(spark, tmpdir_path):
    base, t = tmpdir_path, "2024-01-01T{}:00Z".format
    post = lambda i, c, at: {"coin_id": c, "submission_id": i, "created_utc": at}
    send(f"{base}/posts", "1", [json.dumps([post("p1", "a", t("00:00")), post("p2", "a", t("00:30")), post("p3", "z", t("00:10"))])])
    send(f"{base}/prices", "1", ticks(("a", t("00:00"), 1, 1.0), ("b", t("00:20"), 2, 2.0)))

    def pairs():
        with live.state_partitions(spark, 2):
            live.start_pair_stream(spark, f"{base}/prices", f"{base}/posts", f"{base}/out", f"{base}/ckpt", max_per_trigger=1).awaitTermination()
        return sorted((r.submission_id, r.price) for r in spark.read.parquet(f"{base}/out").collect() if r.submission_id != "end")
    assert pairs() == [("p1", 1.0)]                                      # p2 and p3 wait
    send(f"{base}/prices", "2", ticks(("a", t("01:29"), 3, 3.0), ("a", t("00:59"), 4, 4.0), ("a", t("01:30"), 5, 5.0)))
    assert pairs() == [("p1", 1.0), ("p1", 4.0), ("p2", 3.0), ("p2", 4.0)]
    send(f"{base}/prices", "3", ticks(("b", t("09:00"), 6, 6.0)))
    send(f"{base}/posts", "2", [json.dumps([post("end", "q", t("09:00"))])])
    found = pairs()
    assert [x for x in found if x[0] != "p3"] == [("p1", 1.0), ("p1", 4.0), ("p2", 3.0), ("p2", 4.0)] and ("p3", None) in found
