import json
import os
import tempfile

from pyspark.sql import functions as F

from tickvault import schemas
from tickvault.streaming import ingest
from tickvault.streaming.messages import array_messages, explode_messages


def _write_messages(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _tick(coin, ts, price, with_usd=True):
    q = {"USD": {"price": price, "volume_24h": 1.0, "market_cap": 2.0}} if with_usd else {"EUR": {"price": price}}
    return json.dumps({"id": coin, "last_updated": ts, "quotes": q})


def _paths(base):
    return (f"{base}/topic", f"{base}/table", f"{base}/quarantine", f"{base}/ckpt")


def _table(spark, path):
    return sorted((r.coin_id, str(r.read_timestamp), r.price)
                  for r in spark.read.schema(schemas.PRICE_TABLE).parquet(path).collect())


def test_price_stream_quarantine_replay_and_resume(spark, tmpdir_path):
    topic, table, quarantine, ckpt = _paths(tmpdir_path)
    _write_messages(topic, "m1.json", [
        _tick("btc", "2024-01-01T01:00:00Z", 1.0), _tick("eth", "2024-01-01T01:00:00Z", 2.0),
        "this is not json", _tick("sol", "2024-01-01T01:00:00Z", 3.0, with_usd=False),
        _tick("ada", "", 4.0), _tick("btc", "2024-01-01T01:00:00Z", 1.0)])            # redelivered message
    ingest.start_price_stream(spark, topic, table, quarantine, ckpt).awaitTermination()
    assert _table(spark, table) == [("btc", "2024-01-01 01:00:00", 1.0), ("eth", "2024-01-01 01:00:00", 2.0)]
    reasons = sorted(r.reason for r in spark.read.parquet(quarantine).collect())
    assert reasons == ["missing USD quote", "missing or bad last_updated", "not decodable"]
    # resume: only the new file is processed with the same checkpoint
    _write_messages(topic, "m2.json", [_tick("btc", "2024-01-01T02:00:00Z", 5.0)])
    ingest.start_price_stream(spark, topic, table, quarantine, ckpt).awaitTermination()
    assert len(_table(spark, table)) == 3
    # replay from scratch (new checkpoint) over all messages: same table
    before = _table(spark, table)
    ingest.start_price_stream(spark, topic, table, quarantine, f"{tmpdir_path}/ckpt2").awaitTermination()
    assert _table(spark, table) == before


def test_stream_equals_batch(spark, tmpdir_path):
    topic, table, quarantine, ckpt = _paths(tmpdir_path)
    lines = [_tick(f"c{i % 7}", f"2024-01-0{1 + i % 3}T0{i % 10}:00:00Z", float(i)) for i in range(60)]
    _write_messages(topic, "m.json", lines)
    ingest.start_price_stream(spark, topic, table, quarantine, ckpt).awaitTermination()
    batch = ingest.decode_prices(spark.read.schema(ingest.MESSAGE).text(topic))
    from tickvault.operators.topn import latest_per_key
    want = latest_per_key(batch.filter("problem is null").select(*schemas.PRICE_TABLE.fieldNames()),
                          schemas.PRICE_KEY, ["date", "hour", "price"])
    assert _table(spark, table) == sorted((r.coin_id, str(r.read_timestamp), r.price) for r in want.collect())


def test_post_stream_array_messages(spark, tmpdir_path):
    topic, table, quarantine, ckpt = _paths(tmpdir_path)
    post = {"coin_id": "btc", "submission_id": "s1", "title": "t", "score": 1, "url": "", "num_comments": 0,
            "created_utc": "2024-01-01T00:00:00Z", "selftext": "b", "subreddit": "all", "author": None,
            "sort_type": "hot", "flair": ""}
    _write_messages(topic, "m.json", [json.dumps([dict(post, title="z old", score=9, event_id=1), dict(post, submission_id="s2")]), "not json",
                                      json.dumps([dict(post, title="again", event_id=2)]),
                                      json.dumps([dict(post, submission_id="s3", created_utc="")]),
                                      json.dumps([dict(post, submission_id="s4", score="not a number")])])
    ingest.start_post_stream(spark, topic, table, quarantine, ckpt).awaitTermination()
    rows = sorted((r.submission_id, r.title) for r in spark.read.parquet(table).collect())
    assert rows == [("s1", "again"), ("s2", "t")]              # the last write, not the greatest values
    bad = {r.reason: r for r in spark.read.parquet(quarantine).collect()}
    assert sorted(bad) == ["bad field", "missing or bad created_utc", "not decodable"]
    assert json.loads(bad["bad field"].payload)["score"] == "not a number" and bad["bad field"].source == "posts"
    assert json.loads(bad["missing or bad created_utc"].payload)["selftext"] == "b"


def test_two_streams_side_by_side_and_listener(spark, tmpdir_path):
    listener = ingest.ErrorListener()
    spark.streams.addListener(listener)
    try:
        a, b = f"{tmpdir_path}/a", f"{tmpdir_path}/b"
        _write_messages(f"{a}/topic", "m.json", [_tick("btc", "2024-01-01T01:00:00Z", 1.0)])
        _write_messages(f"{b}/topic", "m.json", [_tick("eth", "2024-01-01T01:00:00Z", 2.0)])
        q1 = ingest.start_price_stream(spark, *_paths(a))
        q2 = ingest.start_price_stream(spark, *_paths(b))
        q1.awaitTermination()
        q2.awaitTermination()
        assert _table(spark, f"{a}/table") == [("btc", "2024-01-01 01:00:00", 1.0)]
        assert _table(spark, f"{b}/table") == [("eth", "2024-01-01 01:00:00", 2.0)]
    finally:
        spark.streams.removeListener(listener)


def test_processing_time_trigger_start_and_stop(spark, tmpdir_path):
    topic, table, quarantine, ckpt = _paths(tmpdir_path)
    _write_messages(topic, "m.json", [_tick("btc", "2024-01-01T01:00:00Z", 1.0)])
    q = ingest.start_price_stream(spark, topic, table, quarantine, ckpt, available_now=False, interval="1 second")
    q.processAllAvailable()
    q.stop()
    assert not q.isActive and len(_table(spark, table)) == 1


def test_array_messages_bounded_and_roundtrip(spark):
    df = spark.createDataFrame([(1, t, f"x{t}") for t in range(20)] + [(2, 0, "y")], "conv int, turn int, text string")
    msgs = array_messages(df, ["conv"], "turn", 8)
    sizes = sorted(r[0] for r in msgs.select(F.size(F.from_json("value", "array<string>"))).collect())
    assert sizes == [1, 4, 8, 8]
    back = explode_messages(msgs, "array<struct<conv:int,turn:int,text:string>>")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_transform_hook_applies_before_merge(spark, tmpdir_path):
    topic, table, quarantine, ckpt = _paths(tmpdir_path)
    _write_messages(topic, "m.json", [_tick("btc", "2024-01-01T01:00:00Z", 1.0), _tick("eth", "2024-01-01T01:00:00Z", 2.0)])
    only_btc = lambda df: df.filter(F.col("coin_id") == "btc")        # noqa: E731
    ingest.start_price_stream(spark, topic, table, quarantine, ckpt, transform=only_btc).awaitTermination()
    assert _table(spark, table) == [("btc", "2024-01-01 01:00:00", 1.0)]


def test_logged_reraises(caplog):
    import pytest
    from tickvault.errors import logged

    @logged("demo")
    def boom():
        raise ValueError("x")
    with pytest.raises(ValueError):
        boom()
    assert any("demo" in r.getMessage() for r in caplog.records)


def test_kafka_source_is_requested_with_the_built_options(spark):
    """The Kafka jar is not in this build: the stream asks Spark for the kafka source with our
    options and fails cleanly; with the jar on the classpath the same call starts reading."""
    import pytest
    from tickvault.sources.kafka import kafka_source_options
    with pytest.raises(Exception) as e:
        ingest.message_stream(spark, kafka_source_options("broker:9092", "prices"))
    assert "kafka" in str(e.value).lower()


def test_last_message_of_a_key_wins_and_fractions_are_kept(spark, tmpdir_path):
    topic, table, quarantine, ckpt = _paths(tmpdir_path)
    lines = [json.dumps({**json.loads(_tick("btc", "2024-01-01T01:00:00.100Z", p)), "event_id": i}) for i, p in enumerate([10.0, 5.0])]
    lines.append(_tick("btc", "2024-01-01T01:00:00.900Z", 7.0))
    lines.append(_tick("btc", "2024-01-01T03:00:00.100+02:00", 1.0).replace('"id"', '"event_id": -1, "id"'))
    _write_messages(topic, "m.json", lines)
    ingest.start_price_stream(spark, topic, table, quarantine, ckpt).awaitTermination()
    assert _table(spark, table) == [("btc", "2024-01-01 01:00:00.100000", 5.0), ("btc", "2024-01-01 01:00:00.900000", 7.0)]


def test_streams_and_jobs_share_a_quarantine_without_loss(spark, tmpdir_path):
    """Price and post stream, a second checkpoint and a batch job write to one root; nothing is erased."""
    from tickvault.sinks.quarantine import quarantine_batch
    topic, table, quarantine, ckpt = _paths(tmpdir_path)
    _write_messages(topic, "m.json", ["junk", _tick("btc", "", 1.0)])
    _write_messages(f"{topic}2", "m.json", ["junk posts"])
    q1 = ingest.start_price_stream(spark, topic, table, quarantine, ckpt)
    q2 = ingest.start_post_stream(spark, f"{topic}2", f"{table}2", quarantine, f"{ckpt}2")
    q1.awaitTermination()
    q2.awaitTermination()
    ingest.start_price_stream(spark, topic, table, quarantine, f"{ckpt}3").awaitTermination()
    bad = spark.createDataFrame([("missing", "x"), ("missing", "x")], "reason string, payload string")
    for _ in range(2):
        quarantine_batch(bad, quarantine, "history")
    rows = spark.read.schema(schemas.QUARANTINE).parquet(quarantine).collect()
    assert sorted((r.source, r.payload) for r in rows if r.payload in ("junk", "junk posts", "x")) == \
        [("history", "x"), ("history", "x"), ("posts", "junk posts"), ("prices", "junk"), ("prices", "junk")]


def test_publisher_stream_is_triggered_and_repeatable(spark, tmpdir_path):
    landing, topic = f"{tmpdir_path}/landing", f"{tmpdir_path}/topic"
    _write_messages(landing, "a.json", [_tick("btc", "2024-01-01T01:00:00Z", 1.0)])
    landed = spark.readStream.schema(schemas.TICKER).json(landing)
    ingest.start_publisher(landed, topic, f"{tmpdir_path}/pub").awaitTermination()
    _write_messages(landing, "b.json", [_tick("eth", "2024-01-01T01:00:00Z", 2.0)])
    q = ingest.start_publisher(landed, topic, f"{tmpdir_path}/pub", interval="1 second")
    q.processAllAvailable()
    q.stop()
    table = f"{tmpdir_path}/table"
    ingest.start_price_stream(spark, topic, table, f"{tmpdir_path}/quar", f"{tmpdir_path}/ckpt").awaitTermination()
    assert [r[0] for r in _table(spark, table)] == ["btc", "eth"]


def test_replayed_batch_does_not_duplicate_quarantine(spark, tmpdir_path):
    topic, table, quarantine, _ = _paths(tmpdir_path)
    _write_messages(topic, "m.json", [_tick("btc", "2024-01-01T01:00:00Z", 1.0), "junk"])
    writer = ingest.price_batch_writer(table, quarantine)
    batch = ingest.decode_prices(spark.read.schema(ingest.MESSAGE).text(topic))
    writer(batch, 7)
    writer(batch, 7)                      # the same micro-batch delivered again after a failure
    assert spark.read.parquet(quarantine).count() == 1
    assert len(_table(spark, table)) == 1


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_messages_are_decoded_once(spark, tmpdir_path):
    """What a post batch stores is filtered from decoded rows (before, the filter parsed each message once per field that it
    looked at, and the quarantine parsed it again); only what is not stored keeps its payload."""
    topic, table, quarantine, _ = _paths(tmpdir_path)
    post = {"coin_id": "btc", "submission_id": "s1", "title": "t", "score": 1, "created_utc": "2024-01-01T00:00:00Z"}
    _write_messages(topic, "m.json", [json.dumps([post, dict(post, submission_id="s2", score="x")]), "junk"])
    plans = []
    batch = spark.read.schema(ingest.MESSAGE).text(topic).withColumnRenamed("value", "payload")
    ingest.post_batch_writer(table, quarantine, lambda good: (plans.append(_optimized(good)), good)[1])(batch, 0)
    assert len(plans) == 1 and "InMemoryRelation" in plans[0] and "from_json" not in plans[0].split("InMemoryRelation")[0]
    assert [r.submission_id for r in spark.read.schema(schemas.POST_TABLE).parquet(table).collect()] == ["s1"]
    bad = {r.reason: r.payload for r in spark.read.schema(schemas.QUARANTINE).parquet(quarantine).collect()}
    assert bad.keys() == {"bad field", "not decodable"} and bad["not decodable"] == "junk" and json.loads(bad["bad field"])["score"] == "x"


def test_price_messages_of_one_small_file_are_made_once(spark, tmpdir_path):
    """Messages that are sent twice are read, not made again; null keys and equal rows stay."""
    rows = [(1, "2024-01-01 00:00:00", 7, "view", 2.0, '{"k": 3}'), (1, "2024-01-01 00:00:00", 7, "view", 2.0, '{"k": 3}'),
            (None, None, None, "signup", None, None), (2, "2024-01-01 01:00:00", 8, "purchase", 4.0, '{"k": 1}')]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmpdir_path}/events.parquet")
    messages = ingest._price_messages(spark, tmpdir_path)
    assert "from_json" not in _optimized(messages) and "Join" not in _optimized(messages)
    got = sorted((r.event_id or 0, r.id or "", next(iter(r.quotes)), next(iter(r.quotes.values())).price) for r in messages.collect() if r.event_id)
    assert got == [(2, "7", "USD", 2.0), (2, "7", "USD", 2.0), (4, "8", "USD", 4.0), (5, "8", "USD", 2.0)] and messages.count() == 5


def test_messages_are_encoded_before_few_files_take_them(spark, tmpdir_path):
    """A folder of two files is written by two tasks, but its messages are encoded by all (before: by those two)."""
    df = spark.range(100).select(F.col("id").alias("event_id"), F.lit("x").alias("a"))
    top, *below = _optimized(ingest.encoded(df, key="event_id", files=2)).splitlines()
    assert top.startswith("RepartitionByExpression") and "Json" in "".join(below)
    ingest.publish(df, f"{tmpdir_path}/topic", key="event_id", files=2)
    assert len([f for f in os.listdir(f"{tmpdir_path}/topic") if f.endswith(".txt")]) == 2
    assert sorted(json.loads(r.value)["event_id"] for r in spark.read.text(f"{tmpdir_path}/topic").collect()) == list(range(100))


def test_few_posts_a_day_share_a_folder(spark, tmpdir_path):
    """Sixty days with one post each are two months and two folders (before: sixty, each with its file); a later post of
    one month rewrites that month only."""
    topic, table, quarantine, ckpt = _paths(tmpdir_path)
    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 3) for d in range(1, 31)]
    post = lambda day, title, n: {"coin_id": "btc", "submission_id": day, "title": title, "score": 1, "created_utc": f"{day}T05:00:00Z", "event_id": n}
    _write_messages(topic, "m1.json", [json.dumps([post(d, "old", 1) for d in days])])
    ingest.start_post_stream(spark, topic, table, quarantine, ckpt).awaitTermination()
    folders = sorted(f for f in os.listdir(table) if "=" in f)
    assert folders == ["created_month=2024-01-01", "created_month=2024-03-01"]
    january = sorted(os.listdir(f"{table}/{folders[0]}"))
    _write_messages(topic, "m2.json", [json.dumps([post("2024-03-07", "new", 2)])])
    ingest.start_post_stream(spark, topic, table, quarantine, ckpt).awaitTermination()
    rows = {r.submission_id: r for r in spark.read.schema(schemas.POST_TABLE).parquet(table).collect()}
    assert len(rows) == 60 and {d for d, r in rows.items() if r.title == "new"} == {"2024-03-07"}
    assert all(str(r.created_date) == d and str(r.created_month) == d[:8] + "01" for d, r in rows.items())
    assert sorted(os.listdir(f"{table}/{folders[0]}")) == january
