import datetime as dt

from pyspark.sql import functions as F

from tickvault import schemas
from tickvault.sinks.merge import merge_frames, upsert, overwrite_partitions
from tickvault.sources.files import read_or_empty

COLS = schemas.PRICE_TABLE.fieldNames()


def _row(coin, ts, price):
    t = dt.datetime.fromisoformat(ts)
    return (coin, t, t.date(), t.hour, price, 1.0, 2.0)


def _read(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(schemas.PRICE_TABLE).parquet(path).select(*COLS).collect())


def test_upsert_batch_wins_and_other_hours_survive(spark, tmpdir_path):
    path = f"{tmpdir_path}/prices"
    first = spark.createDataFrame([_row("btc", "2024-01-01 01:00:00", 1.0), _row("btc", "2024-01-01 02:00:00", 2.0),
                                   _row("eth", "2024-01-02 01:00:00", 3.0)], schemas.PRICE_TABLE)
    upsert(first, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
    fix = spark.createDataFrame([_row("btc", "2024-01-01 02:00:00", 20.0), _row("btc", "2024-01-01 03:00:00", 30.0)],
                                schemas.PRICE_TABLE)
    info = upsert(fix, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"], stats=True)
    assert info["mode"] == "merge" and info["rows"] == 3       # the rewritten 2024-01-01 partition
    got = _read(spark, path)
    assert [r[4] for r in got] == [1.0, 20.0, 30.0, 3.0]     # 01:00 kept, 02:00 replaced, 03:00 added, eth untouched


def test_upsert_is_idempotent(spark, tmpdir_path):
    path = f"{tmpdir_path}/prices"
    batch = spark.createDataFrame([_row("btc", "2024-01-01 01:00:00", 1.0), _row("btc", "2024-01-01 01:00:00", 1.5),
                                   _row("eth", "2024-01-03 05:00:00", 3.0)], schemas.PRICE_TABLE)
    upsert(batch, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
    once = _read(spark, path)
    upsert(batch, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
    upsert(batch, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
    assert _read(spark, path) == once and len(once) == 2      # duplicate key inside the batch resolved once


def test_new_keys_take_the_append_path(spark, tmpdir_path):
    path = f"{tmpdir_path}/prices"
    upsert(spark.createDataFrame([_row("btc", "2024-01-01 01:00:00", 1.0)], schemas.PRICE_TABLE),
           path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
    info = upsert(spark.createDataFrame([_row("btc", "2024-01-01 02:00:00", 2.0)], schemas.PRICE_TABLE),
                  path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"], stats=True)
    assert info["mode"] == "append" and info["rows"] == 1 and len(_read(spark, path)) == 2


def test_metadata_rank_change_keeps_one_row_per_coin(spark, tmpdir_path):
    path = f"{tmpdir_path}/meta"
    cols = schemas.METADATA_TABLE.fieldNames()

    def meta(rank):
        vals = {c: None for c in cols}
        vals.update(coin_id="btc", name="Bitcoin", rank=rank, is_monitored=True)
        return spark.createDataFrame([tuple(vals[c] for c in cols)], schemas.METADATA_TABLE)
    upsert(meta(5), path, schemas.METADATA_KEY, schemas.METADATA_TABLE)
    upsert(meta(7), path, schemas.METADATA_KEY, schemas.METADATA_TABLE)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 1 and rows[0]["rank"] == 7


def test_merge_reads_only_the_touched_partition(spark, tmpdir_path):
    """20 stored days, a one-day batch: the date is a literal partition filter and one file is read."""
    from tickvault.sinks.merge import touched
    path = f"{tmpdir_path}/prices"
    days = spark.createDataFrame([_row("btc", f"2024-01-{d:02d} 01:00:00", float(d)) for d in range(1, 21)], schemas.PRICE_TABLE)
    days.repartition(1).write.partitionBy("date").parquet(path)
    fresh = spark.createDataFrame([_row("btc", "2024-01-07 01:00:00", 70.0)], schemas.PRICE_TABLE)
    stored = touched(spark.read.schema(schemas.PRICE_TABLE).parquet(path), fresh, ["date"])
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-07" in plan
    assert len(stored.select(F.input_file_name()).distinct().collect()) == 1
    upsert(fresh, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
    assert sorted(r[4] for r in _read(spark, path)) == sorted([float(d) for d in range(1, 21) if d != 7] + [70.0])


def test_many_partition_values_prune_by_range(spark, tmpdir_path, monkeypatch):
    from tickvault.sinks import merge
    monkeypatch.setattr(merge, "MAX_LITERALS", 2)
    path = f"{tmpdir_path}/prices"
    days = [_row("btc", f"2024-01-{d:02d} 01:00:00", float(d)) for d in range(1, 11)]
    upsert(spark.createDataFrame(days, schemas.PRICE_TABLE), path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
    upsert(spark.createDataFrame([(*r[:4], r[4] * 2, *r[5:]) for r in days[2:7]], schemas.PRICE_TABLE), path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
    assert sorted(r[4] for r in _read(spark, path)) == [1.0, 2.0, 6.0, 8.0, 8.0, 9.0, 10.0, 10.0, 12.0, 14.0]


def test_order_decides_inside_a_batch(spark, tmpdir_path):
    path = f"{tmpdir_path}/prices"
    rows = [(*_row("btc", "2024-01-01 01:00:00", p), i) for i, p in enumerate([10.0, 50.0, 5.0])]
    batch = spark.createDataFrame(rows, "coin_id string, read_timestamp timestamp_ntz, date date, hour int, price double, volume_24h double, market_cap double, event_id long")
    upsert(batch, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"], order=["event_id"])
    assert [r[4] for r in _read(spark, path)] == [5.0]


def test_a_failed_publish_leaves_the_old_table(spark, tmpdir_path, monkeypatch):
    """Unpartitioned tables: a job that dies before or inside the swap keeps a complete copy."""
    import os

    import pytest
    from tickvault.sinks import merge
    path = f"{tmpdir_path}/meta"
    cols = schemas.METADATA_TABLE.fieldNames()

    def meta(rank):
        vals = {c: None for c in cols}
        vals.update(coin_id="btc", rank=rank, is_monitored=True)
        return spark.createDataFrame([tuple(vals[c] for c in cols)], schemas.METADATA_TABLE)

    def write(rank):
        upsert(meta(rank), path, schemas.METADATA_KEY, schemas.METADATA_TABLE)

    def stored():
        return [r.rank for r in read_or_empty(spark, path, schemas.METADATA_TABLE).collect()]
    write(1)
    swap, staged = merge.swap_in, []
    monkeypatch.setattr(merge, "swap_in", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
    monkeypatch.setattr(merge, "_stage", (lambda f: lambda df, schema, stages: (staged.append(stages), f(df, schema, stages))[1])(merge._stage))
    with pytest.raises(RuntimeError):
        write(2)
    assert stored() == [1]
    assert staged and not any(os.path.exists(p) for paths in staged for p in paths)       # no stage is left behind
    os.rename(path, f"{path}.old-abc")                                                   # died between the two renames
    assert stored() == [1]
    monkeypatch.setattr(merge, "swap_in", swap)
    write(3)
    assert stored() == [3] and [n for n in os.listdir(tmpdir_path) if n.startswith("meta.")] == []


def test_merge_frames_pure(spark):
    a = spark.createDataFrame([("k", 1), ("j", 2)], "k string, v int")
    b = spark.createDataFrame([("k", 0)], "k string, v int")
    assert sorted(tuple(r) for r in merge_frames(a, b, ["k"]).collect()) == [("j", 2), ("k", 0)]


def test_missing_target_reads_as_empty_typed_frame(spark, tmpdir_path):
    df = read_or_empty(spark, f"{tmpdir_path}/nothing", schemas.PRICE_TABLE)
    assert df.count() == 0 and df.schema == schemas.PRICE_TABLE


def test_dynamic_overwrite_replaces_only_present_partitions(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string").write.partitionBy("p").parquet(path)
    overwrite_partitions(spark.createDataFrame([(2, "z")], "p int, v string"), path, "p")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("p", "v").collect()) == [(1, "a"), (2, "z")]


def test_unpartitioned_table_appends_new_keys(spark, tmpdir_path):
    path = f"{tmpdir_path}/meta"
    cols = schemas.METADATA_TABLE.fieldNames()

    def meta(coin):
        vals = {c: None for c in cols}
        vals.update(coin_id=coin, is_monitored=True)
        return spark.createDataFrame([tuple(vals[c] for c in cols)], schemas.METADATA_TABLE)
    upsert(meta("btc"), path, schemas.METADATA_KEY, schemas.METADATA_TABLE)
    info = upsert(meta("eth"), path, schemas.METADATA_KEY, schemas.METADATA_TABLE, stats=True)
    assert info == {"rows": 1, "mode": "append"}
    assert sorted(r.coin_id for r in spark.read.parquet(path).collect()) == ["btc", "eth"]
