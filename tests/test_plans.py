"""The physical plans the scale design relies on (checked with the executed plan text)."""
from pyspark.sql import functions as F

import __spark_entry__ as E
from tickvault import schemas
from tickvault.operators.topn import latest_per_key
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_per_keyword_limits_before_each_shuffle(spark):
    p = plan(E.queries()["keyword_search_topk"](spark, SF_SMALL))
    assert p.count("WindowGroupLimit") >= 4 and "Partial" in p          # salted and final phase, map side
    assert "BroadcastNestedLoopJoin" not in p and "Python" not in p     # keywords are found by an equi-join on grams


def test_dedup_is_partially_aggregated_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("user_id").cast("string").alias("coin_id"), F.col("ts").alias("read_timestamp"), "value")
    p = plan(latest_per_key(df, ["coin_id", "read_timestamp"], ["value"]))
    assert "partial_max_by" in p


def test_filters_and_projection_reach_the_scan(spark):
    p = plan(E.queries()["lang_text_search"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(lang), IsNotNull(text), IsNotNull(doc_id), EqualTo(lang,en)]" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,n_chars:bigint>" in p
    assert "TakeOrderedAndProject" in p


def test_anti_join_right_side_is_distinct_ids(spark):
    p = plan(E.queries()["missing_ids_anti"](spark, SF_SMALL))
    assert "LeftAnti" in p and "HashAggregate" in p
    assert "ReadSchema: struct<user_id:bigint>" in p


def test_resample_uses_decomposable_max_by(spark):
    p = plan(E.queries()["resample_interval"](spark, SF_SMALL))
    assert "partial_max_by" in p


def test_no_cartesian_products_anywhere(spark):
    for name in ["price_point", "meta_ticker_merge", "active_price_join", "missing_ids_except", "id_exists",
                 "post_lookup", "universe_distinct", "row_count", "json_array_explode", "ohlc_bars"]:
        assert "CartesianProduct" not in plan(E.queries()[name](spark, SF_SMALL)), name


def test_merge_streams_stored_rows_through_a_broadcast_anti_join(spark, tmpdir_path):
    from tickvault.sinks.merge import replace_keys
    stored_path, batch_path = f"{tmpdir_path}/stored", f"{tmpdir_path}/batch"
    spark.range(0, 20000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v")) \
        .write.parquet(stored_path)
    spark.range(0, 10).select(F.col("id").cast("string").alias("k"), F.lit(99).cast("bigint").alias("v")) \
        .write.parquet(batch_path)
    out = replace_keys(spark.read.parquet(stored_path), spark.read.parquet(batch_path), ["k"])
    p = plan(out)
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    assert out.count() == 20000 and out.filter("v = 99").count() == 10


def test_flagship_join_broadcasts_the_coin_dimension(spark):
    p = plan(E.entry(spark))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "PushedFilters: [IsNotNull(c_mktsegment), Not(EqualTo(c_mktsegment,AUTOMOBILE))]" in p
