import datetime as dt

from pyspark.sql import functions as F, types as T

from tickvault.functions import nulls, times
from tickvault.functions.nested import quote_field, present, field_of_each, keywords
from tickvault import schemas


def test_parse_iso_variants_and_bad_text(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05+00:00",), ("2024-01-02 03:04:05",),
                                ("2024-01-02T05:04:05+02:00",), ("2024-01-01T22:04:05-0500",), ("2024-01-02T03:04:05.100Z",),
                                ("2024-01-02T03:04:05.900123Z",), ("",), ("junk",), (None,), ("2024-01-02T03:04:05 garbage",),
                                ("2024-01-02T03:04:05Zx",), ("2024-13-02T03:04:05Z",), ("2024-01-02",)], "s string")
    got = [r[0] for r in df.select(times.parse_iso("s")).collect()]
    want = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[:5] == [want] * 5
    assert got[5:7] == [want.replace(microsecond=100_000), want.replace(microsecond=900_123)]
    assert got[7:] == [None] * 7


def test_parse_iso_is_zone_independent(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.createDataFrame([("2024-06-01T12:00:00Z",)], "s string").select(times.parse_iso("s")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == dt.datetime(2024, 6, 1, 12, 0, 0)


def test_epoch_to_iso_z(spark):
    got = spark.createDataFrame([(0,), (1704067200,), (1704067261,)], "s long") \
        .select(times.iso_from_epoch("s")).collect()
    assert [r[0] for r in got] == ["1970-01-01T00:00:00Z", "2024-01-01T00:00:00Z", "2024-01-01T00:01:01Z"]


def test_strip_iso(spark):
    got = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05+00:00",)], "s string") \
        .select(times.strip_iso("s")).collect()
    assert [r[0] for r in got] == ["2024-01-02 03:04:05"] * 2


def test_date_hour_and_relative_day(spark):
    r = spark.createDataFrame([(dt.datetime(2024, 3, 1, 17, 30),)], "ts timestamp_ntz").select(
        times.ts_date("ts"), times.ts_hour("ts"), times.days_before("2024-03-01", 364)).first()
    assert r[0] == dt.date(2024, 3, 1) and r[1] == 17 and r[2] == dt.date(2023, 3, 3)


def test_falsy_and_fallback_chain(spark):
    df = spark.createDataFrame([(None, None), ("", "t"), ("b", "t"), ("", "")], "body string, title string")
    got = df.select(nulls.falsy_default("body"), nulls.first_non_empty("body", "title")).collect()
    assert [tuple(r) for r in got] == [("", ""), ("", "t"), ("b", "b"), ("", "")]


def test_fillna_touches_strings_only(spark):
    df = spark.createDataFrame([(None, None, None)], "s string, d double, b boolean")
    r = nulls.fill_strings(df).first()
    assert r["s"] == "NA" and r["d"] is None and r["b"] is None


def test_quote_lookup_missing_currency_is_null(spark):
    df = spark.createDataFrame([({"USD": {"price": 1.5}},), ({"EUR": {"price": 2.0}},), (None,)],
                               T.StructType([T.StructField("quotes", T.MapType(T.StringType(), schemas.QUOTE))]))
    got = [r[0] for r in df.select(quote_field("quotes", "price")).collect()]
    assert got == [1.5, None, None]


def test_present_transform_keywords(spark):
    df = spark.createDataFrame([([{"text": "a"}, {"text": "b"}], None, "n", "s")],
                               "tags array<struct<text:string>>, rt string, name string, symbol string")
    r = df.select(field_of_each("tags", "text"), present("rt"), keywords("name", "symbol")).first()
    assert r[0] == ["a", "b"] and r[1] is False and r[2] == ["n", "s"]
