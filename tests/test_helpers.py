"""H1-H4 on the helper-column inputs of FIXTURES.md 5."""

import datetime as dt

from pyspark.sql import functions as F

from coursewise.functions import casts as C, emptiness as E, timecols as T


def test_calendar_edges(spark):
    ts = [dt.datetime(2019, 4, 13, 23, 59, 59, 999000), dt.datetime(2019, 4, 14, 0, 0, 0),
          dt.datetime(2019, 4, 15, 5, 7, 9)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    r = T.calendar(df, "ts").collect()
    assert [x.day_key for x in r] == ["20190413", "20190414", "20190415"]
    assert [x.iso_weekday for x in r] == [6, 7, 1] and [x.is_weekend for x in r] == [True, True, False]
    assert r[0].epoch_ms == 1555199999999
    assert r[2].hour_text == "05" and r[2].hour_back == "5" and r[1].hour_text == "00" and r[1].hour_back == "0"
    assert r[0].day_start == dt.datetime(2019, 4, 13) and r[0].day_end == dt.datetime(2019, 4, 13, 23, 59, 59, 999000)
    assert r[1].day_key_from_text == "20190414"


def test_elapsed_days_and_same_day(spark):
    pairs = [(dt.datetime(2019, 1, 1, 23, 0), dt.datetime(2019, 1, 2, 1, 0)),   # other date, 2 h: 0 days
             (dt.datetime(2019, 1, 1, 1, 0), dt.datetime(2019, 1, 3, 0, 59)),   # 47 h 59 m: 1 day
             (dt.datetime(2019, 1, 3, 0, 0), dt.datetime(2019, 1, 1, 0, 0))]    # backwards: -2
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    r = df.select(T.elapsed_days("a", "b").alias("d"), T.same_day("a", "b").alias("s")).collect()
    assert [(x.d, x.s) for x in r] == [(0, True), (1, False), (-2, False)]


def test_epoch_to_date_zone(spark):
    df = spark.createDataFrame([(1555199999,)], "t bigint")   # 2019-04-13 23:59:59 UTC
    r = df.select(T.epoch_to_date("t").alias("u"), T.epoch_to_date("t", "Asia/Shanghai").alias("s")).collect()[0]
    assert r.u == dt.date(2019, 4, 13) and r.s == dt.date(2019, 4, 14)


def test_del_zero_and_add_zero(spark):
    df = spark.createDataFrame([(x,) for x in ["0", "5", "05", "12", "00"]], "v string")
    assert [r[0] for r in df.select(T.del_zero("v")).collect()] == ["0", "5", "5", "12", "0"]
    assert [r[0] for r in df.select(T.add_zero("v")).collect()] == ["00", "05", "05", "12", "00"]


def test_safe_casts(spark):
    vals = [None, "", "   ", "12", " 12", "x", "TRUE", "1.5"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    r = df.select(C.cast_int("v"), C.cast_long("v"), C.cast_double("v"), C.cast_boolean("v"),
                  C.cast_string("v")).collect()
    assert [x[0] for x in r] == [0, 0, 0, 12, 0, 0, 0, 0]
    assert [x[1] for x in r] == [0, 0, 0, 12, 0, 0, 0, 0]
    assert [x[2] for x in r] == [0.0, 0.0, 0.0, 12.0, 12.0, 0.0, 0.0, 1.5]
    assert [x[3] for x in r] == [False, False, False, False, False, False, True, False]
    assert [x[4] for x in r] == ["", "", "   ", "12", " 12", "x", "TRUE", "1.5"]


def test_url_codec(spark):
    from coursewise.functions import codec
    df = spark.createDataFrame([("a b&c=é/~*",), ("%zz",)], "v string")
    r = df.select(codec.encode_url("v").alias("e"), codec.decode_url("v").alias("d")).collect()
    assert r[0].e == "a+b%26c%3D%C3%A9%2F%7E*"
    assert r[1].d is None
    back = df.select(codec.decode_url(codec.encode_url("v"))).collect()[0][0]
    assert back == "a b&c=é/~*"


def test_emptiness(spark):
    df = spark.createDataFrame([(None, None, None), ("", [], {}), (" x", [1], {"k": 1})],
                               "s string, a array<int>, m map<string,int>")
    r = df.select(E.string_empty("s"), E.array_empty("a"), E.map_empty("m")).collect()
    assert [tuple(x) for x in r] == [(True, True, True), (True, True, True), (False, False, False)]


def test_build_format_parse(spark):
    df = spark.createDataFrame([("2019-04-13", "2019-13-01")], "a string, b string")
    r = df.select(T.make_ts(2019, 4, 13, 8, 5, 9).alias("t"), T.format_ts(T.make_ts(2019, 4, 13, 8, 5, 9)).alias("f"),
                  T.text_to_epoch_millis("a").alias("ms"), T.text_to_epoch_millis("b").alias("bad"),
                  T.text_to_epoch_millis("a", tz="Asia/Shanghai").alias("sh")).collect()[0]
    assert r.t == dt.datetime(2019, 4, 13, 8, 5, 9) and r.f == "2019-04-13 08:05:09"
    assert r.ms == 1555113600000 and r.bad is None and r.sh == 1555113600000 - 8 * 3600 * 1000
