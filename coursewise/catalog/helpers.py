"""Helper column jobs H1-H4: calendar, typed casts, URL codec, emptiness."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import casts as CS
from ..functions import codec as CD
from ..functions import emptiness as EM
from ..functions import text as TX
from ..functions import timecols as TC
from ..sources import driver
from .base import LINES_CTE, blank_sql, fieldcount_sql, lines_input, register


def _calendar(spark, sf):
    ev = driver.table(spark, sf, "events").select(
        "event_id", "ts", F.timestamp_add("SECOND", F.floor(F.col("value") * 3600), F.col("ts")).alias("later"))
    cal = TC.calendar(ev, "ts")
    return cal.select("event_id", "day_key", "day_text", "epoch_ms", "hour", "minute", "second", "iso_weekday",
                      "is_weekend", "day_start", "day_end", "hour_text", "hour_back", "day_key_from_text",
                      "formatted", "rebuilt", "day_epoch_ms",
                      TC.elapsed_days("ts", "later").alias("elapsed_days"),
                      TC.same_day("ts", "later").alias("same_day"))


_HT = "lpad(CAST(hour(ts) AS VARCHAR), 2, '0')"
register("calendar", f"""
SELECT event_id, strftime(ts, '%Y%m%d') AS day_key, strftime(ts, '%Y-%m-%d') AS day_text,
       epoch_us(ts) // 1000 AS epoch_ms, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(minute(ts) AS INTEGER) AS minute, CAST(second(ts) AS INTEGER) AS second,
       CAST(isodow(ts) AS INTEGER) AS iso_weekday, isodow(ts) >= 6 AS is_weekend,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_start,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND AS day_end,
       {_HT} AS hour_text,
       CASE WHEN {_HT} = '0' THEN {_HT} ELSE regexp_replace({_HT}, '^0', '') END AS hour_back,
       strftime(ts, '%Y%m%d') AS day_key_from_text,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS formatted,
       make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), CAST(second(ts) AS DOUBLE)) AS rebuilt,
       epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS day_epoch_ms,
       CAST((epoch_us(later) - epoch_us(ts)) // 86400000000 AS INTEGER) AS elapsed_days,
       (epoch_us(later) - epoch_us(ts)) // 86400000000 = 0 AS same_day
FROM (SELECT *, ts + to_seconds(CAST(floor(value * 3600) AS BIGINT)) AS later FROM events) e""")(_calendar)


def _safe_cast(spark, sf):
    f = TX.split_fields("value")
    lines = lines_input(spark, sf).where(TX.field_count_ok("value")).select(f.alias("f"))
    g = lambda i: F.col("f").getItem(i)
    return lines.select(g(0).alias("uid_raw"), CS.cast_int(g(0)).alias("uid_int"),
                        CS.cast_long(g(16)).alias("time_long"), CS.cast_double(g(14)).alias("version_double"),
                        CS.cast_boolean(g(4)).alias("vip_bool"), CS.cast_string(g(7)).alias("net_string"))


def _int_sql(s: str, t: str) -> str:
    return (f"CASE WHEN NOT {blank_sql(s)} AND regexp_full_match({s}, '[+-]?[0-9]+') "
            f"THEN COALESCE(TRY_CAST({s} AS {t}), 0) ELSE 0 END")


register("safe_cast", LINES_CTE + f"""
SELECT f[1] AS uid_raw, {_int_sql('f[1]', 'INTEGER')} AS uid_int, {_int_sql('f[17]', 'BIGINT')} AS time_long,
       COALESCE(CASE WHEN NOT {blank_sql('f[15]')} THEN TRY_CAST(trim(f[15]) AS DOUBLE) END, 0.0) AS version_double,
       CASE WHEN f[5] IS NULL THEN false ELSE lower(f[5]) = 'true' END AS vip_bool,
       COALESCE(f[8], '') AS net_string
FROM (SELECT string_split(value, chr(9)) AS f FROM lines WHERE {fieldcount_sql('value')} = 17) t""")(_safe_cast)

register("url_columns", """
SELECT page_id, url, enc, url_decode(replace(enc, '+', '%20')) AS dec
FROM (SELECT page_id, url,
             replace(replace(replace(url_encode(url), '%20', '+'), '~', '%7E'), '%2A', '*') AS enc
      FROM pages) t""")(lambda spark, sf: driver.table(spark, sf, "pages").select(
    "page_id", "url", CD.encode_url("url").alias("enc")).withColumn("dec", CD.decode_url("enc")))

register("empty_filters", f"""
SELECT doc_id, {blank_sql('text')} AS text_blank,
       COALESCE(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) = 0, true) AS lines_empty
FROM documents""")(lambda spark, sf: driver.table(spark, sf, "documents").select(
    "doc_id", EM.string_empty("text").alias("text_blank"),
    EM.array_empty(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).alias("lines_empty")))

register("empty_map_filter", """
SELECT event_id, props, COALESCE(cardinality(CAST(json(props) AS MAP(VARCHAR, INTEGER))) = 0, true) AS props_empty
FROM events""")(lambda spark, sf: driver.table(spark, sf, "events").select(
    "event_id", "props",
    EM.map_empty(F.from_json("props", "map<string,int>")).alias("props_empty")))
