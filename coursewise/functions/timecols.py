"""Epoch / calendar column helpers.

Everything here is zone-explicit: an epoch-second column is turned into a
wall-clock value of a named zone without consulting the session time zone,
so the same job gives the same days on every cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_local_ntz(epoch_seconds, tz: str = "UTC") -> Column:
    """Epoch seconds -> zone-less wall-clock timestamp in ``tz``."""
    utc_wall = F.timestamp_add("SECOND", _c(epoch_seconds), F.expr(_EPOCH_NTZ))
    if tz.upper() == "UTC":
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def epoch_to_date(epoch_seconds, tz: str = "UTC") -> Column:
    """``from_unixtime(t, 'yyyy-MM-dd')`` as a DATE, in an explicit zone."""
    return F.to_date(epoch_to_local_ntz(epoch_seconds, tz))


def day_key(ts) -> Column:
    """8-digit integer day key ``yyyyMMdd`` of a timestamp or date."""
    c = _c(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


# ---------------------------------------------------------------- H1 calendar

def ntz_epoch_millis(ts, tz: str = "UTC") -> Column:
    """Epoch milliseconds of a zone-less timestamp read as wall time in ``tz``."""
    c = _c(ts)
    utc = c if tz.upper() == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), c)
    return F.floor(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), utc) / 1000).cast("bigint")


def iso_weekday(ts) -> Column:
    """ISO day of week: Monday 1 ... Sunday 7."""
    return (F.weekday(_c(ts)) + 1).cast("int")


def is_weekend(ts) -> Column:
    return iso_weekday(ts) >= 6


def start_of_day(ts) -> Column:
    """Midnight of the timestamp's day (zone-less)."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def end_of_day(ts) -> Column:
    """Last millisecond of the timestamp's day (23:59:59.999)."""
    return F.timestamp_add("MILLISECOND", F.lit(-1), F.timestamp_add("DAY", F.lit(1), start_of_day(ts)))


def add_zero(c) -> Column:
    """'5' -> '05'; values above 9 unchanged."""
    return F.lpad(_c(c).cast("string"), 2, "0")


def del_zero(c) -> Column:
    """'05' -> '5'; '0' stays '0' ('00' -> '0')."""
    c = _c(c)
    return F.when(c == "0", c).otherwise(F.regexp_replace(c, "^0", ""))


def dash_to_compact(day_text) -> Column:
    """'yyyy-MM-dd' text -> 'yyyyMMdd' text (NULL when it does not parse)."""
    return F.date_format(F.try_to_timestamp(_c(day_text), F.lit("yyyy-MM-dd")), "yyyyMMdd")


def elapsed_days(start, end) -> Column:
    """Whole elapsed 24-hour days from ``start`` to ``end`` (toward zero)."""
    return F.timestamp_diff("DAY", _c(start), _c(end)).cast("int")


def same_day(start, end) -> Column:
    """Less than 24 hours apart (either direction), the reference's test."""
    return elapsed_days(start, end) == 0


DEFAULT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def make_ts(year, month, day, hour=0, minute=0, second=0) -> Column:
    """Zone-less timestamp from its parts (the reference's date builders)."""
    lit = lambda v: _c(v) if not isinstance(v, int) else F.lit(v)
    return F.make_timestamp_ntz(lit(year), lit(month), lit(day), lit(hour), lit(minute), lit(second))


def format_ts(ts, fmt: str = DEFAULT_FORMAT) -> Column:
    """Timestamp -> text (default 'yyyy-MM-dd HH:mm:ss')."""
    return F.date_format(_c(ts), fmt)


def text_to_epoch_millis(text, pattern: str = "yyyy-MM-dd", tz: str = "UTC") -> Column:
    """Date/time text in ``pattern`` read as wall time in ``tz`` -> epoch ms (NULL if it does not parse)."""
    return ntz_epoch_millis(F.try_to_timestamp(_c(text), F.lit(pattern)).cast("timestamp_ntz"), tz)


def calendar(df, ts: str = "ts", tz: str = "UTC"):
    """H1: calendar columns of a zone-less timestamp column, added to ``df``."""
    c = F.col(ts)
    return df.select(
        "*",
        F.date_format(c, "yyyyMMdd").alias("day_key"),
        F.date_format(c, "yyyy-MM-dd").alias("day_text"),
        ntz_epoch_millis(c, tz).alias("epoch_ms"),
        F.hour(c).alias("hour"), F.minute(c).alias("minute"), F.second(c).alias("second"),
        iso_weekday(c).alias("iso_weekday"), is_weekend(c).alias("is_weekend"),
        start_of_day(c).alias("day_start"), end_of_day(c).alias("day_end"),
        add_zero(F.hour(c)).alias("hour_text"),
        del_zero(add_zero(F.hour(c))).alias("hour_back"),
        dash_to_compact(F.date_format(c, "yyyy-MM-dd")).alias("day_key_from_text"),
        format_ts(c).alias("formatted"),
        make_ts(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), F.second(c)).alias("rebuilt"),
        text_to_epoch_millis(F.date_format(c, "yyyy-MM-dd"), "yyyy-MM-dd", tz).alias("day_epoch_ms"),
    )
