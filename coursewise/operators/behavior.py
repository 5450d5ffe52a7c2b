"""App-behaviour analyses (B1-B6) over the cleaned behaviour table.

Input columns (see ``sources.driver.behavior_log``): uid, os, channel,
version, video_length, start_video_time, end_video_time, event_key,
event_time, dt.

The reference runs each analysis for one ``day``. Here ``day=None`` runs
every day of the table at once and keys the result by ``dt``; with a day
given the rows are exactly the reference's for that day.

Plan shape: each analysis is one scan with the event-key filter pushed to
the reader and a partial (map-side) aggregation before the only shuffle,
so a hot user or day is pre-combined per task instead of being shipped
whole. The reference's repeated scans of the same table (funnel x5,
feedback x2, bands x3) become one conditional aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_to_date


def finished() -> Column:
    """Watched-to-the-end predicate: (end - start) >= video length."""
    return (F.col("end_video_time") - F.col("start_video_time")) >= F.col("video_length")


def _day(log: DataFrame, day) -> DataFrame:
    return log if day is None else log.where(F.col("dt") == F.lit(int(day)))


def _flag(cond: Column) -> Column:
    return F.max(F.when(cond, 1).otherwise(0))


def _known_user() -> Column:
    """1 for a known user: like ``count(distinct uid)``, NULL counts as nobody."""
    return F.col("uid").isNotNull().cast("int")


def video_feedback(log: DataFrame, day=None) -> DataFrame:
    """B1: users who started a video, users who watched one to the end.

    (watch_video_count, complete_video_count, dt); a day with neither
    event has no row, a day with only one kind has 0 for the other.
    """
    started = F.col("event_key") == "startVideo"
    done = (F.col("event_key") == "endVideo") & finished()
    per_user = (_day(log, day)
                .where(started | done)
                .groupBy("dt", "uid")
                .agg(_flag(started).alias("s"), _flag(done).alias("c")))
    return (per_user.groupBy("dt")
            .agg(F.sum(F.col("s") * _known_user()).alias("watch_video_count"),
                 F.sum(F.col("c") * _known_user()).alias("complete_video_count"))
            .select("watch_video_count", "complete_video_count", "dt"))


def version_access(log: DataFrame, day=None) -> DataFrame:
    """B2: events (not users) per os and version: (os, version, access_count, dt)."""
    return (_day(log, day).groupBy("os", "version", "dt")
            .agg(F.count(F.lit(1)).alias("access_count"))
            .select("os", "version", "access_count", "dt"))


def channel_new_users(log: DataFrame, day=None) -> DataFrame:
    """Distinct registering users per channel: (channel, new_user_count, dt)."""
    return (_day(log, day).where(F.col("event_key") == "registerAccount")
            .groupBy("channel", "dt")
            .agg(F.count_distinct("uid").alias("new_user_count"))
            .select("channel", "new_user_count", "dt"))


def access_bands(log: DataFrame, day=None) -> DataFrame:
    """Users by number of events in the day.

    Like the reference this emits up to three rows per day, one per band, each
    with the other two columns 0: ``le_two`` (<= 2 events), ``le_four``
    (<= 4, cumulative, so it includes le_two) and ``gt_four`` (> 4). A band
    without users has no row.
    """
    per_user = (_day(log, day).groupBy("uid", "dt").agg(F.count(F.lit(1)).alias("access_count")))
    per_day = per_user.groupBy("dt").agg(
        F.count(F.when(F.col("access_count") <= 2, 1)).alias("n2"),
        F.count(F.when(F.col("access_count") <= 4, 1)).alias("n4"),
        F.count(F.when(F.col("access_count") > 4, 1)).alias("n5"))
    zero = F.lit(0).cast("bigint")
    bands = F.explode(F.array(
        F.struct(F.col("n2").alias("le_two"), zero.alias("le_four"), zero.alias("gt_four"), F.col("n2").alias("n")),
        F.struct(zero.alias("le_two"), F.col("n4").alias("le_four"), zero.alias("gt_four"), F.col("n4").alias("n")),
        F.struct(zero.alias("le_two"), zero.alias("le_four"), F.col("n5").alias("gt_four"), F.col("n5").alias("n")),
    )).alias("b")
    return (per_day.select("dt", bands).where(F.col("b.n") > 0)
            .select("b.le_two", "b.le_four", "b.gt_four", "dt"))


def study_funnel(log: DataFrame, day=None) -> DataFrame:
    """startApp -> startVideo -> finished endVideo -> startHomework -> completeHomework.

    The reference left-joins each step on the previous step's uid, so a user
    counts at step n when they have every step 1..n that day (no time order).
    One pass: per (uid, dt) step flags, then a prefix-AND and per-day sums.
    Days without any startApp have no row.
    """
    ek = F.col("event_key")
    steps = [ek == "startApp", ek == "startVideo", (ek == "endVideo") & finished(),
             ek == "startHomework", ek == "completeHomework"]
    names = ["start_app_count", "start_video_count", "complete_video_count",
             "start_homework_count", "complete_homework_count"]
    any_step = steps[0]
    for s in steps[1:]:
        any_step = any_step | s
    flags = (_day(log, day).where(any_step).groupBy("uid", "dt")
             .agg(*[_flag(s).alias(f"f{i}") for i, s in enumerate(steps)]))
    reached = []
    chain = None
    for i in range(len(steps)):
        chain = F.col(f"f{i}") if chain is None else chain * F.col(f"f{i}")
        reached.append((chain * _known_user()).alias(f"r{i}"))
    return (flags.where(F.col("f0") == 1).select("dt", *reached)
            .groupBy("dt").agg(*[F.sum(f"r{i}").alias(n) for i, n in enumerate(names)])
            .select(*names, "dt"))


# The retention table's rate columns, intervals 0 to 6 in order.
RATE_COLUMNS = ("zero_interval_retained_rate", "one_interval_retained_rate",
                "two_interval_retained_rate", "three_interval_retained_rate",
                "four_interval_retained_rate", "five_interval_retained_rate",
                "six_interval_retained_rate")


def retention_7d(log: DataFrame, start_day=None, end_day=None, tz: str = "UTC") -> DataFrame:
    """Seven-day retention rates per registration day.

    For every registration row (event ``registerAccount``; rows, not distinct
    users, as in the reference) and every day the same user was active,
    ``day_interval`` is the whole-day distance between the two events' dates
    (epoch seconds read in zone ``tz``). The rate of interval k (0..6) is the
    number of (registration row, active day k days later) pairs over the
    registration rows of that day; a missing interval is 0. A registration
    day has a row when some registration of that day has an active day on or
    after it (later intervals only keep the row, as in the reference).
    ``dt`` is ``end_day`` (default: the last day in the table). Without a
    window (``start_day``/``end_day`` None) the whole table is used.

    Scale: one scan. Events shrink to a row per (user, day, date) before the
    first shuffle, and a user's rows, as many as the table has days, meet in
    one array; no (registration x activity) pairs are formed, and a user with
    a third of all events is a few rows per task by then. What follows is a
    sum per registration day.
    """
    scoped = log
    if start_day is not None:
        scoped = scoped.where(F.col("dt") >= F.lit(int(start_day)))
    if end_day is not None:
        scoped = scoped.where(F.col("dt") <= F.lit(int(end_day)))

    per_day = scoped.groupBy("uid", "dt", epoch_to_date("event_time", tz).alias("date")).agg(
        F.count(F.when(F.col("event_key") == "registerAccount", 1)).alias("registered"))
    users = per_day.groupBy("uid").agg(F.collect_list(F.struct("dt", "date", "registered")).alias("days"),
                                       F.max("dt").alias("last_dt"))
    # the date a user was active on in a day of the table: that of the day's last event; nobody, for a NULL user
    active = F.transform(F.array_distinct(F.transform("days", lambda x: x["dt"])), lambda dt: F.array_max(
        F.transform(F.filter("days", lambda x: x["dt"] == dt), lambda x: x["date"])))
    users = users.select("last_dt", F.explode_outer(F.filter("days", lambda x: x["registered"] > 0)).alias("reg"),
                         F.when(F.col("uid").isNotNull(), active).otherwise(F.array().cast("array<date>")).alias("active"))

    def is_later(k: int):
        return lambda d: d == F.date_add(F.col("reg.date"), k)

    n = F.col("reg.registered")
    by_day = users.groupBy(F.col("reg.dt").alias("register_day")).agg(
        F.max("last_dt").alias("last_dt"), F.sum(n).alias("register_count"),
        F.max(F.exists("active", lambda d: d >= F.col("reg.date"))).alias("keep"),
        *[F.sum(n * F.size(F.filter("active", is_later(k)))).alias(f"retained_{k}") for k in range(len(RATE_COLUMNS))])
    # a row for each day, and one for users who never registered, whose days count for the last day
    current = F.lit(int(end_day)) if end_day is not None else F.max("last_dt").over(
        Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (by_day.withColumn("current", current.cast("int")).where(F.col("register_day").isNotNull() & F.col("keep"))
            .select("register_day", *[F.round(F.try_divide(F.col(f"retained_{k}"), F.col("register_count")), 4).alias(c)
                                      for k, c in enumerate(RATE_COLUMNS)], F.col("current").alias("dt")))
