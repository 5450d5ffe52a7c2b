"""Seven-day retention kept as a state table that each new day adds to.

A day of the state holds what its activity contributes: for every registration
day up to six days back, the pairs of (registration row, user active on this
day) by interval, and the registration rows of the day itself (interval -1). A
new day reads its own log and the registrations of six others, however long
the history is, and running a day again replaces its rows. The report is a sum
over the state. ``dt`` of the log is the date of its events, as the load
writes it.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .behavior import RATE_COLUMNS

STATE = "register_day int, day_interval int, n long, dt int"
REGISTRATIONS = -1


def _days_before(day: int, n: int) -> int:
    return int((datetime.strptime(str(day), "%Y%m%d") - timedelta(days=n)).strftime("%Y%m%d"))


def day_state(log: DataFrame, day: int) -> DataFrame:
    """(register_day, day_interval, n, dt) that the log of ``day`` adds.

    Both sides of the join are a row per user (and day), so a user with a
    third of all events is seven rows at most. The NULL user's registrations
    count, the user never returns.
    """
    first = _days_before(day, len(RATE_COLUMNS) - 1)
    registered = (log.where((F.col("event_key") == "registerAccount") & F.col("dt").between(first, day))
                  .groupBy("uid", F.col("dt").alias("register_day")).agg(F.count(F.lit(1)).alias("n")))
    active = log.where((F.col("dt") == day) & F.col("uid").isNotNull()).select("uid").distinct()
    date = lambda c: F.to_date(c.cast("string"), "yyyyMMdd")
    returned = (registered.join(active, "uid").groupBy("register_day").agg(F.sum("n").alias("n"))
                .withColumn("day_interval", F.date_diff(date(F.lit(day)), date(F.col("register_day")))))
    own = (registered.where(F.col("register_day") == day).groupBy("register_day").agg(F.sum("n").alias("n"))
           .withColumn("day_interval", F.lit(REGISTRATIONS)))
    return returned.unionByName(own).select("register_day", "day_interval", "n", F.lit(day).alias("dt"))


def retention(state: DataFrame, start_day: int, end_day: int) -> DataFrame:
    """The rates of ``behavior.retention_7d(log, start_day, end_day)`` from the state's days."""
    n, k = F.col("n"), F.col("day_interval")
    scoped = state.where(F.col("dt").between(start_day, end_day) & (F.col("register_day") >= start_day))
    sums = scoped.groupBy("register_day").agg(
        F.sum(F.when(k == REGISTRATIONS, n)).alias("registered"), F.max(k).alias("last"),
        *[F.coalesce(F.sum(F.when(k == i, n)), F.lit(0)).alias(f"retained_{i}") for i in range(len(RATE_COLUMNS))])
    # a registration of a known user is an active day of its own: a day without any has no row
    return (sums.where(F.col("last") >= 0)
            .select("register_day", *[F.round(F.try_divide(F.col(f"retained_{i}"), F.col("registered")), 4).alias(c)
                                      for i, c in enumerate(RATE_COLUMNS)], F.lit(int(end_day)).alias("dt")))
