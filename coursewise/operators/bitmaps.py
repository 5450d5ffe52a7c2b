"""Distinct users as bitmaps that merge: B1, B3 and B5 over any range of days.

``user_bitmaps`` turns a log into exact bitmaps of its users, for each day and
kind of event (and channel, for registrations). Stored by day, they answer the
distinct counts of one day, or of a range of days by OR over its days, without
another look at the log: a user active on several days counts once.

A bitmap holds 32,768 neighbouring ids in 4 KB, so users should be numbered
densely; a bucket without users has no row, and thin bitmaps shrink in storage.
The NULL user has a row without a bucket, which counts nobody but keeps the
day in the result, as in ``operators.behavior``.

Scale: users are made distinct by a map-side aggregate and meet by bucket, at
most 32,768 a group whatever a user's or an event's share of the log; merging
ships bitmaps only, pre-merged in each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .behavior import finished

# The funnel's steps in order; ``watched`` is an endVideo that lasted the video's length.
STEPS = ("startApp", "startVideo", "watched", "startHomework", "completeHomework")
STEP_COUNTS = ("start_app_count", "start_video_count", "complete_video_count", "start_homework_count",
               "complete_homework_count")
REGISTERED = "registerAccount"


def user_bitmaps(log: DataFrame) -> DataFrame:
    """(kind, channel, bucket, bits, dt); ``channel`` is NULL but for registrations."""
    kind = F.when(F.col("event_key") == "endVideo", F.when(finished(), "watched")).when(
        F.col("event_key").isin(*STEPS, REGISTERED), F.col("event_key"))
    channel = F.when(F.col("event_key") == REGISTERED, F.col("channel"))
    keys = ["dt", "kind", "channel", "bucket"]
    users = (log.select("dt", kind.alias("kind"), channel.alias("channel"), "uid")
             .where(F.col("kind").isNotNull()).distinct()
             .withColumn("bucket", F.bitmap_bucket_number("uid")).repartition(*keys))
    return (users.groupBy(*keys).agg(F.bitmap_construct_agg(F.bitmap_bit_position("uid")).alias("bits"))
            .select("kind", "channel", "bucket", "bits", "dt"))


def _merged(bitmaps: DataFrame, by_day: bool, *keys: str) -> tuple[list[str], DataFrame]:
    """One bitmap for each of ``keys`` and bucket, over all days or for each."""
    days = ["dt"] if by_day else []
    return days, bitmaps.groupBy(*days, *keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _users(bits: Column | str) -> Column:
    """Number of users of a bitmap; nobody in the row of the NULL user."""
    return F.when(F.col("bucket").isNotNull(), F.bitmap_count(bits)).otherwise(0)


def video_feedback(bitmaps: DataFrame, by_day: bool = False) -> DataFrame:
    """B1 of all days of ``bitmaps`` together, or of each: users who started a video, users who watched one."""
    days, merged = _merged(bitmaps.where(F.col("kind").isin("startVideo", "watched")), by_day, "kind")
    total = [F.sum(F.when(F.col("kind") == k, _users("bits")).otherwise(0)).alias(name)
             for k, name in (("startVideo", "watch_video_count"), ("watched", "complete_video_count"))]
    out = merged.groupBy(*days).agg(*total, F.count(F.lit(1)).alias("_n")).where("_n > 0")
    return out.select("watch_video_count", "complete_video_count", *days)


def channel_new_users(bitmaps: DataFrame, by_day: bool = False) -> DataFrame:
    """B3 of all days of ``bitmaps`` together, or of each: distinct registering users by channel."""
    days, merged = _merged(bitmaps.where(F.col("kind") == REGISTERED), by_day, "channel")
    return (merged.groupBy("channel", *days).agg(F.sum(_users("bits")).alias("new_user_count"))
            .select("channel", "new_user_count", *days))


def study_funnel(bitmaps: DataFrame, by_day: bool = False) -> DataFrame:
    """B5 of all days of ``bitmaps`` together, or of each: users with every step up to the n-th.

    Over several days a user may take the steps on different days. Without
    any startApp there is no row, as for a day.
    """
    days = ["dt"] if by_day else []
    step = F.col("kind")
    # a bitmap for each step of a bucket (empty without users), then the AND over the first n of them: one shuffle
    steps = bitmaps.where(step.isin(*STEPS)).groupBy(*days, "bucket").agg(
        F.max(F.when(step == STEPS[0], 1).otherwise(0)).alias("started"),
        F.array(*[F.bitmap_or_agg(F.when(step == s, F.col("bits"))) for s in STEPS]).alias("all_bits"))
    chains = steps.select(*days, "bucket", "started", F.posexplode("all_bits").alias("at", "bits"))
    reached = chains.groupBy(*days, "bucket").agg(F.max("started").alias("started"), *[
        F.bitmap_count(F.bitmap_and_agg(F.when(F.col("at") <= n, F.col("bits")))).alias(f"reached{n}") for n in range(len(STEPS))])
    counts = [F.sum(F.when(F.col("bucket").isNotNull(), F.col(f"reached{n}")).otherwise(0)).alias(c)
              for n, c in enumerate(STEP_COUNTS)]
    out = reached.groupBy(*days).agg(*counts, F.max("started").alias("started"))
    return out.where("started = 1").select(*STEP_COUNTS, *days)
