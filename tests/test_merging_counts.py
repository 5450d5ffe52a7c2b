"""Stored distinct counts and retention state against the one-pass analyses; tables replaced in one step."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from coursewise.operators import behavior as B
from coursewise.operators import bitmaps as M
from coursewise.operators import retention_state as R
from coursewise.plans import sinks as S
from coursewise.plans.warehouse import Warehouse
from coursewise.session import scratch_path

from conftest import rows

DAYS = [20240227, 20240228, 20240229, 20240301, 20240302, 20240303, 20240304, 20240305, 20240306]
EVENTS = ["startApp", "startVideo", "endVideo", "startHomework", "completeHomework", "registerAccount", "other"]
SCHEMA = ("uid long, os string, channel string, version string, video_length long, start_video_time long, "
          "end_video_time long, event_key string, event_time long, dt int")


@pytest.fixture(scope="module")
def log(spark):
    """Users around the edges of buckets, negative ones and NULL; one user with many events; a day of NULL users only."""
    import calendar
    rng = random.Random(5)
    users = [None, 0, -1, -32768, -32767, 32768, 32769, 65536, 7, 8, 9, 2**40, 10**6]
    out = []
    for n in range(900):
        day = rng.choice(DAYS[:-1])
        uid = 7 if n % 3 == 0 else rng.choice(users)
        t = calendar.timegm((day // 10000, day // 100 % 100, day % 100, rng.randrange(24), 0, 0))
        out.append((uid, "a", rng.choice(["web", None, "app"]), "1", 60, t, t + rng.choice([10, 60, 90]), rng.choice(EVENTS), t, day))
    t = calendar.timegm((2024, 3, 6, 5, 0, 0))
    out += [(None, "a", "web", "1", 60, t, t + 60, e, t, DAYS[-1]) for e in EVENTS]
    return spark.createDataFrame(out, SCHEMA)


def test_bitmaps_of_days_give_the_counts_of_days(spark, log):
    bits = M.user_bitmaps(log)
    for ours, theirs in ((M.video_feedback, B.video_feedback), (M.channel_new_users, B.channel_new_users),
                         (M.study_funnel, B.study_funnel)):
        assert rows(ours(bits, by_day=True)) == rows(theirs(log))


def test_bitmaps_merge_over_days(spark, log):
    bits = M.user_bitmaps(log)
    one = log.withColumn("dt", F.lit(0))
    for ours, theirs in ((M.video_feedback, B.video_feedback), (M.channel_new_users, B.channel_new_users),
                         (M.study_funnel, B.study_funnel)):
        assert rows(ours(bits)) == rows(theirs(one).drop("dt"))
        assert ours(M.user_bitmaps(log.limit(0))).count() == ours(M.user_bitmaps(log.limit(0)), by_day=True).count() == 0


def test_users_travel_before_bitmaps(spark, log):
    plan = M.user_bitmaps(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2  # distinct users, then by bucket; bitmaps are made behind the second
    assert "partial_bitmap_construct" in plan.split("Exchange")[0]


def _warehouse(spark, log):
    wh = Warehouse(spark)
    S.overwrite_partitions(log, wh.path("dwd", "user_behavior"), ("dt",))
    return wh


def test_days_of_the_state_give_the_window(spark, log):
    wh = _warehouse(spark, log)
    for day in DAYS:
        wh.update_retention(day)
    wh.update_retention(DAYS[3])  # once more
    for start, end in ((DAYS[0], DAYS[-1]), (DAYS[1], DAYS[4]), (DAYS[-1], DAYS[-1])):
        assert rows(wh.retention(start, end)) == rows(B.retention_7d(log, start, end))


def test_a_day_reads_seven_days(spark, log):
    wh = _warehouse(spark, log)
    scans = R.day_state(wh.behavior(), DAYS[-1])._jdf.queryExecution().executedPlan().toString()
    assert "20240229" in scans and "PartitionFilters" in scans and "EqualTo(event_key,registerAccount)" in scans


def test_stored_bitmaps_by_range(spark, log):
    wh = _warehouse(spark, log)
    wh.store_user_bitmaps()
    wh.store_user_bitmaps(DAYS[2])
    assert rows(M.study_funnel(wh.user_bitmaps(DAYS[1], DAYS[3]))) == rows(
        B.study_funnel(log.where(F.col("dt").between(DAYS[1], DAYS[3])).withColumn("dt", F.lit(0))).drop("dt"))


def test_replaced_in_one_step(spark):
    root, df = scratch_path(spark, "it's"), spark.range(5).withColumn("a b", F.lit("x"))
    S.replace_table(df, "swapped", root)
    S.replace_table(df.where("id > 2"), "swapped", root)
    broken = df.withColumn("a b", F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("a b")))
    with pytest.raises(PySparkException):
        S.replace_table(broken, "swapped", root)
    assert [r.id for r in spark.table("swapped").orderBy("id").collect()] == [3, 4]
    with pytest.raises(ValueError):
        S.replace_table(df.drop("id"), "swapped", root)
    spark.sql("DROP TABLE swapped")
