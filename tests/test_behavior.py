"""B1-B6 golden values from the five user groups of FIXTURES.md 1.1-1.2 (scaled 1/100)."""

from pyspark.sql import functions as F

from coursewise.operators import behavior as B

EVENTS = ["registerAccount", "startApp", "startVideo", "endVideo", "startHomework", "completeHomework",
          "enterOrderPage", "completeOrder"]
# group: (first uid, users, events per user, channel, os, version); users scaled by 1/100
GROUPS = [(20001, 80, 4, "auto", "ios", "1.0"), (30001, 70, 5, "huawei", "ios", "1.0"),
          (40001, 60, 6, "huawei", "ios", "1.0"), (50001, 40, 7, "toutiao", "ios", "1.1"),
          (60000, 20, 8, "toutiao", "ios", "2.0")]
DAY, T0 = 20190413, 1555113600  # 2019-04-13 00:00:00 UTC


def group_log(spark):
    rows = []
    for first, n, k, channel, os_, version in GROUPS:
        for u in range(first, first + n):
            for i, ev in enumerate(EVENTS[:k]):
                t = T0 + 3600 + i * 400
                video = ev in ("startVideo", "endVideo")
                rows.append((u, os_, channel, version, 300 if video else 0, t - 300 if video else 0,
                             t if video else 0, ev, t, DAY))
    return spark.createDataFrame(rows, "uid bigint, os string, channel string, version string, video_length int, "
                                       "start_video_time bigint, end_video_time bigint, event_key string, "
                                       "event_time bigint, dt int")


def test_funnel(spark):
    r = B.study_funnel(group_log(spark)).collect()[0]
    assert tuple(r) == (270, 270, 270, 190, 120, DAY)


def test_channels_versions_bands_feedback(spark):
    log = group_log(spark)
    assert {(r.channel, r.new_user_count) for r in B.channel_new_users(log).collect()} == \
        {("auto", 80), ("huawei", 130), ("toutiao", 60)}
    assert {(r.os, r.version, r.access_count) for r in B.version_access(log).collect()} == \
        {("ios", "1.0", 1030), ("ios", "1.1", 280), ("ios", "2.0", 160)}
    assert sorted(tuple(r) for r in B.access_bands(log).collect()) == [(0, 0, 190, DAY), (0, 80, 0, DAY)]
    assert [tuple(r) for r in B.video_feedback(log).collect()] == [(270, 270, DAY)]


def test_retention_single_day(spark):
    r = B.retention_7d(group_log(spark), DAY, DAY + 6).collect()
    assert len(r) == 1
    assert r[0].register_day == DAY and r[0].zero_interval_retained_rate == 1.0
    assert all(r[0][c] == 0.0 for c in B.RATE_COLUMNS[1:]) and r[0].dt == DAY + 6


def test_retention_counts_rows_and_late_days(spark):
    # user 1 registers twice on day 1 and is active on day 3 and day 10;
    # user 2 registers on day 1 only
    d = lambda k: T0 + k * 86400 + 60
    rows = [(1, "registerAccount", d(0), DAY), (1, "registerAccount", d(0) + 5, DAY),
            (1, "startApp", d(2), DAY + 2), (1, "startApp", d(9), DAY + 9), (2, "registerAccount", d(0), DAY)]
    log = spark.createDataFrame(rows, "uid bigint, event_key string, event_time bigint, dt int")
    r = B.retention_7d(log).collect()[0]
    # 3 registration rows on day 0 -> interval 0 retained 3, interval 2 retained 2 (user 1's two rows)
    assert r.zero_interval_retained_rate == 1.0
    assert r.two_interval_retained_rate == round(2 / 3, 4)
    assert r.dt == DAY + 9


def test_one_day_filter_matches_all_days(spark):
    log = group_log(spark).unionByName(group_log(spark).withColumn("dt", F.lit(DAY + 1)))
    all_days = {tuple(r) for r in B.study_funnel(log).collect()}
    assert {tuple(r) for r in B.study_funnel(log, DAY + 1).collect()} <= all_days
    assert len(all_days) == 2
