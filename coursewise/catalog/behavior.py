"""Behaviour analyses B1-B6, over the derived log and over the stored, dt-partitioned table."""

from __future__ import annotations

from ..operators import behavior, bitmaps
from ..plans import sinks as SK
from ..plans.warehouse import Warehouse
from ..session import scratch_path
from .base import (LOG_CTE, ORACLES, TEXT_LINES_CTE, behavior_input, clean_sql, lines_input, register, spark_round_sql,
                   stored, stored_sql)


# a video counts as watched when the watch lasts its length
_WATCHED = "event_key = 'endVideo' AND end_video_time - start_video_time >= video_length"
VIDEO_SQL = f"""
SELECT count(DISTINCT uid) FILTER (event_key = 'startVideo') AS watch_video_count,
       count(DISTINCT uid) FILTER ({_WATCHED}) AS complete_video_count, dt
FROM log WHERE event_key = 'startVideo' OR ({_WATCHED}) GROUP BY dt"""
register("video_feedback", LOG_CTE + VIDEO_SQL)(lambda spark, sf: behavior.video_feedback(behavior_input(spark, sf)))

VERSION_SQL = "SELECT os, version, count(*) AS access_count, dt FROM log GROUP BY os, version, dt"
register("version_access", LOG_CTE + VERSION_SQL)(
    lambda spark, sf: behavior.version_access(behavior_input(spark, sf)))

CHANNEL_SQL = """
SELECT channel, count(DISTINCT uid) AS new_user_count, dt
FROM log WHERE event_key = 'registerAccount' GROUP BY channel, dt"""
register("channel_new_users", LOG_CTE + CHANNEL_SQL)(
    lambda spark, sf: behavior.channel_new_users(behavior_input(spark, sf)))

# days with their users by number of events, one row for each band that has any
BANDS_SQL = """
, users AS (SELECT dt, uid, count(*) AS n FROM log GROUP BY ALL)
, days AS (SELECT dt, [count(*) FILTER (n <= 2), count(*) FILTER (n <= 4), count(*) FILTER (n > 4)] AS v
           FROM users GROUP BY dt)
SELECT CASE WHEN k = 1 THEN v[k] ELSE 0 END AS le_two, CASE WHEN k = 2 THEN v[k] ELSE 0 END AS le_four,
       CASE WHEN k = 3 THEN v[k] ELSE 0 END AS gt_four, dt
FROM days, range(1, 4) r(k) WHERE v[k] > 0"""
register("access_bands", LOG_CTE + BANDS_SQL)(lambda spark, sf: behavior.access_bands(behavior_input(spark, sf)))

# which steps each user took on a day; a step counts when all before it were taken too
_STEPS = {"start_app": "event_key = 'startApp'", "start_video": "event_key = 'startVideo'", "complete_video": _WATCHED,
          "start_homework": "event_key = 'startHomework'", "complete_homework": "event_key = 'completeHomework'"}
FUNNEL_SQL = f"""
, steps AS (SELECT dt, uid, {', '.join(f"bool_or({test}) AS {step}" for step, test in _STEPS.items())} FROM log GROUP BY dt, uid)
SELECT {', '.join(f"count(uid) FILTER ({' AND '.join(list(_STEPS)[:k + 1])}) AS {step}_count" for k, step in enumerate(_STEPS))}, dt
FROM steps GROUP BY dt HAVING bool_or(start_app)"""
register("study_funnel", LOG_CTE + FUNNEL_SQL)(lambda spark, sf: behavior.study_funnel(behavior_input(spark, sf)))

# a registration is retained k days later for each active day then; a day has a row if any of its users is active again
_DAY = "CAST(make_timestamp({t} * 1000000) AS DATE)"
_RATES = ", ".join(f"{spark_round_sql(f'count(*) FILTER (later = {k}) / any_value(registered)', 4)} AS {c}"
                   for k, c in enumerate(behavior.RATE_COLUMNS))


def retention_sql(where: str = "true", end: str = "(SELECT max(dt) FROM log)") -> str:
    return f"""
, scoped AS (SELECT * FROM log WHERE {where})
, active AS (SELECT uid, {_DAY.format(t='max(event_time)')} AS day FROM scoped GROUP BY uid, dt)
, registered AS (SELECT uid, dt, {_DAY.format(t='event_time')} AS day, count(*) OVER (PARTITION BY dt) AS registered
                 FROM scoped WHERE event_key = 'registerAccount')
, later AS (SELECT r.dt AS register_day, r.registered, date_diff('day', r.day, a.day) AS later
            FROM registered r JOIN active a ON r.uid = a.uid AND a.day >= r.day)
SELECT register_day, {_RATES}, CAST({end} AS INTEGER) AS dt FROM later GROUP BY register_day"""


register("retention_7d", LOG_CTE + retention_sql())(lambda spark, sf: behavior.retention_7d(behavior_input(spark, sf)))


def _stored_log(spark, sf):
    """The stored log of ``sf``, loaded once in a session."""
    return stored(spark, ("log", sf), lambda: _load_log(spark, sf)).behavior()


def _load_log(spark, sf) -> Warehouse:
    wh = Warehouse(spark)
    src = SK.write_lines(lines_input(spark, sf), scratch_path(spark, "ods_behavior"))
    wh.load_behavior(SK.read_lines(spark, src))
    return wh


register("behavior_table_funnel", stored_sql(ORACLES["study_funnel"]))(
    lambda spark, sf: behavior.study_funnel(_stored_log(spark, sf)))
register("behavior_table_retention", stored_sql(ORACLES["retention_7d"]))(
    lambda spark, sf: behavior.retention_7d(_stored_log(spark, sf)))


# one day, or a window of days, of the stored table: the partition filter prunes the folders
DAY, WINDOW = 20240105, (20240102, 20240106)
_ONE_DAY = stored_sql(LOG_CTE) + f", one AS (SELECT * FROM log WHERE dt = {DAY})"
for _name, _fn, _sql in (("video_feedback", behavior.video_feedback, VIDEO_SQL),
                         ("version_access", behavior.version_access, VERSION_SQL),
                         ("channel_new_users", behavior.channel_new_users, CHANNEL_SQL),
                         ("access_bands", behavior.access_bands, BANDS_SQL),
                         ("study_funnel", behavior.study_funnel, FUNNEL_SQL)):
    register(f"day_{_name}", _ONE_DAY + _sql.replace("FROM log", "FROM one"))(
        lambda spark, sf, f=_fn: f(_stored_log(spark, sf), DAY))
register("window_retention", stored_sql(LOG_CTE) + retention_sql(f"dt BETWEEN {WINDOW[0]} AND {WINDOW[1]}", str(WINDOW[1])))(
    lambda spark, sf: behavior.retention_7d(_stored_log(spark, sf), *WINDOW))
register("behavior_rejects", clean_sql(False, TEXT_LINES_CTE))(
    lambda spark, sf: stored(spark, ("log", sf), lambda: _load_log(spark, sf)).behavior_rejects())


# users as stored bitmaps of each day: the counts of each day, and distinct counts over a window of days
def _bitmaps(spark, sf, *window):
    def build():
        wh = stored(spark, ("log", sf), lambda: _load_log(spark, sf))
        wh.store_user_bitmaps()
        wh.store_user_bitmaps(DAY)  # a day run again replaces its own
        return wh
    return stored(spark, ("bitmaps", sf), build).user_bitmaps(*window)


_RANGE = stored_sql(LOG_CTE) + f", range_log AS (SELECT * REPLACE (0 AS dt) FROM log WHERE dt BETWEEN {WINDOW[0]} AND {WINDOW[1]})"
for _name, _fn, _sql in (("video_feedback", bitmaps.video_feedback, VIDEO_SQL),
                         ("channel_new_users", bitmaps.channel_new_users, CHANNEL_SQL),
                         ("study_funnel", bitmaps.study_funnel, FUNNEL_SQL)):
    register(f"bitmap_{_name}", stored_sql(LOG_CTE) + _sql)(lambda spark, sf, f=_fn: f(_bitmaps(spark, sf), by_day=True))
    register(f"range_{_name}", f"SELECT * EXCLUDE (dt) FROM ({_RANGE + _sql.replace('FROM log', 'FROM range_log')})")(
        lambda spark, sf, f=_fn: f(_bitmaps(spark, sf, *WINDOW)))


def _daily_retention(spark, sf):
    # a day at a time, the third run twice
    wh = stored(spark, ("log", sf), lambda: _load_log(spark, sf))
    for day in (*range(WINDOW[0], WINDOW[1] + 1), WINDOW[0] + 2):
        wh.update_retention(day)
    return wh.retention(*WINDOW)


register("daily_retention", ORACLES["window_retention"])(_daily_retention)
