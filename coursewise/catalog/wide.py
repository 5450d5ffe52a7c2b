"""Quiz wide tables Q1-Q6, member wide table M1-M3, and their layered (written) runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import member as MB
from ..operators import quiz as QZ
from ..operators import reports
from ..plans import sinks as SK
from ..plans.warehouse import Warehouse
from ..session import scratch_path
from ..sources import feeds as FD
from ..sources import ods
from .base import ORACLES, dwd_ctes, dwd_input, reader_sql, register, stored
from .reports import AVG_SQL, BANDS_SQL, ERROR_RATE_SQL, LOW3_SQL, MIN_MAX_SQL, PASS_RATE_SQL, TOP3_SQL


def _q_chapter(spark, sf):
    d = lambda f: dwd_input(spark, sf, f)
    return QZ.chapter_wide(d("QzChapter"), d("QzChapterList"), d("QzPoint"), d("QzPointQuestion"))


def _q_course(spark, sf):
    d = lambda f: dwd_input(spark, sf, f)
    return QZ.course_wide(d("QzSiteCourse"), d("QzCourse"), d("QzCourseEduSubject"))


def _q_major(spark, sf):
    d = lambda f: dwd_input(spark, sf, f)
    return QZ.major_wide(d("QzMajor"), d("QzWebsite"), d("QzBusiness"))


def _q_paper(spark, sf):
    d = lambda f: dwd_input(spark, sf, f)
    return QZ.paper_wide(d("QzPaperView"), d("QzCenterPaper"), d("QzCenter"), d("QzPaper"))


def _q_question(spark, sf):
    d = lambda f: dwd_input(spark, sf, f)
    return QZ.question_wide(d("QzQuestion"), d("QzQuestionType"))


def _q_detail(spark, sf):
    """Q6; the answers, which it reads twice, are parsed once into a written intermediate."""
    answers, path = dwd_input(spark, sf, "QzMemberPaperQuestion"), scratch_path(spark, "answers")
    answers.write.parquet(path)
    return QZ.user_paper_detail(spark.read.schema(answers.schema).parquet(path), _q_chapter(spark, sf),
                                _q_course(spark, sf), _q_major(spark, sf), _q_paper(spark, sf),
                                _q_question(spark, sf))


_CHAPTER_SQL = f"""
SELECT {', '.join('showstatus AS status' if c == 'status' else c for c in QZ.CHAPTER_WIDE)}
FROM ({reader_sql('chapter', 'dwd_qz_chapter')}) a
JOIN ({reader_sql('chapter_list', 'dwd_qz_chapter_list')}) b USING (chapterlistid, dn, dt)
JOIN ({reader_sql('point', 'dwd_qz_point')}) c USING (chapterid, dn, dt)
JOIN ({reader_sql('point_question', 'dwd_qz_point_question')}) d USING (pointid, dn, dt)"""
_COURSE_SQL = f"""
SELECT {', '.join(QZ.COURSE_WIDE)}
FROM ({reader_sql('site_course', 'dwd_qz_site_course')}) a
JOIN ({reader_sql('course', 'dwd_qz_course')}) b USING (courseid, dn, dt)
JOIN ({reader_sql('course_edusubject', 'dwd_qz_course_edusubject')}) c USING (courseid, dn, dt)"""
_MAJOR_SQL = f"""
SELECT {', '.join(QZ.MAJOR_WIDE)}
FROM ({reader_sql('major', 'dwd_qz_major')}) a
JOIN ({reader_sql('website', 'dwd_qz_website')}) b USING (siteid, dn, dt)
JOIN ({reader_sql('business', 'dwd_qz_business')}) c USING (businessid, dn, dt)"""
_PAPER_SQL = f"""
SELECT {', '.join(QZ.PAPER_WIDE)}
FROM ({reader_sql('paper_view', 'dwd_qz_paper_view')}) a
LEFT JOIN ({reader_sql('center_paper', 'dwd_qz_center_paper')}) b USING (paperviewid, dn, dt)
LEFT JOIN ({reader_sql('center', 'dwd_qz_center')}) c USING (centerid, dn, dt)
JOIN ({reader_sql('paper', 'dwd_qz_paper')}) d USING (paperid, dn, dt)"""
_QUESTION_SQL = f"""
SELECT {', '.join(QZ.QUESTION_WIDE)}
FROM ({reader_sql('question', 'dwd_qz_question')}) a
JOIN ({reader_sql('question_type', 'dwd_qz_question_type')}) b USING (questypeid, dn, dt)"""

_CH_FEEDS = ("QzChapter", "QzChapterList", "QzPoint", "QzPointQuestion")
_CO_FEEDS = ("QzSiteCourse", "QzCourse", "QzCourseEduSubject")
_MA_FEEDS = ("QzMajor", "QzWebsite", "QzBusiness")
_PA_FEEDS = ("QzPaperView", "QzCenterPaper", "QzCenter", "QzPaper")
_QU_FEEDS = ("QzQuestion", "QzQuestionType")

register("chapter_wide", dwd_ctes(*_CH_FEEDS) + _CHAPTER_SQL)(_q_chapter)
register("course_wide", dwd_ctes(*_CO_FEEDS) + _COURSE_SQL)(_q_course)
register("major_wide", dwd_ctes(*_MA_FEEDS) + _MAJOR_SQL)(_q_major)
register("paper_wide", dwd_ctes(*_PA_FEEDS) + _PAPER_SQL)(_q_paper)
register("question_wide", dwd_ctes(*_QU_FEEDS) + _QUESTION_SQL)(_q_question)

_DETAIL_SQL = (dwd_ctes(*_CH_FEEDS, *_CO_FEEDS, *_MA_FEEDS, *_PA_FEEDS, *_QU_FEEDS, "QzMemberPaperQuestion")
               + f""", dws_qz_chapter AS ({_CHAPTER_SQL}), dws_qz_course AS ({_COURSE_SQL}),
dws_qz_major AS ({_MAJOR_SQL}), dws_qz_paper AS ({_PAPER_SQL}), dws_qz_question AS ({_QUESTION_SQL}),
fact AS (SELECT userid, paperviewid, chapterid, sitecourseid, questionid, majorid, useranswer, istrue, lasttime,
                opertype, spendtime, score, question_answer AS user_question_answer, dt, dn
         FROM dwd_qz_member_paper_question),
ch AS ({reader_sql('dws_chapter', 'dws_qz_chapter')}),
co AS (SELECT * EXCLUDE (majorid, chapterlistid, pointlistid) RENAME (sitecourse_creator AS course_creator,
              sitecourse_createtime AS course_createtime)
       FROM ({reader_sql('dws_course', 'dws_qz_course')})),
ma AS ({reader_sql('dws_major', 'dws_qz_major')}),
pa AS (SELECT * EXCLUDE (courseid) FROM ({reader_sql('dws_paper', 'dws_qz_paper')})),
qu AS ({reader_sql('dws_question', 'dws_qz_question')})
SELECT {', '.join(QZ.PAPER_DETAIL)}
FROM fact JOIN co USING (sitecourseid, dn, dt) JOIN ch USING (chapterid, dn, dt)
JOIN ma USING (majorid, dn, dt) JOIN pa USING (paperviewid, dn, dt) JOIN qu USING (questionid, dn, dt)""")
register("paper_detail", _DETAIL_SQL)(_q_detail)

# member

_MB_FEEDS = ("member", "memberRegtype", "baseadlog", "baswewebsite", "pcentermempaymoney", "pcenterMemViplevel")


def _mb_inputs(spark, sf):
    return [dwd_input(spark, sf, f) for f in _MB_FEEDS]


def _reader(name: str, table: str, **also) -> str:
    """Sub-select of a member reader; ``also``: further columns by alias."""
    amount = "TRY_CAST(paymoney AS DECIMAL(10,4))"
    cols = [f'{amount if (name, src) == ("paymoney", "paymoney") else chr(34) + src + chr(34)} AS {alias}' for src, alias in MB.pairs(name)]
    return f"(SELECT {', '.join(cols + [f'{e} AS {a}' for a, e in also.items()])} FROM {table})"


# every joined row; the smallest of a member (columns in their declared order, NULL first) gives the plain columns
_PLAIN = MB.MEMBER_COLS + MB.REG_COLS + MB.SITE_COLS + ("adname", "vip_id", "vip_max_free", "vip_min_free", "vip_operator")
_JOINED = f"""
SELECT * FROM {_reader('member', 'dwd_member')} m
LEFT JOIN (SELECT r.* EXCLUDE (siteid), w.* EXCLUDE (dn)
           FROM {_reader('regtype', 'dwd_member_regtype')} r
           LEFT JOIN {_reader('website', 'dwd_base_website')} w ON r.siteid = w.siteid AND r.dn = w.dn) USING (uid, dn)
LEFT JOIN {_reader('base_ad', 'dwd_base_ad')} USING (ad_id, dn)
LEFT JOIN (SELECT p.* EXCLUDE (vip_id), v.* EXCLUDE (dn)
           FROM {_reader('paymoney', 'dwd_pcentermempaymoney')} p
           LEFT JOIN {_reader('vip_level', 'dwd_vip_level')} v ON p.vip_id = v.vip_id AND p.dn = v.dn) USING (uid, dn)"""
_M1_SQL = dwd_ctes(*_MB_FEEDS) + f""", joined AS ({_JOINED})
, placed AS (SELECT *, row_number() OVER (PARTITION BY uid, dn, dt ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _PLAIN)}) AS place
             FROM joined)
SELECT uid, dn, dt, {', '.join(f'max({c}) FILTER (place = 1) AS {c}' for c in _PLAIN)},
       {', '.join(f'max({c}) AS {c}' for c in MB.VIP_MAX)}, min(vip_start_time) AS vip_start_time,
       CAST(sum(paymoney) AS DECIMAL(20,4)) AS paymoney
FROM placed GROUP BY uid, dn, dt"""

register("member_wide", _M1_SQL)(lambda spark, sf: MB.member_wide(*_mb_inputs(spark, sf)))


def _member_views(spark, sf):
    """M2 while its dimensions are cached (S15), written before they are released."""
    inputs = _mb_inputs(spark, sf)
    path = scratch_path(spark, "member_views")
    with SK.cached(inputs[2], inputs[3], inputs[5]):
        wide = MB.member_wide_views(spark, *inputs)
        wide.write.parquet(path)
    return spark.read.schema(wide.schema).parquet(path)


register("member_wide_views", _M1_SQL)(_member_views)
register("member_join_broadcast", dwd_ctes(*_MB_FEEDS) + f"""
SELECT {', '.join(MB.MEMBER_WIDE)}
FROM {_reader('member', 'dwd_member')} LEFT JOIN {_reader('regtype', 'dwd_member_regtype')} USING (uid, dn)
LEFT JOIN {_reader('base_ad', 'dwd_base_ad')} USING (ad_id, dn)
LEFT JOIN {_reader('website', 'dwd_base_website')} USING (siteid, dn)
LEFT JOIN {_reader('paymoney', 'dwd_pcentermempaymoney')} USING (uid, dn)
LEFT JOIN {_reader('vip_level', 'dwd_vip_level')} USING (vip_id, dn)""")(
    lambda spark, sf: MB.member_join(*_mb_inputs(spark, sf)))


def _layers(spark, sf, feeds):
    wh = Warehouse(spark)
    wh.ingest_all({feed: ods.ods_lines(spark, sf, feed) for feed in feeds}, load="first")
    return wh


def _member_layers(spark, sf):
    """The member warehouse of ``sf``, built once in a session."""
    return stored(spark, ("member", sf), lambda: _layers(spark, sf, _MB_FEEDS))


def _quiz_layers(spark, sf):
    """The quiz warehouse of ``sf``, built once in a session."""
    def build():
        wh = _layers(spark, sf, _CH_FEEDS + _CO_FEEDS + _MA_FEEDS + _PA_FEEDS + _QU_FEEDS + ("QzMemberPaperQuestion",))
        wh.build_quiz()
        return wh
    return stored(spark, ("quiz", sf), build)


# A1-A7 over the written detail table, for its day
_DETAIL_CTE = _DETAIL_SQL.replace(
    "\nSELECT " + ", ".join(QZ.PAPER_DETAIL), "\n, detail AS (SELECT " + ", ".join(QZ.PAPER_DETAIL), 1) + ")"
QUIZ_DAY = "20190722"


def _report(fn, *args):
    return lambda spark, sf: fn(_quiz_layers(spark, sf).paper_detail(), *args)


register("paper_report_layered", _DETAIL_CTE + AVG_SQL)(_report(reports.paper_avg))
for _name, _fn, _sql in (("paper_avg", reports.paper_avg, AVG_SQL), ("paper_min_max", reports.paper_min_max, MIN_MAX_SQL),
                         ("paper_low3", reports.paper_low3, LOW3_SQL.replace("paperviewid, dt ORDER", "paperviewid ORDER")),
                         ("paper_bands", reports.paper_bands, BANDS_SQL),
                         ("paper_pass_rate", reports.paper_pass_rate, PASS_RATE_SQL),
                         ("question_error_rate", reports.question_error_rate, ERROR_RATE_SQL)):
    register(f"day_{_name}", _DETAIL_CTE + f", one AS (SELECT * FROM detail WHERE dt = '{QUIZ_DAY}')"
             + _sql.replace("FROM detail", "FROM one"))(_report(_fn, QUIZ_DAY))
register("stored_paper_top3", _DETAIL_CTE + TOP3_SQL)(_report(reports.paper_top3))
# the list form of A5: an entry for each answer, sorted
register("paper_bands_list", _DETAIL_CTE + f""", bands AS (SELECT * FROM (WITH x AS (SELECT 1){BANDS_SQL}) t)
SELECT paperviewid, paperviewname, score_segment, dt, dn,
       array_to_string(list_sort(flatten(list(list_resize([userid], answers, userid)))), ',') AS userids
FROM bands GROUP BY ALL""")(_report(lambda d: reports.paper_bands(d, as_list=True)))


# Q1-Q6, M1 and M3 for a day, over the stored detail tables: ``dt`` prunes their partitions
def _day_wide(build, feeds, layers):
    def run(spark, sf):
        wh = layers(spark, sf)
        return build(*[wh.dwd(f) for f in feeds])
    return run


for _name, _build, _feeds, _sql in (("chapter_wide", QZ.chapter_wide, _CH_FEEDS, _CHAPTER_SQL), ("course_wide", QZ.course_wide, _CO_FEEDS, _COURSE_SQL),
                                    ("major_wide", QZ.major_wide, _MA_FEEDS, _MAJOR_SQL), ("paper_wide", QZ.paper_wide, _PA_FEEDS, _PAPER_SQL),
                                    ("question_wide", QZ.question_wide, _QU_FEEDS, _QUESTION_SQL)):
    register(f"day_{_name}", f"{dwd_ctes(*_feeds)}SELECT * FROM ({_sql}) t WHERE dt = '{QUIZ_DAY}'")(
        _day_wide(lambda *d, b=_build: b(*d, dt=QUIZ_DAY), _feeds, _quiz_layers))


def _day_detail(spark, sf):
    wh = _quiz_layers(spark, sf)
    wide = [wh.table("dws", f"dws_qz_{n}") for n in ("chapter", "course", "major", "paper", "question")]
    return QZ.user_paper_detail(wh.dwd("QzMemberPaperQuestion"), *wide, QUIZ_DAY)


register("day_paper_detail", f"SELECT * FROM ({_DETAIL_SQL}) t WHERE dt = '{QUIZ_DAY}'")(_day_detail)
register("day_member_wide", f"SELECT * FROM ({_M1_SQL}) t WHERE dt = '{QUIZ_DAY}'")(
    _day_wide(lambda *d: MB.member_wide(*d, dt=QUIZ_DAY), _MB_FEEDS, _member_layers))
register("day_member_join", f"SELECT * FROM ({ORACLES['member_join_broadcast']}) t WHERE dt = '{QUIZ_DAY}'")(
    _day_wide(lambda *d: MB.member_join(*d, dt=QUIZ_DAY), _MB_FEEDS, _member_layers))


def _ingest_counts(spark, sf):
    """The ledger of the loads of all 23 feeds."""
    both = _quiz_layers(spark, sf).ledger().unionByName(_member_layers(spark, sf).ledger())
    return both.select("feed", "lines", "rows", "rejected")


register("ingest_counts", "\nUNION ALL\n".join(
    f"SELECT feed, lines, kept AS rows, lines - kept AS rejected FROM ({ods.line_counts_sql(f)}) t" for f in FD.FEEDS))(_ingest_counts)


def _kept_rejects(spark, sf):
    """What the loads of all 23 feeds kept out, from the stored rejects."""
    out = None
    for feed in FD.FEEDS:
        wh = (_member_layers if feed in _MB_FEEDS else _quiz_layers)(spark, sf)
        one = wh.rejects(feed).select(F.lit(feed).alias("feed"), "*")
        out = one if out is None else out.unionByName(one)
    return out


register("ingest_rejects", ORACLES["feed_rejects"])(_kept_rejects)


def _member_layered(spark, sf):
    wh = _member_layers(spark, sf)
    wh.mode = "overwrite"  # the member table only; the loads stay
    wh.build_member()
    return wh.table("dws", "dws_member")


register("member_wide_layered", _M1_SQL)(_member_layered)
