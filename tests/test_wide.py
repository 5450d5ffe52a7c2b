"""M1-M3 and Q1-Q6 on the test rows of FIXTURES.md 3, M1 checked against nested loops."""

from decimal import Decimal

from coursewise.operators import member as MB, quiz as QZ
from coursewise.sources import feeds as FD


def dwd(spark, feed, rows):
    spec = FD.FEEDS[feed]
    types = {"i": "int", "s": "string", "d1": "decimal(10,1)", "d1d": "decimal(10,1)", "d1dz": "decimal(10,1)"}
    schema = ", ".join(f"`{c.name}` {types[c.kind]}" for c in spec.cols)
    names = [c.name for c in spec.cols]
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, schema)


def member_inputs(spark):
    m = lambda uid, ad: {"uid": uid, "ad_id": ad, "fullname": f"n{uid}", "dt": "20190722", "dn": "w"}  # noqa
    member = dwd(spark, "member", [m(1, 1), m(2, 9), m(3, 1), m(4, 1)])
    reg = dwd(spark, "memberRegtype", [
        {"uid": 1, "appkey": "a", "websiteid": 1, "regsource": "1", "regsourcename": "PC", "dn": "w", "dt": "x"},
        {"uid": 3, "appkey": "b", "regsource": "9", "websiteid": 1, "dn": "w", "dt": "x"},
        {"uid": 3, "appkey": "c", "regsource": "1", "websiteid": 7, "dn": "w", "dt": "x"},   # two rows: sums double
        {"uid": 4, "appkey": "d", "websiteid": 1, "dn": "other", "dt": "x"}])     # other site: no match
    ad = dwd(spark, "baseadlog", [{"adid": 1, "adname": "ad1", "dn": "w"}])
    site = dwd(spark, "baswewebsite", [{"siteid": 1, "sitename": "s1", "dn": "w"}])
    pay = dwd(spark, "pcentermempaymoney", [
        {"uid": 1, "paymoney": "10.5", "vip_id": 1, "dn": "w", "dt": "x"},
        {"uid": 1, "paymoney": "1.25", "vip_id": 2, "dn": "w", "dt": "x"},
        {"uid": 3, "paymoney": "100", "vip_id": 1, "dn": "w", "dt": "x"}])
    vip = dwd(spark, "pcenterMemViplevel", [
        {"vip_id": 1, "vip_level": "gold", "start_time": "2019-01-01", "dn": "w"},
        {"vip_id": 1, "vip_level": "gold2", "start_time": "2018-01-01", "dn": "w"}])   # repeated vip row
    return member, reg, ad, site, pay, vip


def brute_member_wide(inputs):
    """Every joined row by nested loops: rows of (plain columns as a sort key, payment, vip level, vip start)."""
    member, reg, ad, site, pay, vip = ([r.asDict() for r in df.collect()] for df in inputs)
    pick = lambda rows, **at: [r for r in rows if all(v is not None and r[k] == v for k, v in at.items())] or [{}]
    out = {}
    for m in member:
        for r in pick(reg, uid=m["uid"], dn=m["dn"]):
            for s in pick(site, siteid=r.get("websiteid"), dn=r.get("dn")):
                for a in pick(ad, adid=m["ad_id"], dn=m["dn"]):
                    for p in pick(pay, uid=m["uid"], dn=m["dn"]):
                        for v in pick(vip, vip_id=p.get("vip_id"), dn=p.get("dn")):
                            plain = (m["ad_id"], r.get("appkey"), r.get("regsource"), s.get("siteid"), s.get("sitename"),
                                     a.get("adname"), v.get("vip_id"))
                            out.setdefault((m["uid"], m["dn"], m["dt"]), []).append(
                                (plain, p.get("paymoney"), v.get("vip_level"), v.get("start_time")))
    return out


def test_member_wide_takes_one_joined_row(spark):
    inputs = member_inputs(spark)
    joined = brute_member_wide(inputs)
    cols = ["ad_id", "appkey", "regsource", "siteid", "sitename", "adname", "vip_id"]
    got = {(r.uid, r.dn, r.dt): r for r in MB.member_wide(*inputs).collect()}
    assert got.keys() == joined.keys()
    first = lambda rows: min((x[0] for x in rows), key=lambda t: [(v is not None, v) for v in t])
    for key, rows in joined.items():
        r = got[key]
        assert tuple(r[c] for c in cols) == first(rows)                 # a row that exists
        paid = [Decimal(x[1]) for x in rows if x[1] is not None]
        assert r.paymoney == (sum(paid) if paid else None)
        assert r.vip_level == max((x[2] for x in rows if x[2]), default=None)
        assert r.vip_start_time == min((x[3] for x in rows if x[3]), default=None)
    assert got[1, "w", "20190722"].paymoney == Decimal("22.2500")       # 10.5 x 2 vip rows + 1.25
    assert got[3, "w", "20190722"].paymoney == Decimal("400.0000")      # 100 x 2 reg rows x 2 vip rows
    three = got[3, "w", "20190722"]
    assert (three.appkey, three.regsource, three.siteid) == ("b", "9", 1)


def test_member_join_keeps_left_keys(spark):
    member, reg, ad, site, pay, vip = member_inputs(spark)
    out = MB.member_join(member, reg, ad, site, pay, vip).collect()
    by_uid = {}
    for r in out:
        by_uid.setdefault(r.uid, []).append(r)
    assert len(by_uid[1]) == 3 and len(by_uid[3]) == 4 and len(by_uid[2]) == 1
    assert {r.siteid for r in by_uid[3]} == {1, 7}                      # USING key from the left
    assert all(r.sitename is None for r in by_uid[3] if r.siteid == 7)


def q(spark, feed, rows, dt="20190722", dn="w"):
    return dwd(spark, feed, [dict(r, dt=r.get("dt", dt), dn=r.get("dn", dn)) for r in rows])


def test_chapter_wide_fanout_and_dn(spark):
    ch = q(spark, "QzChapter", [{"chapterid": 1, "chapterlistid": 5, "showstatus": "on"},
                                {"chapterid": 1, "chapterlistid": 5, "showstatus": "on", "dn": "other"}])
    cl = q(spark, "QzChapterList", [{"chapterlistid": 5, "chapterlistname": "L"}])
    pt = q(spark, "QzPoint", [{"pointid": 10, "chapterid": 1}, {"pointid": 11, "chapterid": 1}])
    pq = q(spark, "QzPointQuestion", [{"pointid": 10, "questionid": 100}, {"pointid": 11, "questionid": 101}])
    out = QZ.chapter_wide(ch, cl, pt, pq, "20190722").collect()
    assert sorted(r.questionid for r in out) == [100, 101]             # two points -> two rows; other dn no match
    assert all(r.status == "on" for r in out)
    assert list(QZ.chapter_wide(ch, cl, pt, pq).columns) == list(QZ.CHAPTER_WIDE)


def test_paper_without_centre_kept(spark):
    pv = q(spark, "QzPaperView", [{"paperviewid": 1, "paperid": 1}, {"paperviewid": 2, "paperid": 2}])
    cp = q(spark, "QzCenterPaper", [{"paperviewid": 1, "centerid": 9}])
    ce = q(spark, "QzCenter", [{"centerid": 9, "centername": "c9"}])
    pa = q(spark, "QzPaper", [{"paperid": 1}, {"paperid": 2}])
    out = {r.paperviewid: r.centername for r in QZ.paper_wide(pv, cp, ce, pa).collect()}
    assert out == {1: "c9", 2: None}


def test_paper_detail_columns(spark):
    assert len(QZ.PAPER_DETAIL) == 119 and len(set(QZ.PAPER_DETAIL)) == 119


def test_vip_columns_come_from_one_joined_row(spark):
    member, reg, ad, site, pay, _ = member_inputs(spark)
    vip = dwd(spark, "pcenterMemViplevel", [
        {"vip_id": 1, "max_free": "9", "min_free": "9", "operator": "zoe", "dn": "w"},
        {"vip_id": 2, "max_free": "1", "min_free": "1", "operator": "amy", "dn": "w"}])
    row = MB.member_wide(member, reg, ad, site, pay, vip).where("uid = 1").first()
    assert (row.vip_id, row.vip_max_free, row.vip_min_free, row.vip_operator) == (1, "9", "9", "zoe")


def detail_inputs(spark):
    answers = q(spark, "QzMemberPaperQuestion", [
        {"userid": u, "chapterid": c, "questionid": x, "sitecourseid": 1, "majorid": 1, "paperviewid": 1}
        for u, c, x in ((1, 1, 100), (2, 1, 100), (3, 1, 101), (4, 2, 100), (5, None, 100), (6, 1, 999))])
    chapter = QZ.chapter_wide(
        q(spark, "QzChapter", [{"chapterid": 1, "chapterlistid": 5}, {"chapterid": 2, "chapterlistid": 5}]),
        q(spark, "QzChapterList", [{"chapterlistid": 5}]),
        q(spark, "QzPoint", [{"pointid": 10, "chapterid": 1}, {"pointid": 11, "chapterid": 1}, {"pointid": 12, "chapterid": 2}]),
        q(spark, "QzPointQuestion", [{"pointid": p, "questionid": 100} for p in (10, 11, 12)]))
    course = QZ.course_wide(q(spark, "QzSiteCourse", [{"sitecourseid": 1, "courseid": 3}]), q(spark, "QzCourse", [{"courseid": 3}]),
                            q(spark, "QzCourseEduSubject", [{"courseid": 3}]))
    major = QZ.major_wide(q(spark, "QzMajor", [{"majorid": 1, "siteid": 2, "businessid": 2}]), q(spark, "QzWebsite", [{"siteid": 2}]),
                          q(spark, "QzBusiness", [{"businessid": 2}]))
    paper = QZ.paper_wide(q(spark, "QzPaperView", [{"paperviewid": 1, "paperid": 4}]), q(spark, "QzCenterPaper", []),
                          q(spark, "QzCenter", []), q(spark, "QzPaper", [{"paperid": 4}]))
    question = QZ.question_wide(q(spark, "QzQuestion", [{"questionid": x, "questypeid": 0} for x in (100, 101, 101)]),
                                q(spark, "QzQuestionType", [{"questypeid": 0}]))
    return answers, chapter, course, major, paper, question


def test_detail_fans_out_over_points_and_repeated_questions(spark):
    want = sorted([(1, 10, 100), (1, 11, 100), (2, 10, 100), (2, 11, 100), (4, 12, 100)]
                  + 2 * [(3, 10, 101), (3, 11, 101)])
    for dt in (None, "20190722"):
        out = QZ.user_paper_detail(*detail_inputs(spark), dt).collect()
        assert sorted((r.userid, r.pointid, r.questionid) for r in out) == want


def test_sides_that_grow_are_not_broadcast(spark):
    # Catalyst takes their wide rows for a fraction of their size, and the driver would hold them
    plan = QZ.user_paper_detail(*detail_inputs(spark))._jdf.queryExecution().executedPlan().toString()
    merged = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    for key in ("chapterid", "questionid", "pointid"):
        assert any(key in line for line in merged), key
    broadcast = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert not any(k in line for line in broadcast for k in ("[chapterid", "questionid", "pointid"))


def test_rows_with_all_columns_are_not_shuffled(spark):
    # a paper table of any size is joined onto the narrow answers, not by a shuffle of what the other sides widened
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QZ.user_paper_detail(*detail_inputs(spark))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [(len(line) - len(line.lstrip(" :+-")), line) for line in plan.splitlines() if "SortMergeJoin" in line and "Inner" in line]
    paper = min(depth for depth, line in joins if "paperviewid" in line)
    pair = min(depth for depth, line in joins if "chapterid" in line and "questionid" in line)
    assert paper > pair


def test_detail_takes_columns_from_their_sides_and_repeated_papers(spark):
    answers, chapter, course, major, _, question = detail_inputs(spark)
    paper = QZ.paper_wide(q(spark, "QzPaperView", [{"paperviewid": 1, "paperid": p, "paperviewname": f"view {p}"} for p in (4, 5)]),
                          q(spark, "QzCenterPaper", [{"paperviewid": 1, "centerid": 9}]), q(spark, "QzCenter", [{"centerid": 9, "centername": "c9"}]),
                          q(spark, "QzPaper", [{"paperid": p, "courseid": 77, "papername": f"paper {p}"} for p in (4, 5)]))
    out = QZ.user_paper_detail(answers, chapter, course, major, paper, question).where("userid = 1")
    assert out.columns == list(QZ.PAPER_DETAIL)
    cols = ("pointid", "paperid", "paperviewname", "papername", "centername", "courseid", "chapterlistid", "businessid", "questypeid", "dn")
    assert sorted(map(tuple, out.select(*cols).collect())) == [
        (point, p, f"view {p}", f"paper {p}", "c9", 3, 5, 2, 0, "w") for point in (10, 11) for p in (4, 5)]
