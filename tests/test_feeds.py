"""JSON feed ingest on the edge lines of FIXTURES.md 2."""

from decimal import Decimal

from coursewise.sources import feeds as FD


def ingest(spark, feed, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return FD.ingest(df, FD.FEEDS[feed]).collect()


def test_object_filter(spark):
    lines = ['{"questionid": 1, "dt": "d", "dn": "x"}', "not json", "", "[1,2]", '"s"', '{"a": ', "{}", None]
    out = ingest(spark, "QzQuestion", lines)
    assert sorted(r.questionid for r in out) == [0, 1]          # '{}' kept with defaults


def test_text_behind_the_object_is_refused(spark):
    good = ['{"questionid": 1}', ' {"questionid": 2}\t', '{"questionid": 3, "content": "},{}],["}']
    bad = ['{"questionid": 4},{}],[', '{"questionid": 5},{}],[{"a": 1}', '{"questionid": 6},{}]  {}', '{"questionid": 7},{}]//{}',
           '{"questionid": 8},{"a": 2}', '{"questionid": 9}]', '{"questionid": 10},{"__end":"9"}],[{}', "null", "}"]
    assert sorted(r.questionid for r in ingest(spark, "QzQuestion", good + bad)) == [1, 2, 3]
    m = spark.createDataFrame([(x,) for x in good + bad], "value string").select(FD.json_object("value").alias("m")).where("m is not null")
    assert sorted(r.m["questionid"] for r in m.collect()) == ["1", "2", "3"]


def test_a_line_is_parsed_once(spark):
    for feed, spec in FD.FEEDS.items():
        lines = spark.createDataFrame([("{}",)], "value string")
        for df in (FD.ingest(lines, spec), FD.rejects(lines, spec), FD.object_line_counts(lines)):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("from_json(") == 1, feed


def test_int_string_decimal_rules(spark):
    lines = [
        '{"questionid": "12", "parentid": 3.7, "optnum": "", "content": 5, "score": 0.25, "splitscore": -0.25,'
        ' "dt": "20190722", "dn": "webA", "extra": "ignored"}',
        '{"questionid": 13, "optnum": "abc", "score": 0.15, "dt": "20190722", "dn": "webA"}',
    ]
    out = {r.questionid: r for r in ingest(spark, "QzQuestion", lines)}
    a, b = out[12], out[13]
    assert a.parentid == 3 and a.optnum == 0 and a.content == "5"
    assert a.score == Decimal("0.3") and a.splitscore == Decimal("-0.3")
    assert b.score == Decimal("0.2") and b.splitscore == Decimal("0.0")   # missing -> 0.0 (d1dz)
    assert b.parentid == 0 and b.optnum == 0 and b.answer is None        # missing int 0, string NULL


def test_decimal_missing_is_null_for_d1(spark):
    out = ingest(spark, "QzPoint", ['{"pointid": 1, "dt": "d", "dn": "x"}', '{"pointid": 2, "score": 9.95}'])
    got = {r.pointid: r.score for r in out}
    assert got == {1: None, 2: Decimal("10.0")}


def test_misspelt_keys(spark):
    c = ingest(spark, "QzCourse", ['{"courseid": 1, "sequnece": "s1"}', '{"courseid": 2, "sequence": "s2"}'])
    assert sorted((r.courseid, r.sequence) for r in c) == [(1, "s1"), (2, "s2")]
    q = ingest(spark, "QzPointQuestion", ['{"pointid": 1, "questionid": 2, "questtype": 3}'])
    assert q[0].questype == 3


def test_member_masks_and_label(spark):
    m = ingest(spark, "member", ['{"uid": 1, "fullname": "Wang Wu", "password": "p", "phone": "13912345678",'
                                 ' "dt": "20190722", "dn": "webA"}'])[0]
    assert (m.fullname, m.password, m.phone) == ("Wxx", "******", "139*****5678")
    r = ingest(spark, "memberRegtype", ['{"uid": 1, "regsource": "3"}', '{"uid": 2, "regsource": "9"}', '{"uid": 3}'])
    assert sorted((x.uid, x.regsourcename) for x in r) == [(1, "App"), (2, "other"), (3, "other")]


def test_column_order_and_partitions(spark):
    for spec in FD.FEEDS.values():
        names = [c.name for c in spec.cols]
        assert names[-len(spec.partition):] == list(spec.partition)
        assert len(set(names)) == len(names)
    assert len(FD.FEEDS) == 23
    assert [c.name for c in FD.FEEDS["QzChapter"].cols].count("status") == 0
    assert "discountval" not in [c.name for c in FD.FEEDS["pcenterMemViplevel"].cols]


def test_decimal_text_nested_values_and_key_precedence(spark):
    out = ingest(spark, "QzQuestion", ['{"questionid": 1, "score": "2.45", "splitscore": "x", "content": {"a": [1, 2]},'
                                       ' "answer": null}'])[0]
    assert out.score == Decimal("2.5") and out.splitscore == Decimal("0.0")   # not numeric -> default
    assert out.content == '{"a":[1,2]}' and out.answer is None
    both = ingest(spark, "QzCourse", ['{"courseid": 1, "sequnece": "first", "sequence": "second"}'])[0]
    assert both.sequence == "first"


def test_json_booleans_as_ints(spark):
    out = ingest(spark, "QzQuestion", ['{"questionid": true, "parentid": false, "optnum": "true"}'])[0]
    assert (out.questionid, out.parentid, out.optnum) == (1, 0, 1)


def test_decimal_via_double_or_text(spark):
    long_text = "1234567.0499999999999"         # exact as text; 1234567.05 as a double
    pt = ingest(spark, "QzPoint", [f'{{"pointid": 1, "score": {long_text}}}'])[0]
    mp = ingest(spark, "QzMemberPaperQuestion", [f'{{"userid": 1, "score": "{long_text}"}}'])[0]
    assert pt.score == Decimal("1234567.1")    # via double (point score)
    assert mp.score == Decimal("1234567.0")    # from the exact text (answer score)


def test_reasons_are_listed_only_where_there_are_some(spark):
    spec = FD.FEEDS["QzPointQuestion"]
    lines = ['{"pointid":1,"questionid":"2","questtype":null}', '{"pointid":"x","questionid":" ","questtype":"true"}',
             '{"pointid":"x","questionid":"1.5","questtype":"y"}', "no json", "{}", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = FD.parsed(df, spec)
    want = [(None, []), (lines[1], ["bad_number:pointid"]), (lines[2], ["bad_number:pointid", "bad_number:questtype"]),
            (lines[3], ["not_an_object"]), (None, []), (None, ["not_an_object"])]
    assert [(r["_line"], r["_reasons"]) for r in out.collect()] == want
    # the array is built by expressions that aren't compiled: not for a line without a reason
    assert "ELSE [] END AS _reasons" in out._jdf.queryExecution().optimizedPlan().toString()
