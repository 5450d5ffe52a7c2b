"""Raw JSON feed lines derived from the driver tables (the ODS layer).

Each feed gets its lines from one driver table: every JSON key is an SQL
expression over that table's row, written so that Spark SQL and DuckDB read
it the same way. The same description yields

* ``ods_lines``    : the Spark DataFrame of raw lines (``to_json`` per row),
* ``expected_sql`` : DuckDB SQL of the typed rows the ingest must produce.

Defects are injected by fixed rules on a per-row key ``rk``:

* ``rk % 23 = 5``: the line is damaged, kind ``((rk - 5) / 23) % 9``:
  0 not JSON, 1 empty, 2 array, 3 scalar, 4 cut-off object, 5 object with text
  after it, 6 two objects, 7 object and a bracket, 8 empty object (only kind 8
  survives, with every field at its default);
* ``(rk + position) % 29 = 0``: that key is left out of the object (not for
  ids and partition columns);
* int fields at odd positions are written as JSON text ("12"), not numbers.

Columns without a listed expression get a generic value from ``rk``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import driver
from .feeds import FEEDS, FeedSpec

QUIZ_DT, QUIZ_DN = "'20190722'", "'webA'"


def _site(x: str) -> str:
    return f"concat('site', CAST(({x}) % 3 AS STRING))"


def _member_dt(x: str) -> str:
    return f"CAST(20190720 + ({x}) % 3 AS STRING)"


# feed -> (source table, row key, {json key: expression}, {extra key: expression})
SOURCES = {
    "memberRegtype": ("customer", "c_custkey", {
        "uid": "c_custkey", "appkey": "concat('app', CAST(c_custkey % 7 AS STRING))",
        "appregurl": "concat('www.site', CAST(c_nationkey AS STRING), '.com/reg')",
        "bdp_uuid": "CAST(c_custkey * 31 AS STRING)",
        "createtime": "concat('2019-07-', lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0'))",
        "isranreg": "CAST(c_custkey % 2 AS STRING)", "regsource": "CAST(c_custkey % 6 AS STRING)",
        "websiteid": "c_custkey % 5", "dt": _member_dt("c_custkey"), "dn": _site("c_custkey")}, {}),
    "member": ("customer", "c_custkey", {
        "uid": "c_custkey", "ad_id": "c_nationkey",
        "birthday": "concat('19', CAST(70 + c_custkey % 30 AS STRING), '-01-01')",
        "email": "concat('u', CAST(c_custkey AS STRING), '@example.com')", "fullname": "c_name",
        "memberlevel": "CAST(c_custkey % 10 AS STRING)", "password": "concat('pw', CAST(c_custkey AS STRING))",
        "paymoney": "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING)",
        "phone": "concat('13', lpad(CAST(c_custkey AS STRING), 9, '0'))",
        "dt": _member_dt("c_custkey"), "dn": _site("c_custkey")}, {}),
    "baseadlog": ("nation", "n_nationkey", {
        "adid": "n_nationkey", "adname": "concat('ad ', n_name)", "dn": _site("n_nationkey")}, {}),
    "baswewebsite": ("region", "r_regionkey", {
        "siteid": "r_regionkey", "sitename": "r_name", "siteurl": "concat('www.', lower(r_name), '.com')",
        "delete": "0", "dn": _site("r_regionkey")}, {}),
    "pcentermempaymoney": ("orders", "o_orderkey", {
        "uid": "o_custkey", "paymoney": "CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING)",
        "siteid": "o_orderkey % 5", "vip_id": "CAST(substring(o_orderpriority, 1, 1) AS INT) - 1",
        "dt": _member_dt("o_orderkey"), "dn": _site("o_custkey")}, {}),
    "pcenterMemViplevel": ("nation", "n_nationkey", {
        "vip_id": "n_nationkey % 5", "vip_level": "concat('level', CAST(n_nationkey % 5 AS STRING))",
        "start_time": "concat('2019-0', CAST(n_nationkey % 9 + 1 AS STRING), '-01')",
        "end_time": "concat('2020-0', CAST(n_nationkey % 9 + 1 AS STRING), '-01')",
        "next_level": "concat('level', CAST(n_nationkey % 5 + 1 AS STRING))",
        "dn": _site("n_nationkey")}, {"discountval": "'0.9'"}),
    "QzChapter": ("part", "p_partkey", {
        "chapterid": "p_partkey", "chapterlistid": "p_partkey % 10", "chaptername": "p_name",
        "sequence": "CAST(p_size AS STRING)", "showstatus": "CAST(p_partkey % 2 AS STRING)",
        "creator": "p_brand", "courseid": "p_partkey % 25", "chapternum": "p_size",
        "outchapterid": "p_partkey % 13", "dt": QUIZ_DT, "dn": QUIZ_DN}, {"status": "'1'"}),
    "QzChapterList": ("supplier", "s_suppkey", {
        "chapterlistid": "s_suppkey", "chapterlistname": "s_name", "courseid": "s_suppkey % 25",
        "chapterallnum": "s_nationkey", "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzPoint": ("part", "p_partkey", {
        "pointid": "p_partkey", "courseid": "p_partkey % 25", "pointname": "concat('point ', p_name)",
        "pointyear": "'2019'", "chapter": "p_type", "excisenum": "p_size", "pointlistid": "p_partkey % 50",
        "chapterid": "p_partkey", "score": "p_size / 4.0", "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzPointQuestion": ("part", "p_partkey", {
        "pointid": "p_partkey", "questionid": "p_partkey", "questtype": "p_size % 4",
        "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzSiteCourse": ("nation", "n_nationkey", {
        "sitecourseid": "n_nationkey", "siteid": "n_regionkey", "courseid": "n_nationkey",
        "sitecoursename": "concat('sitecourse ', n_name)", "boardid": "n_nationkey % 4",
        "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzCourse": ("nation", "n_nationkey", {
        "courseid": "n_nationkey", "majorid": "n_nationkey % 10", "coursename": "concat('course ', n_name)",
        "sequnece": "CAST(n_nationkey AS STRING)", "chapterlistid": "n_nationkey % 10",
        "pointlistid": "n_nationkey % 50", "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzCourseEduSubject": ("nation", "n_nationkey", {
        "courseeduid": "n_nationkey + 1000", "edusubjectid": "n_regionkey", "courseid": "n_nationkey",
        "majorid": "n_nationkey % 10", "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzWebsite": ("region", "r_regionkey", {
        "siteid": "r_regionkey", "sitename": "r_name", "domain": "concat(lower(r_name), '.example.org')",
        "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzMajor": ("nation", "n_nationkey", {
        "majorid": "n_nationkey", "businessid": "n_regionkey", "siteid": "n_regionkey",
        "majorname": "concat('major ', n_name)", "shortname": "substring(n_name, 1, 3)",
        "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzBusiness": ("region", "r_regionkey", {
        "businessid": "r_regionkey", "businessname": "concat('biz ', r_name)", "siteid": "r_regionkey",
        "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzPaperView": ("supplier", "s_suppkey", {
        "paperviewid": "s_suppkey", "paperid": "s_suppkey", "paperviewname": "concat('view ', s_name)",
        "dayiid": "s_suppkey % 30", "paperviewcatid": "s_nationkey", "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzCenterPaper": ("supplier", "s_suppkey", {
        "paperviewid": "s_suppkey", "centerid": "s_nationkey + (s_suppkey % 2) * 100",
        "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzPaper": ("supplier", "s_suppkey", {
        "paperid": "s_suppkey", "papercatid": "s_nationkey", "courseid": "s_suppkey % 25",
        "papername": "concat('paper ', s_name)", "totalscore": "CAST(s_acctbal AS DECIMAL(12,2)) / 100",
        "chapterid": "s_suppkey % 200", "chapterlistid": "s_suppkey % 10", "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzCenter": ("nation", "n_nationkey", {
        "centerid": "n_nationkey", "centername": "concat('center ', n_name)", "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzQuestion": ("part", "p_partkey", {
        "questionid": "p_partkey", "parentid": "0", "questypeid": "p_size % 4", "quesviewtype": "p_size % 3",
        "content": "p_name", "score": "p_size / 4.0", "splitscore": "p_size / 8.0", "optnum": "4",
        "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzQuestionType": ("region", "r_regionkey", {
        "quesviewtype": "r_regionkey % 3", "viewtypename": "concat('view ', r_name)",
        "questypeid": "r_regionkey", "description": "concat('type ', r_name)", "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
    "QzMemberPaperQuestion": ("lineitem", "l_orderkey * 8 + l_linenumber", {
        "userid": "l_orderkey", "paperviewid": "l_suppkey", "chapterid": "l_partkey",
        "sitecourseid": "l_partkey % 25", "questionid": "l_partkey", "majorid": "l_suppkey % 10",
        "useranswer": "l_returnflag", "istrue": "CASE WHEN l_returnflag = 'R' THEN '0' ELSE '1' END",
        "paperid": "l_suppkey", "spendtime": "l_linenumber * 60", "score": "l_quantity * 1.25",
        "question_answer": "CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END", "dt": QUIZ_DT, "dn": QUIZ_DN}, {}),
}

# The damaged line texts, by damage kind 0-4 (kind 5 is '{}').
BROKEN_LINES = ("this is not json", "", "[1, 2, 3]", '"just text"', '{"broken": ', '{"dn": "webA"} and more',
                '{"dn": "webA"}{"dn": "webB"}', '{"dn": "webA"}]', '{"dn": "webA"},{}],[')
KINDS = len(BROKEN_LINES) + 1   # the last kind is the empty object
DAMAGE_MOD, DAMAGE_AT, MISSING_MOD = 23, 5, 29


def _emitted(spec: FeedSpec):
    """(position, column, json key, kind) for every column written to JSON."""
    out = []
    for pos, c in enumerate(spec.cols):
        if spec.derived.get(c.name) == "regsource_label":
            continue  # computed by the ingest, not read from the line
        out.append((pos, c, c.json_keys[0], c.kind))
    return out


def _expr(spec: FeedSpec, pos: int, col, key: str, rk: str) -> str:
    src = SOURCES[spec.feed][2]
    if key in src:
        return src[key]
    if col.kind == "i":
        return f"(({rk}) + {pos}) % 50"
    if col.kind in ("d1", "d1d", "d1dz"):
        return f"(({rk}) % 40) / 4.0"
    return f"concat('{col.name}-', CAST(({rk}) % 97 AS STRING))"


def _missing(rk: str, pos: int, name: str) -> str:
    # ids (join keys) and partition columns are always present
    if name in ("dt", "dn") or name.endswith("id"):
        return "false"
    return f"((({rk}) + {pos}) % {MISSING_MOD} = 0)"


def _damaged(rk: str) -> str:
    return f"(({rk}) % {DAMAGE_MOD} = {DAMAGE_AT})"


def _kind(rk: str) -> str:
    return f"(CAST((({rk}) - {DAMAGE_AT}) / {DAMAGE_MOD} AS BIGINT) % {KINDS})"


def ods_lines(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """The raw lines (column ``value``) of one feed."""
    spec = FEEDS[feed]
    table, rk, _, extra = SOURCES[feed]
    src = driver.table(spark, sf_dir, table)
    fields = []
    for pos, col, key, kind in _emitted(spec):
        e = _expr(spec, pos, col, key, rk)
        if kind == "i" and pos % 2 == 1:
            e = f"CAST(({e}) AS STRING)"
        fields.append(F.expr(f"CASE WHEN {_missing(rk, pos, col.name)} THEN NULL ELSE ({e}) END").alias(key))
    for key, e in extra.items():
        fields.append(F.expr(e).alias(key))
    good = F.to_json(F.struct(*fields))
    kind = F.expr(_kind(rk))
    bad = F.element_at(F.array(*[F.lit(x) for x in BROKEN_LINES + ("{}",)]), (kind + 1).cast("int"))
    return src.select(F.when(F.expr(_damaged(rk)), bad).otherwise(good).alias("value"))


def _typed_sql(kind: str, e: str) -> str:
    if kind == "i":
        return f"COALESCE(TRY_CAST(TRY_CAST(({e}) AS DECIMAL(38,6)) AS INTEGER), 0)"
    if kind == "s":
        return f"CAST(({e}) AS VARCHAR)"
    return f"CAST(round(CAST(({e}) AS DECIMAL(18,4)), 1) AS DECIMAL(10,1))"


def _default_sql(kind: str) -> str:
    return {"i": "0", "s": "CAST(NULL AS VARCHAR)", "d1": "CAST(NULL AS DECIMAL(10,1))",
            "d1d": "CAST(NULL AS DECIMAL(10,1))", "d1dz": "CAST(0 AS DECIMAL(10,1))"}[kind]


def expected_sql(feed: str) -> str:
    """DuckDB SQL of the rows ``ingest(ods_lines(feed))`` must give."""
    spec = FEEDS[feed]
    table, rk, _, _ = SOURCES[feed]
    empty = f"({_damaged('_rk')} AND {_kind('_rk')} = {KINDS - 1})"
    raw = {}
    for pos, col, key, kind in _emitted(spec):
        e = _expr(spec, pos, col, key, "_rk").replace("_rk", "_rk")
        raw[col.name] = (f"CASE WHEN {empty} OR {_missing('_rk', pos, col.name)} "
                         f"THEN {_default_sql(kind)} ELSE {_typed_sql(kind, e)} END")
    out = []
    for c in spec.cols:
        rule = spec.derived.get(c.name)
        if rule == "regsource_label":
            v = (f"CASE {raw['regsource']} WHEN '1' THEN 'PC' WHEN '2' THEN 'Mobile' WHEN '3' THEN 'App' "
                 f"WHEN '4' THEN 'WeChat' ELSE 'other' END")
        elif rule == "mask_name":
            v = f"CASE WHEN length({raw['fullname']}) >= 1 THEN substring({raw['fullname']}, 1, 1) || 'xx' END"
        elif rule == "redact":
            v = "'******'"
        elif rule == "mask_phone_b":
            p = raw["phone"]
            v = f"CASE WHEN length({p}) >= 11 THEN substring({p}, 1, 3) || '*****' || substring({p}, 8, 4) END"
        else:
            v = raw[c.name]
        out.append(f"{v} AS {c.name}")
    # the source columns are referenced by bare name; the row key is exposed as _rk
    return (f"SELECT {', '.join(out)} FROM (SELECT *, {rk} AS _rk FROM {table}) s "
            f"WHERE NOT ({_damaged('_rk')} AND {_kind('_rk')} < {KINDS - 1})")


def line_counts_sql(feed: str) -> str:
    """DuckDB SQL of (feed, lines, kept) for one feed."""
    table, rk, _, _ = SOURCES[feed]
    return (f"SELECT '{feed}' AS feed, count(*) AS lines, "
            f"CAST(sum(CASE WHEN {_damaged(rk)} AND {_kind(rk)} < {KINDS - 1} THEN 0 ELSE 1 END) AS BIGINT) AS kept "
            f"FROM {table}")


def rejects_sql(feed: str) -> str:
    """DuckDB SQL of the lines of one feed that are no object, with the reason."""
    table, rk, _, _ = SOURCES[feed]
    lines = ", ".join("'" + x + "'" for x in BROKEN_LINES)
    return (f"SELECT [{lines}][CAST({_kind(rk)} AS INTEGER) + 1] AS line, 'not_an_object' AS reason FROM {table} "
            f"WHERE {_damaged(rk)} AND {_kind(rk)} < {KINDS - 1}")
