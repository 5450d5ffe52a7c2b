"""JSON feed ingest (ODS text -> DWD detail tables), F1-F23.

Every feed is one flat JSON object per line. The reference parses each line
twice with a JSON library inside RDD closures; here each line is parsed once
by ``from_json`` into an all-text struct of the feed's keys (numbers arrive
as their text), and every output column is a typed field of it:

* C5  only lines that parse to a JSON *object* are kept (``{}`` included);
      garbage, empty lines, arrays and scalars give NULL and are dropped
* C6  ``i``   int: missing / null / empty -> 0; numeric text accepted;
      decimals truncate (3.7 -> 3); true / false -> 1 / 0; non-numeric -> 0
* C7  ``s``   string: missing -> NULL; numbers come out as text
* C8  ``d1``  decimal, one place, half up (0.25 -> 0.3, -0.25 -> -0.3), from
      the exact text; missing -> NULL. ``d1d`` / ``d1dz``: the same through a
      double first (the point and question scores are read that way, so
      digits beyond a double's precision are lost before rounding); ``d1dz``
      gives 0.0 when missing

Feed-specific rules (registration-source label, name/phone masks, the
password redaction, misspelt keys) are extra column expressions on the
same map. The output column order is the target table's.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX

DEC1 = "decimal(10,1)"


@dataclass(frozen=True)
class Col:
    name: str
    kind: str                 # 'i' | 's' | 'd1' | 'd1d' | 'd1dz'
    keys: tuple = ()          # JSON keys to read, first present wins (default: name)

    @property
    def json_keys(self) -> tuple:
        return self.keys or (self.name,)


@dataclass(frozen=True)
class FeedSpec:
    feed: str                 # ODS log name
    target: str               # DWD table
    cols: tuple               # output columns (Col) in table order, partition columns last
    partition: tuple = ("dt", "dn")
    mode: str = "append"      # 'append' | 'overwrite' (overwrite touched partitions)
    derived: dict = field(default_factory=dict)   # column -> rule name, applied after parsing


def _spec(feed, target, layout, partition=("dt", "dn"), mode="append", derived=None, keys=None):
    """layout: 'name:kind name:kind ...' (kind i/s/d1/d1d/d1dz); keys: {col: (json keys)}."""
    keys = keys or {}
    cols = []
    for tok in layout.split():
        name, kind = tok.split(":")
        cols.append(Col(name, kind, tuple(keys.get(name, ()))))
    for p in partition:
        cols.append(Col(p, "s"))
    return FeedSpec(feed, target, tuple(cols), tuple(partition), mode, dict(derived or {}))


# The 23 feeds, their target tables and column layouts (names,
# order and types of the detail tables).
FEEDS = {s.feed: s for s in [
    _spec("memberRegtype", "dwd_member_regtype",
          "uid:i appkey:s appregurl:s bdp_uuid:s createtime:s isranreg:s regsource:s regsourcename:s websiteid:i",
          derived={"regsourcename": "regsource_label"}),
    _spec("member", "dwd_member",
          "uid:i ad_id:i birthday:s email:s fullname:s iconurl:s lastlogin:s mailaddr:s memberlevel:s "
          "password:s paymoney:s phone:s qq:s register:s regupdatetime:s unitname:s userip:s zipcode:s",
          derived={"fullname": "mask_name", "password": "redact", "phone": "mask_phone_b"}),
    _spec("baseadlog", "dwd_base_ad", "adid:i adname:s", partition=("dn",), mode="overwrite"),
    _spec("baswewebsite", "dwd_base_website",
          "siteid:i sitename:s siteurl:s delete:i createtime:s creator:s", partition=("dn",), mode="overwrite"),
    _spec("pcentermempaymoney", "dwd_pcentermempaymoney", "uid:i paymoney:s siteid:i vip_id:i"),
    _spec("pcenterMemViplevel", "dwd_vip_level",
          "vip_id:i vip_level:s start_time:s end_time:s last_modify_time:s max_free:s min_free:s "
          "next_level:s operator:s", partition=("dn",), mode="overwrite"),
    _spec("QzChapter", "dwd_qz_chapter",
          "chapterid:i chapterlistid:i chaptername:s sequence:s showstatus:s creator:s createtime:s "
          "courseid:i chapternum:i outchapterid:i"),
    _spec("QzChapterList", "dwd_qz_chapter_list",
          "chapterlistid:i chapterlistname:s courseid:i chapterallnum:i sequence:s status:s creator:s createtime:s"),
    _spec("QzPoint", "dwd_qz_point",
          "pointid:i courseid:i pointname:s pointyear:s chapter:s creator:s createtime:s status:s "
          "modifystatus:s excisenum:i pointlistid:i chapterid:i sequence:s pointdescribe:s pointlevel:s "
          "typelist:s score:d1d thought:s remid:s pointnamelist:s typelistids:s pointlist:s"),
    _spec("QzPointQuestion", "dwd_qz_point_question",
          "pointid:i questionid:i questype:i creator:s createtime:s", keys={"questype": ("questtype",)}),
    _spec("QzSiteCourse", "dwd_qz_site_course",
          "sitecourseid:i siteid:i courseid:i sitecoursename:s coursechapter:s sequence:s status:s "
          "creator:s createtime:s helppaperstatus:s servertype:s boardid:i showstatus:s"),
    _spec("QzCourse", "dwd_qz_course",
          "courseid:i majorid:i coursename:s coursechapter:s sequence:s isadvc:s creator:s createtime:s "
          "status:s chapterlistid:i pointlistid:i", keys={"sequence": ("sequnece", "sequence")}),
    _spec("QzCourseEduSubject", "dwd_qz_course_edusubject",
          "courseeduid:i edusubjectid:i courseid:i creator:s createtime:s majorid:i"),
    _spec("QzWebsite", "dwd_qz_website",
          "siteid:i sitename:s domain:s sequence:s multicastserver:s templateserver:s status:s creator:s "
          "createtime:s multicastgateway:s multicastport:s"),
    _spec("QzMajor", "dwd_qz_major",
          "majorid:i businessid:i siteid:i majorname:s shortname:s status:s sequence:s creator:s "
          "createtime:s columm_sitetype:s"),
    _spec("QzBusiness", "dwd_qz_business",
          "businessid:i businessname:s sequence:s status:s creator:s createtime:s siteid:i"),
    _spec("QzPaperView", "dwd_qz_paper_view",
          "paperviewid:i paperid:i paperviewname:s paperparam:s openstatus:s explainurl:s iscontest:s "
          "contesttime:s conteststarttime:s contestendtime:s contesttimelimit:s dayiid:i status:s "
          "creator:s createtime:s paperviewcatid:i modifystatus:s description:s papertype:s downurl:s "
          "paperuse:s paperdifficult:s testreport:s paperuseshow:s"),
    _spec("QzCenterPaper", "dwd_qz_center_paper",
          "paperviewid:i centerid:i openstatus:s sequence:s creator:s createtime:s"),
    _spec("QzPaper", "dwd_qz_paper",
          "paperid:i papercatid:i courseid:i paperyear:s chapter:s suitnum:s papername:s status:s "
          "creator:s createtime:s totalscore:d1 chapterid:i chapterlistid:i"),
    _spec("QzCenter", "dwd_qz_center",
          "centerid:i centername:s centeryear:s centertype:s openstatus:s centerparam:s description:s "
          "creator:s createtime:s sequence:s provideuser:s centerviewtype:s stage:s"),
    _spec("QzQuestion", "dwd_qz_question",
          "questionid:i parentid:i questypeid:i quesviewtype:i content:s answer:s analysis:s "
          "limitminute:s score:d1dz splitscore:d1dz status:s optnum:i lecture:s creator:s createtime:s "
          "modifystatus:s attanswer:s questag:s vanalysisaddr:s difficulty:s quesskill:s vdeoaddr:s"),
    _spec("QzQuestionType", "dwd_qz_question_type",
          "quesviewtype:i viewtypename:s questypeid:i description:s status:s creator:s createtime:s "
          "papertypename:s sequence:s remark:s splitscoretype:s"),
    _spec("QzMemberPaperQuestion", "dwd_qz_member_paper_question",
          "userid:i paperviewid:i chapterid:i sitecourseid:i questionid:i majorid:i useranswer:s "
          "istrue:s lasttime:s opertype:s paperid:i spendtime:i score:d1 question_answer:i"),
]}

#: Key that marks the element put behind a line.
_END = "__end"
_MAP = T.MapType(T.StringType(), T.StringType())


def parsed_line(line, schema: T.DataType) -> Column:
    """The line as ``schema`` when it is one JSON object and nothing else, as an array of it; else empty or NULL.

    A JSON parser stops after the first value and ignores what follows, so
    the line is read as the first of two elements of an array: any other
    text in it breaks the array or changes its length. The second element holds
    the line's length; if the line closes the array early, its own text stands
    there instead. The parsed array is bound once, as the only element of
    another: named twice, it would be parsed twice.
    """
    c = F.col(line) if isinstance(line, str) else line
    end = F.octet_length(c).cast("string")
    if isinstance(schema, T.StructType):
        schema = T.StructType([*schema.fields, T.StructField(_END, T.StringType())])
    both = F.from_json(F.concat(F.lit("["), c, F.lit(f',{{"{_END}":"'), end, F.lit('"}]')), T.ArrayType(schema))
    whole = F.transform(F.array(both), lambda b: F.when((F.size(b) == 2) & (F.get(b, F.lit(1))[_END] == end), F.get(b, F.lit(0))))
    return F.filter(whole, lambda x: x.isNotNull())


def json_object(line) -> Column:
    """The line as a string map when it is one JSON object, else NULL."""
    return F.get(parsed_line(line, _MAP), F.lit(0))


def json_int(m: Column, *keys: str) -> Column:
    """Int value, 0 when missing, null, empty or not numeric; booleans 1 / 0."""
    v = F.coalesce(*[m[k] for k in keys]) if len(keys) > 1 else m[keys[0]]
    number = v.try_cast("decimal(38,6)").try_cast("int")
    return F.coalesce(F.when(v == "true", 1).when(v == "false", 0).otherwise(number), F.lit(0))


def json_string(m: Column, *keys: str) -> Column:
    """Text value, NULL when missing (``m`` is the parsed line, struct or map)."""
    return F.coalesce(*[m[k] for k in keys]) if len(keys) > 1 else m[keys[0]]


def json_decimal1(m: Column, *keys: str, missing_zero: bool = False, via_double: bool = False) -> Column:
    """One-decimal value rounded half up from the decimal text (or from
    the text of the value as a double, ``via_double``)."""
    v = json_string(m, *keys)
    if via_double:
        v = v.try_cast("double").cast("string")
    d = F.round(v.try_cast("decimal(38,18)"), 1).try_cast(DEC1)
    return F.coalesce(d, F.lit(0).cast(DEC1)) if missing_zero else d


def _typed(m: Column, c: Col) -> Column:
    if c.kind == "i":
        return json_int(m, *c.json_keys)
    if c.kind == "s":
        return json_string(m, *c.json_keys)
    if c.kind in ("d1", "d1d", "d1dz"):
        return json_decimal1(m, *c.json_keys, missing_zero=c.kind == "d1dz", via_double=c.kind != "d1")
    raise ValueError(c.kind)


def _derived(rule: str, parsed: dict) -> Column:
    if rule == "regsource_label":
        return TX.code_label(parsed["regsource"])
    if rule == "mask_name":
        return TX.mask_name(parsed["fullname"])
    if rule == "redact":
        return TX.redact()
    if rule == "mask_phone_b":
        return TX.mask_phone(parsed["phone"], "*****", keep_blank=False)
    raise ValueError(rule)


def line_schema(spec: FeedSpec) -> T.StructType:
    """All-text struct of every JSON key the feed reads (numbers arrive as their text)."""
    keys = []
    for c in spec.cols:
        if spec.derived.get(c.name) == "regsource_label":
            continue
        keys.extend(k for k in c.json_keys if k not in keys)
    return T.StructType([T.StructField(k, T.StringType()) for k in keys])


def _columns(m: Column, spec: FeedSpec) -> list[Column]:
    """The table's columns of a parsed line, in order."""
    # every column read from the line, including the raw inputs of masks
    parsed_cols = {c.name: _typed(m, c) for c in spec.cols
                   if spec.derived.get(c.name) != "regsource_label"}
    out = []
    for c in spec.cols:
        expr = _derived(spec.derived[c.name], parsed_cols) if c.name in spec.derived else parsed_cols[c.name]
        out.append(expr.alias(c.name))
    return out


def _reasons(m: Column, spec: FeedSpec) -> Column:
    """What a row of the parsed line (NULL: no object) doesn't show, as an array of reasons.

    Nearly every line has none, which one generated condition finds out; the
    array is only built, expression by expression, for the others.
    """
    found = {"not_an_object": m.isNull()}
    for c in spec.cols:
        rule = spec.derived.get(c.name)
        if c.kind == "i" and rule is None:
            v = json_string(m, *c.json_keys)
            number = v.try_cast("decimal(38,6)").try_cast("int")
            found[f"bad_number:{c.json_keys[0]}"] = number.isNull() & (F.trim(v) != "") & ~v.isin("true", "false")
        elif rule == "mask_phone_b":
            v = json_string(m, *c.json_keys)
            found["short_phone"] = F.length(v) < 11
        elif rule == "mask_name":
            v = json_string(m, *c.json_keys)
            found["empty_name"] = F.length(v) < 1
    some = reduce(or_, [F.coalesce(cond, F.lit(False)) for cond in found.values()])
    names = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in found.items()]))
    return F.when(some, names).otherwise(F.array().cast("array<string>"))


def ingest(lines: DataFrame, spec: FeedSpec, col: str = "value") -> DataFrame:
    """Raw feed lines -> typed DWD rows (columns in table order).

    Each line is parsed straight into a struct of the feed's keys (field
    access, not a key search per column). A line that is not one JSON object
    is dropped (``rejects`` has it); ``{}`` is an object and is kept. The drop
    happens inside a 0/1-element ``explode``: a plain filter on the parsed
    value would be pushed below the projection and parse every line twice.
    """
    objs = lines.select(F.explode(parsed_line(col, line_schema(spec))).alias("_m"))
    return objs.select(*_columns(F.col("_m"), spec))


def parsed(lines: DataFrame, spec: FeedSpec, col: str = "value") -> DataFrame:
    """Rows and rejects from one parse: the table's columns, ``_kept`` (the line is an object), ``_reasons``, ``_line``.

    The line itself is there only with a reason. Written once, it feeds the
    table and its rejects (``Warehouse.ingest``).
    """
    m = F.col("_m")
    objs = lines.select(F.col(col).alias("_line"), F.explode_outer(parsed_line(col, line_schema(spec))).alias("_m"))
    with_reasons = objs.select("_line", "_m", _reasons(m, spec).alias("_reasons"))
    return with_reasons.select(*_columns(m, spec), m.isNotNull().alias("_kept"), "_reasons",
                               F.when(F.size("_reasons") > 0, F.col("_line")).alias("_line"))


def rejects(lines: DataFrame, spec: FeedSpec, col: str = "value") -> DataFrame:
    """(line, reason) of what ``ingest`` drops or changes without a trace in its rows, a row for each reason.

    ``not_an_object``: the line is dropped. ``bad_number:<key>``: an integer
    field holds other text and became 0. ``short_phone`` and ``empty_name``:
    the masked field became NULL.
    """
    objs = lines.select(F.col(col).alias("line"), F.explode_outer(parsed_line(col, line_schema(spec))).alias("_m"))
    return objs.select("line", F.explode(_reasons(F.col("_m"), spec)).alias("reason"))


def object_line_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """(lines, kept): how many lines there are and how many are JSON objects."""
    return lines.agg(F.count(F.lit(1)).alias("lines"),
                     F.count(json_object(col)).alias("kept"))
