"""The behaviour-log cleaner on the edge lines of FIXTURES.md 1.3."""

from coursewise.operators import cleaning
from coursewise.sources.driver import BEHAVIOR_COLUMNS


def line(**over):
    base = {c: f"{c}v" for c in BEHAVIOR_COLUMNS}
    base.update(uid="7", phone="18701420007", event_time="1555000000")
    base.update(over)
    return "\t".join(base[c] for c in BEHAVIOR_COLUMNS)


def run(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good = {r.uid: r for r in cleaning.clean_behavior(df).collect()}
    bad = sorted((r.reject_reason for r in cleaning.behavior_rejects(df).collect()))
    return good, bad


def test_field_counts(spark):
    full = line()
    lines = [
        full.rsplit("\t", 1)[0],                      # 16 fields: dropped
        full + "\tx",                                 # 18 fields: dropped
        full.rsplit("\t", 1)[0] + "\t",               # 17, empty last: dropped
        line(uid="8") + "\t",                         # 18, empty last: kept
        line(uid="9", os=""),                         # 17, empty middle: kept
        "",                                           # empty line: dropped
    ]
    good, bad = run(spark, lines)
    assert sorted(good) == [8, 9] and bad == []
    assert good[9].os == ""


def test_masks_trims_and_rejects(spark):
    lines = [
        line(uid="1", phone="   "),                   # blank phone kept as is (trimmed)
        line(uid="2", phone="18701"),                 # short phone -> reject
        line(uid="3", phone="1870142000399"),         # long phone -> 11 chars used
        line(uid=" 4"),                               # uid with space -> reject
        line(uid="5", username="  ni\nck \r"),        # newline stripped, Java-trimmed
        line(uid="6", gender="\x0bF \x01"),           # control characters trimmed
    ]
    good, bad = run(spark, lines)
    assert sorted(good) == [1, 3, 5, 6]
    assert bad == ["bad_phone", "bad_uid"]
    assert good[1].phone == ""
    assert good[3].phone == "187xxxx0003"
    assert good[5].username == "nick"
    assert good[6].gender == "F"
    assert good[1].event_time == "1555000000"


def test_lines_are_split_once(spark):
    import itertools

    from coursewise.functions import text as T
    from coursewise.operators import cleaning as C
    from pyspark.sql import functions as F
    shapes = ["\t".join(x) + "\t" * k for n in range(5) for x in itertools.product(("a", ""), repeat=n) for k in range(4)]
    lines = spark.createDataFrame([(x,) for x in [*shapes, None]], "value string")
    for n in (2, 3, 4):
        kept = lines.select("value", F.coalesce(T.field_count_ok("value", n), F.lit(False)).alias("a"),
                            F.coalesce(T.fields_ok(T.split_fields("value"), n), F.lit(False)).alias("b"))
        assert kept.where("a != b").count() == 0 and kept.where("a").count() > 0
    for one in (C.clean_behavior(lines), C.behavior_rejects(lines)):
        plan = one._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1 and r"+\z" not in plan.replace(r"[0-9]+\z", "")
