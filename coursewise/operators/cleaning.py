"""Clean the raw behaviour log (text lines -> typed 17-column table).

Steps of the reference, as one projection over ``spark.read.text``:
keep lines with exactly 17 tab-separated fields (Java split semantics),
mask the phone (field 9), strip line feeds from the nickname (field 1),
parse ``uid`` as an integer without trimming, Java-trim the other fields.

Lines the reference would crash on (bad uid, phone of 1-10 characters) are
not thrown: they get a ``reject_reason`` and are kept out of the good rows.
Lines with the wrong field count are dropped silently, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.driver import BEHAVIOR_COLUMNS


def parse_behavior(lines: DataFrame, col: str = "value") -> DataFrame:
    """Valid-length lines -> typed columns + ``reject_reason`` (NULL when good)."""
    # split once into an array column; later expressions index into it
    # instead of re-splitting the line (keeps the generated code small)
    f = F.col("_f")
    raw = [f.getItem(i) for i in range(len(BEHAVIOR_COLUMNS))]
    phone = T.mask_phone(raw[9])
    uid_ok = T.is_int_text(raw[0])
    reason = (F.when(~uid_ok, F.lit("bad_uid"))
              .when(phone.isNull() & ~T.is_blank(raw[9]), F.lit("bad_phone")))
    out = [raw[0].try_cast("int").alias("uid")]
    for i, name in enumerate(BEHAVIOR_COLUMNS[1:], start=1):
        v = raw[i]
        if name == "username":
            v = T.strip_newlines(v)
        elif name == "phone":
            v = phone
        out.append(T.java_trim(v).alias(name))
    # keep lines of the right length through a 0/1-element explode of the line
    # and its fields: a plain filter would be pushed below and split again
    n = len(BEHAVIOR_COLUMNS)
    line = F.struct(F.col(col).alias("line"), T.split_fields(col).alias("_f"))
    valid = F.explode(F.filter(F.array(line), lambda v: T.fields_ok(v["_f"], n))).alias("_v")
    return lines.select(valid).select("_v.line", "_v._f").select("line", *out, reason.alias("reject_reason"))


def clean_behavior(lines: DataFrame, col: str = "value") -> DataFrame:
    """Good rows only: uid int + 16 trimmed strings."""
    return (parse_behavior(lines, col).where(F.col("reject_reason").isNull())
            .select(*BEHAVIOR_COLUMNS))


def behavior_rejects(lines: DataFrame, col: str = "value") -> DataFrame:
    """Rows the reference would have failed on: (line, reject_reason)."""
    return (parse_behavior(lines, col).where(F.col("reject_reason").isNotNull())
            .select("line", "reject_reason"))


# Documented types of the behaviour table (everything else is text).
BEHAVIOR_TYPES = {"uid": "bigint", "level": "int", "is_vip": "int", "video_id": "int", "video_length": "int",
                  "start_video_time": "bigint", "end_video_time": "bigint", "event_time": "bigint"}


def typed_behavior(clean: DataFrame, tz: str = "UTC") -> DataFrame:
    """Cleaned text rows -> the typed behaviour table with its ``dt`` day key.

    Numbers that do not parse become NULL (``try_cast``); ``dt`` is the
    8-digit day of ``event_time`` read in zone ``tz``.
    """
    from ..functions.timecols import day_key, epoch_to_local_ntz
    cols = [F.col(c).try_cast(BEHAVIOR_TYPES[c]).alias(c) if c in BEHAVIOR_TYPES else F.col(c)
            for c in BEHAVIOR_COLUMNS]
    typed = clean.select(*cols)
    return typed.withColumn("dt", day_key(epoch_to_local_ntz(F.col("event_time"), tz)))
