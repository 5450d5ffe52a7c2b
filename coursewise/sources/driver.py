"""Driver tables and the warehouse views derived from them.

The reference reads Hive tables filled from an app log and JSON feeds. The
rebuild derives the same logical tables from the generated parquet tables:

* ``behavior_log``  : the cleaned app-behaviour table (17 columns + ``dt``)
  from ``events``; one line per event, two (start, end) per video view.
* ``behavior_lines``: the raw tab-separated text of that log, with a fixed
  share of damaged lines, for the cleaner.
* ``paper_detail``  : the exam-answer wide table the reports read, from
  ``lineitem`` joined to ``orders``.

All of them are lazy column expressions over the scans, so Catalyst reads
only the columns a query needs and pushes filters on source columns into the
parquet reader. Filters on derived columns (such as the event key) cannot
reach the files; the stored, ``dt``-partitioned behaviour table
(``plans.warehouse.Warehouse.load_behavior``) gives those pushdown and
partition pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; a plain parquet scan (pruning and pushdown apply)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# behaviour log
# ---------------------------------------------------------------------------

# Fixed values of the log mapping (event type -> event key, and the app
# attributes picked by the ``k`` property). Order matters: index = k modulo n.
EVENT_KEYS = {
    "signup": "registerAccount",
    "click": "startApp",
    "error": "startHomework",
    "purchase": "completeHomework",
}
VIDEO_KEYS = ("startVideo", "endVideo")
CHANNELS = ("auto", "toutiao", "huawei")
OSES = ("ios", "android")
VERSIONS = ("1.0", "1.1", "2.0", "2.1")
VIDEO_LENGTH = 60

# The behaviour log's 17 fields, in line order.
BEHAVIOR_COLUMNS = ("uid", "username", "gender", "level", "is_vip", "os", "channel",
                    "net_config", "ip", "phone", "video_id", "video_length",
                    "start_video_time", "end_video_time", "version", "event_key", "event_time")


def _pick(values: tuple, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def behavior_log(events: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """events -> behaviour table (uid ... event_time, dt).

    ``event_time`` is epoch seconds of the (zone-less) event timestamp and
    ``dt`` its 8-digit day. A ``view`` event yields a startVideo and an
    endVideo line; the watch lasts ``floor(value)`` seconds of a
    ``VIDEO_LENGTH``-second video.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    uid = F.col("user_id")
    et = F.unix_timestamp("ts")
    is_view = F.col("event_type") == "view"
    keys = F.when(is_view, F.array(*[F.lit(v) for v in VIDEO_KEYS]))
    other = None
    for src, dst in EVENT_KEYS.items():
        other = (F.when(F.col("event_type") == src, F.lit(dst)) if other is None
                 else other.when(F.col("event_type") == src, F.lit(dst)))
    keys = keys.otherwise(F.array(other.otherwise(F.col("event_type"))))

    extra = [F.col("event_id")] if keep_event_id else []
    base = events.select("event_id", "ts", "user_id", "event_type", "value", "props").select(
        *extra, uid.alias("uid"), k.alias("k"), et.alias("event_time"), is_view.alias("is_view"),
        F.floor("value").cast("bigint").alias("watched"),
        (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).cast("int").alias("dt"),
        F.explode(keys).alias("event_key"),
    )
    vid = F.col("is_view")
    return base.select(
        *extra,
        F.col("uid"),
        F.concat(F.lit("user_"), F.col("uid").cast("string")).alias("username"),
        F.when(F.col("uid") % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.col("uid") % 3 + 1).cast("int").alias("level"),
        F.when(F.col("k") >= 50, 1).otherwise(0).alias("is_vip"),
        _pick(OSES, F.col("k") % 2).alias("os"),
        _pick(CHANNELS, F.col("k") % 3).alias("channel"),
        F.when(F.col("k") % 5 == 0, "4G").otherwise("wifi").alias("net_config"),
        F.concat_ws(".", F.lit("10"), F.lit("0"), (F.col("uid") % 256).cast("string"),
                    F.col("k").cast("string")).alias("ip"),
        F.concat(F.lit("187"), F.lpad((F.col("uid") % 100000000).cast("string"), 8, "0")).alias("phone"),
        F.when(vid, F.col("k")).otherwise(0).alias("video_id"),
        F.when(vid, F.lit(VIDEO_LENGTH)).otherwise(0).alias("video_length"),
        F.when(vid, F.col("event_time")).otherwise(F.lit(0).cast("bigint")).alias("start_video_time"),
        F.when(vid, F.col("event_time") + F.col("watched")).otherwise(F.lit(0).cast("bigint")).alias("end_video_time"),
        _pick(VERSIONS, F.col("k") % 4).alias("version"),
        F.col("event_key"),
        F.col("event_time"),
        F.col("dt"),
    )


def behavior_log_sql(keep_event_id: bool = False) -> str:
    """The same derivation in DuckDB SQL (oracle side), over view ``events``."""
    ek = " ".join(f"WHEN '{s}' THEN '{d}'" for s, d in EVENT_KEYS.items())
    arr = lambda vals: "[" + ",".join(f"'{v}'" for v in vals) + "]"
    return f"""
    WITH b AS (
      SELECT {"event_id," if keep_event_id else ""} user_id AS uid,
             CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
             epoch_us(ts) // 1000000 AS event_time,
             event_type = 'view' AS is_view,
             CAST(floor(value) AS BIGINT) AS watched,
             CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS dt,
             unnest(CASE WHEN event_type = 'view' THEN {arr(VIDEO_KEYS)}
                         ELSE [CASE event_type {ek} ELSE event_type END] END) AS event_key
      FROM events)
    SELECT {"event_id," if keep_event_id else ""} uid,
           'user_' || CAST(uid AS VARCHAR) AS username,
           CASE WHEN uid % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           CAST(uid % 3 + 1 AS INTEGER) AS level,
           CASE WHEN k >= 50 THEN 1 ELSE 0 END AS is_vip,
           {arr(OSES)}[k % 2 + 1] AS os,
           {arr(CHANNELS)}[k % 3 + 1] AS channel,
           CASE WHEN k % 5 = 0 THEN '4G' ELSE 'wifi' END AS net_config,
           '10.0.' || CAST(uid % 256 AS VARCHAR) || '.' || CAST(k AS VARCHAR) AS ip,
           '187' || lpad(CAST(uid % 100000000 AS VARCHAR), 8, '0') AS phone,
           CASE WHEN is_view THEN k ELSE 0 END AS video_id,
           CASE WHEN is_view THEN {VIDEO_LENGTH} ELSE 0 END AS video_length,
           CASE WHEN is_view THEN event_time ELSE 0 END AS start_video_time,
           CASE WHEN is_view THEN event_time + watched ELSE 0 END AS end_video_time,
           {arr(VERSIONS)}[k % 4 + 1] AS version,
           event_key, event_time, dt
    FROM b"""


# ---------------------------------------------------------------------------
# raw behaviour lines (input of the cleaner)
# ---------------------------------------------------------------------------

# Damage applied to a fixed share of lines, chosen by ``event_id % 50``.
# Residue -> kind of damage.
LINE_DAMAGE = {
    7: "short",          # 16 fields
    13: "empty_last",    # 17 fields, last one empty -> rejected
    21: "extra_empty",   # 18 fields, last one empty -> kept (trailing empties drop)
    29: "blank_phone",   # phone is spaces -> kept as is
    33: "short_phone",   # 5-digit phone -> reject
    37: "spaced_uid",    # ' 7' -> reject (integer parse does not trim)
    41: "messy_name",    # padding + newline inside the nickname
    45: "long_phone",    # 13 digits -> digits past 11 dropped
    49: "empty_mid",     # empty middle field -> kept
}


def behavior_lines(events: DataFrame) -> DataFrame:
    """Raw tab-separated lines (column ``value``) of the behaviour log."""
    log = behavior_log(events, keep_event_id=True)
    r = F.col("event_id") % 50
    s = {c: F.col(c).cast("string") for c in BEHAVIOR_COLUMNS}
    s["uid"] = F.when(r == 37, F.concat(F.lit(" "), s["uid"])).otherwise(s["uid"])
    s["username"] = F.when(r == 41, F.concat(F.lit("  "), s["username"], F.lit("\n x \r"))).otherwise(s["username"])
    s["phone"] = (F.when(r == 29, F.lit("   "))
                  .when(r == 33, F.substring(s["phone"], 1, 5))
                  .when(r == 45, F.concat(s["phone"], F.lit("99")))
                  .otherwise(s["phone"]))
    s["net_config"] = F.when(r == 49, F.lit("")).otherwise(s["net_config"])
    # the 17 texts as one array column, so each line shape below reuses it
    fields = log.select("event_id", F.array(*[s[c] for c in BEHAVIOR_COLUMNS]).alias("_a"))
    full = F.array_join("_a", "\t")
    short = F.array_join(F.slice("_a", 1, len(BEHAVIOR_COLUMNS) - 1), "\t")
    line = (F.when(r == 7, short)
            .when(r == 13, F.concat(short, F.lit("\t")))
            .when(r == 21, F.concat(full, F.lit("\t")))
            .otherwise(full))
    return fields.select(line.alias("value"))


def behavior_lines_sql() -> str:
    """DuckDB twin of :func:`behavior_lines` (needs ``event_id`` kept)."""
    cols = {c: f"CAST({c} AS VARCHAR)" for c in BEHAVIOR_COLUMNS}
    r = "(event_id % 50)"
    cols["uid"] = f"CASE WHEN {r} = 37 THEN ' ' || {cols['uid']} ELSE {cols['uid']} END"
    cols["username"] = (f"CASE WHEN {r} = 41 THEN '  ' || username || chr(10) || ' x ' || chr(13) "
                        f"ELSE username END")
    cols["phone"] = (f"CASE WHEN {r} = 29 THEN '   ' WHEN {r} = 33 THEN substring(phone, 1, 5) "
                     f"WHEN {r} = 45 THEN phone || '99' ELSE phone END")
    cols["net_config"] = f"CASE WHEN {r} = 49 THEN '' ELSE net_config END"
    full = " || chr(9) || ".join(cols[c] for c in BEHAVIOR_COLUMNS)
    short = " || chr(9) || ".join(cols[c] for c in BEHAVIOR_COLUMNS[:-1])
    return f"""
    SELECT CASE WHEN {r} = 7 THEN {short}
                WHEN {r} = 13 THEN {short} || chr(9)
                WHEN {r} = 21 THEN {full} || chr(9)
                ELSE {full} END AS value
    FROM ({behavior_log_sql(keep_event_id=True)})"""


# ---------------------------------------------------------------------------
# paper detail (exam answers, the table the reports read)
# ---------------------------------------------------------------------------

def paper_detail(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """lineitem x orders -> one answered question per line item.

    userid = customer, paperviewid = supplier, questionid = part,
    score = 2 x quantity (decimal(4,1)), spendtime = line number x 60 s,
    user_question_answer = 0 (wrong) for returned lines else 1,
    dt = ship year (text), dn = line status. Name columns are derived from
    the ids so that they are constant per id.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                         "l_returnflag", "l_linestatus", "l_shipdate")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey"))
    j = li.join(od, "l_orderkey")
    s = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    return j.select(
        F.col("o_custkey").alias("userid"),
        F.col("l_suppkey").alias("paperviewid"),
        s("paperview-", F.col("l_suppkey")).alias("paperviewname"),
        F.col("l_partkey").alias("questionid"),
        s("chapter-", F.col("l_partkey") % 100).alias("chaptername"),
        s("point-", F.col("l_partkey")).alias("pointname"),
        s("sitecourse-", F.col("l_partkey") % 20).alias("sitecoursename"),
        s("course-", F.col("l_partkey") % 20).alias("coursename"),
        s("major-", F.col("l_suppkey") % 10).alias("majorname"),
        s("m", F.col("l_suppkey") % 10).alias("shortname"),
        s("site-", F.col("l_linestatus")).alias("sitename"),
        s("paper-", F.col("l_suppkey")).alias("papername"),
        (F.col("l_quantity") * 2).cast("decimal(4,1)").alias("score"),
        (F.col("l_linenumber") * 60).cast("int").alias("spendtime"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("user_question_answer"),
        F.year("l_shipdate").cast("string").alias("dt"),
        F.col("l_linestatus").alias("dn"),
    )


def paper_detail_sql() -> str:
    """DuckDB twin of :func:`paper_detail` over views ``lineitem``, ``orders``."""
    return """
    SELECT o_custkey AS userid,
           l_suppkey AS paperviewid,
           'paperview-' || CAST(l_suppkey AS VARCHAR) AS paperviewname,
           l_partkey AS questionid,
           'chapter-' || CAST(l_partkey % 100 AS VARCHAR) AS chaptername,
           'point-' || CAST(l_partkey AS VARCHAR) AS pointname,
           'sitecourse-' || CAST(l_partkey % 20 AS VARCHAR) AS sitecoursename,
           'course-' || CAST(l_partkey % 20 AS VARCHAR) AS coursename,
           'major-' || CAST(l_suppkey % 10 AS VARCHAR) AS majorname,
           'm' || CAST(l_suppkey % 10 AS VARCHAR) AS shortname,
           'site-' || l_linestatus AS sitename,
           'paper-' || CAST(l_suppkey AS VARCHAR) AS papername,
           CAST(l_quantity * 2 AS DECIMAL(4,1)) AS score,
           CAST(l_linenumber * 60 AS INTEGER) AS spendtime,
           CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS user_question_answer,
           CAST(year(l_shipdate) AS VARCHAR) AS dt,
           l_linestatus AS dn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
