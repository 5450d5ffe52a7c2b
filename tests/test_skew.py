"""Hot keys: one key holding a third of the rows must not change results."""

from pyspark.sql import functions as F

from coursewise.operators import behavior as B
from coursewise.operators import member as MB
from coursewise.operators.joins import left_join_skew_safe


def test_skew_safe_left_join_equals_left_join(spark):
    left = spark.range(30).select((F.col("id") % 10).alias("k"), F.col("id").alias("l"))
    right = (spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 7).alias("k"),
                                      F.col("id").alias("r"))
             .unionByName(spark.createDataFrame([(None, -1)], "k bigint, r bigint")))
    want = sorted(tuple(r) for r in left.join(right, ["k"], "left").select("k", "l", "r").collect())
    got = sorted(tuple(r) for r in left_join_skew_safe(left, right, ["k"]).select("k", "l", "r").collect())
    assert got == want


INT_COLUMNS = {"uid", "websiteid", "adid", "siteid", "delete", "vip_id", "ad_id"}


def empty_table(spark, cols):
    """An empty detail table with the given columns (ids int, the rest text)."""
    schema = ", ".join(f"{c} int" if c in INT_COLUMNS else f"{c} string" for c in cols)
    return spark.createDataFrame([], schema)


def with_text_columns(df, cols):
    for c in cols:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def test_member_wide_with_hot_member(spark):
    n = 3000
    member = spark.createDataFrame([(u, 1, "d", "w") for u in range(1, 11)], "uid int, ad_id int, dt string, dn string")
    member = with_text_columns(member, MB.MEMBER_COLS + ("email",))
    reg = empty_table(spark, ["uid", "appkey", "appregurl", "bdp_uuid", "createtime", "isranreg", "regsource",
                              "regsourcename", "websiteid", "dn"])
    ad = empty_table(spark, ["adid", "adname", "dn"])
    site = empty_table(spark, ["siteid", "sitename", "siteurl", "delete", "createtime", "creator", "dn"])
    # member 1 holds a third of the payments
    hot_uid = F.when(F.col("id") < n, 1).otherwise(F.col("id") % 10 + 1).cast("int")
    pay = spark.range(3 * n).select(hot_uid.alias("uid"), F.lit("1.5").alias("paymoney"),
                                    (F.col("id") % 3).cast("int").alias("vip_id"), F.lit("w").alias("dn"))
    vip = spark.createDataFrame([(0, "a", "w"), (0, "b", "w"), (1, "c", "w")],
                                "vip_id int, vip_level string, dn string")
    vip = with_text_columns(vip, ("start_time", "end_time", "last_modify_time", "max_free", "min_free",
                                  "next_level", "operator"))
    out = {r.uid: r.paymoney for r in MB.member_wide(member, reg, ad, site, pay, vip).collect()}
    # literal join: rows per payment = number of vip rows matching (at least 1)
    vip_rows = vip.groupBy("vip_id", "dn").count()
    mult = (pay.join(vip_rows, ["vip_id", "dn"], "left")
            .select("uid", (F.col("paymoney").cast("decimal(10,4)") * F.coalesce("count", F.lit(1))).alias("v"))
            .groupBy("uid").agg(F.sum("v").alias("s")))
    want = {r.uid: r.s for r in mult.collect()}
    assert {k: float(v) for k, v in out.items()} == {k: float(v) for k, v in want.items()}


def test_retention_hot_user(spark):
    # one user with many events every day next to ordinary users
    key = F.when(F.col("id") % 50 == 0, "registerAccount").otherwise("startApp")
    hot = spark.range(5000).select(F.lit(1).cast("bigint").alias("uid"), key.alias("event_key"),
                                   (F.lit(1555113600) + (F.col("id") % 5) * 86400 + F.col("id")).alias("event_time"))
    cold = spark.createDataFrame([(2, "registerAccount", 1555113600), (2, "startApp", 1555113600 + 86400)],
                                 "uid bigint, event_key string, event_time bigint")
    day = F.date_format(F.timestamp_seconds("event_time"), "yyyyMMdd").cast("int")
    log = hot.unionByName(cold).withColumn("dt", day)
    got = {r.register_day: tuple(r)[1:8] for r in B.retention_7d(log).collect()}
    # brute force: every registration row x every active day of that user
    regs = [(r.uid, r.dt) for r in log.where("event_key = 'registerAccount'").collect()]
    act = {(r.uid, r.dt) for r in log.select("uid", "dt").distinct().collect()}
    import datetime as dtm
    d = lambda k: dtm.datetime.strptime(str(k), "%Y%m%d")
    from collections import Counter
    ret, cnt = Counter(), Counter(day for _, day in regs)
    for u, day in regs:
        for u2, a in act:
            if u2 == u and (d(a) - d(day)).days >= 0:
                ret[(day, (d(a) - d(day)).days)] += 1
    for day, rates in got.items():
        for i in range(7):
            assert rates[i] == (round(ret[(day, i)] / cnt[day], 4) if ret[(day, i)] else 0.0)


def _final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()
    return qe.executedPlan().toString()


def test_aqe_splits_hot_key_in_skew_safe_form(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(200).select((F.col("id") % 20).alias("k"), F.col("id").alias("l"))
        # key 0 holds well over a third of the right side
        right = spark.range(30000).select(F.when(F.col("id") < 15000, 0).otherwise(F.col("id") % 20).alias("k"),
                                          F.col("id").alias("r"), F.lit("x" * 20).alias("pad"))
        plain = _final_plan(left.join(right, ["k"], "left"))
        safe = _final_plan(left_join_skew_safe(left, right, ["k"]))
        assert "skew=true" not in plain          # outer join: the hot right side cannot be split
        assert "skew=true" in safe               # inner part: the hot key is split over tasks
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
