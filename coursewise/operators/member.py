"""Member warehouse: member wide table (M1-M3) and its readers.

The reference joins member x registration x ad x website x payment x VIP
level (all LEFT, on id + site domain ``dn``) and groups by (uid, dn, dt),
taking ``first`` of most columns and ``sum(paymoney)`` over the joined rows.

``member_wide`` (M1) computes the same rows without materialising that
fan-out: every side is first reduced to one row per join key with a row
count, so the joined-row multiplicity that inflates ``sum(paymoney)`` in the
reference is recomputed exactly as a product of counts. A member that owns
a third of all payments then costs one pre-aggregated row per task, not a
third of the data in one task. ``first`` takes some joined row in the
reference; here it takes the smallest one (columns compared in the declared
order, NULL first), so all columns of a result come from one joined row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import left_join_skew_safe

PAY = "decimal(10,4)"

# The member wide table's 41 columns, in order.
MEMBER_WIDE = ("uid", "ad_id", "fullname", "iconurl", "lastlogin", "mailaddr", "memberlevel", "password",
               "paymoney", "phone", "qq", "register", "regupdatetime", "unitname", "userip", "zipcode", "appkey",
               "appregurl", "bdp_uuid", "reg_createtime", "isranreg", "regsource", "regsourcename", "adname",
               "siteid", "sitename", "siteurl", "site_delete", "site_createtime", "site_creator", "vip_id",
               "vip_level", "vip_start_time", "vip_end_time", "vip_last_modify_time", "vip_max_free",
               "vip_min_free", "vip_next_level", "vip_operator", "dt", "dn")

# The columns each side contributes, and the three rules of the VIP columns.
MEMBER_COLS = ("ad_id", "fullname", "iconurl", "lastlogin", "mailaddr", "memberlevel", "password", "phone", "qq",
               "register", "regupdatetime", "unitname", "userip", "zipcode")
REG_COLS = ("appkey", "appregurl", "bdp_uuid", "reg_createtime", "isranreg", "regsource", "regsourcename")
SITE_COLS = ("siteid", "sitename", "siteurl", "site_delete", "site_createtime", "site_creator")
VIP_MAX = ("vip_level", "vip_end_time", "vip_last_modify_time", "vip_next_level")
VIP_MIN = ("vip_start_time",)
VIP_FIRST = ("vip_max_free", "vip_min_free", "vip_operator")  # of one row, with the vip_id


# Columns the readers R1-R6 take, as names or (source, alias).
READ = {
    "member": ("uid", "ad_id", "email", "fullname", "iconurl", "lastlogin", "mailaddr", "memberlevel", "password", "phone",
               "qq", "register", "regupdatetime", "unitname", "userip", "zipcode", "dt", "dn"),  # R1
    "regtype": ("uid", "appkey", "appregurl", "bdp_uuid", ("createtime", "reg_createtime"), "isranreg", "regsource",
                "regsourcename", ("websiteid", "siteid"), "dn"),  # R2
    "base_ad": (("adid", "ad_id"), "adname", "dn"),  # R3
    "website": ("siteid", "sitename", "siteurl", ("delete", "site_delete"), ("createtime", "site_createtime"),
                ("creator", "site_creator"), "dn"),  # R4
    "vip_level": ("vip_id", "vip_level", ("start_time", "vip_start_time"), ("end_time", "vip_end_time"),
                  ("last_modify_time", "vip_last_modify_time"), ("max_free", "vip_max_free"), ("min_free", "vip_min_free"),
                  ("next_level", "vip_next_level"), ("operator", "vip_operator"), "dn"),  # R5
    "paymoney": ("uid", "paymoney", "vip_id", "dn"),  # R6; the amount as decimal(10,4)
}


def pairs(name: str) -> list[tuple[str, str]]:
    """(source, alias) of each column of a reader."""
    return [(c, c) if isinstance(c, str) else c for c in READ[name]]


def read(name: str, df: DataFrame) -> DataFrame:
    """One of the readers R1-R6."""
    cols = {alias: F.col(src).alias(alias) for src, alias in pairs(name)}
    if name == "paymoney":
        cols["paymoney"] = F.col("paymoney").try_cast(PAY).alias("paymoney")
    return df.select(*cols.values())


# ------------------------------------------------------------- M1 / M2

def member_wide(member, regtype, base_ad, website, paymoney, vip_level, dt=None) -> DataFrame:
    """M1: one row per (uid, dn, dt) of the members of day ``dt`` (all days if None).

    Only the member side is filtered by day; the other tables contribute all
    their days, as in the reference.
    """
    mem = read("member", member)
    if dt is not None:
        mem = mem.where(F.col("dt") == F.lit(str(dt)))

    # registration x website, reduced to one row per (uid, dn)
    # (the website's own siteid is NULL when it does not match, as d.siteid)
    reg = read("regtype", regtype).withColumnRenamed("siteid", "websiteid")
    site = read("website", website).withColumn("websiteid", F.col("siteid"))
    reg_site = (reg.join(site, ["websiteid", "dn"], "left")
                .groupBy("uid", "dn")
                .agg(F.count(F.lit(1)).alias("n_reg"), F.min(F.struct(*REG_COLS, *SITE_COLS)).alias("reg_site")))

    ad = (read("base_ad", base_ad).groupBy("ad_id", "dn")
          .agg(F.count(F.lit(1)).alias("n_ad"), F.min(F.struct("adname"))["adname"].alias("adname")))

    # payments per (uid, dn, vip_id) first: a hot member shrinks to a few rows
    pay = (read("paymoney", paymoney).groupBy("uid", "dn", "vip_id")
           .agg(F.sum("paymoney").alias("pay_sum")))
    vip = (read("vip_level", vip_level).groupBy("vip_id", "dn")
           .agg(F.count(F.lit(1)).alias("n_vip"),
                F.min(F.struct(*VIP_FIRST)).alias("vip_row"),
                *[F.max(c).alias(c) for c in VIP_MAX], *[F.min(c).alias(c) for c in VIP_MIN]))
    pv = pay.join(vip.withColumn("vip_key", F.col("vip_id")), ["vip_id", "dn"], "left")
    mult = F.coalesce(F.col("n_vip"), F.lit(1))
    per_pay = (pv.groupBy("uid", "dn")
               .agg(F.sum(F.col("pay_sum") * mult).alias("pay_sum"),
                    F.min(F.struct(F.col("vip_key").alias("vip_id"), *[F.col("vip_row")[c].alias(c) for c in VIP_FIRST])).alias("vip"),
                    *[F.max(c).alias(c) for c in VIP_MAX], *[F.min(c).alias(c) for c in VIP_MIN]))

    rows = (mem.join(reg_site, ["uid", "dn"], "left")
            .join(ad, ["ad_id", "dn"], "left")
            .join(per_pay, ["uid", "dn"], "left"))
    weight = F.coalesce(F.col("n_reg"), F.lit(1)) * F.coalesce(F.col("n_ad"), F.lit(1))
    out = rows.groupBy("uid", "dn", "dt").agg(
        F.min(F.struct(F.struct(*MEMBER_COLS).alias("member"), "reg_site", "adname", "vip")).alias("row"),
        *[F.min(c).alias(c) for c in VIP_MIN], *[F.max(c).alias(c) for c in VIP_MAX],
        F.sum(F.col("pay_sum") * weight).try_cast("decimal(20,4)").alias("paymoney"))
    return out.select("uid", "dn", "dt", "paymoney", *VIP_MIN, *VIP_MAX, "row.member.*", "row.reg_site.*", "row.adname",
                      "row.vip.*").select(*MEMBER_WIDE)


def member_wide_views(spark, member, regtype, base_ad, website, paymoney, vip_level, dt=None) -> DataFrame:
    """M2: the same rows, with the inputs registered as temp views first (the reference's variant).

    Views get names of their own, so runs of one session don't see each other's.
    """
    from ..plans.sinks import register_views
    mark = uuid.uuid4().hex[:8]
    inputs = {f"{name}_{mark}": df for name, df in (
        ("dwd_member", member), ("dwd_member_regtype", regtype), ("dwd_base_ad", base_ad), ("dwd_base_website", website),
        ("dwd_pcentermempaymoney", paymoney), ("dwd_vip_level", vip_level))}
    register_views(inputs)
    return member_wide(*[spark.table(name) for name in inputs], dt)


# ------------------------------------------------------------- M3

def member_join(member, regtype, base_ad, website, paymoney, vip_level, dt=None) -> DataFrame:
    """M3: the un-aggregated member join by API (USING keys), one row per match.

    ``siteid`` and ``vip_id`` are the left side's (USING semantics), so they
    stay set when the dimension has no match. The reference forces a
    broadcast of four tables; payments grow with the data, so here the
    planner decides from measured sizes, and the registration and payment
    joins are written skew-safe (a hot member is split across tasks).
    """
    mem = read("member", member)
    if dt is not None:
        mem = mem.where(F.col("dt") == F.lit(str(dt)))
    j = (left_join_skew_safe(mem, read("regtype", regtype), ["uid", "dn"])
         .join(read("base_ad", base_ad), ["ad_id", "dn"], "left")
         .join(read("website", website), ["siteid", "dn"], "left"))
    j = left_join_skew_safe(j, read("paymoney", paymoney), ["uid", "dn"])
    j = j.join(read("vip_level", vip_level), ["vip_id", "dn"], "left")
    return j.select(*MEMBER_WIDE)
