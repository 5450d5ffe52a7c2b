"""Exam reports (A1-A7) over the user-paper detail table.

Input columns: userid, paperviewid, paperviewname, questionid, score
(decimal), spendtime, user_question_answer, dt, dn and the name columns
chaptername, pointname, sitecoursename, coursename, majorname, shortname,
sitename, papername.

``dt=None`` reports every day at once (rows keyed by ``dt``); a given ``dt``
keeps that day only, which is the reference's call. Casts that can overflow
use ``try_cast`` so a bad group gives NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The name columns the top / bottom reports return, in order.
NAME_COLUMNS = ("paperviewname", "chaptername", "pointname", "sitecoursename", "coursename",
                "majorname", "shortname", "sitename", "papername")


def _day(detail: DataFrame, dt) -> DataFrame:
    return detail if dt is None else detail.where(F.col("dt") == F.lit(str(dt)))


def paper_avg(detail: DataFrame, dt=None) -> DataFrame:
    """A1: average score (decimal(4,1)) and time (decimal(10,2)) per paper.

    Averages run over the detail rows (one per answered question), as in
    the reference. Ordered by score, then time, descending; the keys break ties,
    so equal scores spread over the sort's tasks and the order is total.
    """
    return (_day(detail, dt).groupBy("paperviewid", "paperviewname", "dt", "dn")
            .agg(F.avg("score").try_cast("decimal(4,1)").alias("score"),
                 F.avg("spendtime").try_cast("decimal(10,2)").alias("spendtime"))
            .select("paperviewid", "paperviewname", "score", "spendtime", "dt", "dn")
            .orderBy(F.desc("score"), F.desc("spendtime"), "paperviewid", "paperviewname", "dt", "dn"))


def paper_min_max(detail: DataFrame, dt=None) -> DataFrame:
    """A2: best and worst score per paper (max_score, min_score)."""
    return (_day(detail, dt).groupBy("paperviewid", "paperviewname", "dt", "dn")
            .agg(F.max("score").try_cast("decimal(4,1)").alias("max_score"),
                 F.min("score").try_cast("decimal(4,1)").alias("min_score"))
            .select("paperviewid", "paperviewname", "max_score", "min_score", "dt", "dn"))


def _ranked(detail: DataFrame, keys, ascending: bool) -> DataFrame:
    """Rows whose score is among the three best (or worst) distinct scores of their group.

    This is ``dense_rank() over (partition by keys order by score) < 4``. The
    rank is computed over each group's *distinct* scores (bounded by the
    score domain, not by the number of answers), which Spark prunes with a
    ``WindowGroupLimit``, and the top ranks are equi-joined back to the
    answers (NULL-safe on keys and score, as a window keeps those groups). A popular paper whose best score is
    shared by a huge number of answers is then an ordinary inner-join key
    that AQE can split, instead of one window partition in one task.
    """
    order = F.col("score").asc() if ascending else F.col("score").desc()
    w = Window.partitionBy(*keys).orderBy(order)
    top = (detail.select(*keys, "score").distinct()
           .select(*[F.col(k).alias(f"top_{k}") for k in keys], F.col("score").alias("top_score"),
                   F.dense_rank().over(w).alias("rk"))
           .where(F.col("rk") < 4))
    cond = [F.col(k).eqNullSafe(F.col(f"top_{k}")) for k in keys] + [F.col("score").eqNullSafe(F.col("top_score"))]
    return (detail.join(top, cond)
            .select("userid", *NAME_COLUMNS, "score", "rk", "dt", "dn"))


def paper_top3(detail: DataFrame) -> DataFrame:
    """A3: users with the three best distinct scores of each paper (ties kept).

    Ranks over all days and sites, as the reference does (its ``dt``
    argument is unused).
    """
    return _ranked(detail, ["paperviewid"], ascending=False)


def paper_low3(detail: DataFrame, dt=None) -> DataFrame:
    """A4: users with the three worst distinct scores of each paper in a day."""
    if dt is None:
        return _ranked(detail, ["paperviewid", "dt"], ascending=True)
    return _ranked(_day(detail, dt), ["paperviewid"], ascending=True)


# Score bands (low, high, label); the first band includes its low end.
BANDS = ((0, 20, "0-20"), (20, 40, "20-40"), (40, 60, "40-60"), (60, 80, "60-80"), (80, 100, "80-100"))


def score_band(score) -> F.Column:
    """[0,20] -> '0-20', (20,40] -> '20-40', ... (80,100] -> '80-100', else NULL."""
    s = F.col(score) if isinstance(score, str) else score
    lo, hi, name = BANDS[0]
    expr = F.when((s >= lo) & (s <= hi), F.lit(name))
    for lo, hi, name in BANDS[1:]:
        expr = expr.when((s > lo) & (s <= hi), F.lit(name))
    return expr


def paper_bands(detail: DataFrame, dt=None, as_list: bool = False) -> DataFrame:
    """A5: who answered in which score band: one row per paper, band and user, with the number of answers.

    Scores outside [0,100] form the NULL band. ``as_list`` gives the
    reference's shape instead: one row per paper and band, the user ids joined
    by commas, one entry per answer, sorted. Its rows grow with the answers of
    a paper, so it is for small reports only.
    """
    keys = ["paperviewid", "paperviewname", "score_segment"]
    per_user = (_day(detail, dt).select("paperviewid", "paperviewname", score_band("score").alias("score_segment"),
                                        "userid", "dt", "dn")
                .groupBy(*keys, "userid", "dt", "dn").agg(F.count(F.lit(1)).alias("answers")))
    if not as_list:
        return per_user.select(*keys, "userid", "answers", "dt", "dn").orderBy(*keys, "userid", "dt", "dn")
    ids = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("userid", "answers"))),
                                lambda x: F.array_repeat(x["userid"].cast("string"), x["answers"].cast("int"))))
    return (per_user.groupBy(*keys, "dt", "dn").agg(F.array_join(ids, ",").alias("userids"))
            .select(*keys, "userids", "dt", "dn").orderBy(*keys, "dt", "dn"))


def paper_pass_rate(detail: DataFrame, dt=None) -> DataFrame:
    """Fails (score in [0,60]), passes (> 60) and pass rate per paper.

    The reference counts fails per (paper, name, day, site) and passes per
    (paper, day, site) and inner-joins them, so papers with only passes or
    only fails disappear. Here one aggregate counts both; the per-paper pass
    total is a window over the (small) aggregated rows.
    """
    s = F.col("score")
    fail = (s >= 0) & (s <= 60)
    agg = (_day(detail, dt).where(fail | (s > 60))
           .groupBy("paperviewid", "paperviewname", "dt", "dn")
           .agg(F.count(F.when(fail, 1)).alias("countdetail"),
                F.count(F.when(s > 60, 1)).alias("p")))
    w = Window.partitionBy("paperviewid", "dt", "dn")
    out = agg.withColumn("passcount", F.sum("p").over(w)).where(
        (F.col("countdetail") > 0) & (F.col("passcount") > 0))
    rate = F.try_divide(F.col("passcount"), F.col("passcount") + F.col("countdetail"))
    return out.select("paperviewid", "paperviewname", "countdetail", "dt", "dn", "passcount",
                      rate.try_cast("decimal(4,2)").alias("rate"))


def question_error_rate(detail: DataFrame, dt=None, top: int | None = None) -> DataFrame:
    """Wrong and right answers and error rate per question.

    Questions never answered wrong, or never right, are absent (inner join
    in the reference). Ordered by errcount descending, then question, day and
    site; ``top`` optionally keeps the first n rows (the report comment's "top 3").
    """
    a = F.col("user_question_answer")
    out = (_day(detail, dt).where(a.isin(0, 1))
           .groupBy("questionid", "dt", "dn")
           .agg(F.count(F.when(a == 0, 1)).alias("errcount"),
                F.count(F.when(a == 1, 1)).alias("rightcount"))
           .where((F.col("errcount") > 0) & (F.col("rightcount") > 0)))
    rate = F.try_divide(F.col("errcount"), F.col("errcount") + F.col("rightcount"))
    out = (out.select("questionid", "errcount", "dt", "dn", "rightcount",
                      rate.try_cast("decimal(4,2)").alias("rate"))
           .orderBy(F.desc("errcount"), "questionid", "dt", "dn"))
    return out.limit(top) if top else out
