"""The command-line jobs end to end on small files: ODS -> DWD -> DWS -> ADS."""

import os

from coursewise import jobs
from coursewise.plans import sinks as S
from coursewise.plans.warehouse import Warehouse
from coursewise.session import scratch_path
from coursewise.sources import driver, ods

SF = "/root/testdata/sf0.001"
QUIZ = ["QzChapter", "QzChapterList", "QzPoint", "QzPointQuestion", "QzSiteCourse", "QzCourse",
        "QzCourseEduSubject", "QzMajor", "QzWebsite", "QzBusiness", "QzPaperView", "QzCenterPaper", "QzCenter",
        "QzPaper", "QzQuestion", "QzQuestionType", "QzMemberPaperQuestion"]


def test_quiz_and_member_layers(spark):
    ods_dir, root, out = (scratch_path(spark, n).replace("file:", "") for n in ("ods", "wh", "ads"))
    for feed in QUIZ + ["member", "memberRegtype", "baseadlog", "baswewebsite", "pcentermempaymoney",
                        "pcenterMemViplevel"]:
        S.write_lines(ods.ods_lines(spark, SF, feed), os.path.join(ods_dir, f"{feed}.log"))
    jobs.dwd(spark, root, ods_dir)
    wh = Warehouse(spark, root)
    wh.build_quiz("20190722")
    wh.build_member("20190722")
    written = jobs.ads_quiz(spark, root, "20190722", out)
    assert set(written) == {"paper_avg", "paper_min_max", "paper_top3", "paper_low3", "paper_bands",
                            "paper_pass_rate", "question_error_rate"}
    assert spark.read.option("sep", "\t").csv(written["paper_avg"]).count() > 0
    assert wh.table("dws", "dws_member").count() > 0


def test_behavior_jobs(spark):
    raw = S.write_lines(driver.behavior_lines(driver.table(spark, SF, "events")), scratch_path(spark, "raw"))
    cleaned = jobs.clean_log(spark, raw, scratch_path(spark, "clean"))
    assert spark.read.orc(cleaned).count() > 0 and spark.read.orc(cleaned + "_rejects").count() > 0
    root = scratch_path(spark, "wh")
    Warehouse(spark, root).load_behavior(S.read_lines(spark, raw))
    out = jobs.behavior_reports(spark, root, 20240105, scratch_path(spark, "res"), 20240101, 20240107)
    assert len(out) == 6
    funnel = spark.read.option("sep", "\t").csv(out["app_study_funnel_analysis"]).collect()
    assert len(funnel) == 1 and funnel[0][-1] == "20240105"


def test_cli_copy_partition(spark, monkeypatch):
    from pyspark.sql import functions as F
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    S.overwrite_partitions(spark.range(9).select(F.col("id"), (F.col("id") % 3).cast("string").alias("dt")), src,
                           ("dt",))
    monkeypatch.setattr(jobs, "build_session", lambda app=None, shuffle_partitions=None: spark)
    monkeypatch.setattr(spark, "stop", lambda: None)
    jobs.main(["copy-partition", src, dst, "1"])
    assert sorted(r.id for r in spark.read.parquet(dst).collect()) == [1, 4, 7]
