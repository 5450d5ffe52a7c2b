"""The warehouse as layered jobs: ODS lines -> DWD -> DWS -> ADS.

``Warehouse`` keeps every table as a partitioned parquet folder under one root
in the cluster's shared folder. Each step reads its inputs from the layer
below (partition pruning on ``dt``), writes its output, and so cuts the
lineage: a lost executor only re-runs the current step. Tables that the
reference appends to are appended to, so a second load of a day adds its rows;
``mode='overwrite'`` asks for steps that replace the partitions they write
(dynamic partition overwrite) and may be run again.

A feed load may carry a name. Its rows, its rejects and its line of the ledger
then lie in folders of that load, and running it again replaces them: the same
load twice adds its rows once, two loads add both.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import bitmaps as BM
from ..operators import cleaning as CL
from ..operators import member as MB
from ..operators import quiz as QZ
from ..operators import retention_state as RS
from ..sources import feeds as FD
from ..session import scratch_path
from . import sinks


LEDGER = "feed string, load string, lines long, rows long, rejected long"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str | None = None, mode: str = "append"):
        self.spark = spark
        self.root = (root or scratch_path(spark, "warehouse")).rstrip("/")
        self.mode = mode
        self.counts: dict = {}     # feed -> lines, rows and rejected lines of this run's last load
        self._schemas: dict = {}   # path -> schema written by this run (partition columns as text)

    # ------------------------------------------------------------ storage
    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def table(self, layer: str, table: str, partition_cols=("dt", "dn")) -> DataFrame:
        p = self.path(layer, table)
        if p in self._schemas:   # known layout: no schema inference pass over the folder
            df = self.spark.read.schema(self._schemas[p]).parquet(p)
        else:
            df = sinks.read_table(self.spark, p, (*partition_cols, "load"))
        return df.drop("load")

    def _write(self, df: DataFrame, layer: str, table: str, partition_cols, mode: str | None = None,
               load: str | None = None, shaped: bool = False) -> str:
        mode = mode or self.mode
        p = self.path(layer, table)
        from pyspark.sql import types as T
        data = [f for f in df.schema.fields if f.name not in partition_cols]
        levels = [*(["load"] if load else []), *partition_cols]
        self._schemas[p] = T.StructType(data + [T.StructField(c, T.StringType(), True) for c in levels])
        if load:
            (df if shaped else sinks.compact(df, partition_cols)).write.mode("overwrite").option(
                "partitionOverwriteMode", "static").partitionBy(*partition_cols).parquet(f"{p}/load={load}")
            return p
        if mode == "append":
            return sinks.append_partitioned(df, p, partition_cols, shaped=shaped)
        return sinks.overwrite_partitions(df, p, partition_cols, shaped=shaped)

    # ------------------------------------------------------------ DWD
    def ingest(self, feed: str, lines: DataFrame, load: str | None = None) -> str:
        """One feed job (F1-F23): parse, then append / overwrite per the spec.

        Lines are parsed once, into a written intermediate that feeds the table
        and its rejects; ``counts[feed]`` has the lines read, the rows and the
        lines with a reject. A named ``load`` may be run again (append feeds; the
        tables of a feed take either named loads or nameless ones).
        """
        spec = FD.FEEDS[feed]
        mode = "overwrite" if spec.mode == "overwrite" else self.mode
        if load is not None and not re.fullmatch(r"[\w.-]+", load):
            raise ValueError(f"a load is named by letters, digits and ._-: {load!r}")
        load = load if spec.mode == "append" else None  # snapshots replace anyway
        counted, parsed = Observation(), FD.parsed(lines, spec)
        path = scratch_path(self.spark, f"parsed-{spec.target}")
        parsed.observe(counted, F.count(F.lit(1)).alias("lines"), F.count(F.when(F.col("_kept"), 1)).alias("rows"),
                       F.count(F.when(F.size("_reasons") > 0, 1)).alias("rejected")).write.parquet(path)
        staged = self.spark.read.schema(parsed.schema).parquet(path)
        rejects = staged.where(F.size("_reasons") > 0).select(F.col("_line").alias("line"), F.explode("_reasons").alias("reason"))
        own = f"/load={load}" if load else ""
        sinks.compact(rejects).write.mode("overwrite" if load else mode).option("partitionOverwriteMode", "static").parquet(
            self.path("dwd_rejects", spec.target) + own)
        kept = staged.where("_kept").drop("_kept", "_reasons", "_line")
        out = self._write(kept, "dwd", spec.target, spec.partition, mode, load, sinks.few_folders(kept, spec.partition))
        self.counts[feed] = c = counted.get
        # last: a load is in the ledger when its rows and rejects are written
        ledger = self.spark.createDataFrame([(feed, load, c["lines"], c["rows"], c["rejected"])], LEDGER)
        ledger.coalesce(1).write.mode("overwrite" if load else mode).parquet(f"{self.path('dwd_ledger', feed)}/{load or 'nameless'}")
        return out

    def rejects(self, feed: str) -> DataFrame:
        """(line, reason) of the lines that the loads of a feed dropped or changed."""
        return self.spark.read.schema("line string, reason string").option("recursiveFileLookup", "true").parquet(
            self.path("dwd_rejects", FD.FEEDS[feed].target))

    def ledger(self) -> DataFrame:
        """(feed, load, lines, rows, rejected) of every load."""
        try:
            return self.spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(self.path("dwd_ledger", ""))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER)

    def ingest_all(self, lines_by_feed: dict, parallel: int = 4, load: str | None = None) -> dict:
        """Run independent feed jobs concurrently (one Spark job per feed).

        The feeds do not depend on each other; submitting several at once
        keeps the cluster busy while the small dimension feeds run. Only job
        submission happens on the driver threads, never data.
        """
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            futures = {feed: pool.submit(self.ingest, feed, lines, load) for feed, lines in lines_by_feed.items()}
            return {feed: f.result() for feed, f in futures.items()}

    def dwd(self, feed: str) -> DataFrame:
        spec = FD.FEEDS[feed]
        return self.table("dwd", spec.target, spec.partition)

    def load_behavior(self, lines: DataFrame, tz: str = "UTC") -> str:
        """B0 + load: raw log lines -> cleaned, typed ``user_behavior`` table by ``dt``;
        rejected lines go to ``user_behavior_rejects``.

        Analyses reading it get partition pruning on ``dt`` and the event-key
        filters pushed into the parquet scan.
        """
        typed = CL.typed_behavior(CL.clean_behavior(lines), tz)
        rejects = sinks.compact(CL.behavior_rejects(lines)).write.mode(self.mode)
        rejects.parquet(self.path("dwd", "user_behavior_rejects"))
        return self._write(typed, "dwd", "user_behavior", ("dt",))

    def behavior_rejects(self) -> DataFrame:
        """(line, reject_reason) of the raw lines that ``load_behavior`` kept out."""
        return self.spark.read.parquet(self.path("dwd", "user_behavior_rejects"))

    def behavior(self) -> DataFrame:
        t = self.spark.read.parquet(self.path("dwd", "user_behavior"))
        return t.withColumn("dt", F.col("dt").cast("int"))

    def store_user_bitmaps(self, day=None) -> str:
        """The bitmaps of a day's users (every day of the log when None); a day run again replaces its own."""
        log = self.behavior()
        days = log if day is None else log.where(F.col("dt") == int(day))
        return sinks.overwrite_partitions(BM.user_bitmaps(days), self.path("dws", "user_bitmaps"), ("dt",))

    def user_bitmaps(self, start_day=None, end_day=None) -> DataFrame:
        """The stored bitmaps of a range of days: other days' folders aren't read."""
        return self._days(self.spark.read.parquet(self.path("dws", "user_bitmaps")), start_day, end_day)

    def update_retention(self, day: int) -> str:
        """Adds a day to the retention state, from its log and the registrations of the six days before."""
        state = RS.day_state(self.behavior(), int(day))
        return sinks.overwrite_partitions(state, self.path("dws", "retention_state"), ("dt",))

    def retention(self, start_day: int, end_day: int) -> DataFrame:
        """B6 over a window of days that are in the state."""
        state = self.spark.read.schema(RS.STATE).parquet(self.path("dws", "retention_state"))
        return RS.retention(state, int(start_day), int(end_day))

    @staticmethod
    def _days(df: DataFrame, start_day, end_day) -> DataFrame:
        if start_day is not None:
            df = df.where(F.col("dt") >= int(start_day))
        return df if end_day is None else df.where(F.col("dt") <= int(end_day))

    # ------------------------------------------------------------ DWS
    def build_quiz(self, dt=None) -> dict:
        """Q1-Q6 from the DWD tables of day ``dt`` (every day when None)."""
        d = self.dwd
        out = {}
        steps = [
            ("dws_qz_chapter", lambda: QZ.chapter_wide(d("QzChapter"), d("QzChapterList"), d("QzPoint"),
                                                       d("QzPointQuestion"), dt)),
            ("dws_qz_course", lambda: QZ.course_wide(d("QzSiteCourse"), d("QzCourse"), d("QzCourseEduSubject"), dt)),
            ("dws_qz_major", lambda: QZ.major_wide(d("QzMajor"), d("QzWebsite"), d("QzBusiness"), dt)),
            ("dws_qz_paper", lambda: QZ.paper_wide(d("QzPaperView"), d("QzCenterPaper"), d("QzCenter"),
                                                   d("QzPaper"), dt)),
            ("dws_qz_question", lambda: QZ.question_wide(d("QzQuestion"), d("QzQuestionType"), dt)),
        ]
        # wide rows aren't shuffled once more for their files: a join's tasks write them, where the days are few
        shaped = sinks.few_folders(d("QzMemberPaperQuestion"), ("dt", "dn"))
        from concurrent.futures import ThreadPoolExecutor
        # the five wide tables are independent of each other: build them concurrently
        with ThreadPoolExecutor(max_workers=len(steps)) as pool:
            futures = {name: pool.submit(lambda b=build, n=name: self._write(b(), "dws", n, ("dt", "dn"), shaped=shaped))
                       for name, build in steps}
            out.update({name: f.result() for name, f in futures.items()})
        t = lambda n: self.table("dws", n)
        detail = QZ.user_paper_detail(d("QzMemberPaperQuestion"), t("dws_qz_chapter"), t("dws_qz_course"),
                                      t("dws_qz_major"), t("dws_qz_paper"), t("dws_qz_question"), dt)
        out["dws_user_paper_detail"] = self._write(detail, "dws", "dws_user_paper_detail", ("dt", "dn"), shaped=shaped)
        return out

    def build_member(self, dt=None) -> str:
        """M1 from the DWD member tables (members of day ``dt``)."""
        d = self.dwd
        wide = MB.member_wide(d("member"), d("memberRegtype"), d("baseadlog"), d("baswewebsite"),
                              d("pcentermempaymoney"), d("pcenterMemViplevel"), dt)
        return self._write(wide, "dws", "dws_member", ("dt", "dn"))

    # ------------------------------------------------------------ ADS input
    def paper_detail(self) -> DataFrame:
        return self.table("dws", "dws_user_paper_detail")
