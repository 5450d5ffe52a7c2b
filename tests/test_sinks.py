"""Write / read round trips under the shared folder."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from coursewise.plans import sinks as S
from coursewise.session import scratch_path


def frame(spark, n=10):
    return spark.range(n).select(F.col("id").cast("int").alias("k"), (F.col("id") % 3).cast("string").alias("dt"),
                                 F.lit("w").alias("dn"))


def test_orc_fails_if_exists(spark):
    p = scratch_path(spark, "orc")
    S.write_orc(frame(spark), p)
    assert spark.read.orc(p).count() == 10
    with pytest.raises(AnalysisException):
        S.write_orc(frame(spark), p)


def test_append_duplicates_and_overwrite_replaces_touched_partitions(spark):
    p = scratch_path(spark, "tbl")
    S.append_partitioned(frame(spark), p)
    S.append_partitioned(frame(spark), p)
    assert S.read_table(spark, p).count() == 20
    S.overwrite_partitions(frame(spark).where("dt = '1'").withColumn("k", F.lit(-1)), p)
    t = S.read_table(spark, p)
    assert t.where("dt = '1'").agg(F.max("k")).first()[0] == -1
    assert t.where("dt = '1'").count() == 3 and t.where("dt <> '1'").count() == 14
    assert dict(t.dtypes)["dt"] == "string"


def test_partition_copy(spark):
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    S.overwrite_partitions(frame(spark), src, ("dt",))
    S.copy_partitions(spark, src, dst, dt="2")
    assert sorted(r.k for r in spark.read.parquet(dst).collect()) == [2, 5, 8]


def test_tsv_and_ctas_and_text(spark):
    df = frame(spark)
    p = S.write_tsv(df, scratch_path(spark, "tsv"))
    assert sorted(S.read_tsv(spark, p, df.schema).collect()) == sorted(df.collect())
    S.save_table(df, "t_ctas_test", scratch_path(spark, "ctas"))
    S.save_table(df.limit(3), "t_ctas_test", scratch_path(spark, "ctas"))   # drop and re-create
    assert spark.table("t_ctas_test").count() == 3
    lp = S.write_lines(spark.createDataFrame([("a\tb",), ("c",)], "value string"), scratch_path(spark, "txt"))
    assert sorted(r.value for r in S.read_lines(spark, lp).collect()) == ["a\tb", "c"]


def test_shared_dir_comes_from_session(spark):
    from coursewise.session import shared_dir
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir().rstrip("/")
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/")   # the scheme is kept


def test_partition_copy_keeps_keys_and_layout(spark):
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    df = spark.createDataFrame([(1, "007", "01"), (2, "007", "x"), (3, "7", "01")], "k int, dt string, dn string")
    S.overwrite_partitions(df, src, ("dt", "dn"))
    S.copy_partitions(spark, src, dst, "007", ("dt", "dn"))
    assert sorted(map(tuple, S.read_table(spark, dst).select("k", "dt", "dn").collect())) == [(1, "007", "01"), (2, "007", "x")]


def test_cached_blocks_are_released(spark):
    df = spark.range(5)
    with S.cached(df):
        assert df.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_warehouse_appends_unless_asked_to_replace(spark):
    from coursewise.plans.warehouse import Warehouse
    lines = spark.createDataFrame([('{"pointid": 1, "questionid": 2, "dt": "20190722", "dn": "w"}',),
                                   ('{"pointid": 3, "questionid": 4, "dt": "20190723", "dn": "w"}',)], "value string")
    wh = Warehouse(spark, mode="overwrite")     # dynamic partition overwrite
    wh.ingest("QzPointQuestion", lines)
    wh.ingest("QzPointQuestion", lines)         # re-run of the same day(s)
    assert wh.dwd("QzPointQuestion").count() == 2
    old = Warehouse(spark)                      # the reference's behaviour
    old.ingest("QzPointQuestion", lines)
    old.ingest("QzPointQuestion", lines)
    assert old.dwd("QzPointQuestion").count() == 4


def test_result_table_keeps_every_text(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "a\tb"), (4, "x\ny\r\nz"), (5, "\\N"), (6, "\\t\\\\n"), (7, "|;|"), (8, "\\"), (None, "é\x0b")]
    df = spark.createDataFrame(rows, "k int, v string")
    for sep in ("\t", "|"):
        name = f"result_{'tab' if sep == chr(9) else 'bar'}"
        t = S.ResultTable(spark, name, "k int, v string", str(tmp_path / name), sep).create()
        t.insert_overwrite(df.limit(2))
        t.insert_overwrite(df)
        key = lambda r: repr(r)
        assert sorted(map(tuple, t.read().collect()), key=key) == sorted(rows, key=key)
        lines = [r.value for r in spark.read.text(str(tmp_path / name)).collect()]
        assert len(lines) == len(rows) and all(x.count(sep) == 1 for x in lines)
        spark.sql(f"DROP TABLE {name}_text")


def test_few_folders_are_written_without_a_shuffle(spark):
    days = lambda n: spark.range(400).selectExpr("id", f"cast(id % {n} as string) AS dt", "'w' AS dn")
    assert S.few_folders(days(S.FEW_FOLDERS), ("dt", "dn")) and not S.few_folders(days(S.FEW_FOLDERS + 1), ("dt", "dn"))
    p = scratch_path(spark, "shaped")
    S.append_partitioned(days(2).repartition(3, "id"), p, shaped=True)
    assert len(S.read_table(spark, p).inputFiles()) == 6      # each task wrote its own
    assert S.read_table(spark, p).count() == 400


def test_feed_load_of_one_day_does_not_shuffle_its_rows(spark, monkeypatch):
    from coursewise.plans.warehouse import Warehouse
    shuffled = []
    monkeypatch.setattr(S, "compact", lambda df, cols=(): shuffled.append(cols) or df)
    for n, folders in ((1, 1), (20, 20)):
        lines = [(f'{{"courseid": {k}, "dt": "201907{k % n:02d}", "dn": "w"}}',) for k in range(40)]
        wh = Warehouse(spark)
        wh.ingest("QzCourse", spark.createDataFrame(lines, "value string"))
        assert wh.dwd("QzCourse").count() == 40
    assert [c for c in shuffled if c] == [("dt", "dn")]           # the load of twenty days only


def test_packed_lines_keep_their_text(spark):
    lines = spark.createDataFrame([("a\tb",), ("",), ("\u00e9 c",)], "value string")
    p = S.write_lines(lines, scratch_path(spark, "packed"), packed=True)
    assert all(f.endswith(".gz") for f in S.read_lines(spark, p).inputFiles())
    assert sorted(r.value for r in S.read_lines(spark, p).collect()) == ["", "a\tb", "\u00e9 c"]
