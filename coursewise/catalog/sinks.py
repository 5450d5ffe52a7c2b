"""Sinks and table maintenance as write / read-back round trips: S1, S5-S10, B7."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import behavior
from ..operators import cleaning as CL
from ..plans import sinks as SK
from ..session import scratch_path
from ..sources import driver
from ..sources import feeds as FD
from ..sources import ods
from .base import ORACLES, TEXT_LINES_CTE, behavior_input, clean_sql, dwd_input, lines_input, register


def _sink_orc(spark, sf):
    src = SK.write_lines(lines_input(spark, sf), scratch_path(spark, "ods_behavior"))
    out = SK.write_orc(CL.clean_behavior(SK.read_lines(spark, src)), scratch_path(spark, "behavior_clean"))
    return spark.read.orc(out)

register("sink_orc", clean_sql(True, TEXT_LINES_CTE))(_sink_orc)


def _sink_append(spark, sf):
    path = scratch_path(spark, "dwd_qz_point_question")
    df = dwd_input(spark, sf, "QzPointQuestion")
    SK.append_partitioned(df, path)
    SK.append_partitioned(df, path)
    return SK.read_table(spark, path).select(*df.columns)


_PQ = ods.expected_sql("QzPointQuestion")
register("sink_append", f"{_PQ}\nUNION ALL\n{_PQ}")(_sink_append)


def _sink_overwrite(spark, sf):
    path = scratch_path(spark, "dwd_member")
    df = dwd_input(spark, sf, "member")
    SK.overwrite_partitions(df, path)
    changed = (df.where(F.col("dt") == "20190722")
               .withColumn("memberlevel", F.concat(F.lit("v2-"), F.col("memberlevel"))))
    SK.overwrite_partitions(changed, path)
    return SK.read_table(spark, path).select(*df.columns)


_MEM = FD.FEEDS["member"]
register("sink_dynamic_overwrite", f"""
SELECT {', '.join("CASE WHEN dt = '20190722' THEN 'v2-' || memberlevel ELSE memberlevel END AS memberlevel"
                  if c.name == 'memberlevel' else c.name for c in _MEM.cols)}
FROM ({ods.expected_sql('member')}) t""")(_sink_overwrite)


def _sink_tsv(spark, sf):
    df = behavior.retention_7d(behavior_input(spark, sf))
    path = SK.write_tsv(df, scratch_path(spark, "retention_tsv"))
    return SK.read_tsv(spark, path, df.schema)


register("sink_tsv", ORACLES["retention_7d"])(_sink_tsv)


def _result_table(spark, sf):
    """Text with NULL, empty, tab, line break and backslash through a declared table, filled twice."""
    import uuid
    part = driver.table(spark, sf, "part")
    k = F.col("p_partkey") % 7
    note = (F.when(k == 0, F.lit(None)).when(k == 1, F.lit("")).when(k == 2, F.concat("p_name", F.lit("\t"), "p_brand"))
            .when(k == 3, F.concat(F.lit("a\nb\r"), "p_name")).when(k == 4, F.lit("\\N")).when(k == 5, F.concat(F.lit("\\t\\\\"), "p_name"))
            .otherwise(F.col("p_name")))
    rows = part.select("p_partkey", note.alias("note"), F.col("p_retailprice").cast("decimal(12,2)").alias("price"))
    name = f"result_{uuid.uuid4().hex[:12]}"
    table = SK.ResultTable(spark, name, "p_partkey long, note string, price decimal(12,2)", scratch_path(spark, name)).create()
    table.insert_overwrite(rows.limit(3))
    return table.insert_overwrite(rows).read()


register("result_table", """
SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN p_name || chr(9) || p_brand
       WHEN 3 THEN 'a' || chr(10) || 'b' || chr(13) || p_name WHEN 4 THEN '\\N' WHEN 5 THEN '\\t\\\\' || p_name ELSE p_name END AS note,
       CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part""")(_result_table)


def _sink_ctas(spark, sf):
    import uuid
    name = "tmp_app_access_count_" + uuid.uuid4().hex[:12]
    counts = behavior_input(spark, sf).groupBy("uid", "dt").agg(F.count(F.lit(1)).alias("access_count"))
    SK.save_table(counts, name, scratch_path(spark, name))
    t = spark.table(name)
    per_day = t.groupBy("dt").agg(
        F.count(F.when(F.col("access_count") <= 2, 1)).alias("n2"),
        F.count(F.when(F.col("access_count") <= 4, 1)).alias("n4"),
        F.count(F.when(F.col("access_count") > 4, 1)).alias("n5"))
    z = F.lit(0).cast("bigint")
    parts = [per_day.where(F.col(n) > 0).select(*[F.col(n).alias(c) if c == tgt else z.alias(c)
                                                  for c in ("le_two", "le_four", "gt_four")], "dt")
             for n, tgt in (("n2", "le_two"), ("n4", "le_four"), ("n5", "gt_four"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


register("sink_ctas", ORACLES["access_bands"])(_sink_ctas)


def _partition_copy(spark, sf):
    src = SK.overwrite_partitions(behavior_input(spark, sf), scratch_path(spark, "user_behavior"), ("dt",))
    dst = SK.copy_partitions(spark, src, scratch_path(spark, "user_behavior_copy"))
    return spark.read.parquet(dst)


register("partition_copy", f"SELECT * FROM ({driver.behavior_log_sql()}) t")(_partition_copy)


def _key_copy(spark, sf):
    # keys with leading zeros, two partition columns
    log = behavior_input(spark, sf).select("uid", F.lpad((F.col("dt") % 100).cast("string"), 3, "0").alias("dt"),
                                           F.col("channel").alias("dn"))
    src = SK.overwrite_partitions(log, scratch_path(spark, "key_src"), ("dt", "dn"))
    dst = SK.copy_partitions(spark, src, scratch_path(spark, "key_copy"), partition_cols=("dt", "dn"))
    return SK.read_table(spark, dst, ("dt", "dn"))


register("partition_copy_keys", f"""
SELECT uid, lpad(CAST(dt % 100 AS VARCHAR), 3, '0') AS dt, channel AS dn FROM ({driver.behavior_log_sql()}) t""")(_key_copy)


def _second_load(spark, sf):
    # two loads of one day under the default mode: the second adds its rows
    from ..plans.warehouse import Warehouse
    wh = Warehouse(spark)
    for _ in range(2):
        wh.ingest("QzPointQuestion", ods.ods_lines(spark, sf, "QzPointQuestion"))
    return wh.dwd("QzPointQuestion").select(*[c.name for c in FD.FEEDS["QzPointQuestion"].cols])


register("append_second_load", f"{_PQ}\nUNION ALL\n{_PQ}")(_second_load)


def _named_loads(spark, sf):
    # one load run twice and another: the rows of both, once each
    from ..plans.warehouse import Warehouse
    wh = Warehouse(spark)
    for load in ("day-1", "day-1", "day-2"):
        wh.ingest("QzPointQuestion", ods.ods_lines(spark, sf, "QzPointQuestion"), load)
    return wh.dwd("QzPointQuestion").select(*[c.name for c in FD.FEEDS["QzPointQuestion"].cols])


register("named_loads", f"{_PQ}\nUNION ALL\n{_PQ}")(_named_loads)


def _preview(spark, sf):
    # S16 looks at the first rows and leaves the data as they are
    df = driver.table(spark, sf, "region")
    SK.preview(df, 3)
    return df.select("r_regionkey", "r_name")


register("preview_rows", "SELECT r_regionkey, r_name FROM region")(_preview)


def _replaced_table(spark, sf):
    # filled, and filled anew in one catalog change
    import uuid
    name = "replaced_" + uuid.uuid4().hex[:12]
    root, log = scratch_path(spark, name), behavior_input(spark, sf)
    counts = log.groupBy("uid", "dt").agg(F.count(F.lit(1)).alias("access_count"))
    SK.replace_table(counts.where("access_count > 1"), name, root)
    return spark.table(SK.replace_table(counts, name, root))


register("replaced_table", f"SELECT uid, dt, count(*) AS access_count FROM ({driver.behavior_log_sql()}) t GROUP BY uid, dt")(
    _replaced_table)
