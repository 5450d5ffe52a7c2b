"""Log cleaning and masking: C1-C4, C9, C11, C12 and the cleaner B0."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import cleaning
from ..operators import cleaning as CL
from ..plans import sinks as SK
from ..session import scratch_path
from ..sources import driver
from .base import (LINES_CTE, STORED_LOG_CTE, blank_sql, clean_sql, fieldcount_sql,
                   jtrim_sql, lines_input, mask_sql, register)

register("clean_validate_fields", LINES_CTE + f"""
SELECT value, CAST({fieldcount_sql('value')} AS INTEGER) AS n_fields,
       {fieldcount_sql('value')} = 17 AS valid
FROM lines""")(lambda spark, sf: lines_input(spark, sf).select(
    "value", TX.field_count("value").alias("n_fields"), TX.field_count_ok("value", 17).alias("valid")))

register("clean_mask_phone", LINES_CTE + f"""
SELECT phone, {blank_sql('phone')} AS blank,
       {mask_sql('phone', 'xxxx', True)} AS phone_a,
       {mask_sql('phone', '*****', False)} AS phone_b
FROM (SELECT string_split(value, chr(9))[10] AS phone FROM lines
      WHERE {fieldcount_sql('value')} = 17) t""")(
    lambda spark, sf: lines_input(spark, sf).where(TX.field_count_ok("value"))
    .select(TX.split_fields("value").getItem(9).alias("phone"))
    .select("phone", TX.is_blank("phone").alias("blank"),
            TX.mask_phone("phone").alias("phone_a"),
            TX.mask_phone("phone", "*****", keep_blank=False).alias("phone_b")))

register("clean_strip_newline", LINES_CTE + f"""
SELECT username, {jtrim_sql("replace(username, chr(10), '')")} AS clean_username
FROM (SELECT string_split(value, chr(9))[2] AS username FROM lines
      WHERE {fieldcount_sql('value')} = 17) t""")(
    lambda spark, sf: lines_input(spark, sf).where(TX.field_count_ok("value"))
    .select(TX.split_fields("value").getItem(1).alias("username"))
    .select("username", TX.java_trim(TX.strip_newlines("username")).alias("clean_username")))

register("clean_behavior", clean_sql(True))(
    lambda spark, sf: cleaning.clean_behavior(lines_input(spark, sf)))
register("clean_rejects", clean_sql(False))(
    lambda spark, sf: cleaning.behavior_rejects(lines_input(spark, sf)))

register("mask_name", """
SELECT c_custkey,
       CASE WHEN length(c_name) >= 1 THEN substring(c_name, 1, 1) || 'xx' END AS fullname,
       '******' AS password
FROM customer""")(lambda spark, sf: driver.table(spark, sf, "customer").select(
    "c_custkey", TX.mask_name("c_name").alias("fullname"), TX.redact().alias("password")))

register("code_label", """
SELECT o_orderkey, substring(o_orderpriority, 1, 1) AS regsource,
       CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'PC' WHEN '2' THEN 'Mobile'
            WHEN '3' THEN 'App' WHEN '4' THEN 'WeChat' ELSE 'other' END AS regsourcename
FROM orders""")(lambda spark, sf: driver.table(spark, sf, "orders").select(
    "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("regsource"))
    .withColumn("regsourcename", TX.code_label("regsource")))


register("clean_typed_projection", STORED_LOG_CTE + "SELECT * FROM log")(
    lambda spark, sf: CL.typed_behavior(CL.clean_behavior(
        SK.read_lines(spark, SK.write_lines(lines_input(spark, sf), scratch_path(spark, "ods_behavior"))))))
