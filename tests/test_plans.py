"""Plan shape of every registered query: no Python UDF, no cartesian or
nested-loop join, filters and column pruning reach the parquet scan."""

import pytest

import __spark_entry__ as E
from coursewise import catalog

SF = "/root/testdata/sf0.001"
SIDE_EFFECTS = {"sink_orc", "sink_append", "sink_dynamic_overwrite", "sink_tsv", "sink_ctas", "partition_copy",
                "paper_report_layered", "member_wide_layered", "feed_stream_ingest", "member_wide_views",
                "behavior_table_funnel", "behavior_table_retention", "clean_typed_projection", "result_table", "named_loads"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SIDE_EFFECTS))
def test_no_slow_operators(spark, name):
    p = plan(E.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in p, f"{name}: {bad}"


def test_event_filter_pushed_and_columns_pruned(spark):
    from coursewise.operators import behavior
    from coursewise.sources import driver
    df = behavior.channel_new_users(driver.behavior_log(driver.table(spark, SF, "events")))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in p
    rep = E.queries()["paper_pass_rate"](spark, SF)
    p2 = rep._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in p2 and "l_tax" not in p2     # only the needed lineitem columns are read


def test_day_filter_pushed_to_scan(spark):
    from pyspark.sql import functions as F
    from coursewise.operators import reports
    from coursewise.sources import driver
    li = driver.table(spark, SF, "lineitem").where(F.col("l_returnflag") == "R")
    p = plan(reports.paper_avg(driver.paper_detail(li, driver.table(spark, SF, "orders"))))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in p


def test_stored_behavior_table_prunes_and_pushes(spark):
    from coursewise.operators import behavior
    from coursewise.plans import sinks as S
    from coursewise.plans.warehouse import Warehouse
    from coursewise.sources import driver
    from coursewise.session import scratch_path
    wh = Warehouse(spark)
    src = S.write_lines(driver.behavior_lines(driver.table(spark, SF, "events")), scratch_path(spark, "ods"))
    wh.load_behavior(S.read_lines(spark, src))
    p = plan(behavior.channel_new_users(wh.behavior(), day=20240105))
    assert "PartitionFilters: [isnotnull(dt" in p and "20240105" in p
    assert "EqualTo(event_key,registerAccount)" in p


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SIDE_EFFECTS))
def test_result_columns_are_unique(spark, name):
    cols = E.queries()[name](spark, SF).columns
    assert len(cols) == len(set(cols)), cols
