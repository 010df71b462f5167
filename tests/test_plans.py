"""Plan assertions: scans, pushdown, pruning, no Python UDFs, no cross joins."""

import re

import pytest

from sacctlens.plans.explain import final_plan_text, plan_text
from sacctlens.plans.queries import QUERIES
from paths import SF01


def _plan(df, run=False):
    if run:
        df.write.format("noop").mode("overwrite").save()
    return plan_text(df)


def _scans(plan, table):
    return len(re.findall(rf"FileScan parquet [^\n]*{table}\.parquet", plan)) or \
        len(re.findall(rf"Scan parquet [^\n]*\n[^\n]*{table}", plan))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF01), run=True)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, (name, node)


def _formatted(spark, df):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return plan_text(df, "formatted")


def test_report_reads_each_table_once_with_pushdown(spark):
    text = _formatted(spark, QUERIES["report_windows"](spark, SF01))
    blocks = [b for b in text.split("\n\n") if re.match(r"\(\d+\) Scan parquet", b.strip())]
    tables = sorted(re.search(r"/(\w+)\.parquet\]", b).group(1) for b in blocks)
    assert tables == ["lineitem", "orders"], text
    line = [b for b in blocks if "lineitem" in b][0]
    pushed = re.search(r"PushedFilters: \[(.*)\]", line).group(1)
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in pushed
    assert "LessThan(l_shipdate,1998-06-01T00:00)" in pushed
    read_schema = re.search(r"ReadSchema: struct<(.*)>", line).group(1)
    cols = {c.split(":")[0] for c in read_schema.split(",")}
    assert cols == {"l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice",
                    "l_returnflag", "l_linestatus", "l_shipdate"}


@pytest.mark.parametrize("name", ["report_all_months", "single_pass_metrics", "report_params_long",
                                  "report_tex_lines", "period_calendar", "jobs_enriched"])
def test_one_scan_of_the_jobs(spark, name):
    plan = _plan(QUERIES[name](spark, SF01))
    tables = re.findall(r"FileScan parquet [^\n]*?/(\w+)\.parquet\]", plan)
    assert tables.count("lineitem") == 1, (name, tables)


def test_recent_runs_limits_before_shuffle(spark):
    plan = _plan(QUERIES["recent_runs"](spark, SF01))
    assert "WindowGroupLimit" in plan
    # the partial limit sits below the exchange
    partial = plan.index("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") >= 2 and plan.find("Exchange", partial) > partial


def test_month_grain_aggregates_before_shuffle(spark):
    plan = _plan(QUERIES["single_pass_metrics"](spark, SF01))
    assert re.search(r"HashAggregate\(keys=\[year#\d+, month#\d+, cluster#\d+\], functions=\[partial_", plan)


def test_output_diff_computes_both_sides_from_the_jobs(spark):
    df = QUERIES["output_diff"](spark, SF01)
    plan = _plan(df)
    assert "ExistingRDD" not in plan and len(re.findall(r"FileScan parquet [^\n]*lineitem\.parquet", plan)) >= 2
    assert df.collect()[0].identical


@pytest.mark.parametrize("name", ["period_calendar", "gpu_allocation_rules", "month_pruned_scan", "union_months"])
def test_queries_of_lineitem_alone_do_not_join(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES[name](spark, SF01))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "orders" not in plan and len(re.findall(r"FileScan parquet", plan)) == 1, plan


def test_run_jobs_read_each_input_once(spark):
    assert len(re.findall(r"FileScan parquet", _plan(QUERIES["run_metrics"](spark, SF01)))) == 1
    # the speedup needs the events alone: no samples, nothing run beforehand
    speedup = _plan(QUERIES["speedup_vs_baseline"](spark, SF01))
    assert len(re.findall(r"FileScan parquet", speedup)) == 1 and "ExistingRDD" not in speedup
    # samples are cut to the picked runs before they are aggregated
    assert "LeftSemi" in _plan(QUERIES["config_summary"](spark, SF01))


def test_only_bounded_frames_are_broadcast_at_scale(spark):
    """With automatic broadcasts off (as for tables far above the threshold), the
    report's only broadcasts are the <= 16-row window membership and the <= 9-row
    window result; the jobs join is a sort-merge join."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("report_windows", "report_tex_lines"):
            df = QUERIES[name](spark, SF01)
            df.collect()
            plan = final_plan_text(df)
            assert plan.count("BroadcastExchange") == 2, (name, plan)
            assert "SortMergeJoin" in plan
        for name in ("single_pass_metrics", "report_all_months", "run_metrics", "recent_runs"):
            df = QUERIES[name](spark, SF01)
            df.collect()
            assert "BroadcastExchange" not in plan_text(df), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
