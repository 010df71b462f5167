"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All read the shared test tables through the adapters in
``sacctlens.sources.testtables``; the report queries use one report month
(``REPORT_YEAR`` / ``REPORT_MONTH``) whose windows the data covers, and every
other query runs over the whole tables.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sacctlens.functions import calendar as C
from sacctlens.functions import enrich as E
from sacctlens.operators import compare as CMP
from sacctlens.operators import params as PRM
from sacctlens.operators import periods as P
from sacctlens.operators import runs as R
from sacctlens.operators import usage as U
from sacctlens.session import checkpoint_dir
from sacctlens.sources import testtables as TT

# Report month used by the report queries (the data spans 1995-01 .. 2001-11).
REPORT_YEAR = 1998
REPORT_MONTH = 5
# Benchmark comparison on the adapter: configurations v0..v7, v0 is the baseline.
RECENT_RUNS = 3
ADAPTER_BASELINE = "v0"
ADAPTER_CONFIG_ORDER = [f"v{i}" for i in range(8)]

JOB_OUTPUT = ["job_id", "line_no", "year", "month", "estate", "outcome", "cluster", "agency",
              "old_vnodes", "vnodes", "job_seconds"]


def _month_range(year: int, first: int, last: int) -> tuple[_dt.date, _dt.date]:
    lo = _dt.date(year, first, 1)
    nxt = _dt.date(year + (last == 12), last % 12 + 1, 1)
    return lo, nxt - _dt.timedelta(days=1)


def _report_jobs(spark: SparkSession, sf_dir: str, year: int = REPORT_YEAR,
                 month: int = REPORT_MONTH) -> DataFrame:
    """Jobs of the report year up to the report month, with the date range pushed to the scan."""
    return TT.jobs(spark, sf_dir, ship_range=_month_range(year, 1, month))


# ---------------------------------------------------------------- job rows
def q_jobs_enriched(spark, sf_dir):
    return TT.jobs(spark, sf_dir).select(*JOB_OUTPUT)


def q_month_pruned_scan(spark, sf_dir):
    """Rows per month for exactly the months the report's windows need; lineitem alone decides them."""
    needed = sorted({m for ms in C.window_months(REPORT_MONTH).values() for m in ms})
    jobs = TT.line_jobs(spark, sf_dir, ship_range=_month_range(REPORT_YEAR, min(needed), max(needed)))
    return (jobs.where((F.col("year") == REPORT_YEAR) & F.col("month").isin(needed))
            .groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_jobs")))


def q_union_months(spark, sf_dir):
    """The union of all monthly frames, counted per period: one scan with the period as a column."""
    period = F.element_at(F.array(*map(F.lit, C.MONTH_ABBR)), F.col("month"))
    return (TT.line_jobs(spark, sf_dir).withColumn("period", period)
            .groupBy("year", "period").agg(F.count(F.lit(1)).alias("n_jobs")))


# ---------------------------------------------------------------- aggregates
def q_state_histogram(spark, sf_dir):
    return U.state_histogram(TT.jobs(spark, sf_dir))


def q_outcome_by_cluster(spark, sf_dir):
    return U.outcome_by_cluster(TT.jobs(spark, sf_dir))


def q_usage_nonlocal(spark, sf_dir):
    return U.usage_nonlocal(TT.jobs(spark, sf_dir))


def q_usage_ehpc(spark, sf_dir):
    return U.usage_ehpc(TT.jobs(spark, sf_dir))


def q_usage_by_agency_cluster(spark, sf_dir):
    return U.usage_by_agency_cluster(TT.jobs(spark, sf_dir))


def q_gpu_allocation_rules(spark, sf_dir):
    jobs = TT.line_jobs(spark, sf_dir).select("*", E.cluster().alias("cluster"), E.old_vnodes().alias("old_vnodes"), E.vnodes().alias("vnodes"))
    return U.gpu_allocation_rules(jobs)


def q_single_pass_metrics(spark, sf_dir):
    return U.single_pass_metrics(TT.jobs(spark, sf_dir))


# ---------------------------------------------------------------- windows
def q_report_windows(spark, sf_dir):
    return P.report_windows(_report_jobs(spark, sf_dir), REPORT_YEAR, REPORT_MONTH)


def q_report_all_months(spark, sf_dir):
    return P.report_all_months(TT.jobs(spark, sf_dir))


def q_reports_requested(spark, sf_dir):
    """The reports of all quarter ends that the jobs reach, as a table of requests."""
    requests = TT.line_jobs(spark, sf_dir).where(F.col("month") % 3 == 0).select("year", "month")
    return P.reports_requested(TT.jobs(spark, sf_dir), requests)


def q_refreshed_month_grain(spark, sf_dir):
    """A grain that lacked the failed jobs of even months, after those months were refreshed; months and clusters with jobs."""
    jobs = TT.jobs(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/month-grain-{uuid.uuid4().hex}"
    months = [(r.year, r.month) for r in TT.line_jobs(spark, sf_dir).select("year", "month").distinct().collect()]
    P.refresh_month_grain(jobs.where((F.col("month") % 2 == 1) | (F.col("outcome") == "COMPLETED")), path, months)
    P.refresh_month_grain(jobs, path, [(y, m) for y, m in months if m % 2 == 0])
    grain = P.read_grain_versions(spark, path)
    return U.with_hours(grain.where(F.col("completed_jobs") + F.col("failed_jobs") > 0))


def q_period_calendar(spark, sf_dir):
    return P.period_calendar(TT.line_jobs(spark, sf_dir))


def q_report_params_long(spark, sf_dir):
    return PRM.report_params_long(_report_jobs(spark, sf_dir), REPORT_YEAR, REPORT_MONTH)


def q_report_tex_lines(spark, sf_dir):
    return PRM.report_tex_lines(_report_jobs(spark, sf_dir), REPORT_YEAR, REPORT_MONTH)


# ---------------------------------------------------------------- runs
def q_run_metrics(spark, sf_dir):
    return R.run_metrics(TT.run_events(spark, sf_dir))


def q_resource_peaks(spark, sf_dir):
    runs = TT.run_events(spark, sf_dir).select("run").distinct()
    return R.resource_peaks(runs, TT.samples(spark, sf_dir))


def q_recent_runs(spark, sf_dir):
    return R.recent_runs(R.run_aggregates(TT.run_events(spark, sf_dir)), n=RECENT_RUNS)


def _summary(spark, sf_dir):
    runs = CMP.benchmark_runs(TT.run_events(spark, sf_dir), TT.samples(spark, sf_dir), n=RECENT_RUNS)
    return CMP.config_summary(runs)


def q_config_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def q_merged_config_summary(spark, sf_dir):
    """The summary of all runs, put together from one of the odd and one of the even run numbers."""
    runs = CMP.benchmark_runs(TT.run_events(spark, sf_dir), TT.samples(spark, sf_dir), n=RECENT_RUNS)
    halves = runs.withColumn("config", F.concat_ws("/", "config", (F.col("run_no") % 2).cast("string")))
    published = CMP.config_summary(halves, digits=None).withColumn("config", F.substring_index("config", "/", 1))
    return CMP.merge_summaries(published)


def q_config_summary_display(spark, sf_dir):
    return CMP.config_summary_display(_summary(spark, sf_dir), ADAPTER_CONFIG_ORDER)


def q_speedup_vs_baseline(spark, sf_dir):
    """Wall times of the recent runs only: no samples, one scan of the events."""
    runs = CMP.recent_metrics(TT.run_events(spark, sf_dir), n=RECENT_RUNS)
    return CMP.speedup_vs_baseline(CMP.config_summary(runs, metrics=("wall_time_s",)), baseline=ADAPTER_BASELINE)


# ---------------------------------------------------------------- equality
def q_output_diff(spark, sf_dir):
    """The separate aggregates against the single conditional pass, each from the job rows."""
    jobs = TT.jobs(spark, sf_dir)
    return CMP.multiset_diff(U.separate_aggregates_long(jobs), U.single_pass_long(jobs), drop_zero="value")


def q_row_differences(spark, sf_dir):
    """The jobs whose billing units differ between the old and the current rule."""
    jobs = TT.line_jobs(spark, sf_dir).select("*", E.old_vnodes().alias("old_vnodes"), E.vnodes().alias("new_vnodes"))
    side = lambda units: jobs.select("job_id", "line_no", F.col(units).alias("vnodes"))
    return CMP.row_differences(side("old_vnodes"), side("new_vnodes"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "jobs_enriched": q_jobs_enriched,
    "month_pruned_scan": q_month_pruned_scan,
    "union_months": q_union_months,
    "state_histogram": q_state_histogram,
    "outcome_by_cluster": q_outcome_by_cluster,
    "usage_nonlocal": q_usage_nonlocal,
    "usage_ehpc": q_usage_ehpc,
    "usage_by_agency_cluster": q_usage_by_agency_cluster,
    "gpu_allocation_rules": q_gpu_allocation_rules,
    "single_pass_metrics": q_single_pass_metrics,
    "report_windows": q_report_windows,
    "report_all_months": q_report_all_months,
    "period_calendar": q_period_calendar,
    "report_params_long": q_report_params_long,
    "report_tex_lines": q_report_tex_lines,
    "run_metrics": q_run_metrics,
    "resource_peaks": q_resource_peaks,
    "recent_runs": q_recent_runs,
    "config_summary": q_config_summary,
    "config_summary_display": q_config_summary_display,
    "speedup_vs_baseline": q_speedup_vs_baseline,
    "output_diff": q_output_diff,
    "reports_requested": q_reports_requested,
    "refreshed_month_grain": q_refreshed_month_grain,
    "merged_config_summary": q_merged_config_summary,
    "row_differences": q_row_differences,
}
