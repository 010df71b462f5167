"""sacctlens — job-accounting usage reports and Spark run analytics as DataFrame jobs.

Three job families, all written with built-in Spark SQL functions:

* usage report: accounting rows -> outcome / cluster / agency / GPU-aware node
  seconds -> per-cluster counts and hours for overlapping reporting windows
  (month, trailing quarter, year to date) in one pass;
* run metrics: Spark event logs + resource samples -> one metrics row per run;
* configuration comparison: run rows -> mean, sample deviation, speedup,
  ordered display table, and an output-equality check.

The names below are the main entry points; see the README for the rest.
"""

from sacctlens.functions.enrich import enrich
from sacctlens.operators.compare import (config_summary, config_summary_display, log_benchmark_runs,
                                         log_run_metrics, multiset_diff, speedup_vs_baseline,
                                         summary_document)
from sacctlens.operators.params import report_params_long, report_tex_lines
from sacctlens.operators.periods import (period_calendar, report_all_months, report_windows,
                                         save_month_grain, windows_from_grain)
from sacctlens.operators.runs import recent_runs, resource_peaks, run_metrics
from sacctlens.operators.usage import month_grain, single_pass_metrics
from sacctlens.session import build_session, checkpoint_dir
from sacctlens.sources.eventlogs import read_event_logs
from sacctlens.sources.jobs import read_enriched_jobs, read_jobs, read_jobs_parquet, write_jobs_parquet
from sacctlens.sources.samples import read_resource_samples
from sacctlens.sources.summaries import read_summary_documents

__all__ = [
    "build_session", "checkpoint_dir",
    "read_jobs", "read_enriched_jobs", "read_jobs_parquet", "write_jobs_parquet", "enrich",
    "month_grain", "single_pass_metrics", "report_windows", "windows_from_grain", "save_month_grain",
    "report_all_months", "period_calendar", "report_params_long", "report_tex_lines",
    "read_event_logs", "read_resource_samples", "read_summary_documents",
    "run_metrics", "resource_peaks", "recent_runs", "log_run_metrics", "log_benchmark_runs",
    "config_summary", "summary_document", "speedup_vs_baseline", "config_summary_display",
    "multiset_diff",
]
