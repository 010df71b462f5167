"""Explicit schemas and the fixed values the report must reproduce."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Job accounting file (pipe separated, header row, one row per job).
# Only the seven columns below are used: they are picked by header name and
# typed with try_cast; any other column of the file is never parsed.
# ---------------------------------------------------------------------------
JOB_COLUMNS = ["Partition", "Account", "State", "AllocCPUS", "AllocTRES", "ElapsedRaw", "NNodes"]

JOB_SCHEMA = T.StructType([
    T.StructField("Partition", T.StringType()),
    T.StructField("Account", T.StringType()),
    T.StructField("State", T.StringType()),
    T.StructField("AllocCPUS", T.LongType()),
    T.StructField("AllocTRES", T.StringType()),
    T.StructField("ElapsedRaw", T.LongType()),
    T.StructField("NNodes", T.LongType()),
])

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's output; stated as plain text).
# ---------------------------------------------------------------------------
# Cluster labels, in report order, and their lower-case key prefixes.
CLUSTERS = ["ARM", "AMD", "GPU"]
# Classification substrings / prefixes (case sensitive, first rule wins).
ARM_MARK = "arm"
GPU_MARK = "a100"
FCT_PREFIX = "f"
EHPC_PREFIX = "ee"
COMPLETED_STATE = "COMPLETED"
CANCELLED_PATTERN = "CANCELLED(.*)"
GPU_TRES_PATTERN = r"gres/gpu=(\d+)"
GPUS_PER_NODE = 4          # GPU count assumed when the TRES string has no gres/gpu=N
CPUS_PER_GPU_SLOT = 32     # old allocation rule: one slot per 32 CPUs
# Machine definition.
MACHINE_NODES = {"ARM": 1632, "AMD": 500, "GPU": 132}
AVAILABILITY_RATIO = 0.8
EUROHPC_SHARE = 0.35
# Reporting-window tags: our tag name -> key suffix used in the parameter table.
TAG_SUFFIX = {"month": "", "quarter": "Trimester", "ytd": "Year"}
TAGS = ["month", "quarter", "ytd"]

# Parameter-table keys in output order (70 keys).
PARAM_KEYS = [
    "reportPeriod", "reportPeriodTrimester", "reportPeriodYear", "reportMonth", "reportYear",
    "armnodes", "amdnodes", "gpunodes", "percentaviail", "eurohpcavail",
    "ndays",
    "armusedhours", "amdusedhours", "gpuusedhours",
    "gpuusedhoursEuroHPC", "amdusedhoursEuroHPC", "armusedhoursEuroHPC",
    "armJobs", "amdJobs", "gpuJobs",
    "gpuCompletedJobs", "gpuFailedJobs", "armCompletedJobs", "amdCompletedJobs",
    "amdFailedJobs", "armFailedJobs",
    "gpuJobsEuroHPC", "amdJobsEuroHPC", "armJobsEuroHPC",
    "ndaysTrimester",
    "gpuCompletedJobsTrimester", "gpuFailedJobsTrimester", "armCompletedJobsTrimester",
    "amdCompletedJobsTrimester", "amdFailedJobsTrimester", "armFailedJobsTrimester",
    "armusedhoursTrimester", "amdusedhoursTrimester", "gpuusedhoursTrimester",
    "armJobsTrimester", "amdJobsTrimester", "gpuJobsTrimester",
    "gpuusedhoursEuroHPCTrimester", "amdusedhoursEuroHPCTrimester", "armusedhoursEuroHPCTrimester",
    "gpuJobsEuroHPCTrimester", "amdJobsEuroHPCTrimester", "armJobsEuroHPCTrimester",
    "ndaysYear",
    "gpuCompletedJobsYear", "gpuFailedJobsYear", "armCompletedJobsYear",
    "amdCompletedJobsYear", "amdFailedJobsYear", "armFailedJobsYear",
    "armusedhoursYear", "amdusedhoursYear", "gpuusedhoursYear",
    "armJobsYear", "amdJobsYear", "gpuJobsYear",
    "gpuJobsEuroHPCYear", "amdJobsEuroHPCYear", "armJobsEuroHPCYear",
    "gpuusedhoursEuroHPCYear", "amdusedhoursEuroHPCYear", "armusedhoursEuroHPCYear",
    "monthhours", "hoursTrimester", "hoursYear",
]
# Metric name in the key -> column of the window report that feeds it.
PARAM_METRICS = {
    "CompletedJobs": "completed_jobs",
    "FailedJobs": "failed_jobs",
    "Jobs": "jobs_nonlocal",
    "usedhours": "hours_nonlocal",
    "JobsEuroHPC": "jobs_ehpc",
    "usedhoursEuroHPC": "hours_ehpc",
}
# TeX expressions emitted verbatim for the hour totals of each window.
PARAM_TEX_EXPRESSIONS = {
    "monthhours": "{\\inteval{\\ndays * 24}}",
    "hoursTrimester": "{\\inteval{\\ndaysTrimester * 24}}",
    "hoursYear": "{\\inteval{\\ndaysYear * 24}}",
}
# Configuration display order of the comparison table; unknown names go last.
CONFIG_ORDER = ["baseline", "v2", "v3", "v4", "v5", "v6", "v7", "final"]
# Column headings of the comparison table, its caption and label.
DISPLAY_COLUMNS = ["Configuration", "Runtime (s)", "# Stages", "# Tasks", "Shuffle Read (MB)", "Shuffle Write (MB)",
                   "Peak Memory (MB)", "Driver Time (s)"]
TABLE_CAPTION = "Benchmark results across configurations."
TABLE_LABEL = "tab:benchmark"

# ---------------------------------------------------------------------------
# Spark event log: the subset of fields the run metrics need.
# ---------------------------------------------------------------------------
EVENT_LOG_SCHEMA = T.StructType([
    T.StructField("Event", T.StringType()),
    T.StructField("Timestamp", T.LongType()),
    T.StructField("App ID", T.StringType()),
    # job start: its stages and properties (job group); task end: its stage
    T.StructField("Job ID", T.LongType()),
    T.StructField("Stage IDs", T.ArrayType(T.LongType())),
    T.StructField("Properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("Stage ID", T.LongType()),
    T.StructField("Stage Info", T.StructType([
        T.StructField("Stage ID", T.LongType()),
        T.StructField("Number of Tasks", T.LongType()),
    ])),
    T.StructField("Task Info", T.StructType([
        T.StructField("Launch Time", T.LongType()),
        T.StructField("Finish Time", T.LongType()),
    ])),
    T.StructField("Task Metrics", T.StructType([
        T.StructField("Shuffle Read Metrics", T.StructType([
            T.StructField("Remote Bytes Read", T.LongType()),
            T.StructField("Local Bytes Read", T.LongType()),
        ])),
        T.StructField("Shuffle Write Metrics", T.StructType([
            T.StructField("Shuffle Bytes Written", T.LongType()),
        ])),
    ])),
    T.StructField("_bad", T.StringType()),
])

RUN_METRIC_COLUMNS = ["wall_time_s", "stages", "tasks", "shuffle_read_mb",
                      "shuffle_write_mb", "driver_time_s", "peak_memory_mb"]

RUN_METRICS_SCHEMA = T.StructType([
    T.StructField("run", T.LongType()),
    T.StructField("config", T.StringType()),
    T.StructField("wall_time_s", T.DoubleType()),
    T.StructField("stages", T.LongType()),
    T.StructField("tasks", T.LongType()),
    T.StructField("shuffle_read_mb", T.DoubleType()),
    T.StructField("shuffle_write_mb", T.DoubleType()),
    T.StructField("driver_time_s", T.DoubleType()),
    T.StructField("peak_memory_mb", T.DoubleType()),
])
