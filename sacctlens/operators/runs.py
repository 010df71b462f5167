"""Per-run metrics from normalised run events and resource samples.

Input of ``run_aggregates`` is the run-event model: one row per event with a run
key, ``config``, ``kind`` (app_start, app_end, stage_submitted, task_start,
task_end), ``ts_ms``, ``n_tasks``, ``read_bytes`` and ``write_bytes``.  Both the
event-log reader and the test adapter emit it.

All per-run figures are min / max / sum / count, so a run holding a third of
all events is reduced map-side before the shuffle on the run key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BYTES_PER_MIB = 1024 * 1024
MS_PER_S = 1000.0


def _kind(k: str):
    return F.col("kind") == k


def run_aggregates(events: DataFrame, keys: Sequence[str] = ("run", "config"),
                   extra: Sequence = ()) -> DataFrame:
    """One row per run: app start/end, stage and task counts, task span, shuffle bytes.

    Zero timestamps are ignored for the task span; a missing application start
    or end counts as 0, so a log without an end has no wall time.
    """
    ts = F.col("ts_ms")
    return events.groupBy(*keys).agg(
        F.coalesce(F.min(F.when(_kind("app_start"), ts)), F.lit(0).cast("bigint")).alias("app_start_ms"),
        F.coalesce(F.max(F.when(_kind("app_end"), ts)), F.lit(0).cast("bigint")).alias("app_end_ms"),
        F.count_if(_kind("stage_submitted")).alias("stages"),
        F.coalesce(F.sum(F.when(_kind("stage_submitted"), F.col("n_tasks"))), F.lit(0).cast("bigint"))
         .cast("bigint").alias("tasks"),
        F.min(F.when(_kind("task_start") & (ts != 0), ts)).alias("first_launch_ms"),
        F.max(F.when(_kind("task_end") & (ts != 0), ts)).alias("last_finish_ms"),
        F.coalesce(F.sum(F.when(_kind("task_end"), F.col("read_bytes"))), F.lit(0).cast("bigint"))
         .cast("bigint").alias("read_bytes"),
        F.coalesce(F.sum(F.when(_kind("task_end"), F.col("write_bytes"))), F.lit(0).cast("bigint"))
         .cast("bigint").alias("write_bytes"),
        *extra,
    )


def metrics_from_aggregates(agg: DataFrame, keys: Sequence[str] = ("run", "config")) -> DataFrame:
    """Turn run aggregates into the published metric columns (seconds, MiB)."""
    start, end = F.col("app_start_ms"), F.col("app_end_ms")
    wall = F.when(end > start, (end - start) / F.lit(MS_PER_S)).otherwise(F.lit(0.0))
    span = (F.col("last_finish_ms") - F.col("first_launch_ms")) / F.lit(MS_PER_S)
    has_tasks = F.col("first_launch_ms").isNotNull() & F.col("last_finish_ms").isNotNull()
    return agg.select(
        *keys,
        wall.alias("wall_time_s"),
        F.col("stages"),
        F.col("tasks"),
        (F.col("read_bytes") / F.lit(BYTES_PER_MIB)).alias("shuffle_read_mb"),
        (F.col("write_bytes") / F.lit(BYTES_PER_MIB)).alias("shuffle_write_mb"),
        F.when(has_tasks & (wall > 0), F.greatest(F.lit(0.0), wall - span)).otherwise(F.lit(0.0))
         .alias("driver_time_s"),
    )


def run_metrics(events: DataFrame, keys: Sequence[str] = ("run", "config")) -> DataFrame:
    """wall, stages, tasks, shuffle read/write MiB and driver time per run."""
    return metrics_from_aggregates(run_aggregates(events, keys), keys)


def sample_peaks(samples: DataFrame, key: str = "run", value: str = "used_raw") -> DataFrame:
    """Peak memory per run in MiB from text samples.

    Non-numeric cells (repeated header rows) are skipped; the peak starts at 0,
    so negative or NaN samples never raise it.
    """
    v = F.col(value).try_cast("double")
    v = F.when(~F.isnan(v), v)
    return samples.groupBy(key).agg(
        (F.greatest(F.lit(0.0), F.coalesce(F.max(v), F.lit(0.0))) / F.lit(BYTES_PER_MIB))
        .alias("peak_memory_mb"))


def resource_peaks(runs: DataFrame, samples: DataFrame, key: str = "run",
                   value: str = "used_raw") -> DataFrame:
    """Every run with its peak memory; 0.0 for runs without a sample file."""
    peaks = sample_peaks(samples, key, value)
    return (runs.select(key).join(peaks, key, "left")
            .select(key, F.coalesce("peak_memory_mb", F.lit(0.0)).alias("peak_memory_mb")))


def pick_recent(agg: DataFrame, n: int = 3, group: str = "config", run: str = "run",
                start: str = "app_start_ms", fallback: str | None = None) -> DataFrame:
    """Rows of the ``n`` most recent runs per group (all columns kept) + ``run_no``.

    Recency is the application start (``fallback``, e.g. the log's file time,
    when a log has none); ties go to the smaller run key.  Runs are numbered
    1..n oldest-first.  ``row_number() <= n`` lets Spark insert a partial
    WindowGroupLimit before the shuffle, so each map task ships at most ``n``
    rows per group even when one group holds most runs.
    """
    order_ts = F.col(start) if fallback is None else \
        F.when(F.col(start) != 0, F.col(start)).otherwise(F.col(fallback))
    newest_first = Window.partitionBy(group).orderBy(order_ts.desc(), F.col(run).asc())
    picked = agg.select("*", F.row_number().over(newest_first).alias("_recency")) \
                .where(F.col("_recency") <= n)
    # Renumber oldest-first: reverse recency within the (at most n) picked rows.
    oldest_first = Window.partitionBy(group).orderBy(F.col("_recency").desc())
    return picked.select("*", F.row_number().over(oldest_first).alias("run_no")).drop("_recency")


def recent_runs(agg: DataFrame, n: int = 3, group: str = "config", run: str = "run",
                start: str = "app_start_ms", fallback: str | None = None) -> DataFrame:
    """(group, run, run_no) of the ``n`` most recent runs per group, numbered oldest-first."""
    return pick_recent(agg, n, group, run, start, fallback).select(group, run, "run_no")
