"""Usage aggregates over enriched job rows.

Every aggregate here is algebraic (count / sum), so Spark plans a partial
hash aggregate before the shuffle: each map task emits at most one row per
group, and a hot group (one cluster holding a third of all jobs) never lands
in one task as raw rows.  Group counts are tiny (clusters x months), so the
shuffles move kilobytes whatever the input size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600

# The six report metrics, in output order.
SIX_METRICS = ["completed_jobs", "failed_jobs", "jobs_nonlocal", "seconds_nonlocal",
               "jobs_ehpc", "seconds_ehpc"]


def _nonlocal() -> Column:
    return F.col("agency") != "LOCAL"


def _ehpc() -> Column:
    return F.col("agency") == "EHPC"


def six_metric_aggs() -> list[Column]:
    """Conditional aggregates computing all six metrics in one pass."""
    return [
        F.count_if(F.col("outcome") == "COMPLETED").alias("completed_jobs"),
        F.count_if(F.col("outcome") == "FAILED").alias("failed_jobs"),
        F.count_if(_nonlocal()).alias("jobs_nonlocal"),
        F.coalesce(F.sum(F.when(_nonlocal(), F.col("job_seconds"))), F.lit(0).cast("bigint"))
         .alias("seconds_nonlocal"),
        F.count_if(_ehpc()).alias("jobs_ehpc"),
        F.coalesce(F.sum(F.when(_ehpc(), F.col("job_seconds"))), F.lit(0).cast("bigint"))
         .alias("seconds_ehpc"),
    ]


def resum_six() -> list[Column]:
    """Re-aggregate already aggregated six-metric rows (e.g. months -> window)."""
    return [F.sum(m).cast("bigint").alias(m) for m in SIX_METRICS]


def with_hours(df: DataFrame) -> DataFrame:
    """Add hours columns: seconds / 3600 as double (GPU-hours on the GPU cluster)."""
    return df.withColumn("hours_nonlocal", F.col("seconds_nonlocal") / F.lit(SECONDS_PER_HOUR)) \
             .withColumn("hours_ehpc", F.col("seconds_ehpc") / F.lit(SECONDS_PER_HOUR))


def month_grain(jobs: DataFrame) -> DataFrame:
    """(year, month, cluster) -> six metrics.  The base of every window report."""
    return jobs.groupBy("year", "month", "cluster").agg(*six_metric_aggs())


def single_pass_metrics(jobs: DataFrame) -> DataFrame:
    """Six metrics per (year, month, cluster) plus hours, one scan, one aggregate."""
    return with_hours(month_grain(jobs))


def state_histogram(jobs: DataFrame) -> DataFrame:
    """Jobs per normalised state, with the overall total on every row.

    The total is a scalar subquery over the histogram, so however many raw
    states a site has, they never meet in one task.
    """
    hist = jobs.groupBy("estate").agg(F.count(F.lit(1)).alias("n_jobs"))
    total = hist.agg(F.sum("n_jobs").cast("bigint").alias("total")).scalar()
    return hist.withColumn("total_jobs", total)


def outcome_by_cluster(jobs: DataFrame) -> DataFrame:
    """Jobs per cluster and outcome, all agencies."""
    return jobs.groupBy("cluster", "outcome").agg(F.count(F.lit(1)).alias("n_jobs"))


def usage_nonlocal(jobs: DataFrame) -> DataFrame:
    """Jobs and node/GPU-seconds per cluster for non-local accounts; count and sum fused."""
    agg = (jobs.where(_nonlocal())
           .groupBy("cluster")
           .agg(F.count(F.lit(1)).alias("jobs"),
                F.coalesce(F.sum("job_seconds"), F.lit(0).cast("bigint")).alias("seconds")))
    return agg.withColumn("hours", F.col("seconds") / F.lit(SECONDS_PER_HOUR))


def usage_by_agency_cluster(jobs: DataFrame) -> DataFrame:
    """Jobs and seconds per (agency, cluster)."""
    return (jobs.groupBy("agency", "cluster")
            .agg(F.count(F.lit(1)).alias("jobs"),
                 F.coalesce(F.sum("job_seconds"), F.lit(0).cast("bigint")).alias("seconds")))


def usage_ehpc(jobs: DataFrame) -> DataFrame:
    """Per-cluster EHPC usage: the agency x cluster aggregate kept for EHPC.

    The filter on the group key is pushed below the aggregate by Catalyst,
    so only EHPC rows are aggregated.
    """
    return (usage_by_agency_cluster(jobs)
            .where(F.col("agency") == "EHPC")
            .select("cluster", "jobs", "seconds",
                    (F.col("seconds") / F.lit(SECONDS_PER_HOUR)).alias("hours")))


def gpu_allocation_rules(jobs: DataFrame) -> DataFrame:
    """Old (CPU-block) versus current (GRES) billing units per cluster."""
    return (jobs.groupBy("cluster")
            .agg(F.sum("old_vnodes").cast("bigint").alias("sum_old_vnodes"),
                 F.sum("vnodes").cast("bigint").alias("sum_vnodes")))


def grouped_both_ways(jobs: DataFrame) -> DataFrame:
    """Jobs and seconds per (cluster, outcome) and per (cluster, agency), from one pass (grouping sets).

    ``by_outcome`` tells the two apart; the columns that a row is not grouped by are null.
    """
    return (jobs.groupingSets([["cluster", "outcome"], ["cluster", "agency"]], "cluster", "outcome", "agency")
            .agg((F.grouping("agency") == 1).alias("by_outcome"), F.count(F.lit(1)).alias("jobs"),
                 F.coalesce(F.sum("job_seconds"), F.lit(0).cast("bigint")).alias("seconds")))


def separate_aggregates_long(jobs: DataFrame) -> DataFrame:
    """The six metrics from plain aggregates by group, as (cluster, metric, value) rows.

    Outcome counts, non-local and EHPC counts and sums, all read off one grouping-sets
    aggregate, so the jobs are read once.  A group absent from an aggregate has no row
    (it is zero).
    """
    def entry(metric, value, when) -> Column:
        return F.when(when, F.struct(F.lit(metric).alias("metric"), F.col(value).cast("bigint").alias("value")))

    by_outcome, by_agency = F.col("by_outcome"), ~F.col("by_outcome")
    entries = F.array_compact(F.array(
        entry("completed_jobs", "jobs", by_outcome & (F.col("outcome") == "COMPLETED")),
        entry("failed_jobs", "jobs", by_outcome & (F.col("outcome") != "COMPLETED")),
        *[entry(f"{value}_{name}", value, by_agency & population()) for name, population in (("nonlocal", _nonlocal), ("ehpc", _ehpc))
          for value in ("jobs", "seconds")]))
    return (grouped_both_ways(jobs).select("cluster", F.explode(entries).alias("e"))
            .groupBy("cluster", F.col("e.metric").alias("metric")).agg(F.sum("e.value").cast("bigint").alias("value")))


def single_pass_long(jobs: DataFrame) -> DataFrame:
    """The six metrics from one conditional aggregate over the jobs, as (cluster, metric, value) rows."""
    return jobs.groupBy("cluster").agg(*six_metric_aggs()).unpivot("cluster", SIX_METRICS, "metric", "value")
