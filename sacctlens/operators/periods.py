"""Overlapping reporting windows (month, trailing quarter, year to date).

Windows overlap, so one job row belongs to up to three of them.  Instead of
expanding the jobs, everything is first reduced to the month grain
(year, month, cluster) — a few hundred rows per decade of data — and the
window logic runs on that:

* ``report_windows``: one report month; the month grain is joined to a
  (tag, year, month) membership frame of at most 16 rows (built from the
  parameters, so its size is bounded by construction) and re-aggregated.
* ``report_all_months``: every month at once; one aggregate per month with
  cluster-conditional metrics, then range frames over the month number,
  partitioned by (year, cluster) — partitioning by year *is* the January clip
  of the quarter.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sacctlens import schema as S
from sacctlens.functions import calendar as C
from sacctlens.sources.local import local_rows
from sacctlens.operators.usage import SIX_METRICS, month_grain, resum_six, with_hours

GRAIN_SCHEMA = "year int, month int, cluster string, " + ", ".join(f"{m} bigint" for m in SIX_METRICS) + ", version bigint"


def window_tags(spark, year: int, month: int) -> DataFrame:
    """(tag, year, month) membership rows of one report (<= 1 + 3 + 12 rows)."""
    rows = [(tag, int(year), m) for tag, months in C.window_months(month).items() for m in months]
    return local_rows(spark, rows, "tag string, year int, month int")


def report_spine(spark) -> DataFrame:
    """The 3 tags x 3 clusters rows every report prints, zero when absent."""
    rows = [(t, c) for t in S.TAGS for c in S.CLUSTERS]
    return local_rows(spark, rows, "tag string, cluster string")


def report_windows(jobs: DataFrame, year: int, month: int) -> DataFrame:
    """Six metrics + hours for the month, quarter and YTD windows of (year, month).

    One scan of the jobs restricted to year ``year``, months 1..``month``
    (partition pruning when the jobs are month-partitioned), one partial +
    final aggregate to the month grain, then tiny joins.
    """
    grain = month_grain(jobs.where((F.col("year") == year) & (F.col("month") <= month)
                                   & (F.col("month") >= 1)))
    return windows_from_grain(grain, year, month)


def save_month_grain(jobs: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write the month grain once (a few hundred rows per decade) and return it read back.

    For several reports over the same jobs (e.g. every month of a year): one
    scan of the jobs, then each report reads the small table.  ``path`` should
    be in shared storage (it also cuts lineage, so lost executors only re-read it).
    """
    month_grain(jobs).write.mode(mode).parquet(path)
    return jobs.sparkSession.read.parquet(path)


#: Years a request may name; the months needed for all of them are broadcast (3,600 rows at most).
YEARS = (1900, 2199)


def requested_members(requests: DataFrame) -> DataFrame:
    """(report_year, report_month, tag, year, month): the months in each window of each distinct request."""
    month = F.col("report_month")
    windows = F.map_from_arrays(F.array(*map(F.lit, S.TAGS)), F.array(
        F.array(month), F.sequence(F.greatest(month - 2, F.lit(1)), month), F.sequence(F.lit(1), month)))
    wanted = (requests.select(F.col("year").cast("int").alias("report_year"), F.col("month").cast("int").alias("report_month"))
              .where(F.col("report_month").between(1, 12) & F.col("report_year").between(*YEARS)).distinct())
    return (wanted.select("report_year", "report_month", F.explode(windows).alias("tag", "months"))
            .select("report_year", "report_month", "tag", F.col("report_year").alias("year"), F.explode("months").alias("month")))


def reports_requested(jobs: DataFrame, requests: DataFrame) -> DataFrame:
    """The window report of every (year, month) in ``requests``, from one scan of the jobs.

    The months that any window needs are broadcast (bounded by ``YEARS``), so on the
    (year, month) layout Spark prunes the partitions at run time: no folder outside
    them is opened.  Rows: (year, month, tag, cluster, six metrics, hours), all nine of
    a report (zeros where nothing ran); repeated requests count once, impossible months go.
    """
    spark = jobs.sparkSession
    members = requested_members(requests)
    # One key: with two, Spark would prune by years and by months apart and open their combinations.
    needed = members.select((F.col("year") * 100 + F.col("month")).alias("_needed")).distinct()
    grain = month_grain(jobs.join(F.broadcast(needed), jobs["year"] * 100 + jobs["month"] == needed["_needed"], "left_semi"))
    per_window = members.join(grain, ["year", "month"]).groupBy("report_year", "report_month", "tag", "cluster").agg(*resum_six())
    clusters = F.explode(F.array(*map(F.lit, S.CLUSTERS))).alias("cluster")
    spine = members.where(F.col("month") == F.col("report_month")).select("report_year", "report_month", "tag", clusters)
    dense = spine.join(per_window, ["report_year", "report_month", "tag", "cluster"], "left").fillna(0, subset=SIX_METRICS)
    return with_hours(dense.withColumnsRenamed({"report_year": "year", "report_month": "month"}))


def _year_month(year: Column, month: Column) -> Column:
    """One long for a (year, month) of ints, another one for every other pair."""
    return year.cast("bigint") * F.lit(1 << 32) + month.cast("bigint")


def refresh_month_grain(jobs: DataFrame, path: str, months: Sequence[tuple[int, int]]) -> None:
    """Compute the grain of the named (year, month) anew and add it to ``path`` as their newest version.

    Only those months of ``jobs`` are read.  Every cluster gets a row (zeros where
    nothing ran), so a month that lost its jobs is replaced, too.  Versions are only
    added: a job that fails leaves the last ones in force, and ``read_grain_versions``
    can go back.
    """
    spark = jobs.sparkSession
    named = local_rows(spark, [(int(y), int(m)) for y, m in months], "year int, month int")
    # One hashed list of literals, whatever the number of months: a condition per month would be planned and
    # tested month by month.  It names partition columns only, so other months' folders are not listed for the scan.
    grain = month_grain(jobs.where(_year_month(F.col("year"), F.col("month")).isin(sorted({(int(y) << 32) + int(m) for y, m in months}))))
    spine = named.select("year", "month", F.explode(F.array(*map(F.lit, S.CLUSTERS))).alias("cluster"))
    dense = spine.join(F.broadcast(grain), ["year", "month", "cluster"], "left").fillna(0, subset=SIX_METRICS)   # 3 rows a month
    dense.withColumn("version", F.lit(time.time_ns())).coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def read_grain_versions(spark, path: str, as_of: int | None = None) -> DataFrame:
    """The month grain in its newest version per month (not newer than ``as_of``)."""
    versions = spark.read.schema(GRAIN_SCHEMA).parquet(path)
    if as_of is not None:
        versions = versions.where(F.col("version") <= as_of)
    newest = F.max("version").over(Window.partitionBy("year", "month"))
    return versions.withColumn("_newest", newest).where("version = _newest").drop("version", "_newest")


def windows_from_grain(grain: DataFrame, year: int, month: int) -> DataFrame:
    """The 3 x 3 window report from a month-grain frame (e.g. a streamed table)."""
    spark = grain.sparkSession
    members = window_tags(spark, year, month)
    per_window = (grain.join(F.broadcast(members), ["year", "month"])
                  .groupBy("tag", "cluster").agg(*resum_six()))
    # per_window has at most 3 tags x 3 clusters rows: safe to broadcast.
    dense = report_spine(spark).join(F.broadcast(per_window), ["tag", "cluster"], "left") \
                               .fillna(0, subset=SIX_METRICS)
    return with_hours(dense)


def dense_month_grain(jobs: DataFrame) -> DataFrame:
    """(year, month, cluster) -> six metrics for every cluster and every month from the
    first to the last month with jobs (zeros where nothing ran).

    One aggregate keyed by (year, month) computes the six metrics for each
    cluster conditionally (18 partial sums before the shuffle); each month row
    is then split into its three cluster rows, zeros included.  A separate
    spine would need a second pass over the jobs, since Catalyst cannot share
    an aggregate whose columns are pruned differently in two branches.
    """
    aggs = []
    for c in S.CLUSTERS:
        in_c = F.col("cluster") == c
        aggs += [
            F.count_if(in_c & (F.col("outcome") == "COMPLETED")).alias(f"{c}__completed_jobs"),
            F.count_if(in_c & (F.col("outcome") == "FAILED")).alias(f"{c}__failed_jobs"),
            F.count_if(in_c & (F.col("agency") != "LOCAL")).alias(f"{c}__jobs_nonlocal"),
            F.coalesce(F.sum(F.when(in_c & (F.col("agency") != "LOCAL"), F.col("job_seconds"))),
                       F.lit(0).cast("bigint")).alias(f"{c}__seconds_nonlocal"),
            F.count_if(in_c & (F.col("agency") == "EHPC")).alias(f"{c}__jobs_ehpc"),
            F.coalesce(F.sum(F.when(in_c & (F.col("agency") == "EHPC"), F.col("job_seconds"))),
                       F.lit(0).cast("bigint")).alias(f"{c}__seconds_ehpc"),
        ]
    wide = jobs.groupBy("year", "month").agg(*aggs)
    # Months with no job at all, between the first and last month present, get
    # zero rows: each month row also emits the empty months up to the next
    # present one.  The ordering window sees one row per calendar month of
    # data (a few hundred rows per decade), never the jobs.
    first = F.make_date("year", "month", F.lit(1))
    nxt = F.lead(first).over(Window.orderBy(first))
    spans = wide.select("*", first.alias("_d"), nxt.alias("_next"))
    spans = spans.select("*", F.explode(F.sequence(
        "_d", F.coalesce(F.add_months("_next", -1), F.col("_d")), F.expr("interval 1 month"))).alias("_m"))
    real = F.col("_m") == F.col("_d")
    zero = F.lit(0).cast("bigint")
    per_cluster = [F.struct(F.lit(c).alias("cluster"),
                            *[F.when(real, F.col(f"{c}__{m}")).otherwise(zero).alias(m) for m in SIX_METRICS])
                   for c in S.CLUSTERS]
    return spans.select(F.year("_m").alias("year"), F.month("_m").alias("month"),
                        F.explode(F.array(*per_cluster)).alias("r")) \
                .select("year", "month", "r.*")


def report_all_months(jobs: DataFrame) -> DataFrame:
    """Month, quarter and YTD metrics for every month present in the data, long format.

    Rows: (year, month, tag, cluster, six metrics, hours); every cluster has a
    row in every month from the first to the last month of the data (zeros
    when it ran nothing), so quarter / YTD values are defined for it.  One scan, one aggregate, then range frames over the
    month number partitioned by (year, cluster).
    """
    dense = dense_month_grain(jobs)
    w = Window.partitionBy("year", "cluster").orderBy("month")
    quarter = w.rangeBetween(-2, 0)
    ytd = w.rangeBetween(Window.unboundedPreceding, 0)
    wide = dense.select(
        "year", "month", "cluster",
        *[F.col(m).alias(f"month__{m}") for m in SIX_METRICS],
        *[F.sum(m).over(quarter).cast("bigint").alias(f"quarter__{m}") for m in SIX_METRICS],
        *[F.sum(m).over(ytd).cast("bigint").alias(f"ytd__{m}") for m in SIX_METRICS],
    )
    per_tag = [
        F.struct(F.lit(tag).alias("tag"), *[F.col(f"{tag}__{m}").alias(m) for m in SIX_METRICS])
        for tag in S.TAGS
    ]
    long = wide.select("year", "month", "cluster", F.explode(F.array(*per_tag)).alias("r")) \
               .select("year", "month", "r.tag", "cluster", *[f"r.{m}" for m in SIX_METRICS])
    return with_hours(long)


def with_calendar(df: DataFrame, ytd_start: _dt.date | None = None) -> DataFrame:
    """Add start/end dates, label, day and hour counts to (year, month, tag) rows."""
    return (df.selectExpr("*", f"{C.window_start_sql(ytd_start)} AS start_date",
                          f"{C.WINDOW_END_SQL} AS end_date")
              .selectExpr("*", f"{C.PERIOD_LABEL_SQL} AS label", f"{C.WINDOW_DAYS_SQL} AS ndays")
              .selectExpr("*", "ndays * 24 AS hours"))


def period_calendar(jobs: DataFrame) -> DataFrame:
    """Calendar rows of the three windows for every (year, month) present in the jobs."""
    months = jobs.select("year", "month").distinct()
    tagged = months.select("year", "month",
                           F.explode(F.array(*[F.lit(t) for t in S.TAGS])).alias("tag"))
    return with_calendar(tagged)


def report_calendar(spark, year: int, month: int, ytd_start: _dt.date | None = None) -> DataFrame:
    """Calendar rows (3) of one report; ``ytd_start`` changes only YTD label and days."""
    rows = [(int(year), int(month), t) for t in S.TAGS]
    return with_calendar(local_rows(spark, rows, "year int, month int, tag string"), ytd_start)
