"""Configuration comparison and output equality.

* ``benchmark_runs``   — the n most recent runs per configuration with all metrics
  (``log_benchmark_runs`` / ``log_run_metrics`` do the same from event-log folders);
* ``config_summary``   — mean and sample standard deviation per configuration
  (``summary_document``: the same plus the runs, in one aggregate);
* ``speedup_vs_baseline`` — baseline mean wall time / configuration mean wall time;
* ``config_summary_display`` — the ordered, formatted comparison table;
* ``multiset_diff``    — rows only in one of two frames, as one count row;
* ``row_differences``  — those rows, found through checksums of hash buckets;
* ``golden_diff``      — the lines in which a report file differs from a golden one;
* ``merge_summaries``  — published summaries of a configuration put together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sacctlens import schema as S
from sacctlens.functions.render import fixed_text
from sacctlens.operators import runs as R

ROUND_DIGITS = 6


def benchmark_runs(events: DataFrame, samples: DataFrame, n: int = 3) -> DataFrame:
    """(config, run_no, run, metrics..., peak_memory_mb) for the n most recent runs.

    One pass: the per-run aggregate feeds the recency pick, whose rows carry
    everything the metrics need (no join back, so the events are read once).
    Samples are cut to the picked runs (at most ``n`` per configuration) by a
    semi-join before they are aggregated.
    """
    metrics = recent_metrics(events, n)
    peaks = R.sample_peaks(samples.join(metrics.select("run"), "run", "left_semi"))
    return (metrics.join(peaks, "run", "left")
            .select("config", "run_no", "run", *[c for c in S.RUN_METRIC_COLUMNS if c != "peak_memory_mb"],
                    F.coalesce("peak_memory_mb", F.lit(0.0)).alias("peak_memory_mb")))


def recent_metrics(events: DataFrame, n: int = 3) -> DataFrame:
    """(config, run_no, run, metrics without peak memory) of the n most recent runs per configuration."""
    return R.metrics_from_aggregates(R.pick_recent(R.run_aggregates(events), n=n), ("config", "run_no", "run"))


def log_run_aggregates(spark, logs_dir: str, config: str) -> DataFrame:
    """Run aggregates of every log in ``logs_dir``; unreadable logs get all-zero figures.

    One pass and one aggregate: every file closes with a status row, so a log of which
    a part cannot be decoded or opened still counts as a run, with zero metrics
    throughout and ``readable`` false, ordered by its file time.  A log that is still
    written counts with what it holds so far (``still_open``).
    """
    from sacctlens.sources import eventlogs as EL

    return scanned_run_aggregates(EL.scan_event_logs(spark, logs_dir), config)


def scanned_run_aggregates(scanned: DataFrame, config: str, streamed: bool = False) -> DataFrame:
    """Run aggregates and state of every log from scanned event rows (``streamed``: of a stream)."""
    from sacctlens.sources import eventlogs as EL

    keys = ["config", "log_id"]
    events = EL.log_run_events(scanned, config)
    agg = R.run_aggregates(events, keys, [F.max("file_mtime_ms").alias("file_mtime_ms"), *EL.status_aggs(streamed)])
    zero = F.lit(0).cast("bigint")
    return agg.select(
        *keys, "file_mtime_ms", "readable", "still_open", "bad_lines",
        *[F.when(F.col("readable"), F.col(c)).otherwise(zero).alias(c)
          for c in ("app_start_ms", "app_end_ms", "stages", "tasks", "read_bytes", "write_bytes")],
        *[F.when(F.col("readable"), F.col(c)).alias(c) for c in ("first_launch_ms", "last_finish_ms")])


def log_run_metrics(spark, logs_dir: str, config: str) -> DataFrame:
    """Metrics of every log of one configuration (zeros for unreadable ones)."""
    return R.metrics_from_aggregates(log_run_aggregates(spark, logs_dir, config), ("config", "log_id", "readable"))


def log_benchmark_runs(spark, logs_dir: str, dstat_dir: str | None, config: str, n: int = 3) -> DataFrame:
    """Benchmark runs of one configuration straight from its event-log directory.

    The n most recent logs (by application start, file time as fallback) are
    numbered 1..n oldest-first; run k takes its peak memory from
    ``dstat_run_<k>.csv`` (0.0 when absent).
    """
    from sacctlens.sources import samples as SM

    picked = R.pick_recent(log_run_aggregates(spark, logs_dir, config), n=n, run="log_id",
                           fallback="file_mtime_ms")
    about = ("log_id", "readable", "still_open", "bad_lines")
    runs = R.metrics_from_aggregates(picked, ("config", "run_no", *about))
    base_cols = [c for c in S.RUN_METRIC_COLUMNS if c != "peak_memory_mb"]
    if dstat_dir is None:
        return runs.select("config", "run_no", F.col("run_no").cast("bigint").alias("run"), *about,
                           *base_cols, F.lit(0.0).alias("peak_memory_mb"))
    peaks = R.sample_peaks(SM.read_resource_samples(spark, dstat_dir), key="run_no")
    return (runs.join(peaks, "run_no", "left")
            .select("config", "run_no", F.col("run_no").cast("bigint").alias("run"), *about, *base_cols,
                    F.coalesce("peak_memory_mb", F.lit(0.0)).alias("peak_memory_mb")))


def _rounded(c, digits: int | None):
    return c if digits is None else F.round(c, digits)


def _summary_aggs(metrics: Sequence[str], digits: int | None) -> list:
    aggs = [F.count(F.lit(1)).alias("n_runs")]
    for m in metrics:
        aggs.append(_rounded(F.avg(m), digits).alias(f"mean_{m}"))
        aggs.append(_rounded(F.stddev_samp(m), digits).alias(f"std_{m}"))
    return aggs


def config_summary(runs: DataFrame, metrics: Sequence[str] = tuple(S.RUN_METRIC_COLUMNS),
                   digits: int | None = ROUND_DIGITS) -> DataFrame:
    """n_runs, mean_<m>, std_<m> (sample, n-1; null when n = 1) per configuration; ``digits`` None: not rounded."""
    return runs.groupBy("config").agg(*_summary_aggs(metrics, digits))


def merge_summaries(summaries: DataFrame, metrics: Sequence[str] = tuple(S.RUN_METRIC_COLUMNS),
                    digits: int | None = ROUND_DIGITS) -> DataFrame:
    """Several summaries of a configuration (n, mean, sample deviation) as one: that of all their runs.

    Parallel variance: with N = sum n and the common mean m, the squared deviations are
    sum (n - 1) std^2 + sum n (mean - m)^2, the second part being taken around the common
    mean itself, so large means cost no digits.  Summaries without runs, and absent or
    NaN deviations of single runs, count as nothing; the runs behind two summaries of one
    configuration must be different ones.  One shuffle by configuration.
    """
    of = Window.partitionBy("config")
    n = F.col("n_runs").cast("double")
    some = summaries.where(F.col("n_runs") > 0)
    some = some.select("config", "n_runs", *[c for m in metrics for c in (
        F.col(f"mean_{m}"), F.coalesce(F.nanvl(F.col(f"std_{m}").cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"std_{m}"))])
    common = some.select("*", *[(F.sum(n * F.col(f"mean_{m}")).over(of) / F.sum(n).over(of)).alias(f"_common_{m}") for m in metrics])
    total = F.sum("n_runs")
    aggs = [total.cast("bigint").alias("n_runs")]
    for m in metrics:
        apart = F.col(f"mean_{m}") - F.col(f"_common_{m}")
        squares = F.sum((n - 1) * F.col(f"std_{m}") * F.col(f"std_{m}") + n * apart * apart)
        aggs += [_rounded(F.first(f"_common_{m}"), digits).alias(f"mean_{m}"),
                 _rounded(F.when(total > 1, F.sqrt(squares / (total - 1))), digits).alias(f"std_{m}")]
    return common.groupBy("config").agg(*aggs)


def summary_document(runs: DataFrame, metrics: Sequence[str] = tuple(S.RUN_METRIC_COLUMNS),
                     digits: int = ROUND_DIGITS) -> DataFrame:
    """One row per configuration: runs (array of structs, at most n each) + summary.

    Runs and summary come from the same single aggregate, so the runs are
    computed once.
    """
    run_struct = F.struct("run_no", "run", *metrics)
    agg = runs.groupBy("config").agg(F.sort_array(F.collect_list(run_struct)).alias("runs"),
                                     *_summary_aggs(metrics, digits))
    return agg.select(
        "config", "runs",
        F.struct(F.col("config"), F.col("n_runs"),
                 F.struct(*[F.col(f"mean_{m}").alias(m) for m in metrics]).alias("mean"),
                 F.struct(*[F.col(f"std_{m}").alias(m) for m in metrics]).alias("std")).alias("summary"))


def speedup_vs_baseline(summary: DataFrame, baseline: str = "baseline",
                        digits: int = ROUND_DIGITS) -> DataFrame:
    """config, mean wall time and speedup relative to the baseline configuration.

    The baseline mean comes from a window over ``summary``, which has one row
    per configuration, so ``summary`` is computed once.
    """
    base = F.max(F.when(F.col("config") == baseline, F.col("mean_wall_time_s"))).over(Window.partitionBy())
    return summary.select(
        "config",
        F.col("mean_wall_time_s").alias("mean_wall"),
        F.round(base / F.col("mean_wall_time_s"), digits).alias("speedup"),
    )


def config_ordinal(order: Sequence[str] = tuple(S.CONFIG_ORDER)):
    """Position of the configuration in ``order`` (0-based); unknown names last."""
    pos = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("config"))
    return F.when(pos > 0, (pos - 1).cast("int")).otherwise(F.lit(len(order)))


def _shown(column: str):
    """A figure for display: absent and NaN (a deviation of one run) show as 0."""
    return F.coalesce(F.nanvl(F.col(column).cast("double"), F.lit(0.0)), F.lit(0.0))


def _pm(mean: str, std: str):
    return F.concat(fixed_text(_shown(mean), 2), F.lit(" ± "), fixed_text(_shown(std), 2))


def config_summary_display(summary: DataFrame, order: Sequence[str] = tuple(S.CONFIG_ORDER)) -> DataFrame:
    """The comparison table: formatted mean ± std per metric, in display order."""
    cells = [F.col("config"), _pm("mean_wall_time_s", "std_wall_time_s"),
             fixed_text(_shown("mean_stages"), 1), fixed_text(_shown("mean_tasks"), 1),
             *[_pm(f"mean_{m}", f"std_{m}") for m in ("shuffle_read_mb", "shuffle_write_mb", "peak_memory_mb", "driver_time_s")]]
    return summary.select(config_ordinal(order).alias("ordinal"),
                          *[c.alias(name) for c, name in zip(cells, S.DISPLAY_COLUMNS, strict=True)])


def multiset_diff(left: DataFrame, right: DataFrame, drop_zero: str | None = None) -> DataFrame:
    """Rows present more often in ``left`` / ``right`` (EXCEPT ALL both ways), as one row.

    Computed with a single shuffle: tag each side +1 / -1, sum per distinct
    row, then count the surplus of each side.  The global aggregate always
    yields exactly one row, also for two empty inputs.
    ``drop_zero`` names a value column whose zero rows are ignored on both
    sides (an absent group and a zero-valued group mean the same).
    """
    cols = left.columns
    if drop_zero:
        left = left.where(F.col(drop_zero) != 0)
        right = right.where(F.col(drop_zero) != 0)
    tagged = left.select(*cols, F.lit(1).alias("_side")).unionByName(
        right.select(*cols, F.lit(-1).alias("_side")))
    per_row = tagged.groupBy(*cols).agg(F.sum("_side").alias("_d"))
    out = per_row.agg(
        F.coalesce(F.sum(F.when(F.col("_d") > 0, F.col("_d"))), F.lit(0)).cast("bigint").alias("left_only"),
        F.coalesce(F.sum(F.when(F.col("_d") < 0, -F.col("_d"))), F.lit(0)).cast("bigint").alias("right_only"),
    )
    return out.withColumn("identical", (F.col("left_only") == 0) & (F.col("right_only") == 0))


#: Buckets of ``bucket_checksums``; the differing ones are broadcast (8 bytes each).
BUCKETS = 1 << 14


def _row_hash(columns: Sequence[str], seed: int):
    # A null leaves xxhash64 as it is, so whether a value is null is hashed as well.
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def bucket_checksums(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n, total, mixed: rows by hash, with sums over a bucket that do not depend on the rows' order.

    Two 64-bit hashes of each row are summed (as decimals) and xor-ed; the partial
    aggregate leaves at most ``buckets`` rows per task to shuffle.
    """
    return (df.select(F.pmod(_row_hash(df.columns, 1), F.lit(buckets)).alias("bucket"), _row_hash(df.columns, 2).alias("h"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("total"), F.bit_xor("h").alias("mixed")))


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Buckets whose checksums differ (at most ``buckets`` rows); none where the frames hold the same rows."""
    a, b = bucket_checksums(left, buckets), bucket_checksums(right.select(*left.columns), buckets)
    a, b = (x.select("bucket", F.struct("n", "total", "mixed").alias(name)) for x, name in ((a, "a"), (b, "b")))
    return a.join(b, "bucket", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket")


def row_differences(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows that occur more often on one side, with ``surplus`` (left minus right, never 0).

    Only rows of differing buckets are shuffled: equal frames move checksums alone.
    """
    columns = left.columns
    where = F.broadcast(differing_buckets(left, right, buckets))

    def inside(df: DataFrame, sign: int) -> DataFrame:
        named = df.select(*columns, F.pmod(_row_hash(columns, 1), F.lit(buckets)).alias("_bucket"), F.lit(sign).alias("_sign"))
        return named.join(where, F.col("_bucket") == F.col("bucket"), "left_semi").drop("_bucket")

    return (inside(left, 1).unionByName(inside(right.select(*columns), -1)).groupBy(*columns)
            .agg(F.sum("_sign").cast("bigint").alias("surplus")).where("surplus <> 0"))


def golden_diff(spark, produced: str, golden: str) -> DataFrame:
    """line_no, produced, golden: the lines in which an output file (or folder of one part) differs from a golden file.

    Lines are compared by place and byte by byte; a missing last line end shows as the
    line after it (empty where the file ends with a line end, null where it does not).
    Report files are small: each is one row.  No rows: the files are the same bytes.
    """
    def lines(path: str, name: str) -> DataFrame:
        body = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path).select("path", "content")
        whole = body.select(F.posexplode(F.split(F.decode("content", "ISO-8859-1"), "\n", -1)).alias("k", "line"))
        return whole.select((F.col("k") + 1).alias("line_no"), F.encode("line", "ISO-8859-1").cast("string").alias(name))

    return (lines(produced, "produced").join(lines(golden, "golden"), "line_no", "full_outer")
            .where(~F.col("produced").eqNullSafe(F.col("golden"))).select("line_no", "produced", "golden"))
