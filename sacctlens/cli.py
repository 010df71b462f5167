"""Command-line front end: ``python -m sacctlens <command> ...``.

* ``report``  — accounting files (or the Parquet layout) -> macro file for one month;
* ``runs``    — one configuration's event logs (+ resource samples) -> summary document;
* ``compare`` — summary documents -> comparison table as CSV and LaTeX.

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings (master, sizing, ``spark.checkpoint.dir``) are whatever spark-submit
provides.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sacctlens import schema as S
from sacctlens.functions import calendar as C
from sacctlens.functions import enrich as E
from sacctlens.operators import compare as CMP
from sacctlens.operators import params as PRM
from sacctlens.operators import periods as P
from sacctlens.session import checkpoint_dir
from sacctlens.sinks import writers as W
from sacctlens.sources import jobs as J
from sacctlens.sources import summaries as SU


def _month(text: str) -> int:
    if text in C.MONTH_ABBR:
        return C.MONTH_ABBR.index(text) + 1
    m = int(text)
    if not 1 <= m <= 12:
        raise argparse.ArgumentTypeError(f"month must be Jan..Dec or 1..12, got {text}")
    return m


def previous_month(today: _dt.date) -> tuple[int, int]:
    """(year, month) of the month before ``today``; January rolls back to December."""
    return (today.year - 1, 12) if today.month == 1 else (today.year, today.month - 1)


def _warn(text: str) -> None:
    print(f"warning: {text}", file=sys.stderr)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sacctlens")
    sub = p.add_subparsers(dest="command", required=True)

    r = sub.add_parser("report", help="usage report for one month -> macro file")
    r.add_argument("--datadir", required=True, help="folder of jobs_<Mon>.txt files, or the Parquet layout")
    r.add_argument("--year", type=int, help="default: the year of the previous month")
    r.add_argument("--month", type=_month, help="Jan..Dec or 1..12; default: the previous month")
    r.add_argument("--months", help="several months, e.g. Jan,Feb,Mar: one scan, one folder per month")
    r.add_argument("--ytd-start", type=_dt.date.fromisoformat, default=None,
                   help="label/day-count start of the year window (rows stay Jan..month)")
    r.add_argument("--parquet", action="store_true", help="datadir is the (year, month) Parquet layout")
    r.add_argument("--out", required=True, help="output folder of the macro file")

    u = sub.add_parser("runs", help="event logs of one configuration -> summary document")
    u.add_argument("--logs-dir", required=True)
    u.add_argument("--dstat-dir", default=None)
    u.add_argument("--config-name", required=True)
    u.add_argument("--runs", type=int, default=3)
    u.add_argument("--out", required=True)

    c = sub.add_parser("compare", help="summary documents -> CSV and LaTeX tables")
    c.add_argument("--summaries", required=True, help="path or glob of summary documents")
    c.add_argument("--out", required=True)
    c.add_argument("--baseline", default="baseline")
    c.add_argument("--order", default=",".join(S.CONFIG_ORDER))
    return p


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"sacctlens-{args.command}").getOrCreate()
    checkpoint_dir(spark)
    if args.command == "report":
        default_year, default_month = previous_month(_dt.date.today())
        if args.months:
            months = [_month(m) for m in args.months.split(",")]
        else:
            months = [args.month if args.month is not None else default_month]
        if args.year is None:
            args.year = default_year if (args.month is None and not args.months) else _dt.date.today().year
        if args.parquet:
            jobs = J.read_jobs_parquet(spark, args.datadir)
        else:
            rows, faults = J.count_faults(J.read_jobs_checked(spark, args.datadir, args.year, J.months_for_report(max(months))))
            jobs = E.enrich(rows)
        if len(months) == 1:
            W.write_params_tex(PRM.report_tex_lines(jobs, args.year, months[0], args.ytd_start), args.out)
        else:
            # One scan: the month grain is written once, every report reads it.
            grain = P.save_month_grain(jobs.where((F.col("year") == args.year) & (F.col("month") <= max(months))),
                                       f"{args.out}/_month_grain")
            for m in months:
                windows = P.windows_from_grain(grain, args.year, m)
                W.write_params_tex(PRM.report_tex_lines(None, args.year, m, args.ytd_start, windows),
                                   f"{args.out}/{C.MONTH_ABBR[m - 1]}")
        if not args.parquet:
            for month, n in faults().items():
                if any(n[f] for f in J.FAULTS):
                    _warn(f"jobs_{month}: {n['short']} rows with too few cells, {n['long']} with too many, {n['unparsable']} with numbers that do not parse")
    elif args.command == "runs":
        runs = CMP.log_benchmark_runs(spark, args.logs_dir, args.dstat_dir, args.config_name, n=args.runs)
        picked = runs.orderBy("run_no").collect()                                   # at most --runs rows: the logs are read once
        if not picked:
            raise SystemExit(f"error: no event log in {args.logs_dir}")
        if len(picked) < args.runs:
            _warn(f"{len(picked)} of {args.runs} runs found in {args.logs_dir}")
        for r in picked:
            if not r.readable:
                _warn(f"{r.log_id} cannot be decoded; its metrics are 0")
            elif r.still_open:
                _warn(f"{r.log_id} is still being written; its metrics are those so far")
            if r.bad_lines:
                _warn(f"{r.log_id}: {r.bad_lines} malformed lines skipped")
        runs = spark.createDataFrame(picked, runs.schema)
        W.write_summary_documents(CMP.summary_document(runs), args.out)
    else:
        docs = SU.read_summary_documents(spark, args.summaries).cache()
        for r in SU.unreadable_summaries(docs).orderBy("source_file").collect():
            _warn(f"{r.source_file} is no summary document; skipped")
        summary = SU.summary_table(docs)
        display = CMP.config_summary_display(summary, args.order.split(","))
        W.write_summary_csv(display, f"{args.out}/csv")
        W.write_summary_latex(display, f"{args.out}/tex")
        W.write_lines(CMP.speedup_vs_baseline(summary, args.baseline)
                      .select(CMP.config_ordinal(args.order.split(",")).alias("ordinal"), F.col("config").alias("name"),
                              F.concat_ws(",", "config", F.col("mean_wall").cast("string"), F.col("speedup").cast("string")).alias("line")),
                      f"{args.out}/speedup", order=("ordinal", "name"))
        docs.unpersist()


if __name__ == "__main__":
    main()
