"""Refreshed months, reports for a table of requests, row faults, merged summaries, differing rows."""

import json
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

import test_sources as TS
from paths import SF01
from sacctlens import schema as S
from sacctlens.functions import enrich as E
from sacctlens.operators import compare as CMP
from sacctlens.operators import params as PRM
from sacctlens.operators import periods as P
from sacctlens.operators import usage as U
from sacctlens.plans.explain import final_plan_text, plan_text
from sacctlens.plans.queries import QUERIES
from sacctlens.sinks import writers as W
from sacctlens.sources import jobs as J

RAW = "Partition string, Account string, State string, AllocCPUS bigint, AllocTRES string, ElapsedRaw bigint, NNodes bigint, year int, month int"


def raw_jobs(spark, seed, months, n=60):
    rng = random.Random(seed)
    rows = [(rng.choice(["normal-arm", "dev-a100-40", "normal-x86", None]), rng.choice(["f1", "ee2", "lab", None]), rng.choice(["COMPLETED", "TIMEOUT", None]),
             rng.randint(1, 90), rng.choice([None, "gres/gpu=3"]), rng.randint(0, 9999), rng.randint(1, 9), y, m) for y, m in months for _ in range(n)]
    return spark.createDataFrame(rows, RAW)


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


# ------------------------------------------------------------------ refresh

def test_corrected_month_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "jobs")
    first, corrected = raw_jobs(spark, 1, [(2025, 1), (2025, 2)]), raw_jobs(spark, 2, [(2025, 2), (2025, 3)], n=7)
    J.write_jobs_parquet(first, path)
    J.write_jobs_parquet(first, path)                                   # twice: no doubles
    assert spark.read.parquet(path).count() == 120
    J.write_jobs_parquet(corrected, path)
    want = first.where("month = 1").unionByName(corrected)
    assert rows_of(J.read_jobs_parquet(spark, path)) == rows_of(E.enrich(want))


def test_refreshed_grain_equals_a_rebuild(spark, tmp_path):
    path, months = str(tmp_path / "grain"), [(2025, 1), (2025, 2), (2025, 3)]
    before = E.enrich(raw_jobs(spark, 1, months))
    P.refresh_month_grain(before, path, months)
    versions = spark.read.parquet(path)
    as_of = versions.agg(F.max("version")).first()[0]
    after = before.where("month = 1").unionByName(E.enrich(raw_jobs(spark, 5, [(2025, 2)], n=11)))       # March lost all its jobs
    P.refresh_month_grain(after, path, [(2025, 2), (2025, 3)])
    for m in (1, 2, 3):
        assert rows_of(P.windows_from_grain(P.read_grain_versions(spark, path), 2025, m)) == rows_of(P.report_windows(after, 2025, m))
        assert rows_of(P.windows_from_grain(P.read_grain_versions(spark, path, as_of), 2025, m)) == rows_of(P.report_windows(before, 2025, m))


def test_refresh_reads_only_the_named_months(spark, tmp_path):
    path = str(tmp_path / "jobs")
    J.write_jobs_parquet(raw_jobs(spark, 3, [(2024, m) for m in range(1, 13)], n=3), path)
    for m in range(1, 12):
        _spoil(path, 2024, m)
    P.refresh_month_grain(J.read_jobs_parquet(spark, path), str(tmp_path / "grain"), [(2024, 12)])
    assert P.read_grain_versions(spark, str(tmp_path / "grain")).agg(F.sum(F.col("completed_jobs") + F.col("failed_jobs"))).first()[0] == 3


def test_refresh_of_many_months_is_one_condition(spark, tmp_path, monkeypatch):
    seen, grain = [], P.month_grain
    monkeypatch.setattr(P, "month_grain", lambda jobs: seen.append(plan_text(jobs)) or grain(jobs))
    months = [(y, m) for y in range(2000, 2010) for m in range(1, 13)]
    jobs = E.enrich(raw_jobs(spark, 6, [*months, (2024, 113), (2025, 13), (-1, 1), (None, 1)], n=1))
    P.refresh_month_grain(jobs, str(tmp_path / "grain"), [*months, (2025, 13)])
    assert seen[0].count(" OR ") < 20 and "INSET" in seen[0].upper()
    got = P.read_grain_versions(spark, str(tmp_path / "grain")).where(F.col("completed_jobs") + F.col("failed_jobs") > 0)
    assert sorted(map(tuple, got.select("year", "month").collect())) == sorted([*months, (2025, 13)])


def _spoil(path, year, month):
    """Whoever opens this month's files fails."""
    folder = f"{path}/year={year}/month={month}"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "wb") as f:
                f.write(b"not parquet")


# ------------------------------------------------------------------ requests

def test_requested_reports_equal_single_ones(spark):
    jobs = E.enrich(raw_jobs(spark, 7, [(2024, 11), (2024, 12), (2025, 1), (2025, 3)]))
    wanted = [(2025, 1), (2025, 3), (2024, 12), (2025, 3), (2025, 2), (2031, 5)]
    requests = spark.createDataFrame([*wanted, (2025, 13), (2025, 0), (None, 3), (2025, None), (9999, 1)], "year int, month int")
    got = P.reports_requested(jobs, requests)
    want = []
    for y, m in set(wanted):
        want += [(y, m, *r) for r in P.report_windows(jobs, y, m).select("tag", "cluster", *U.SIX_METRICS, "hours_nonlocal", "hours_ehpc").collect()]
    assert sorted(map(tuple, got.select("year", "month", "tag", "cluster", *U.SIX_METRICS, "hours_nonlocal", "hours_ehpc").collect())) == sorted(want)
    assert P.reports_requested(jobs, requests.limit(0)).count() == 0


def test_requests_prune_partitions_at_run_time(spark, tmp_path):
    path, asked = str(tmp_path / "jobs"), str(tmp_path / "requests")
    J.write_jobs_parquet(raw_jobs(spark, 3, [(y, m) for y in (2023, 2024) for m in range(1, 13)], n=5), path)
    spark.createDataFrame([(2024, 2), (2023, 1)], "year int, month int").write.parquet(asked)
    needed = {(2024, 1), (2024, 2), (2023, 1)}
    for y in (2023, 2024):
        for m in range(1, 13):
            if (y, m) not in needed:
                _spoil(path, y, m)
    report = P.reports_requested(J.read_jobs_parquet(spark, path), spark.read.parquet(asked))
    assert "dynamicpruning" in plan_text(report).lower()
    assert sum(r.completed_jobs + r.failed_jobs for r in report.where("tag = 'ytd'").collect()) == 15
    final = final_plan_text(report)
    assert "BroadcastNestedLoopJoin" not in final and "CartesianProduct" not in final


# ------------------------------------------------------------------ grouping sets

def test_output_diff_reads_the_jobs_once_per_side(spark):
    plan = plan_text(QUERIES["output_diff"](spark, SF01))
    for table in ("lineitem", "orders"):
        assert plan.count(f"/{table}.parquet") == 2, plan
    assert "Expand" in plan


def test_grouping_sets_equal_the_separate_aggregates(spark):
    jobs = E.enrich(raw_jobs(spark, 4, [(2025, 1)], n=300))
    both = U.grouped_both_ways(jobs)
    assert rows_of(both.where("by_outcome").select("cluster", "outcome", F.col("jobs").alias("n_jobs"))) == rows_of(U.outcome_by_cluster(jobs))
    assert rows_of(both.where("not by_outcome").select("agency", "cluster", "jobs", "seconds")) == rows_of(U.usage_by_agency_cluster(jobs))
    long = {(r.cluster, r.metric): r.value for r in U.separate_aggregates_long(jobs).collect()}
    single = {(r.cluster, r.metric): r.value for r in U.single_pass_long(jobs).collect()}
    assert {k: v for k, v in single.items() if v} == {k: v for k, v in long.items() if v}
    assert U.separate_aggregates_long(jobs.limit(0)).count() == 0


# ------------------------------------------------------------------ faults

FAULTY = ("JobID|Partition|Account|State|AllocCPUS|AllocTRES|ElapsedRaw|NNodes\n"
          "1|normal-arm|f1|COMPLETED|48|cpu=48|3600|1\n"
          "2|normal-arm|f1|COMPLETED|48|cpu=48|3600\n"
          "3|normal-arm|f1|COMPLETED|48|cpu=48|3600|1|extra|cells\n"
          "4|normal-arm|f1|COMPLETED|many|cpu=48|3600|1\n"
          "5|normal-arm|f1|COMPLETED||cpu=48|12h|\n"
          "6|normal-arm|f1|TIMEOUT|48||10|2\n")


def test_rows_that_do_not_fit_are_counted_per_file(spark, tmp_path):
    (tmp_path / "jobs_Jan.txt").write_text(FAULTY)
    (tmp_path / "jobs_Feb.txt").write_text(TS.FEB)
    checked = J.read_jobs_checked(spark, str(tmp_path), 2025)
    rows, counts = J.count_faults(checked)
    plain = J.read_jobs(spark, str(tmp_path), 2025)
    assert rows.columns == plain.columns and rows_of(rows) == rows_of(plain)
    rows.write.format("noop").mode("overwrite").save()
    assert counts() == {"Jan": {"rows": 6, "short": 1, "long": 1, "unparsable": 2}, "Feb": {"rows": 1, "short": 0, "long": 0, "unparsable": 0}}
    bad = {r.fault + str(k): r for k, r in enumerate(J.quarantined(checked).orderBy("fault", "raw_line").collect())}
    assert [k[:-1] for k in bad] == ["long", "short", "unparsable", "unparsable"]
    assert bad["short1"].raw_line.startswith("2|") and bad["long0"].raw_line.endswith("extra|cells") and bad["short1"].source_file == "jobs_Jan.txt"
    assert {r.cells.AllocCPUS for r in bad.values() if r.fault == "unparsable"} == {"many", None}


def test_faults_are_counted_in_the_reports_own_pass(spark, tmp_path):
    (tmp_path / "jobs_Jan.txt").write_text(FAULTY)
    rows, counts = J.count_faults(J.read_jobs_checked(spark, str(tmp_path), 2025))
    assert plan_text(P.report_windows(E.enrich(rows), 2025, 1)).count("FileScan csv") == 1
    got = rows_of(P.report_windows(E.enrich(rows), 2025, 1))
    assert counts()["Jan"]["unparsable"] == 2
    assert got == rows_of(P.report_windows(J.read_enriched_jobs(spark, str(tmp_path), 2025), 2025, 1))


# ------------------------------------------------------------------ summaries

def test_merged_summaries_equal_the_summary_of_all_runs(spark):
    rng = random.Random(3)
    runs = [(f"c{c}", part, 1e6 * c + rng.random(), float(rng.randint(0, 9))) for c in range(4) for part in range(c + 1) for _ in range(rng.randint(1, 6))]
    frame = spark.createDataFrame(runs, "config string, part int, wall_time_s double, stages double")
    metrics = ("wall_time_s", "stages")
    parts = CMP.config_summary(frame.withColumn("config", F.concat_ws("/", "config", "part")), metrics, None)
    published = parts.withColumn("config", F.substring_index("config", "/", 1))
    nothing = spark.createDataFrame([("c0", 0, None, None, None, None), ("c9", 0, 1.0, 1.0, 1.0, 1.0)], published.schema)
    got = {r.config: r for r in CMP.merge_summaries(published.unionByName(nothing), metrics, None).collect()}
    assert set(got) == {"c0", "c1", "c2", "c3"}
    for c, r in got.items():
        for k, m in ((2, "wall_time_s"), (3, "stages")):
            values = [x[k] for x in runs if x[0] == c]
            assert r.n_runs == len(values) and r[f"mean_{m}"] == pytest.approx(statistics.fmean(values), rel=1e-12)
            if len(values) > 1:
                assert r[f"std_{m}"] == pytest.approx(statistics.stdev(values), rel=1e-6, abs=1e-9)
            else:
                assert r[f"std_{m}"] is None


def test_merged_documents_from_files(spark, tmp_path):
    from sacctlens.sources import summaries as SU
    metrics = dict.fromkeys(S.RUN_METRIC_COLUMNS, 1.0)
    for name, n, mean, std in (("a1", 2, 10.0, 2.0), ("a2", 1, 13.0, float("nan"))):
        doc = {"runs": [], "summary": {"config": "a", "n_runs": n, "mean": {**metrics, "wall_time_s": mean}, "std": {**dict.fromkeys(metrics, 0.0), "wall_time_s": std}}}
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    r = CMP.merge_summaries(SU.summary_table(SU.read_summary_documents(spark, str(tmp_path)))).first()
    values = [10 - 2 ** 0.5, 10 + 2 ** 0.5, 13.0]                       # two runs with mean 10 and deviation 2, and one of 13
    assert (r.n_runs, r.mean_wall_time_s, r.std_wall_time_s) == (3, 11.0, round(statistics.stdev(values), 6))
    assert r.std_stages == 0.0


# ------------------------------------------------------------------ differences

def test_differing_rows_are_named(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]), rng.choice([None, 0.5])) for _ in range(4000)]
    schema = "x string, y int, z double"
    left = spark.createDataFrame(rows, schema).repartition(7)
    same = spark.createDataFrame(rng.sample(rows, len(rows)), schema)
    assert CMP.differing_buckets(left, same).count() == 0 and CMP.row_differences(left, same).count() == 0
    other = spark.createDataFrame([*rows[2:], ("new", 1, None), ("new", 1, None), (None, 7, None)], schema)
    want = CMP.row_differences(left, other, buckets=5)
    gone = {}
    for r in rows[:2]:
        gone[r] = gone.get(r, 0) + 1
    assert {tuple(r)[:3]: r.surplus for r in want.collect()} == {**gone, ("new", 1, None): -2, (None, 7, None): -1}
    assert CMP.row_differences(left.limit(0), other.limit(0)).count() == 0


def test_nulls_in_different_columns_are_different_rows(spark):
    a = spark.createDataFrame([(None, 1), (2, None)], "x int, y int")
    b = spark.createDataFrame([(1, None), (None, 2)], "x int, y int")
    assert CMP.row_differences(a, b).count() == 4


def test_equal_frames_move_checksums_alone(spark):
    plan = plan_text(CMP.row_differences(*(spark.range(1000).selectExpr("id", "id % 7 AS k"),) * 2))
    rows = [line for line in plan.splitlines() if "Exchange" in line and "hashpartitioning(id" in line]
    assert len(rows) == 1 and "LeftSemi" in plan                       # the rows' only shuffle comes after the semi-join


def test_a_changed_line_of_a_golden_file_is_named(spark, tmp_path):
    jobs = E.enrich(raw_jobs(spark, 1, [(2025, 1)]))
    W.write_params_tex(PRM.report_tex_lines(jobs, 2025, 1), str(tmp_path / "out"))
    part = next(f for f in os.listdir(tmp_path / "out") if f.startswith("part-"))
    body = (tmp_path / "out" / part).read_bytes()
    golden = tmp_path / "golden.tex"
    golden.write_bytes(body)
    assert CMP.golden_diff(spark, str(tmp_path / "out"), str(golden)).count() == 0
    lines = body.split(b"\n")
    lines[4] = b"\\def\\reportYear{2024 \xe9}"
    golden.write_bytes(b"\n".join(lines))
    got = CMP.golden_diff(spark, str(tmp_path / "out"), str(golden)).collect()
    assert len(got) == 1 and got[0].line_no == 5 and got[0].produced == body.split(b"\n")[4].decode() and "2024" in got[0].golden
    golden.write_bytes(body[:-1])                                      # the last line end alone
    assert [(r.line_no, r.produced, r.golden) for r in CMP.golden_diff(spark, str(tmp_path / "out"), str(golden)).collect()] == [(71, "", None)]
