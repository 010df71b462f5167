"""Equivalences and invariants of the usage report on the test tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paths import SF01
from sacctlens import schema as S
from sacctlens.functions import calendar as C
from sacctlens.operators import compare as CMP
from sacctlens.operators import params as PRM
from sacctlens.operators import periods as P
from sacctlens.operators import usage as U
from sacctlens.sources import testtables as TT

METRICS = U.SIX_METRICS


@pytest.fixture(scope="module")
def jobs(spark):
    df = TT.jobs(spark, SF01).cache()
    yield df
    df.unpersist()        # the frame is shared by later queries of the session


@pytest.fixture(scope="module")
def all_months(jobs):
    return {(r.year, r.month, r.tag, r.cluster): r for r in P.report_all_months(jobs).collect()}


def _loop_per_window(jobs, year, month):
    """The multi-query way: one filter + aggregate per window tag."""
    out = {}
    for tag, months in C.window_months(month).items():
        rows = (jobs.where((F.col("year") == year) & F.col("month").isin(months))
                .groupBy("cluster").agg(*U.six_metric_aggs()).collect())
        for r in rows:
            out[(tag, r.cluster)] = tuple(r[m] for m in METRICS)
    return out


@pytest.mark.parametrize("year,month", [(1998, 5), (1996, 1), (1997, 2), (2001, 11), (1999, 12)])
def test_window_join_equals_loop_and_range_frames(jobs, all_months, year, month):
    report = {(r.tag, r.cluster): tuple(r[m] for m in METRICS)
              for r in P.report_windows(jobs, year, month).collect()}
    assert len(report) == 9
    loop = _loop_per_window(jobs, year, month)
    for key, vals in report.items():
        assert loop.get(key, (0,) * 6) == vals
        ranged = all_months[(year, month) + key]
        assert tuple(ranged[m] for m in METRICS) == vals


def test_invariants(all_months):
    for (y, m, tag, c), r in all_months.items():
        assert r.jobs_ehpc <= r.jobs_nonlocal <= r.completed_jobs + r.failed_jobs
        assert r.seconds_ehpc <= r.seconds_nonlocal
        if tag == "month":
            q = all_months[(y, m, "quarter", c)]
            ytd = all_months[(y, m, "ytd", c)]
            for k in METRICS:
                assert r[k] <= q[k] <= ytd[k]
            if m <= 3:
                assert tuple(q[k] for k in METRICS) == tuple(ytd[k] for k in METRICS)
            if m == 1:
                assert tuple(r[k] for k in METRICS) == tuple(q[k] for k in METRICS)


def test_january_clips_quarter(all_months):
    # Quarter of January must not reach into the previous December.
    jan = all_months[(1998, 1, "quarter", "ARM")]
    month = all_months[(1998, 1, "month", "ARM")]
    assert jan.jobs_nonlocal == month.jobs_nonlocal


def test_separate_aggregates_equal_single_pass(jobs):
    diff = CMP.multiset_diff(U.separate_aggregates_long(jobs), U.single_pass_long(jobs),
                             drop_zero="value").collect()
    assert len(diff) == 1 and diff[0].identical and diff[0].left_only == 0


def test_multiset_diff_detects_changes(spark, jobs):
    first = jobs.orderBy("job_id", "line_no").first()
    one = U.single_pass_long(jobs.where((F.col("job_id") != first.job_id) | (F.col("line_no") != first.line_no)))
    changed = CMP.multiset_diff(U.separate_aggregates_long(jobs), one, drop_zero="value").collect()[0]
    assert changed.left_only == changed.right_only > 0 and not changed.identical      # one job less on one side
    left = U.single_pass_long(jobs)
    right = left.where(F.col("metric") != "jobs_ehpc")
    r = CMP.multiset_diff(left, right).collect()[0]
    assert (r.left_only, r.right_only, r.identical) == (3, 0, False)
    r2 = CMP.multiset_diff(left.limit(0), right.limit(0)).collect()[0]
    assert (r2.left_only, r2.right_only, r2.identical) == (0, 0, True)


def test_missing_cluster_month_is_zero(spark):
    # December 2001 is after the data: every metric zero, all 9 rows present.
    rows = P.report_windows(TT.jobs(spark, SF01), 2001, 12).collect()
    assert len(rows) == 9
    dec = [r for r in rows if r.tag == "month"]
    assert all(r.completed_jobs == 0 and r.hours_nonlocal == 0.0 for r in dec)


def test_expected_may_1998(spark):
    """Values published with the test-table adapter (May 1998, sf0.01)."""
    rows = {(r.tag, r.cluster): r for r in P.report_windows(TT.jobs(spark, SF01), 1998, 5).collect()}
    expected = {
        ("month", "AMD"): (91, 164, 10748.769166666667),
        ("month", "ARM"): (94, 155, 8652.25138888889),
        ("month", "GPU"): (84, 150, 22660.15111111111),
        ("quarter", "AMD"): (244, 467, 27777.383611111112),
        ("quarter", "ARM"): (249, 446, 25106.786944444444),
        ("quarter", "GPU"): (221, 423, 62389.515),
        ("ytd", "AMD"): (396, 744, 44045.146944444445),
        ("ytd", "ARM"): (424, 742, 43309.78166666667),
        ("ytd", "GPU"): (378, 703, 103042.71722222223),
    }
    for k, (c, j, h) in expected.items():
        r = rows[k]
        assert (r.completed_jobs, r.jobs_nonlocal, r.hours_nonlocal) == (c, j, h)


def test_calendar_labels(spark):
    cal = {r.tag: r for r in P.report_calendar(spark, 2026, 1).collect()}
    assert cal["month"].label == "01/01/2026 - 31/01/2026" and cal["month"].ndays == 31
    assert cal["quarter"].label == "01/01/2026 - 31/01/2026"
    cal = {r.tag: r for r in P.report_calendar(spark, 2024, 3, ytd_start=dt.date(2023, 12, 1)).collect()}
    assert cal["quarter"].label == "01/01/2024 - 31/03/2024" and cal["quarter"].ndays == 91
    assert cal["ytd"].label == "01/12/2023 - 31/03/2024" and cal["ytd"].ndays == 122
    assert cal["month"].hours == 31 * 24


def test_params_layout(spark):
    lines = PRM.report_tex_lines(TT.jobs(spark, SF01), 1998, 5).orderBy("ordinal").collect()
    assert [r.ordinal for r in lines] == list(range(1, 71))
    text = [r.line for r in lines]
    assert text[0] == "\\def\\reportPeriod{01/05/1998 - 31/05/1998}"
    assert text[3] == "\\def\\reportMonth{May}"
    assert text[4] == "\\def\\reportYear{1998}"
    assert text[5] == "\\def\\armnodes{1632}"
    assert text[8] == "\\def\\percentaviail{0.8}"
    assert "\\def\\amdusedhours{10748.769166666667}" in text
    assert "\\def\\armJobsTrimester{446}" in text
    assert text[-1] == "\\def\\hoursYear{{\\inteval{\\ndaysYear * 24}}}"
    assert [t.split("{")[0][5:] for t in text] == S.PARAM_KEYS


def test_params_absent_cluster_prints_integer_zero(spark):
    lines = {r.line.split("{")[0][5:]: r.line for r in
             PRM.report_tex_lines(TT.jobs(spark, SF01), 2001, 12).collect()}
    assert lines["gpuusedhours"] == "\\def\\gpuusedhours{0}"
    assert lines["gpuJobs"] == "\\def\\gpuJobs{0}"


def test_reports_from_saved_grain(spark, jobs, tmp_path):
    grain = P.save_month_grain(jobs, str(tmp_path / "grain"))
    for y, m in [(1998, 5), (1996, 1), (2001, 11)]:
        a = sorted(tuple(r) for r in P.windows_from_grain(grain, y, m).collect())
        b = sorted(tuple(r) for r in P.report_windows(jobs, y, m).collect())
        assert a == b


def test_ytd_start_override_changes_label_and_days_only(spark, jobs):
    plain = {r.key: r for r in PRM.report_params(jobs, 1998, 3).collect()}
    moved = {r.key: r for r in PRM.report_params(jobs, 1998, 3, ytd_start=dt.date(1997, 12, 1)).collect()}
    assert plain["reportPeriodYear"].text_value == "01/01/1998 - 31/03/1998"
    assert moved["reportPeriodYear"].text_value == "01/12/1997 - 31/03/1998"
    assert (plain["ndaysYear"].num_value, moved["ndaysYear"].num_value) == (90.0, 121.0)
    changed = {k for k in plain if plain[k] != moved[k]}
    assert changed == {"reportPeriodYear", "ndaysYear"}


def test_all_months_fills_months_without_jobs(spark):
    ddl = ("Partition string, Account string, State string, AllocCPUS bigint, AllocTRES string, "
           "ElapsedRaw bigint, NNodes bigint, year int, month int")
    rows = [("normal-arm", "f1", "COMPLETED", 1, None, 100, 1, 2024, 11),
            ("normal-arm", "f1", "FAILED", 1, None, 10, 2, 2025, 2)]
    from sacctlens.functions import enrich as EN
    from sacctlens.sources.local import local_rows
    got = {(r.year, r.month, r.tag, r.cluster): r for r in
           P.report_all_months(EN.enrich(local_rows(spark, rows, ddl))).collect()}
    assert sorted({(y, m) for y, m, _, _ in got}) == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]
    assert got[(2024, 12, "month", "ARM")].completed_jobs == 0
    assert got[(2024, 12, "quarter", "ARM")].completed_jobs == 1        # Oct..Dec 2024
    assert got[(2025, 1, "quarter", "ARM")].completed_jobs == 0         # clipped at January
    assert got[(2025, 2, "ytd", "ARM")].seconds_nonlocal == 20
    assert got[(2025, 2, "ytd", "ARM")].failed_jobs == 1
