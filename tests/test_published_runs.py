"""Recompute the published per-configuration summary from the 24 published runs."""

import pytest

from sacctlens.operators import compare as CMP
from sacctlens.sources.local import local_rows

# Published wall times (s) of the 3 runs per configuration, and the published
# mean, sample std and speedup (fixed values).
WALLS = {
    "baseline": (66.34, 66.31, 65.64), "v2": (52.77, 52.70, 51.68), "v3": (50.32, 50.18, 49.72),
    "v4": (42.14, 42.08, 42.14), "v5": (40.60, 39.62, 40.12), "v6": (39.35, 39.01, 38.99),
    "v7": (33.37, 34.04, 34.04), "final": (31.54, 31.57, 31.66),
}
EXPECTED = {
    "baseline": (66.0967, 0.3958, 1.00), "v2": (52.3833, 0.6101, 1.26), "v3": (50.0733, 0.3139, 1.32),
    "v4": (42.1200, 0.0346, 1.57), "v5": (40.1133, 0.4900, 1.65), "v6": (39.1167, 0.2023, 1.69),
    "v7": (33.8167, 0.3868, 1.95), "final": (31.5900, 0.0624, 2.09),
}


@pytest.fixture(scope="module")
def summary(spark):
    rows = [(cfg, i + 1, i + 1, w) for cfg, ws in WALLS.items() for i, w in enumerate(ws)]
    runs = local_rows(spark, rows, "config string, run_no int, run bigint, wall_time_s double")
    return CMP.config_summary(runs, metrics=["wall_time_s"])


def test_mean_std_speedup(summary):
    sp = {r.config: r for r in CMP.speedup_vs_baseline(summary, baseline="baseline").collect()}
    got = {r.config: r for r in summary.collect()}
    for cfg, (mean, std, speedup) in EXPECTED.items():
        assert got[cfg].n_runs == 3
        assert round(got[cfg].mean_wall_time_s, 4) == pytest.approx(mean, abs=1e-4)
        assert round(got[cfg].std_wall_time_s, 4) == pytest.approx(std, abs=1e-4)
        assert round(sp[cfg].speedup, 2) == speedup


def test_display_order_and_format(spark, summary):
    full = summary.select("config", "n_runs", "mean_wall_time_s", "std_wall_time_s")
    for m in ["stages", "tasks", "shuffle_read_mb", "shuffle_write_mb", "peak_memory_mb", "driver_time_s"]:
        full = full.selectExpr("*", f"CAST(NULL AS DOUBLE) AS mean_{m}", f"CAST(NULL AS DOUBLE) AS std_{m}")
    extra = local_rows(spark, [("zz", 1, 1.0, None)],
                       "config string, n_runs bigint, mean_wall_time_s double, std_wall_time_s double")
    for m in ["stages", "tasks", "shuffle_read_mb", "shuffle_write_mb", "peak_memory_mb", "driver_time_s"]:
        extra = extra.selectExpr("*", f"CAST(NULL AS DOUBLE) AS mean_{m}", f"CAST(NULL AS DOUBLE) AS std_{m}")
    table = CMP.config_summary_display(full.unionByName(extra)).orderBy("ordinal").collect()
    assert [r.Configuration for r in table] == list(WALLS) + ["zz"]
    assert table[0]["Runtime (s)"] == "66.10 ± 0.40"
    assert table[-1]["Runtime (s)"] == "1.00 ± 0.00"   # n = 1: std shown as 0


def test_summary_document(spark):
    rows = [("v2", 1, 11, 1.0), ("v2", 2, 12, 3.0)]
    runs = local_rows(spark, rows, "config string, run_no int, run bigint, wall_time_s double")
    doc = CMP.summary_document(runs, metrics=["wall_time_s"]).collect()[0]
    assert [r.run for r in doc.runs] == [11, 12]
    assert doc.summary.n_runs == 2 and doc.summary.mean.wall_time_s == 2.0
