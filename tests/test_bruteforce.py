"""Spark report vs a plain-Python brute force over random accounting rows."""

import re

import numpy as np
import pytest

from sacctlens.functions import enrich as E
from sacctlens.operators import periods as P
from sacctlens.sources.local import local_rows

PARTITIONS = ["normal-arm", "dev-a100-40", "a100", "ARM", "x86", "arm-a100", "gpu", None, "normal-a100-80"]
ACCOUNTS = ["f2025", "ee01", "e1", "lab", "F1", "eef", None, "fx"]
STATES = ["COMPLETED", "FAILED", "CANCELLED by 12", "TIMEOUT", "completed", None, "RUNNING"]
TRES = [None, "cpu=8", "cpu=8,gres/gpu=2", "gres/gpu:a100=4", "cpu=4,gres/gpu=12,gres/gpu=3", "gres/gpu=7,node=1"]


def _rows(n, seed=11):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        elapsed = None if rng.random() < 0.03 else int(rng.integers(0, 200000))
        rows.append((PARTITIONS[rng.integers(len(PARTITIONS))], ACCOUNTS[rng.integers(len(ACCOUNTS))],
                     STATES[rng.integers(len(STATES))], int(rng.integers(0, 256)),
                     TRES[rng.integers(len(TRES))], elapsed, int(rng.integers(1, 9)),
                     int(rng.choice([2024, 2025])), int(rng.integers(1, 13))))
    return rows


def _expected(rows, year, month):
    """Brute force: loop over windows and rows."""
    windows = {"month": [month], "quarter": list(range(max(1, month - 2), month + 1)),
               "ytd": list(range(1, month + 1))}
    out = {(t, c): [0] * 6 for t in windows for c in ("ARM", "AMD", "GPU")}
    for part, acct, state, cpus, tres, elapsed, nodes, y, m in rows:
        p = part or ""
        cl = "ARM" if "arm" in p else "GPU" if "a100" in p else "AMD"
        ag = "FCT" if (acct or "").startswith("f") else "EHPC" if (acct or "").startswith("ee") else "LOCAL"
        if "a100" in p:
            hit = re.search(r"gres/gpu=(\d+)", tres) if tres is not None else None
            units = nodes if tres is None else int(hit.group(1)) if hit else nodes * 4
        else:
            units = nodes
        secs = None if elapsed is None else elapsed * units
        for tag, months in windows.items():
            if y != year or m not in months:
                continue
            v = out[(tag, cl)]
            v[0 if state == "COMPLETED" else 1] += 1
            if ag != "LOCAL":
                v[2] += 1
                v[3] += secs or 0
            if ag == "EHPC":
                v[4] += 1
                v[5] += secs or 0
    return {k: tuple(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def data(spark):
    rows = _rows(4000)
    ddl = ("Partition string, Account string, State string, AllocCPUS bigint, AllocTRES string, "
           "ElapsedRaw bigint, NNodes bigint, year int, month int")
    return rows, E.enrich(local_rows(spark, rows, ddl)).cache()


@pytest.mark.parametrize("year,month", [(2025, 1), (2025, 2), (2024, 3), (2024, 7), (2025, 12)])
def test_report_equals_brute_force(data, year, month):
    rows, jobs = data
    got = {(r.tag, r.cluster): (r.completed_jobs, r.failed_jobs, r.jobs_nonlocal, r.seconds_nonlocal,
                                r.jobs_ehpc, r.seconds_ehpc)
           for r in P.report_windows(jobs, year, month).collect()}
    assert got == _expected(rows, year, month)


def test_all_months_equals_brute_force(data):
    rows, jobs = data
    got = {}
    for r in P.report_all_months(jobs).collect():
        got.setdefault((r.year, r.month), {})[(r.tag, r.cluster)] = (
            r.completed_jobs, r.failed_jobs, r.jobs_nonlocal, r.seconds_nonlocal, r.jobs_ehpc, r.seconds_ehpc)
    assert len(got) == 24
    for (y, m), table in got.items():
        assert table == _expected(rows, y, m), (y, m)
