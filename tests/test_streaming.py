"""The streamed month grain equals the batch report, and files are folded in once."""

from sacctlens.operators import periods as P
from sacctlens.sources import jobs as J
from sacctlens.streaming import usage_stream as US

COLUMNS = ["JobID", "Partition", "Account", "State", "AllocCPUS", "AllocTRES", "ElapsedRaw", "NNodes", "User"]
HEAD = "|".join(COLUMNS) + "\n"
JAN = HEAD + ("1|normal-arm|f001|COMPLETED|48|cpu=48|3600|2|u\n"
              "2|dev-a100-40|ee01|CANCELLED by 77|33|cpu=33,gres/gpu=3|7200|1|u\n"
              "3|normal-x86|lab|FAILED|8|cpu=8|100|1|u\n")
FEB = HEAD + "4|normal-arm|ee2|COMPLETED|48|cpu=48|60|3|u\n"
MAR = HEAD + "5|dev-a100-80|f1|COMPLETED|8|gres/gpu=2|1000|1|u\n"


def _report(spark, path, month):
    grain = US.read_month_grain(spark, path)
    return sorted(tuple(r) for r in P.windows_from_grain(grain, 2025, month).collect())


def _batch(spark, landing, month):
    jobs = J.read_enriched_jobs(spark, landing, 2025)
    return sorted(tuple(r) for r in P.report_windows(jobs, 2025, month).collect())


def test_stream_matches_batch_and_is_incremental(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "jobs_Jan.txt").write_text(JAN)
    (landing / "jobs_Feb.txt").write_text(FEB)
    grain = str(tmp_path / "grain")
    ckpt = str(tmp_path / "ckpt")
    q = US.start_month_grain(spark, str(landing), 2025, COLUMNS, grain, checkpoint=ckpt)
    q.awaitTermination(120)
    assert _report(spark, grain, 2) == _batch(spark, str(landing), 2)

    (landing / "jobs_Mar.txt").write_text(MAR)
    q = US.start_month_grain(spark, str(landing), 2025, COLUMNS, grain, checkpoint=ckpt)
    q.awaitTermination(120)
    progress = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert sum(p["numInputRows"] for p in progress) == 1        # only the new file was read
    assert _report(spark, grain, 3) == _batch(spark, str(landing), 3)
