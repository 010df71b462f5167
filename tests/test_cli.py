"""The three command-line programs end to end on small files."""

import os

from sacctlens.cli import main
from test_sources import FEB, JAN, _events_plain, _stage


def _part(folder):
    return [os.path.join(folder, f) for f in os.listdir(folder) if f.startswith("part-")][0]


def test_report_command(spark, tmp_path):
    d = tmp_path / "data"
    d.mkdir()
    (d / "jobs_Jan.txt").write_text(JAN)
    (d / "jobs_Feb.txt").write_text(FEB)
    out = str(tmp_path / "out")
    main(["report", "--datadir", str(d), "--year", "2026", "--month", "Feb", "--out", out], spark=spark)
    lines = open(_part(out)).read().splitlines()
    assert len(lines) == 70
    assert lines[0] == "\\def\\reportPeriod{01/02/2026 - 28/02/2026}"
    assert "\\def\\armusedhoursYear{4.0}" in lines          # 2 x 7200 s non-local ARM
    assert "\\def\\armusedhours{2.0}" in lines
    assert "\\def\\ndaysYear{59}" in lines


def test_runs_and_compare_commands(spark, tmp_path):
    for cfg, walls in (("baseline", (10000, 12000)), ("final", (4000, 6000))):
        logs = tmp_path / f"logs_{cfg}"
        logs.mkdir()
        for i, w in enumerate(walls):
            (logs / f"app-{i}").write_text(_events_plain(1000 * (i + 1), 1000 * (i + 1) + w,
                                                         [_stage("SparkListenerStageSubmitted", 3)]))
        main(["runs", "--logs-dir", str(logs), "--config-name", cfg, "--out",
              str(tmp_path / "metrics" / cfg)], spark=spark)
    out = str(tmp_path / "cmp")
    main(["compare", "--summaries", str(tmp_path / "metrics"), "--out", out], spark=spark)
    csv = open(_part(out + "/csv")).read().splitlines()
    assert csv[1].startswith("baseline,11.00 ± 1.41,1.0,3.0")
    assert csv[2].startswith("final,5.00 ± 1.41")
    speed = dict(line.split(",")[0::2] for line in open(_part(out + "/speedup")).read().splitlines())
    assert speed == {"baseline": "1.0", "final": "2.2"}


def test_report_several_months_one_scan(spark, tmp_path):
    d = tmp_path / "data"
    d.mkdir()
    (d / "jobs_Jan.txt").write_text(JAN)
    (d / "jobs_Feb.txt").write_text(FEB)
    out = str(tmp_path / "out")
    main(["report", "--datadir", str(d), "--year", "2026", "--months", "Jan,Feb", "--out", out], spark=spark)
    single = str(tmp_path / "single")
    main(["report", "--datadir", str(d), "--year", "2026", "--month", "Feb", "--out", single], spark=spark)
    assert open(_part(out + "/Feb")).read() == open(_part(single)).read()
    jan = open(_part(out + "/Jan")).read().splitlines()
    assert jan[0] == "\\def\\reportPeriod{01/01/2026 - 31/01/2026}" and "\\def\\armusedhours{2.0}" in jan


def test_previous_month_default():
    import datetime as dt

    from sacctlens.cli import previous_month
    assert previous_month(dt.date(2026, 1, 15)) == (2025, 12)
    assert previous_month(dt.date(2026, 3, 1)) == (2026, 2)


def test_runs_command_reports_what_is_missing(spark, tmp_path, capsys):
    import gzip

    import pytest
    empty = tmp_path / "none"
    empty.mkdir()
    with pytest.raises(SystemExit, match="no event log"):
        main(["runs", "--logs-dir", str(empty), "--config-name", "c", "--out", str(tmp_path / "o1")], spark=spark)
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "app-1").write_text(_events_plain(1000, 3000, [_stage("SparkListenerStageSubmitted", 1)]) + "not json\n")
    (logs / "app-2.gz").write_bytes(gzip.compress(b"x" * 100000)[:-20])
    main(["runs", "--logs-dir", str(logs), "--config-name", "c", "--runs", "3", "--out", str(tmp_path / "o2")], spark=spark)
    said = capsys.readouterr().err
    assert "2 of 3 runs" in said and "app-2 cannot be decoded" in said and "app-1: 1 malformed" in said


def test_compare_command_names_unreadable_summaries(spark, tmp_path, capsys):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "app-1").write_text(_events_plain(1000, 3000, []))
    main(["runs", "--logs-dir", str(logs), "--config-name", "baseline", "--runs", "1", "--out", str(tmp_path / "m")], spark=spark)
    (tmp_path / "m" / "broken.json").write_text("{nope")
    main(["compare", "--summaries", str(tmp_path / "m"), "--out", str(tmp_path / "out")], spark=spark)
    assert "broken.json" in capsys.readouterr().err
    assert open(_part(str(tmp_path / "out" / "csv"))).read().splitlines()[1].startswith("baseline,2.00 ± 0.00")


def test_report_warns_of_rows_that_do_not_fit(spark, tmp_path, capsys):
    rows = "Partition|Account|State|AllocCPUS|AllocTRES|ElapsedRaw|NNodes\nnormal-arm|f1|COMPLETED|48||3600|1\nnormal-arm|f1|COMPLETED\nnormal-arm|f1|COMPLETED|x||1|1\n"
    (tmp_path / "jobs_Jan.txt").write_text(rows)
    for months in (["--month", "Jan"], ["--months", "Jan"], ["--months", "Jan,Feb"]):
        main(["report", "--datadir", str(tmp_path), "--year", "2025", *months, "--out", str(tmp_path / "out" / "-".join(months))], spark)
        assert "jobs_Jan: 1 rows with too few cells, 0 with too many, 1 with numbers that do not parse" in capsys.readouterr().err
