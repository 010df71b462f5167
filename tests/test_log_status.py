"""Event logs of any size and state: figures or ``readable = false``, and no file fails the job."""

import gzip
import json
import os
import threading

import pytest
import zstandard

from sacctlens.operators import compare as CMP
from sacctlens.operators import runs as R
from sacctlens.sources import eventlogs as EL
from sacctlens.sources import logsource as LS


def log(start, end, stages, filler=0):
    events = [{"Event": "SparkListenerApplicationStart", "App ID": "a", "Timestamp": start}] if start else []
    events += [{"Event": "SparkListenerStageSubmitted", "Stage Info": {"Stage ID": k, "Number of Tasks": 2}} for k in range(stages)]
    events += [{"Event": "SparkListenerOther", "Text": "é" * 40 + str(k)} for k in range(filler)]
    events += [{"Event": "SparkListenerApplicationEnd", "Timestamp": end}] if end else []
    return ("\n".join(json.dumps(e, ensure_ascii=False) for e in events) + "\n").encode()


def zst(body):
    return zstandard.ZstdCompressor().compress(body)


@pytest.fixture()
def folder(tmp_path):
    whole = log(1000, 9000, 3, filler=2000)
    (tmp_path / "a-plain").write_bytes(whole)
    (tmp_path / "b-whole.gz").write_bytes(gzip.compress(whole[:5000]) + gzip.compress(whole[5000:]))
    (tmp_path / "c-whole.zstd").write_bytes(zst(whole[:7000]) + zst(whole[7000:]))
    (tmp_path / "d-cut.gz").write_bytes(gzip.compress(whole)[:-30])
    (tmp_path / "e-cut.zst").write_bytes(zst(whole)[:-9])
    (tmp_path / "f-garbage.gz").write_bytes(b"this is no gzip stream" * 40)
    (tmp_path / "g-garbage.zstd").write_bytes(b"nor a zstd one" * 40)
    (tmp_path / "h-codec.lz4").write_bytes(b"LZ4Block....")
    (tmp_path / "i-empty").write_bytes(b"")
    (tmp_path / "j-empty.gz").write_bytes(b"")
    (tmp_path / "k-open.zstd.inprogress").write_bytes(zst(log(1000, None, 2)) + zst(log(None, None, 5, 900))[:-40])
    rolled = tmp_path / "run-l"
    rolled.mkdir()
    (rolled / "events_1_l.zstd").write_bytes(zst(log(1000, None, 2)))
    (rolled / "events_2_l").write_bytes(log(None, None, 1) + b'{"Event": "SparkListenerStageSubm')
    (rolled / "appstatus_l.inprogress").write_bytes(b"")
    broken = tmp_path / "run-m"
    broken.mkdir()
    (broken / "events_1_m").write_bytes(log(1000, 5000, 2))
    (broken / "events_2_m.zstd").write_bytes(b"garbage")
    (tmp_path / "n-lines").write_bytes(b"\n" + log(1000, 3000, 1)[:-1] + b"\n\xff\xfe not json\n[1]\n   \nlast line without end")
    return tmp_path


def test_every_log_has_figures_or_is_unreadable(spark, folder):
    got = {r.log_id: r for r in CMP.log_run_metrics(spark, str(folder), "cfg").collect()}
    assert {k: r.readable for k, r in got.items()} == {
        "a-plain": True, "b-whole": True, "c-whole": True, "d-cut": False, "e-cut": False, "f-garbage": False, "g-garbage": False,
        "h-codec": False, "i-empty": True, "j-empty": True, "k-open": True, "run-l": True, "run-m": False, "n-lines": True}
    for k, r in got.items():
        if not r.readable:
            assert (r.wall_time_s, r.stages, r.tasks, r.shuffle_read_mb, r.shuffle_write_mb, r.driver_time_s) == (0.0, 0, 0, 0.0, 0.0, 0.0)
    for k in ("a-plain", "b-whole", "c-whole"):
        assert (got[k].wall_time_s, got[k].stages, got[k].tasks) == (8.0, 3, 6)
    assert got["k-open"].stages >= 2 and got["k-open"].wall_time_s == 0.0
    assert (got["run-l"].stages, got["run-l"].wall_time_s) == (3, 0.0)
    states = {r.log_id: r for r in EL.log_statuses(EL.scan_event_logs(spark, str(folder))).collect()}
    assert {k for k, r in states.items() if r.still_open} == {"k-open", "run-l"}
    assert states["n-lines"].bad_lines >= 2 and states["run-l"].bad_lines == 0
    assert EL.undecodable_logs(spark, str(folder)) == ["d-cut", "e-cut", "f-garbage", "g-garbage", "h-codec", "run-m"]


def test_one_pass_over_the_files(spark, folder, monkeypatch):
    from sacctlens.plans.explain import plan_text
    plan = plan_text(CMP.log_run_metrics(spark, str(folder), "cfg"))
    assert plan.count("BatchScan") == 1 and "Join" not in plan


@pytest.mark.parametrize("split", [1, 2, 7, 100, 4096, 1 << 20])
def test_ranges_of_plain_files_share_out_the_lines(tmp_path, split):
    bodies = {"one": b"a\nbb\n\nccc\n", "two": b"\n\n\n", "three": b"no end", "four": "é\nß".encode() * 30, "five": b"x" * 300 + b"\n" + b"y" * 10}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    reader = LS.LogReader(str(tmp_path), split)
    got = {}
    for part in reader.partitions():
        for batch in reader.read(part):
            for line, status in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                assert (line is None) == (status == "whole")
                got.setdefault(part.name, []).extend([line] if line is not None else [])
    assert got == {name: [x.decode() for x in body.split(b"\n") if x.strip()] for name, body in bodies.items()}


def test_ranges_give_the_same_figures(spark, folder):
    events = lambda split: EL.log_run_events(EL.scan_event_logs(spark, str(folder), split), "cfg")
    figures = lambda split: sorted(map(tuple, R.run_metrics(events(split), ("log_id", "config")).collect()))
    assert figures(3001) == figures(1 << 30)


def test_logs_that_grow_or_vanish_while_they_are_read(spark, folder):
    """The plan is made over the files as listed; a writer appends, and a file goes."""
    reader = LS.LogReader(str(folder), LS.SPLIT)
    parts = {p.name: p for p in reader.partitions()}
    with open(folder / "a-plain", "ab") as f:
        f.write(b"half a li")
    os.remove(folder / "b-whole.gz")
    status = lambda name: [s for b in reader.read(parts[name]) for s in b.column(4).to_pylist() if s][-1]
    lines = [x for b in reader.read(parts["a-plain"]) for x in b.column(3).to_pylist() if x]
    assert len(lines) == 2005 and status("a-plain") == "whole" and status("b-whole.gz") == "unreadable"


def test_a_running_application_never_fails_the_others(spark, folder):
    stop = threading.Event()

    def write():
        with open(folder / "z-app.inprogress", "ab", buffering=0) as f:
            f.write(log(1000, None, 1))
            while not stop.is_set():
                f.write(log(None, None, 1))
                f.write(b'{"Event": "Spark')
                f.write(b'ListenerOther"}\n')
    writer = threading.Thread(target=write)
    writer.start()
    try:
        for _ in range(2):
            got = {r.log_id: r for r in CMP.log_run_metrics(spark, str(folder), "cfg").collect()}
            assert got["z-app"].readable and got["z-app"].stages >= 1 and got["a-plain"].stages == 3
    finally:
        stop.set()
        writer.join()


def test_pieces_bound_the_memory(tmp_path):
    """A stream of 200 MB passes in pieces; a line beyond the bound counts as malformed."""
    import resource
    import zlib
    packer = zlib.compressobj(1, wbits=31)
    block = b'{"Event": "SparkListenerOther"}\n' * 4096
    with open(tmp_path / "big.gz", "wb") as f:
        for _ in range(1600):
            f.write(packer.compress(block))
        f.write(packer.flush())
    reader = LS.LogReader(str(tmp_path), LS.SPLIT)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    rows = sum(b.num_rows for b in reader.read(reader.partitions()[0]))
    assert rows == 1600 * 4096 + 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 150_000
    assert list(LS.lines_of(iter([b"x" * (LS.LONGEST_LINE + 1), b"y\nnext\n"]), False, None, True)) == [LS.TOO_LONG.encode(), b"next"]


def test_empty_folder(spark, tmp_path):
    assert CMP.log_run_metrics(spark, str(tmp_path), "cfg").count() == 0
